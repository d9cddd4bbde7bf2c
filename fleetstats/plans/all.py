"""Imports every module that registers queries."""

from __future__ import annotations

from fleetstats.plans import (  # noqa: F401
    alerts, catalogue, efficiency, logs, messages, quality, reports, search, streams,
)
from fleetstats.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
