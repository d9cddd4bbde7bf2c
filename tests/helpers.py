"""Helpers of the tests."""

from __future__ import annotations


def plan_text(df) -> str:
    """The physical plan before run-time re-planning."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns) -> list[tuple]:
    chosen = df.select(*columns) if columns else df
    return [tuple(r) for r in chosen.collect()]
