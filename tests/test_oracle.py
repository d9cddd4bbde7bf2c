"""Every registered query against its SQL twin, and what its plan must not contain."""

import re

import pytest
from helpers import plan_text
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from fleetstats.plans.all import REGISTRY

# The text operators have tests of their own.
NAMES = list(REGISTRY)

# Pair-wise joins and Python rows.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "ExistingRDD"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(NAMES) <= set(queries()) and set(NAMES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_by_a_sound_plan(spark, con, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    plan = plan_text(df)
    assert not [word for word in FORBIDDEN if word in plan]
    # one partition only where a global aggregate has been reduced to a row per task
    for exchange in re.finditer(r"Exchange SinglePartition.*\n(.*)", plan):
        assert "partial_" in exchange[1], exchange[0]
    assert compare(df, con, name) is None
