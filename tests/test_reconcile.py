"""Stores compared by digests."""

import random

import pytest
from helpers import plan_text, rows
from pyspark.sql import functions as F

from fleetstats.operators import reconcile as rec


def plain_diff(a, b):
    out = []
    for day in {d for d, _ in a + b}:
        left, right = ({i for d, i in side if d == day} for side in (a, b))
        if left != right:
            out.append((day, len(left - right), len(right - left), len(left), len(right), len(left ^ right)))
    return sorted(out, key=str)


def table(spark, side):
    return spark.createDataFrame([(d, i, "x") for d, i in side], "day STRING, id STRING, other STRING").repartition(3)


def found(df):
    return sorted(rows(df, "day", "only_a", "only_b", "ids_a", "ids_b", "missing"), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_full_comparison(spark, seed):
    rng = random.Random(seed)
    a = [(rng.choice(["d1", "d2", "d3", None]), f"id{i}") for i in range(400)]
    b = [r for r in a if r[0] != "d1" and rng.random() < 0.97] + [r for r in a if r[0] == "d1"] + [("d2", "extra"), ("d9", "new")]
    a.append(("d3", None))
    left, right = table(spark, a), table(spark, b)
    assert found(rec.id_diff_by_digest(left, right, "id", "day", buckets=8)) == plain_diff(a, b) == found(rec.id_diff(left, right, "id", "day"))


def test_repeated_ids(spark):
    a = [("d", "x"), ("d", "x"), ("d", "y"), ("e", "z"), ("e", "z"), ("e", "q"), *[("e", f"i{i % 20}") for i in range(60)]]
    b = [("d", "x"), ("d", "y"), ("d", "y"), ("e", "z"), ("e", "z"), *[("e", f"i{i % 20}") for i in range(60)]]
    left, right = table(spark, a), table(spark, b)
    assert found(rec.id_diff_by_digest(left, right, "id", "day", 16, repeated=True)) == plain_diff(a, b)
    # without it ids of agreeing parts count as often as they stand there; what only one store has is the same
    assert [r[:3] for r in found(rec.id_diff_by_digest(left, right, "id", "day", 16))] == [r[:3] for r in plain_diff(a, b)]


def test_repeats_that_cancel_by_xor_are_seen(spark):
    a, b = [("d", "x"), ("d", "x")], [("d", "y"), ("d", "y")]
    assert found(rec.id_diff_by_digest(table(spark, a), table(spark, b), "id", "day", 1)) == plain_diff(a, b)


def test_empty_and_equal_stores(spark):
    a = table(spark, [("d", "x"), ("e", "y")])
    assert found(rec.id_diff_by_digest(a, a, "id", "day")) == []
    assert found(rec.id_diff_by_digest(a, a.limit(0), "id", "day")) == [("d", 1, 0, 1, 0, 1), ("e", 1, 0, 1, 0, 1)]
    assert found(rec.id_diff_by_digest(a.limit(0), a.limit(0), "id", "day")) == []


def test_ids_of_parts_that_agree_are_not_shuffled(spark, tmp_path):
    a = spark.range(20000).select(F.concat(F.lit("day"), F.col("id") % 10).alias("day"), F.col("id").cast("string").alias("id"))
    b = a.where("id <> 1234")
    rec.compare_buckets(a, b, "id", "day", 32).write.parquet(f"{tmp_path}/compared")
    compared = spark.read.parquet(f"{tmp_path}/compared")
    parts = compared.where(~F.col("same"))
    assert parts.count() == 1
    left = rec.in_parts(a, parts, "id", "day", 32)
    assert left.count() < 20000 / 10 / 32 * 2
    plan = plan_text(left.distinct())
    # the rows meet the parts before their first exchange
    assert "BroadcastHashJoin" in plan and plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")
    assert "hashpartitioning" not in plan[plan.index("BroadcastHashJoin"):]
    digests = plan_text(rec.bucket_digests(a, "id", "day", 32))
    assert digests.index("Exchange hashpartitioning(day") < digests.index("partial_count") and "SortAggregate" not in digests
