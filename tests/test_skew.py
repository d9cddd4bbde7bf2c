"""One key holding a third of all rows."""

import json
from contextlib import contextmanager

from helpers import plan_text, rows
from pyspark.sql import functions as F

from fleetstats.operators import alerts as al
from fleetstats.operators import catalogue as cat
from fleetstats.operators import messages as msg
from fleetstats.operators import quality
from fleetstats.operators import reconcile as rec
from fleetstats.operators import reports as rep
from fleetstats.operators import steps

N = 60_000


@contextmanager
def settings(spark, **values):
    """Session settings for small data: what counts as skewed, and no broadcast."""
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


def hot(column="id"):
    """Key 0 for a third of the rows, else a key of their own."""
    return F.when(F.col(column) % 3 == 0, F.lit(0).cast("long")).otherwise(F.col(column))


def final_plan(df):
    count = df.count()
    executed = df.agg(F.count("*"))  # a fresh plan, run to its end below
    executed.collect()
    return count, executed._jdf.queryExecution().executedPlan().toString()


def test_hot_block_is_split(spark):
    with settings(spark, **SMALL_SKEW):
        files = spark.range(0, N, 1, 8).select(
            F.col("id").alias("file"), hot().alias("block_id"), (F.col("id") % 50).alias("dataset_id"),
            F.lit(5).alias("file_creation_date"), F.lit(None).cast("long").alias("file_modification_date"),
            F.sha2(F.col("id").cast("string"), 256).alias("name"),
        )
        blocks = spark.range(N).select(F.col("id").alias("block_id"), F.lit("b").alias("block"))
        datasets = spark.range(50).select(F.col("id").alias("dataset_id"), F.lit("d").alias("dataset"))
        joined = cat.changed_files(files, blocks, datasets, 0, 10)
        assert joined.count() == N
        joined.write.format("noop").mode("overwrite").save()
        _, plan = final_plan(joined.select("name", "block", "dataset"))
        assert "skew=true" in plan


def test_hot_name_in_a_semi_join(spark):
    with settings(spark, **SMALL_SKEW):
        alerts = spark.range(0, N, 1, 8).select(
            hot().cast("string").alias("name"), F.lit("s").alias("service"), F.lit("").alias("tag"),
            F.when(F.col("id") == 3, "urgent").otherwise("info").alias("severity"),
        )
        assert al.filter_alerts(alerts, severity="urgent").count() == N // 3


def test_hot_id_in_reconciliation(spark):
    a = spark.range(0, N, 1, 8).select(hot().alias("id"), F.lit("d").alias("day"))
    b = a.where("id <> 4")
    assert rows(rec.id_diff(a, b, "id", "day"), "only_a", "only_b", "ids_b") == [(1, 0, N - N // 3)]


def test_hot_prefix(spark):
    names = spark.range(0, N, 1, 8).select(
        F.concat(F.when(F.col("id") % 3 == 0, "hot_").otherwise("cold_"), "id").alias("name")
    )
    prefixes = spark.createDataFrame([("hot_",), ("hot_1",), ("zzz",)], "p STRING")
    found = rep.prefix_matches(names, "name", prefixes, "p").groupBy("p").count()
    ones = sum(str(i).startswith("1") for i in range(0, N, 3))
    assert dict(rows(found)) == {"hot_": N // 3, "hot_1": ones}


def test_hot_site_counts(spark):
    df = spark.range(0, N, 1, 8).select(
        hot().cast("string").alias("site"), (F.col("id") % 7).cast("string").alias("exitCode")
    )
    assert msg.distinct_sites_and_codes(df).first() == (N - N // 3 + 1, 7)
    top = msg.top_codes_of_top_sites(msg.failing_codes(df), 1, 2)
    assert [(r.site, r["rank"]) for r in top.orderBy("rank").collect()] == [("0", 1), ("0", 2)]


def test_hot_task_counts(spark):
    """A task with a third of the rows, each of its sites and eras among them, is reduced before its counts move."""
    sums = [F.lit(1.0).alias(c) for c in (*steps._SUMMED, *(c + "_n" for c in steps._COUNTED))]
    grain = spark.range(0, N, 1, 8).select(
        hot().cast("string").alias("Task"), F.lit("s").alias("StepName"), F.lit("j").alias("JobType"),
        F.concat(F.lit("site"), F.col("id") % 300).alias("Site"), F.array(F.concat(F.lit("era"), F.col("id") % 90)).alias("acquisition_era"), *sums)
    counted = steps.task_counts(grain)
    assert rows(counted.where("Task = '0'"), "EraCount", "SiteCount") == [(30, 100)]
    plan = plan_text(counted)
    assert plan.count("partial_sum(cpu_time#") == 2  # before each of the two exchanges


def test_wide_contract(spark):
    """As many properties as a full job document has."""
    kinds = ["integer", "string", "number", "boolean"]
    values = {"integer": 1, "string": "x", "number": 0.5, "boolean": True}
    names = {f"key{i}": kinds[i % 4] for i in range(600)}
    contract = {"required": list(names), "properties": {k: {"type": t} for k, t in names.items()}}
    good = {k: values[t] for k, t in names.items()}
    docs = [good, {**good, "key4": "bad"}, {k: v for k, v in good.items() if k != "key9"}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc STRING")
    checked = rows(quality.validate_contract(df, "doc", contract), "missing_keys", "mistyped_keys", "valid")
    assert checked == [([], [], True), ([], ["key4"], False), (["key9"], [], False)]
