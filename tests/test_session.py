"""Session settings and the example of the README."""

import re
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetstats.functions.numbers import thousands
from fleetstats.plans import views
from fleetstats import session
from fleetstats.session import prepare, scanned_bytes, shuffle_partitions
from fleetstats.sources import archive


def test_shuffles_grow_with_the_cluster():
    assert shuffle_partitions({}, 8) == 200
    assert shuffle_partitions({"spark.executor.instances": "1000", "spark.executor.cores": "4"}, 2) == 12_000
    assert shuffle_partitions({"spark.executor.instances": "1000"}, 2, 100 << 40) == 819_200
    assert shuffle_partitions({"spark.dynamicAllocation.maxExecutors": "100", "spark.sql.shuffle.partitions": "500"}, 2) == 500


def test_size_of_what_is_read(spark, sf_dir):
    size = sum(p.stat().st_size for p in [Path(f"{sf_dir}/orders.parquet")])
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert size <= scanned_bytes(orders.join(orders.alias("o"), "o_orderkey").groupBy().count()) <= 3 * size
    assert scanned_bytes(spark.createDataFrame([(1,)], "a INT").union(spark.range(1).selectExpr("CAST(id AS INT)"))) == 0


def test_own_settings_stay(spark):
    prepare(spark)
    before = spark.conf.get("spark.sql.objectHashAggregate.sortBased.fallbackThreshold")
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "77")
    assert prepare(spark).conf.get("spark.sql.objectHashAggregate.sortBased.fallbackThreshold") == "77"
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", before)


@pytest.mark.parametrize("key", [session.ADVISORY, session.SPLIT])
def test_tasks_read_little(spark, key):
    before = spark.conf.get(key)
    for owners, kept in (("128m", session.MOST_BYTES[key]), ("8MB", 8 << 20)):
        spark.conf.unset(session.PREPARED)
        spark.conf.set(key, owners)
        assert session.set_bytes(prepare(spark), key) == kept
    spark.conf.set(key, before)


def test_local_shuffles_follow_large_tables_only(spark, sf_dir, monkeypatch):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    spark.conf.unset(session.INITIAL_PARTITIONS)
    session.size_shuffles(lines)
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None
    monkeypatch.setattr(session, "FINE_BYTES", 10_000)
    session.size_shuffles(lines, fine=True)
    assert int(spark.conf.get(session.INITIAL_PARTITIONS)) == -(-scanned_bytes(lines) // 10_000)
    session.size_shuffles(spark.range(1), fine=True)
    assert spark.conf.get(session.INITIAL_PARTITIONS, None) is None


def test_settings_that_change_results(spark):
    prepare(spark)
    assert rows(spark.sql("SELECT map_from_entries(array(struct('a', 1), struct('a', 2)))['a'], current_timezone()")) == [
        (2, "UTC")]


def test_numbers_for_display(spark):
    assert rows(spark.range(1).select(thousands(F.lit(1234.5)), thousands(F.lit(2.0), 1))) == [("1,234.50", "2.0")]


def test_readme_example(spark, sf_dir, tmp_path):
    """The first example, with its folders and period replaced by small ones."""
    text = (Path(__file__).parent.parent / "README.md").read_text()
    code = re.search(r"```python\n(.*?)```", text, re.S)[1]
    jobs = views.jobs(spark, sf_dir, "1996-01-01", "1996-02-01").select(F.struct("*").alias("data"))
    archive.write_archive(jobs, f"{tmp_path}/archive/jobs", F.to_date(F.timestamp_millis("data.RecordTime")))
    code = code.replace("hdfs://", str(tmp_path)).replace("last_n_days=30", "'1996-01-01', '1996-02-01'")
    code = code.replace('["50"]', '["1000000"]')
    names = {"spark": spark}
    exec(code, names)
    assert names["total"].first()[0] > 0
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["main", "sites", "tiers"]
