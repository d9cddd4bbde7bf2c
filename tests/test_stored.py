"""Stored sketches, file manifests, typed dumps."""

from datetime import UTC, datetime, timedelta
from decimal import Decimal

import pytest
from helpers import plan_text, rows
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructType

from fleetstats.operators import rollups
from fleetstats.sources import manifest, typed


# ---- sketches -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def hits(spark):
    first = datetime(2024, 1, 1, 22, 58)
    # one user in a third of the rows; null times and users
    data = [(first + timedelta(seconds=7 * i), "hot" if i % 3 == 0 else f"u{i % 4000}", "ab"[i % 2]) for i in range(20000)]
    return spark.createDataFrame(data + [(None, "u", "a"), (first, None, "a")], "at TIMESTAMP, user STRING, kind STRING").repartition(4)


def test_sketches_roll_up_to_those_of_longer_intervals(spark, hits, tmp_path):
    rollups.write_sketches(rollups.interval_sketches(hits, "at", "user", ["kind"]), str(tmp_path))
    stored = rollups.read_sketches(spark, str(tmp_path))
    for seconds, by in ((3600, ["kind"]), (86400, []), (300, [])):
        rolled = rollups.estimates(rollups.roll_up(stored, seconds, by))
        direct = rollups.estimates(rollups.interval_sketches(hits, "at", "user", by, seconds))
        order = ["bucket_start", *by]
        assert rows(rolled.select("bucket_start", *by, "n").orderBy(order)) == rows(direct.select("bucket_start", *by, "n").orderBy(order))
        exact = {r[:-1]: r[-1] for r in rows(hits.where("at IS NOT NULL").groupBy(
            rollups.interval_start(F.col("at"), seconds).alias("b"), *by).agg(F.count_distinct("user")))}
        for r in rows(rolled.select("bucket_start", *by, "distinct")):
            assert abs(r[-1] - exact[r[:-1]]) <= max(1, 3 * rollups.RELATIVE_ERROR * exact[r[:-1]])


def test_a_day_written_again_replaces_its_sketches(spark, hits, tmp_path):
    sketches = rollups.interval_sketches(hits, "at", "user")
    rollups.write_sketches(sketches, str(tmp_path))
    before = rows(rollups.read_sketches(spark, str(tmp_path)).agg(F.sum("n")))
    rollups.write_sketches(sketches.where("bucket_start >= '2024-01-02'"), str(tmp_path))
    assert rows(rollups.read_sketches(spark, str(tmp_path)).agg(F.sum("n"))) == before == [(20001,)]
    day = rollups.read_sketches(spark, str(tmp_path), "2024-01-02", "2024-01-02")
    assert "PartitionFilters: [isnotnull(sketch_day" in plan_text(day)
    assert rows(day.agg(F.min("bucket_start"), F.max("bucket_start"))) == [(datetime(2024, 1, 2), datetime(2024, 1, 2, 23, 55))]


def test_sketches_are_united_before_they_move(hits):
    plan = plan_text(rollups.interval_sketches(hits, "at", "user"))
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_hll_sketch_agg")


# ---- manifest -------------------------------------------------------------------------------


def archive(spark, path, hours):
    """A file per entry: the records of some hours, and in each a record without a time."""
    for name, (first, last) in hours.items():
        records = spark.range(first, last).select(F.col("id").alias("t"), F.lit(name).alias("name"))
        records.unionByName(spark.sql(f"SELECT CAST(NULL AS LONG) AS t, '{name}' AS name")).coalesce(1).write.json(f"{path}/{name}")


def reader(spark):
    return lambda files: spark.read.schema("t LONG, name STRING").json(files)


@pytest.fixture
def described(spark, tmp_path):
    path, listed = str(tmp_path / "archive"), str(tmp_path / "manifest")
    archive(spark, path, {"a": (0, 10), "b": (8, 20), "c": (20, 30), "d": (100, 101)})
    manifest.write_manifest(spark.read.schema("t LONG, name STRING").json([f"{path}/{n}" for n in "abcd"]), F.col("t"), listed)
    return path, listed


@pytest.mark.parametrize(("start", "end", "names"), [
    (0, 200, "abcd"), (9, 10, "ab"), (10, 20, "b"), (19, 21, "bc"), (30, 100, ""), (100, 101, "d"), (500, 600, ""), (20, 20, ""),
])
def test_a_period_reads_the_files_that_overlap_it(spark, described, start, end, names):
    path, listed = described
    read = reader(spark)
    scan = manifest.manifest_scan(spark, listed, read, StructType().add("t", LongType()).add("name", StringType()), F.col("t"), start, end)
    whole = read([f"{path}/{n}" for n in "abcd"]).where((F.col("t") >= start) & (F.col("t") < end))
    assert sorted(rows(scan)) == sorted(rows(whole))
    assert {f.split("/")[-2] for f in scan.inputFiles()} <= set(names)
    assert len(manifest.overlapping_files(spark, listed, start, end)) <= len(names)


def test_a_refresh_reads_new_and_changed_files(spark, described, tmp_path):
    path, listed = described
    before = {r["path"]: r for r in manifest.read_manifest(spark, listed).collect()}
    assert {(r["n_rows"], r["least"], r["largest"]) for r in before.values()} == {(11, 0, 9), (13, 8, 19), (11, 20, 29), (2, 100, 100)}
    assert all(r["size"] > 0 and abs(r["modified"] - datetime.now(UTC).replace(tzinfo=None)) < timedelta(hours=1) for r in before.values())
    read = reader(spark)
    assert manifest.refresh_manifest(spark, path, read, F.col("t"), listed) == 0
    archive(spark, path, {"e": (200, 210)})
    spark.range(300, 305).select(F.col("id").alias("t"), F.lit("a").alias("name")).coalesce(1).write.mode("overwrite").json(f"{path}/a")
    assert manifest.refresh_manifest(spark, path, read, F.col("t"), listed) == 2
    after = manifest.read_manifest(spark, listed)
    assert sorted(rows(after, "least")) == [(8,), (20,), (100,), (200,), (300,)]
    assert after.count() == 5  # the file that was replaced is gone


# ---- typed dumps ----------------------------------------------------------------------------

TABLE = (
    StructType().add("id", LongType(), False).add("name", StringType()).add("day", DateType()).add("size", IntegerType())
    .add("big", StringType())
)


def dump(spark, tmp_path, *lines):
    spark.createDataFrame([(v,) for v in lines], "value STRING").coalesce(1).write.text(f"{tmp_path}/dump")
    return f"{tmp_path}/dump"


def test_rows_that_do_not_fit_come_apart(spark, tmp_path):
    path = dump(spark, tmp_path, "1,a,2022-05-15,10,1.25", '2,"b, c",,,', "x,d,2022-13-01,1e3,7", ",e,2022-05-15,1,1", "5,f,2022-05-15",
                "6,g,2022-05-15,1,1,extra", "7, h ,2022-05-15,99999999999,abc")
    good, bad = typed.read_typed_dump(spark, path, TABLE, {"BIG": "DECIMAL(5,2)"})
    assert sorted(rows(good.drop("day")), key=str) == [(1, "a", 10, Decimal("1.25")), (2, "b, c", None, None)]
    found = {r["name"]: r for r in bad.collect()}
    assert found["d"]["bad_columns"] == ["id", "day", "size"] and found["d"]["big"] == Decimal("7.00")
    assert found["d"]["raw_values"] == {"id": "x", "day": "2022-13-01", "size": "1e3"}
    assert found["e"]["bad_columns"] == ["id"] and found["e"]["raw_values"] == {"id": None}
    assert found[" h "]["bad_columns"] == ["size", "big"]
    assert found["f"]["raw_row"] == "5,f,2022-05-15" and found["g"]["raw_row"] == "6,g,2022-05-15,1,1,extra"
    assert (good.count(), bad.count(), bad.select("raw_row").distinct().count()) == (2, 5, 3)


def test_large_objects_stay_texts(spark, tmp_path):
    path = dump(spark, tmp_path, "1,a,whatever,2,{}")
    good, bad = typed.read_typed_dump(spark, path, TABLE, {"day": "STRING"})
    assert rows(good) == [(1, "a", "whatever", 2, "{}")] and rows(bad) == []
    with pytest.raises(ValueError, match="no such columns: colour"):
        typed.merged_schema(TABLE, {"colour": "STRING", "DAY": "STRING"})
