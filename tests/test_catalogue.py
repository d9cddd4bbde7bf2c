"""Extracts, snapshots, dumps, files."""

from datetime import date, datetime
from types import SimpleNamespace

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetstats import sinks
from fleetstats.operators import catalogue as cat
from fleetstats.sources import archive, files
from fleetstats.sources import catalogue as dumps
from fleetstats.storage import materialize, shared_root


@pytest.fixture(scope="module")
def changes(spark):
    return spark.createDataFrame(
        [("new", 15, 16), ("changed", 5, 15), ("later", 15, 25), ("old", 5, 6), ("never", 15, None), ("edge", 20, 20),
         ("first", 10, 10)],
        "id STRING, creation_date BIGINT, last_modification_date BIGINT",
    )


def ids(df):
    return sorted(r[0] for r in rows(df, "id"))


def test_changed_between(changes):
    assert ids(cat.changed_between(changes, 10, 20)) == ["changed", "first", "new"]
    assert ids(cat.changed_between(changes, 10, 20, mode="either")) == ["changed", "first", "later", "never", "new"]
    with pytest.raises(ValueError, match="mode"):
        cat.changed_between(changes, 1, 2, mode="x")


def test_snapshot_as_of(changes):
    assert ids(cat.snapshot_as_of(changes, 15)) == ["changed", "first", "old"]
    assert ids(cat.snapshot_as_of(changes, 15, modified="last_modification_date")) == ["first", "old"]


def test_job_states(spark):
    df = spark.createDataFrame([("S", "D"), ("S", "U"), ("S", "F"), ("F", "D")], "a STRING, b STRING")
    assert [r[0] for r in rows(df.select(cat.job_state(F.col("a"), F.col("b"))))] == [
        "success", "success", "failed", "failed"]


def test_only_marked_snapshots_count(spark):
    df = spark.createDataFrame([("a", i) for i in range(100)] + [("b", i) for i in range(60)] + [("c", 1)], "d STRING, n INT")
    marks = spark.createDataFrame([("a",), ("b",)], "d STRING")
    assert cat.latest_snapshot(df, marks, "d").count() == 60
    assert cat.latest_snapshot(df, marks.limit(0), "d").count() == 0


def test_extract_narrower_than_its_partition_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_of = [(i, date(2024, 1, 1 + i), "2024-01") for i in range(30)]
    month = spark.createDataFrame(rows_of, "n INT, day DATE, dt STRING")
    for _ in range(2):
        sinks.append_extract(month, path, "dt", "day", date(2024, 1, 1), date(2024, 2, 1))
    with pytest.raises(ValueError, match="extract it whole"):
        sinks.append_extract(month.where("n = 3"), path, "dt", "day", date(2024, 1, 4), date(2024, 1, 5))
    with pytest.raises(ValueError, match="outside"):
        sinks.append_extract(month, path, "dt", "day", date(2024, 1, 1), date(2024, 1, 5))
    assert spark.read.parquet(path).count() == 30


def test_expired(spark):
    df = spark.createDataFrame(
        [("x", date(2024, 1, 1)), ("x", date(2024, 1, 2)), ("y", date(2020, 1, 1)), ("z", date(2020, 1, 1))],
        "family STRING, dt DATE",
    )
    assert sorted(rows(cat.expired_partitions(df, {"x": 30, "y": 180}, "2024-02-01"))) == [
        ("x", date(2024, 1, 1)), ("y", date(2020, 1, 1))]


def test_rerun_adds_nothing(spark, tmp_path):
    day = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "n INT, dt STRING")
    for _ in range(2):
        sinks.replace_partitions(day, str(tmp_path), "dt")
    sinks.replace_partitions(day.where("dt = 'b'").withColumn("n", F.lit(9)), str(tmp_path), "dt")
    assert sorted(rows(spark.read.parquet(str(tmp_path)), "n", "dt")) == [(1, "a"), (2, "a"), (9, "b")]


def test_dated_dumps(spark, tmp_path):
    path = str(tmp_path / "dump")
    assert sinks.write_snapshot(spark.range(10), path, "2024-01-01") == 10
    assert sinks.write_snapshot(spark.range(12), path, "2024-01-02", min_rows=9) == 12
    with pytest.raises(ValueError, match="3 rows"):
        sinks.write_snapshot(spark.range(3), path, "2024-01-03", min_rows=9)
    current = cat.latest_snapshot(spark.read.parquet(path), spark.read.parquet(sinks.snapshot_marks(path)))
    assert rows(current.groupBy("snapshot_date").count()) == [(date(2024, 1, 2), 12)]


def test_searchable_layout(spark, tmp_path):
    sinks.write_searchable(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")), str(tmp_path), ["k"], 4)
    per_file = spark.read.parquet(str(tmp_path)).groupBy(F.input_file_name()).agg(F.min("k"), F.max("k"), F.count("*"))
    ranges = sorted((r[1], r[2]) for r in rows(per_file))
    assert len(ranges) == 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_searchable_layout_of_a_frequent_key(spark, tmp_path):
    table = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), "id")
    sinks.write_searchable(table, str(tmp_path), ["k"], 12)
    with_key = spark.read.parquet(str(tmp_path)).where("k = 0").select(F.input_file_name().alias("f")).distinct()
    assert with_key.count() >= 3


def test_jdbc_options():
    assert dumps.jdbc_options("u", "t") == {"url": "u", "dbtable": "t", "fetchsize": "10000"}
    many = dumps.jdbc_options("u", "t", "id", 1, 9, 8, 3000, ("BLOB1", "BLOB2"), {"user": "me"})
    assert many == {
        "url": "u", "dbtable": "t", "fetchsize": "3000", "user": "me", "partitionColumn": "id", "lowerBound": "1",
        "upperBound": "9", "numPartitions": "8", "customSchema": "BLOB1 STRING, BLOB2 STRING",
    }
    with pytest.raises(ValueError, match="split"):
        dumps.jdbc_options("u", "t", parts=4)


def test_csv_escapes(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a,"b"'), (2, "back\\slash"), (3, " pad "), (4, None)], "n INT, t STRING")
    dumps.write_csv_dump(df, str(tmp_path))
    assert sorted(rows(dumps.read_csv_dump(spark, str(tmp_path), df.schema))) == sorted(rows(df))


def test_binary_dumps(spark, tmp_path):
    spark.range(3).write.orc(str(tmp_path / "t"))
    assert dumps.read_dump(spark, str(tmp_path / "t"), "orc").count() == 3


def test_one_object_or_a_list(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1,\n "y": "a"}')
    (tmp_path / "b.json").write_text('[{"x": 2}, {"x": 3}]')
    schema = spark.createDataFrame([], "x INT, y STRING").schema
    assert sorted(rows(archive.read_one_or_many(spark, str(tmp_path), schema), "x")) == [(1,), (2,), (3,)]


def test_block_text(spark, tmp_path):
    (tmp_path / "t.txt").write_text(
        "openstackProjectName  proj one \nmaxTotalCores 5\nstate unknown\nalone\na@Default owner\nsee b@Default\n======\n"
        "openstackProjectName two\nmaxTotalCores 7 extra\n======\n"
    )
    found = files.block_records(files.read_blocks(spark, str(tmp_path)), "openstackProjectName")
    assert sorted(rows(found)) == [
        ("proj one", {"maxTotalCores": 5}, "a, b"), ("two", {"maxTotalCores": 7}, "")]


def test_lookup_lines(spark):
    df = spark.createDataFrame([("# c: d",), ("",), (" 50 : site: error ",), ("none",)], "value STRING")
    assert rows(files.lookup_table(df)) == [("50", "site: error")]


def test_inventory_and_folders(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.log").write_text("12345")
    (tmp_path / "b.txt").write_text("1")
    found = rows(files.file_inventory(spark, str(tmp_path)), F.element_at(F.split("path", "/"), -1), "size")
    assert sorted(found) == [("a.log", 5), ("b.txt", 1)]
    assert files.file_inventory(spark, str(tmp_path), ".log").count() == 1
    assert files.day_folder("/base", datetime(2024, 3, 1, 1), 7200) == "/base/2024/02/29"
    assert rows(files.tagged_lines(spark, str(tmp_path / "b.txt"), "web")) == [("web", "1")]


def test_shared_folder_comes_from_the_session(spark):
    def session(folder, master):
        conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert shared_root(session("hdfs://x/shared/", "yarn")) == "hdfs://x/shared"
    assert shared_root(session("/shared", "local[2]")) == "/shared"
    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_root(session(None, "yarn"))
    assert materialize(spark.range(3), "x").count() == 3
