"""Periods, durations, sizes."""

from datetime import date, datetime, timezone

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetstats.functions import sizes, text, times

TODAY = date(2024, 3, 10)
NOW = datetime(2024, 3, 10, 12, tzinfo=timezone.utc)


@pytest.mark.parametrize(("start", "end", "wanted"), [
    (None, None, ("2024-02-08", "2024-03-09")),
    (None, "2024-03-01", ("2024-01-31", "2024-03-01")),
    ("2024-01-01", None, ("2024-01-01", "2024-01-31")),
    ("2024-03-01", None, ("2024-03-01", "2024-03-09")),
    ("2024-01-01", "2024-01-05", ("2024-01-01", "2024-01-05")),
])
def test_reporting_window(start, end, wanted):
    found = times.reporting_window(start, end, today=TODAY)
    assert tuple(f"{d:%Y-%m-%d}" for d in found) == wanted


def test_reversed_window():
    with pytest.raises(ValueError, match="after"):
        times.reporting_window("2024-02-01", "2024-01-01")


def test_time_ranges():
    now = 1710072000
    assert times.time_range("now-2h", NOW) == [now * 1000, (now - 7200) * 1000]
    assert times.time_range("7d", NOW) == [(now - 7 * 86400) * 1000]
    assert times.time_range("10 mins", NOW, future=True) == [(now + 600) * 1000]
    assert times.time_range("1700000000-30secs", NOW) == [1700000000000, (now - 30) * 1000]
    assert times.time_range("2024-01-01T00:00:00+00:00--2024-01-02T00:00:00+00:00", NOW) == [
        1704067200000, 1704153600000]
    with pytest.raises(ValueError, match="fortnight"):
        times.time_range("fortnight", NOW)


@pytest.mark.parametrize(("a", "b", "shown"), [
    ("2023-01-30 00:00:00", "2023-03-01 00:00:00", "1M 2D"),
    ("2024-01-01 00:00:00", "2024-01-01 03:00:00", "3h"),
    ("2024-01-01 23:59:59", "2024-01-02 00:00:00", "1s"),
    ("2022-12-31 10:00:00", "2024-01-01 09:00:00", "1Y 23h"),
    ("2024-03-01 00:00:01", "2024-01-31 00:00:00", "1M 1D 1s"),
    ("2024-01-01 00:00:00", "2024-01-01 00:00:00", ""),
])
def test_durations(spark, a, b, shown):
    df = spark.createDataFrame([(a, b)], "a STRING, b STRING").select(*[F.col(c).cast("timestamp") for c in "ab"])
    assert rows(df.select(times.duration_text(F.col("a"), F.col("b")))) == [(shown,)]


def test_relative_times(spark):
    df = spark.createDataFrame([("2024-01-02 02:05:00", "2024-01-02 00:00:00")], "now STRING, t STRING")
    now, t = F.col("now").cast("timestamp"), F.col("t").cast("timestamp")
    assert rows(df.select(times.relative_text(now, t), times.relative_text(t, now))) == [("2h 5m AGO", "IN 2h 5m")]


def test_chunks_have_no_holes(spark):
    df = spark.sql("SELECT DATE'2024-01-01' AS a, DATE'2024-03-05' AS b, DATE'2024-01-01' AS c")
    chunks = rows(df.select(F.inline(times.period_chunks(F.col("a"), F.col("b")))))
    assert chunks[0][0] == date(2024, 1, 1) and chunks[-1][1] == date(2024, 3, 5)
    assert all(x[1] == y[0] for x, y in zip(chunks, chunks[1:])) and len(chunks) == 3
    assert rows(df.select(F.size(times.period_chunks(F.col("a"), F.col("c"))))) == [(0,)]


def test_flexible_epochs(spark):
    df = spark.createDataFrame([(0,), (20240101,), (1700000000,)], "t BIGINT")
    assert [r[0] for r in rows(df.select(times.flexible_epoch(F.col("t"))))] == [0, 1704067200, 1700000000]


def test_seconds(spark):
    assert rows(spark.range(1).select(times.seconds_text(F.lit(1000)), times.seconds_text(F.lit(90061)))) == [
        ("0h 16m 40s", "25h 1m 1s")]


def test_sizes(spark):
    df = spark.createDataFrame([("3.0 T",), ("1.5 G",), ("12",), ("2k",), ("x",), ("5 Q",), (None,)], "t STRING")
    found = [r[0] for r in rows(df.select(sizes.bytes_from_text(F.col("t"))))]
    assert found == [3 * 1024**4, 1.5 * 1024**3, 12, 2048, None, None, None]


def test_texts(spark):
    df = spark.createDataFrame([("grid_prod_jobs_raw_metric_v1-2020", "/CN=a/CN=123/CN=b", "/wf/step")], "i STRING, d STRING, t STRING")
    assert rows(df.select(
        text.index_group(F.col("i"), "grid_prod_"), text.plain_dn(F.col("d")), text.task_prefix(F.col("t")),
    )) == [("jobs", "/CN=a/CN=b", "wf")]
