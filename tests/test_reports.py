"""Reports, series, histograms, alerts."""

from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetstats.operators import alerts as al
from fleetstats.operators import reports as rep
from fleetstats.operators import timeseries as ts


def test_every_matching_prefix_gives_a_row(spark):
    indices = spark.createDataFrame([("grid_prod_jobs_raw_v1", 5), ("other", 1), ("grid_x", 2)], "name STRING, size_in_bytes BIGINT")
    patterns = spark.createDataFrame([("[grid_prod_*][grid_*] ",), ("[grid_prod_jobs_raw_v1]",), ("[zz*]",)], "database STRING")
    found = rep.index_usage(indices, patterns, "grid_prod_")
    assert sorted(rows(found, "name", "group", "size")) == [("grid_prod_jobs_raw_v1", "jobs", 5)] * 3 + [("grid_x", "grid_x", 2)]


def test_prefix_join_against_brute_force(spark):
    names = [(f"{a}{b}{c}",) for a in "ab" for b in "ab" for c in ("", "a", "bb")]
    prefixes = [("a",), ("ab",), ("abbb",), ("b",), ("",), ("abbbb",), ("a",)]
    df, p = spark.createDataFrame(names, "name STRING"), spark.createDataFrame(prefixes, "p STRING")
    wanted = sorted((n, q) for (n,) in names for (q,) in prefixes if q and n.startswith(q))
    assert sorted(rows(rep.prefix_matches(df, "name", p, "p"), "name", "p")) == wanted


def test_quota_needs_both_figures(spark):
    elements = spark.createDataFrame(
        [("A", "DISK", "real", 1), ("B", "DISK", "real", 2), ("C", "TAPE", "real", 1), ("D", "DISK", "test", 1),
         ("E", "DISK", "real", 3), ("F", "DISK", "real", 0), ("X", "DISK", "real", 1)],
        "rse STRING, rse_type STRING, cms_type STRING, tier INT",
    )
    usage = spark.createDataFrame(
        [(e, s, u) for e in "ACDEFX" for s, u in (("static", 4e12), ("rucio", 1e12), ("other", 9e12))]
        + [("B", "static", 1e12)], "rse STRING, source STRING, used DOUBLE",
    )
    assert rows(rep.storage_quota(elements, usage, ["X"])) == [("A", 1.0, 4.0, 25.0, 3.0)]


def test_replicated_quota(spark):
    df = spark.createDataFrame([("/a", 1000, 100, 50), ("/b", 500, 10, 0)],
                               "quota_node STRING, max_logical_quota BIGINT, logical_rep_bytes BIGINT, logical_ec_bytes BIGINT")
    table = {r.quota_node: r for r in rep.replicated_quota(df).collect()}
    a, total = table["/a"], table["TOTAL"]
    assert (a.total_used_logical_bytes, a.total_used_physical_bytes, a.free_physical, a.free_logical) == (150, 260, 1740, 850)
    assert (a.free_physical_for_ec, a.free_physical_for_rep) == (pytest.approx(1450), 870)
    assert (total.max_logical_quota, total.total_used_physical_bytes) == (1500, 280)


def test_total_row(spark):
    df = spark.createDataFrame([("p", 1, "x"), ("p", 2, "y")], "name STRING, n BIGINT, contacts STRING")
    assert sorted(rows(rep.with_total(df, "name", ["n"]))) == [("TOTAL", 3, ""), ("p", 1, "x"), ("p", 2, "y")]


def test_campaigns(spark):
    df = spark.createDataFrame(
        [("production", "Completed", "C1", "/a/R1_x/s", 2.0, 11), ("production", "Completed", "C2", "/a/R1_y/s", 3.0, 20),
         ("production", "Completed", "C1", "/a/R2/s", 1.0, 15), ("production", "Completed", "C1", "/a/R1_x/s", 9.0, 10),
         ("analysis", "Completed", "C1", "/a/R1_x/s", 9.0, 15), ("production", "Completed", "C9", "/a/R1_x/s", 9.0, 15)],
        "Type STRING, Status STRING, Campaign STRING, WMAgent_SubTaskName STRING, HS06CoreHr DOUBLE, RecordTime BIGINT",
    )
    sums = rep.campaign_sums(rep.campaign_jobs(df, ["C1", "C2"], 10, 20))
    assert sorted(rows(sums)) == [("C1", "/a/R1_x/s", 2.0), ("C1", "/a/R2/s", 1.0), ("C2", "/a/R1_y/s", 3.0)]
    assert sorted(rows(rep.prefix_totals(sums))) == [("R1", 5.0, 2), ("R2", 1.0, 1)]


# ---- series ---------------------------------------------------------------------------------

MATRIX = (
    '{"status":"success","data":{"resultType":"matrix","result":[{"metric":{"rse":"T1_X_Disk","source":"rucio"},'
    '"values":[[1700000000,"1.5"],[1700003600.7,"2"]]},{"metric":{},"values":[]}]}}'
)


def test_matrix_rows(spark):
    df = spark.createDataFrame([(1, MATRIX), (2, '{"status":"error"}'), (3, "bad")], "id INT, j STRING")
    out = ts.explode_series(df, "j", ["rse", "country"])
    assert rows(out, "id", "rse", "country", "value", ts.iso_utc(F.col("timestamp"))) == [
        (1, "T1_X_Disk", None, 1.5, "2023-11-14T22:13:20Z"), (1, "T1_X_Disk", None, 2.0, "2023-11-14T23:13:20Z")]


def test_export_rows(spark):
    line = '{"metric":{"dataset":"/a/b","dataset_type":"x"},"values":[1,2],"timestamps":[1700000000999,1700000060000]}'
    out = ts.explode_export(spark.createDataFrame([(line,), (None,)], "j STRING"), "j", ["dataset", "dataset_type"])
    assert rows(out) == [("/a/b", "x", 1700000000, 1), ("/a/b", "x", 1700000060, 2)]
    assert ts.filter_series(out, "x", "/b").count() == 2 and ts.filter_series(out, "y").count() == 0


def test_unreadable_samples_are_kept_apart(spark):
    answer = '{"status":"success","data":{"result":[{"metric":{"a":"b"},"values":[[1,"x"],["y","1"],[2,"3"],["NaN","1"]]}]}}'
    df = spark.createDataFrame([(1, answer), (2, '{"status":"error"}'), (3, "bad"), (4, None)], "id INT, j STRING")
    marked = ts.mark_series(df, "j", ["a"])
    assert sorted(rows(marked, "id", "reject_reason", "value"), key=str) == sorted([
        (1, "sample", None), (1, "sample", None), (1, None, 3.0), (1, "sample", None),
        (2, "answer", None), (3, "answer", None), (4, "answer", None)], key=str)
    line = '{"metric":{"a":"b"},"values":[1.5,2],"timestamps":[1700000000123.75,null]}'
    exported = ts.mark_export(spark.createDataFrame([(line,), ("bad",)], "j STRING"), "j", ["a"])
    assert sorted(rows(exported, "reject_reason", "ts", "value"), key=str) == sorted([
        (None, 1700000000, 1.5), ("sample", None, 2.0), ("line", None, None)], key=str)


def test_buckets_without_holes(spark):
    times = ["10:00:00", "10:11:59", "10:25:00", "10:36:00", "09:59:59"]
    df = spark.createDataFrame([(datetime.fromisoformat("2024-01-01T" + t), "j") for t in times], "t TIMESTAMP, id STRING")
    start, end = "2024-01-01 10:00:00", "2024-01-01 10:36:00"
    assert [r[1] for r in sorted(rows(ts.bucket_counts(df, "t", start, end, 720)))] == [2, 0, 1]
    null = ts.bucket_counts(df, "t", start, end, 720, distinct="id", fill=None)
    assert [r[1:] for r in sorted(rows(null), key=lambda r: r[0])] == [(2, 1), (None, None), (1, 1)]
    assert rows(ts.fresh_count(df, "t", "2024-01-01 10:25:00")) == [(1,)]


# ---- alerts ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def alerts(spark):
    def at(text):
        return datetime.fromisoformat("2024-01-01T" + text)

    open_end = datetime.fromtimestamp(al.OPEN_END_SECONDS)
    return al.alert_rows(spark.createDataFrame(
        [({"alertname": "a", "severity": "high", "service": "s1", "x": "1"}, {"b": "2", "a": "1"}, at("10:00"), at("11:00")),
         ({"alertname": "a", "severity": "info", "service": "s2"}, {}, at("12:00"), open_end),
         ({"alertname": "b", "severity": "odd", "tag": "t"}, {}, at("09:00"), at("09:30")),
         ({"alertname": "c", "severity": "urgent"}, {}, at("08:00"), at("08:10"))],
        "labels MAP<STRING,STRING>, annotations MAP<STRING,STRING>, startsAt TIMESTAMP, endsAt TIMESTAMP",
    ))


def test_filter_keeps_all_rows_of_a_name(alerts):
    assert rows(al.filter_alerts(alerts, severity="high"), "name") == [("a",), ("a",)]
    assert al.filter_alerts(alerts, service="s1", severity="info").count() == 0
    assert al.filter_alerts(alerts).count() == 4


def test_orders(alerts):
    def names(by):
        return [r[0] for r in rows(al.sort_alerts(alerts, by, "startsAt"), "severity")]

    assert names("severity") == ["odd", "info", "high", "urgent"]
    assert names("Starts") == ["urgent", "odd", "high", "info"]
    assert names("duration") == ["urgent", "odd", "high", "info"]


def test_texts_and_open_end(alerts):
    now = F.lit("2024-01-01 11:30:00").cast("timestamp")
    table = {r.severity: r for r in al.alert_table(alerts, now).collect()}
    assert (table["high"].starts, table["high"].ends, table["high"].duration) == ("1h 30m AGO", "30m AGO", "1h")
    assert (table["info"].starts, table["info"].ends, table["info"].duration) == ("IN 30m", "Undefined", "Undefined")


def test_latest_and_detail(alerts):
    latest = {r["name"]: r for r in al.latest_alerts(alerts).collect()}
    assert latest["a"].labels["severity"] == "info" and len(latest) == 3
    detail = rows(al.alert_detail(alerts.where("severity = 'high'"), "a"))
    assert detail == [("a", ["service: s1", "severity: high"], ["a: 1", "b: 2"])]


def test_annotations(spark):
    df = spark.createDataFrame(
        [(1, 7, 10, 20, "one\n<a href>", ["x", "y"]), (2, 7, 30, 40, "two", ["x"]), (3, 8, 30, 40, "three", ["x", "y"])],
        "id INT, dashboardId INT, time BIGINT, timeEnd BIGINT, text STRING, tags ARRAY<STRING>",
    )

    def found(**k):
        return sorted(r[0] for r in rows(al.filter_annotations(df, **k), "id"))

    assert found(tags=["x", "y"]) == [1, 3] and found(dashboard=7, start_ms=25) == [2] and found(end_ms=10) == [1]
    assert found(limit=1) == [3]
    assert rows(al.annotation_table(df, F.timestamp_millis(F.lit(0))).where("id = 1"), "text") == [("one",)]
