"""Job efficiency on hand-made records."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetstats.operators import efficiency as eff
from fleetstats.plans import efficiency as registered
from fleetstats.schemas import JOB_FIELDS

DAY = 1_577_836_800_000  # 2020-01-01 in ms

BASE = {
    "GlobalJobId": "j", "Workflow": "wf", "WMAgent_RequestName": "req", "ScheddName": "s1", "WMAgent_JobID": "1",
    "RecordTime": DAY, "JobFailed": 0, "Status": "Completed", "Site": "T2_A", "Tier": "T2", "Type": "production",
    "WallClockHr": 2.0, "CpuTimeHr": 6.0, "CommittedCoreHr": 8.0, "CommittedWallClockHr": 2.0,
    "MaxWallTimeMins": 480.0, "RequestCpus": 4.0, "ChirpCMSSWReadTimeMsecs": None, "ChirpCMSSWElapsed": None,
    "CpuEff": None, "CpuEffOutlier": 0,
}


def jobs(spark, *changes):
    data = [tuple({**BASE, "GlobalJobId": f"j{i}", **c}[n] for n in JOB_FIELDS.names) for i, c in enumerate(changes)]
    return spark.createDataFrame(data, JOB_FIELDS)


def prepared(spark, *changes):
    return eff.prepare_jobs(jobs(spark, *changes), "2020-01-01", "2020-01-02")


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0].asDict()


def test_hand_checked_ratios(spark):
    row = one(eff.workflow_efficiency(prepared(
        spark, {}, {"WallClockHr": 1.0, "RequestCpus": None, "CpuTimeHr": 1.0, "CommittedWallClockHr": None},
    )))
    assert row["CoreTimeHr"] == 9
    assert row["CpuEff"] == pytest.approx(100 * 7 / 9)
    assert row["WastedCpuTimeHr"] == 2
    assert row["Cpus"] == 5
    assert row["CommittedOverMaxWallTimeAvg"] == pytest.approx(60 * 2 / 480)
    assert row["CmsswReadTimePercentage"] is None


def test_filter_bounds_and_states(spark):
    kept = eff.completed_jobs(jobs(
        spark, {}, {"RecordTime": DAY + 86_400_000}, {"RecordTime": DAY - 1}, {"Status": "Running"}, {"JobFailed": 1},
    ), "2020-01-01", "2020-01-02")
    assert rows(kept, "GlobalJobId") == [("j0",)]


def test_newest_row_of_an_id_wins(spark):
    same = jobs(
        spark, {"GlobalJobId": "x", "RecordTime": DAY + 1, "Site": "old"},
        {"GlobalJobId": "x", "RecordTime": DAY + 2, "Site": "new"}, {"GlobalJobId": "y"},
    )
    once = eff.dedup_jobs(same)
    assert sorted(rows(once, "GlobalJobId", "Site")) == [("x", "new"), ("y", "T2_A")]
    assert once.columns == same.columns
    assert sorted(rows(eff.dedup_jobs(once))) == sorted(rows(once))


def test_missing_request_and_tier_spelling(spark):
    row = one(eff.workflow_site_efficiency(prepared(spark, {"WMAgent_RequestName": None, "Tier": "t1"})))
    assert (row["WmagentRequestName"], row["Tier"]) == ("NULL", "T1")


def test_zero_denominators_give_null(spark):
    row = one(eff.workflow_efficiency(prepared(
        spark, {"WallClockHr": 0.0, "CommittedCoreHr": 0.0, "MaxWallTimeMins": 0.0},
    )))
    assert [row[c] for c in ("CpuEff", "NonEvictionEff", "ScheduleEff", "CommittedOverMaxWallTimeAvg")] == [None] * 4


def test_top_tiers_only(spark):
    row = one(eff.workflow_efficiency(prepared(
        spark, {"Tier": "t1"}, {"Tier": "T3", "CpuTimeHr": 1.0}, {"Tier": None, "CpuTimeHr": 1.0},
    )))
    assert (row["CpuTimeHr"], row["CpuTimeHrT1T2"], row["CpusT1T2"]) == (8, 6, 4)
    assert one(eff.workflow_efficiency(prepared(spark, {"Tier": "T3"})))["CpuEffT1T2"] is None


def test_site_level_sets(spark):
    row = one(eff.workflow_site_efficiency(prepared(
        spark, {"WMAgent_JobID": "9"}, {"WMAgent_JobID": "10", "ScheddName": "s0"}, {"ScheddName": None},
    )))
    assert row["Schedds"] == ["s0", "s1"]
    assert row["MaxWmagentJobId"] == "9"  # text order


def test_tiers_leave_out_the_unknown(spark):
    table = eff.tier_overview(prepared(spark, {"Tier": "unknown"}, {"Tier": None}, {"Tier": "T2"}))
    assert rows(table, "Tier", "TierCpus") == [("T2", 4.0)]


def test_production_tiers_first(spark):
    table = eff.sort_tiers(eff.tier_overview(prepared(
        spark, {"Type": "analysis"}, {"Type": "production"}, {"Type": "production", "Tier": "T1"},
    )))
    assert rows(table, "Type", "Tier") == [("production", "T1"), ("production", "T2"), ("analysis", "T2")]


def test_levels_agree_with_direct_aggregates(spark, sf_dir):
    prepared_jobs = registered.prepared_jobs(spark, sf_dir, "site")
    grain = eff.finest_grain(prepared_jobs)
    columns = ["Type", "Workflow", "WmagentRequestName", "CpuEffOutlier", "CpuEff", "Cpus", "CpuEffT1T2",
               "CommittedOverMaxWallTimeAvg"]
    direct = eff.workflow_efficiency(prepared_jobs).select(columns)
    again = eff.workflow_level(grain).select(columns)
    assert direct.exceptAll(again).count() == 0 == again.exceptAll(direct).count()
    assert eff.tier_level(grain).exceptAll(eff.tier_overview(prepared_jobs)).count() == 0


def test_one_hot_id_and_one_hot_workflow(spark):
    """A third of all rows under one id, all in one workflow."""
    n = 30_000
    lines = spark.range(n).select(*[
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(name) if name == "GlobalJobId"
        else (F.lit(DAY) + F.col("id")).alias(name) if name == "RecordTime"
        else F.lit(BASE[name]).cast(JOB_FIELDS[name].dataType).alias(name)
        for name in JOB_FIELDS.names
    ])
    row = one(eff.workflow_efficiency(eff.prepare_jobs(lines, "2020-01-01", "2020-01-02")))
    assert row["Cpus"] == 4 * (n - n // 3 + 1)
