"""What the plans must contain; what none may contain is in test_oracle."""

import re

import pytest
from helpers import plan_text
from pyspark.sql import functions as F

from __spark_entry__ import queries
from fleetstats.operators import efficiency as eff
from fleetstats.operators import search, steps
from fleetstats.operators.search import Criterion
from fleetstats.plans import views
from fleetstats.plans.registry import load

def test_all_levels_read_the_jobs_once(spark, sf_dir):
    plan = plan_text(queries()["efficiency_grouping_sets"](spark, sf_dir))
    assert plan.count("FileScan") == 1
    # the expansion stands above the first aggregate
    assert plan.index("Expand") < plan.index("partial_max(struct")


def test_dedup_combines_before_the_shuffle(spark, sf_dir):
    plan = plan_text(eff.dedup_jobs(views.jobs(spark, sf_dir)))
    exchange = plan.index("Exchange hashpartitioning(GlobalJobId")
    assert "partial_max(struct" in plan[exchange:]


def test_scan_takes_period_and_columns(spark, sf_dir):
    plan = plan_text(eff.tier_overview(eff.prepare_jobs(views.jobs(spark, sf_dir), views.START, views.END)))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan)[1]
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed


def test_search_reaches_the_scan(spark, sf_dir):
    found = search.compile_criteria([Criterion("l_extendedprice", "html", "starts", ["20 KB"])])
    plan = plan_text(load(spark, sf_dir, "lineitem").where(found).select("l_orderkey"))
    assert "GreaterThanOrEqual(l_extendedprice,20000" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan


def test_page_is_a_top_k(spark, sf_dir):
    page, _ = search.search_page(load(spark, sf_dir, "orders"), F.lit(True), [("o_totalprice", "desc")], ["o_orderkey"], 5, 5)
    assert "TakeOrderedAndProject" in plan_text(page)


def test_day_folders_are_pruned(spark, sf_dir, tmp_path):
    from fleetstats.sources import archive

    jobs = views.jobs(spark, sf_dir, "1996-01-01", "1996-01-10")
    archive.write_archive(
        jobs.select(F.struct("*").alias("data")), str(tmp_path / "a"),
        F.to_date(F.timestamp_millis("data.RecordTime")),
    )
    scan = archive.read_jobs(spark, str(tmp_path / "a"), "1996-01-04", "1996-01-05", ["RecordTime"])
    plan = plan_text(scan)
    assert re.search(r"PartitionFilters: \[[^\]]*dt", plan)
    assert "ReadSchema: struct<data:struct<RecordTime:bigint>>" in plan
    days = {r[0] for r in scan.select(F.to_date(F.timestamp_millis("RecordTime")).cast("string")).distinct().collect()}
    assert days == {"1996-01-03", "1996-01-04", "1996-01-05", "1996-01-06"}


def test_archives_are_compressed_in_bounded_files(spark, sf_dir, tmp_path):
    from fleetstats.sources import archive

    lines, seen = views.order_lines(spark, sf_dir, "1996-01-01", "1996-03-01"), []

    def shape(rows):
        seen.append(plan_text(rows))
        return views.work_records(rows, "dt").select(F.struct("task", "wmats", "meta_data", "steps").alias("data"), "dt")

    path = tmp_path / "w"
    archive.write_archive(lines, str(path), F.trunc("l_shipdate", "MM"), shape=shape, file_records=20)
    assert "Exchange" in seen[0] and "named_struct" not in seen[0]  # records are made behind the shuffle
    files = list(path.glob("dt=*/part-*"))
    assert {f.suffix for f in files} == {".lz4"}
    assert max(spark.read.text(str(f)).count() for f in files[:4]) <= 20
    assert sum(f.stat().st_size for f in files) * 2 < sum(spark.read.text(str(path)).selectExpr("sum(length(value))").first())
    read = archive.read_work(spark, str(path), fields=["meta_data.fwjr_id", "task", "steps.output.acquisitionEra"])
    assert "steps:array<struct<output:array<struct<acquisitionEra:string>>>>" in plan_text(read)
    whole = views.work(spark, sf_dir, "1996-01-01", "1996-03-01").select(
        "meta_data.fwjr_id", "task", F.size("steps"), F.col("steps")[0]["output"]["acquisitionEra"])
    back = read.select("meta_data.fwjr_id", "task", F.size("steps"), F.col("steps")[0]["output"]["acquisitionEra"])
    assert sorted(map(str, back.collect())) == sorted(map(str, whole.collect()))


def test_step_sums_stay_hash_aggregates(spark, sf_dir):
    grain = steps.step_grain(steps.flatten_steps(steps.successful_work(views.work(spark, sf_dir), views.START, views.END)))
    plan = plan_text(grain)
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


@pytest.mark.parametrize("name", [
    "freshness_count", "status_histogram", "incremental_extract", "snapshot_as_of", "changed_files_join", "search_date",
    "campaign_hs06", "dashboard_star", "completed_jobs",
])
def test_time_ranges_reach_the_scan(spark, sf_dir, name):
    plan = plan_text(queries()[name](spark, sf_dir))
    pushed = [p for p in re.findall(r"PushedFilters: \[(.*?)\]", plan) if "Than" in p]
    assert any(re.search(r"(Less|Greater)Than(OrEqual)?\((l_shipdate|o_orderdate|ts),", p) for p in pushed), plan


def test_only_the_columns_of_a_level_are_deduplicated(spark, sf_dir):
    plan = plan_text(queries()["tier_overview"](spark, sf_dir))
    read = re.search(r"ReadSchema: struct<(.*?)>", plan)[1]
    assert "l_partkey" not in read and "l_suppkey" not in read
    assert "CpuEff" not in re.search(r"partial_max\(struct\((.*?)\)\)", plan)[1]


def test_totals_read_their_rows_once(spark, sf_dir):
    assert plan_text(queries()["accounting_totals"](spark, sf_dir)).count("FileScan text") == 0


@pytest.mark.parametrize("name", ["alert_table", "alert_duration"])
def test_time_texts_are_worked_out_once(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("last_day(") == 1
