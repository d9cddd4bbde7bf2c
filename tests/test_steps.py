"""Steps of work records on hand-made records."""

import pytest
from helpers import plan_text, rows
from pyspark.sql import functions as F

from fleetstats.operators import steps
from fleetstats.schemas import FLAT_STEP, WORK_FIELDS

TS = 1_577_836_800  # 2020-01-01


def step(name="cmsRun1", streams=2, threads=4, cpu=100.0, job=50.0, secs="10", eras=("A",), site="T2_X"):
    return {
        "name": name, "site": site,
        "performance": {
            "cpu": {"NumberOfStreams": streams, "NumberOfThreads": threads, "TotalJobCPU": cpu, "TotalJobTime": job},
            "storage": {"writeTotalMB": 1.0, "readTotalMB": 2.0, "writeTotalSecs": None, "readTotalSecs": secs},
            "memory": {"PeakValueRss": None, "PeakValueVsize": 7.0},
        },
        "output": None if eras is None else [{"acquisitionEra": e} for e in eras],
    }


def work(spark, *records):
    data = []
    for i, (all_steps, changes) in enumerate(records):
        meta = {"fwjr_id": f"f{i}", "jobtype": "Processing", "jobstate": "success", "ts": TS}
        record = {"task": "/wf/step", "wmats": TS, **changes}
        meta |= record.pop("meta", {})
        data.append({**record, "meta_data": meta, "steps": all_steps})
    return spark.createDataFrame(data, WORK_FIELDS)


def flat(spark, *records):
    return steps.flatten_steps(work(spark, *records))


def test_only_successful_production_work(spark):
    found = steps.successful_work(work(
        spark, ([], {}), ([], {"meta": {"jobstate": "jobfailed"}}), ([], {"meta": {"jobtype": "Cleanup"}}),
        ([], {"task": None}), ([], {"wmats": TS - 1}), ([], {"wmats": TS + 86400}),
    ), "2020-01-01", "2020-01-02")
    assert rows(found, "meta_data.fwjr_id") == [("f0",)]


def test_payload_steps_of_any_case(spark):
    table = flat(spark, ([step(), step("CMSRUN2"), step("stageOut1"), step(None), None], {}))
    assert sorted(rows(table, "StepName", "number_of_steps")) == [("CMSRUN2", 2), ("cmsRun1", 2)]
    assert table.schema.names == FLAT_STEP.names


def test_absent_and_empty_steps(spark):
    assert flat(spark, (None, {}), ([], {}), ([None], {})).count() == 0


def test_products_need_every_factor(spark):
    table = flat(spark, ([step("cmsRun1"), step("cmsRun2", threads=0), step("cmsRun3", cpu=0.0),
                          step("cmsRun4", job=None)], {}))
    assert sorted(rows(table, "StepName", "threads_total_job_time")) == [
        ("cmsRun1", 200.0), ("cmsRun2", None), ("cmsRun3", None), ("cmsRun4", None),
    ]


def test_texts_of_seconds(spark):
    table = flat(spark, ([step("cmsRun1", secs="2.5"), step("cmsRun2", secs=""), step("cmsRun3", secs="0")], {}))
    assert sorted(rows(table, "StepName", "read_total_secs"))[0] == ("cmsRun1", 2.5)
    assert [r[1] for r in sorted(rows(table, "StepName", "read_total_secs"))[1:]] == [None, None]


def test_eras_are_a_set_without_blanks(spark):
    table = flat(spark, ([step("cmsRun1", eras=("B", "A", "B", "", None)), step("cmsRun2", eras=None)], {}))
    assert sorted(rows(table, "StepName", "acquisition_era", "era_length")) == [
        ("cmsRun1", ["A", "B"], 2), ("cmsRun2", [], 0),
    ]


def test_equal_rows_once_and_streams_needed(spark):
    record = ([step(), step(streams=None)], {"meta": {"fwjr_id": "same"}})
    assert flat(spark, record, record).count() == 1


def test_task_level(spark):
    table = steps.task_efficiency(steps.step_grain(flat(
        spark, ([step(), step("cmsRun2", threads=0, cpu=50.0, eras=("B",), site="T1_Y")], {}),
    )))
    row = table.collect()[0]
    assert row.CpuEfficiency == pytest.approx(100 * 150 / 200)  # the second step adds CPU time only
    assert (row.AcquisitionEra, row.EraCount, row.Sites, row.SiteCount) == (["A", "B"], 2, ["T1_Y", "T2_X"], 2)
    assert row.MeanPeakRss is None and row.MeanPeakVSize == 7
    assert row.ReadTimePercentage == pytest.approx(100 * 20 / 100)


def test_levels_have_their_keys(spark):
    grain = steps.step_grain(flat(spark, ([step(), step("cmsRun2"), step(site="T1_Y")], {})))
    counts = {level: steps.task_efficiency(grain, level).count() for level in steps.LEVEL_KEYS}
    assert counts == {"task": 1, "step": 2, "site": 3}
    assert "SiteCount" not in steps.task_efficiency(grain, "site").columns


def test_no_python_in_the_plan(spark):
    assert "Python" not in plan_text(flat(spark, ([step()], {}))).replace("PythonRDD", "")


def test_counts_without_sets(spark):
    many = [([step(eras=(f"E{i % 5}",), site=f"T{i % 7}_X"), step("cmsRun2", eras=None, site=None)], {"task": "/hot"}) for i in range(40)]
    grain = steps.step_grain(flat(spark, *many, ([step(eras=())], {"task": "/none"})))
    for level, keys in steps.LEVEL_KEYS.items():
        with_sets, counted = steps.task_efficiency(grain, level), steps.task_counts(grain, level)
        columns = [c for c in with_sets.columns if c not in ("AcquisitionEra", "Sites")]
        assert counted.columns == columns
        order = [F.col(k).asc_nulls_first() for k in keys]
        for ours, theirs in zip(rows(counted.orderBy(*order)), rows(with_sets.select(columns).orderBy(*order)), strict=True):
            assert ours == pytest.approx(theirs)
    row = steps.task_counts(grain).where("Task = '/hot'").first()
    assert (row.EraCount, row.SiteCount) == (5, 7)


def test_counts_hold_no_sets(spark):
    plan = plan_text(steps.task_counts(steps.step_grain(flat(spark, ([step()], {})))))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "collect_set" not in plan


def test_site_level_is_aggregated_behind_its_shuffle(spark):
    """Its sets hold a member for each row of the grain; the sets of the other levels shrink before they move."""
    grain = steps.step_grain(flat(spark, ([step()], {})))
    for level, partial_first in (("site", False), ("step", True), ("task", True)):
        plan = plan_text(steps.task_efficiency(grain, level))  # the top of a plan comes first
        assert ("partial_collect_set" in plan[plan.index("Exchange"):]) == partial_first, level


def test_step_collections_are_written_compressed(spark, sf_dir, tmp_path, monkeypatch):
    from fleetstats.plans import efficiency

    monkeypatch.setattr(efficiency, "new_path", lambda spark, label: str(tmp_path / label))
    table = spark.range(3).selectExpr("CAST(id AS STRING) AS Task", "id AS n")
    counted = efficiency._contents(spark, {"a": table}, {"a": ("n", "Task")})
    assert rows(counted, "collection", "n", "cpu", "keys") == [("a", 3, 3.0, 3)]
    assert {f.suffix for f in tmp_path.glob("*/a/part-*")} == {".lz4"}
