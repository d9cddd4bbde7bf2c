"""Job and step efficiency."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from fleetstats.functions.times import reporting_window
from fleetstats.operators import efficiency as eff
from fleetstats.operators import steps
from fleetstats.operators.search import display
from fleetstats.plans import views
from fleetstats.plans.registry import query
from fleetstats.plans.views import (
    END, FLAT_STEPS_SQL, JOBS_SQL, START, SUCCESSFUL_WORK_SQL, prepared_jobs_sql,
)
from fleetstats.sinks import write_collections
from fleetstats.storage import materialize, new_path

_RATIOS = """
  100 * sum(CpuTimeHr) / nullif(sum(CoreTimeHr), 0) AS CpuEff,
  100 * sum(CpuTimeHr) / nullif(sum(CommittedCoreHr), 0) AS NonEvictionEff,
  100 * sum(CpuTimeHr) / nullif(sum(CommittedCoreHr), 0)
    - 100 * sum(CpuTimeHr) / nullif(sum(CoreTimeHr), 0) AS EvictionAwareEffDiff,
  100 * sum(CommittedWallClockHr) / nullif(sum(WallClockHr), 0) AS ScheduleEff,
  100 * (sum(ChirpCMSSWReadTimeMsecs) / 1000) / nullif(sum(ChirpCMSSWElapsed), 0) AS CmsswReadTimePercentage,
  sum(RequestCpus) AS Cpus, sum(CpuTimeHr) AS CpuTimeHr, sum(WallClockHr) AS WallClockHr,
  sum(CoreTimeHr) AS CoreTimeHr, sum(CommittedCoreHr) AS CommittedCoreHr,
  sum(CommittedWallClockHr) AS CommittedWallClockHr, sum(WastedCpuTimeHr) AS WastedCpuTimeHr,
  avg(CommittedOverMaxWallTime) AS CommittedOverMaxWallTimeAvg"""

_T1T2 = """
  100 * sum(CpuTimeHr) FILTER (Tier IN ('T1', 'T2'))
    / nullif(sum(CoreTimeHr) FILTER (Tier IN ('T1', 'T2')), 0) AS CpuEffT1T2,
  sum(RequestCpus) FILTER (Tier IN ('T1', 'T2')) AS CpusT1T2,
  sum(CpuTimeHr) FILTER (Tier IN ('T1', 'T2')) AS CpuTimeHrT1T2,
  sum(WallClockHr) FILTER (Tier IN ('T1', 'T2')) AS WallClockHrT1T2,
  sum(CoreTimeHr) FILTER (Tier IN ('T1', 'T2')) AS CoreTimeHrT1T2,
  sum(WastedCpuTimeHr) FILTER (Tier IN ('T1', 'T2')) AS WastedCpuTimeHrT1T2"""

_TIERS = """
  SELECT Tier, Type, 100 * sum(CpuTimeHr) / nullif(sum(CoreTimeHr), 0) AS TierCpuEff,
    sum(RequestCpus) AS TierCpus, sum(CpuTimeHr) AS TierCpuTimeHr, sum(WallClockHr) AS TierWallClockHr
  FROM prepared WHERE Tier <> 'UNKNOWN' GROUP BY Tier, Type"""

_TIER_JOBS, _WORKFLOW_JOBS, _LEVEL_JOBS, _SITE_JOBS = (
    prepared_jobs_sql(eff.LEVEL_COLUMNS[level]) for level in ("tier", "workflow", "levels", "site")
)

WORKFLOW_TABLE_SQL = f"""{_WORKFLOW_JOBS}, workflows AS (
  SELECT Type, Workflow, WmagentRequestName, CpuEffOutlier, {_RATIOS}, {_T1T2}
  FROM prepared GROUP BY Type, Workflow, WmagentRequestName, CpuEffOutlier)"""

SITE_TABLE_SQL = f"""{_SITE_JOBS}, sites AS (
  SELECT Type, Workflow, WmagentRequestName, Site, Tier, CpuEffOutlier, {_RATIOS},
    list_sort(coalesce(list(DISTINCT ScheddName) FILTER (ScheddName IS NOT NULL), [])) AS Schedds,
    max(WMAgent_JobID) AS MaxWmagentJobId
  FROM prepared GROUP BY Type, Workflow, WmagentRequestName, Site, Tier, CpuEffOutlier)"""


def prepared_jobs(spark, sf_dir, level):
    return eff.prepare_jobs(views.jobs(spark, sf_dir), START, END, level)


def workflow_table(spark, sf_dir):
    return eff.workflow_efficiency(prepared_jobs(spark, sf_dir, "workflow"))


def site_table(spark, sf_dir):
    return eff.workflow_site_efficiency(prepared_jobs(spark, sf_dir, "site"))


def flat_steps(spark, sf_dir):
    return steps.flatten_steps(steps.successful_work(views.work(spark, sf_dir), START, END))


def texts(table):
    """Arrays as text, so that rows compare across engines."""
    arrays = [f.name for f in table.schema.fields if isinstance(f.dataType, ArrayType)]
    return table.withColumns({name: display(F.col(name)) for name in arrays})


def task_table(spark, sf_dir, level="task"):
    return steps.task_efficiency(steps.step_grain(flat_steps(spark, sf_dir)), level)


@query(f"""WITH jobs AS ({JOBS_SQL}) SELECT GlobalJobId, RecordTime, Type, Site, CpuTimeHr FROM jobs
WHERE Status = 'Completed' AND JobFailed = 0
  AND RecordTime >= epoch_ms(TIMESTAMP '{START}') AND RecordTime < epoch_ms(TIMESTAMP '{END}')""")
def completed_jobs(spark, sf_dir):
    done = eff.completed_jobs(views.jobs(spark, sf_dir), START, END)
    return done.select("GlobalJobId", "RecordTime", "Type", "Site", "CpuTimeHr")


_WINDOWS = {
    "neither": (None, None, "1997-05-15", "1997-06-14"), "start": ("1997-03-01", None, "1997-03-01", "1997-03-31"),
    "late start": ("1997-06-01", None, "1997-06-01", "1997-06-14"), "end": (None, "1997-02-01", "1997-01-02", "1997-02-01"),
    "both": ("1997-04-02", "1997-04-09", "1997-04-02", "1997-04-09"),
}


@query(" UNION ALL ".join(f"""SELECT * FROM (WITH jobs AS ({JOBS_SQL}) SELECT '{name}' AS bounds, count(*) AS n, min(RecordTime) AS first, max(RecordTime) AS last
FROM jobs WHERE Status = 'Completed' AND JobFailed = 0
  AND RecordTime >= epoch_ms(TIMESTAMP '{first}') AND RecordTime < epoch_ms(TIMESTAMP '{last}'))""" for name, (_, _, first, last) in _WINDOWS.items()))
def reporting_windows(spark, sf_dir):
    """Jobs of the period that the given bounds stand for, with some, all or none of them given as text."""
    parts = []
    for name, (start, end, _, _) in _WINDOWS.items():
        first, last = reporting_window(start, end, 30, today=date(1997, 6, 15))
        done = eff.completed_jobs(views.jobs(spark, sf_dir), first, last)
        parts.append(done.agg(
            F.lit(name).alias("bounds"), F.count("*").alias("n"), F.min("RecordTime").alias("first"), F.max("RecordTime").alias("last")
        ))
    return reduce(DataFrame.unionByName, parts)


@query(f"{prepared_jobs_sql()} SELECT * FROM newest")
def dedup_jobs(spark, sf_dir):
    return eff.dedup_jobs(eff.completed_jobs(views.jobs(spark, sf_dir), START, END))


@query(f"""{_WORKFLOW_JOBS}
SELECT GlobalJobId, WmagentRequestName, Tier, RequestCpus, CoreTimeHr, WastedCpuTimeHr, CommittedOverMaxWallTime
FROM prepared""")
def derived_job_metrics(spark, sf_dir):
    return prepared_jobs(spark, sf_dir, "workflow").select(
        "GlobalJobId", "WmagentRequestName", "Tier", "RequestCpus", "CoreTimeHr", "WastedCpuTimeHr",
        "CommittedOverMaxWallTime",
    )


@query(f"{WORKFLOW_TABLE_SQL} SELECT * FROM workflows")
def workflow_efficiency(spark, sf_dir):
    return eff.sort_workflows(workflow_table(spark, sf_dir))


@query(f"{SITE_TABLE_SQL} SELECT * REPLACE (array_to_string(Schedds, ', ') AS Schedds) FROM sites")
def workflow_site_efficiency(spark, sf_dir):
    return texts(eff.sort_sites(site_table(spark, sf_dir)))


@query(f"{_TIER_JOBS} {_TIERS}")
def tier_overview(spark, sf_dir):
    return eff.tier_overview(prepared_jobs(spark, sf_dir, "tier"))


@query(f"{_TIER_JOBS} {_TIERS} ORDER BY Type <> 'production', Type, Tier, TierCpuEff")
def tier_sorted(spark, sf_dir):
    return eff.sort_tiers(eff.tier_overview(prepared_jobs(spark, sf_dir, "tier")))


@query(f"""{_LEVEL_JOBS}, leveled AS (
  SELECT CASE WHEN grouping(Workflow) = 1 THEN 'tier' WHEN grouping(Site) = 1 THEN 'workflow' ELSE 'site' END AS Level,
    Type, Workflow, WmagentRequestName, Site, Tier, CpuEffOutlier, {_RATIOS}, {_T1T2}
  FROM prepared GROUP BY GROUPING SETS (
    (Type, Workflow, WmagentRequestName, Site, Tier, CpuEffOutlier),
    (Type, Workflow, WmagentRequestName, CpuEffOutlier), (Tier, Type)))
SELECT * FROM leveled WHERE Level <> 'tier' OR Tier <> 'UNKNOWN'""")
def efficiency_grouping_sets(spark, sf_dir):
    return eff.all_levels(prepared_jobs(spark, sf_dir, "levels"))


def _contents(spark, tables, names):
    """Collections written as JSON lines and read again: the number of lines written, and sums over their content."""
    path = new_path(spark, "collections")
    counts = write_collections(tables, path, compression="lz4")
    sums = []
    for name, table in tables.items():
        read = spark.read.schema(table.schema).json(f"{path}/{name}")
        sums.append(read.agg(
            F.lit(name).alias("collection"), F.sum(F.col(names[name][0]).cast("double")).alias("cpu"),
            F.count_distinct(names[name][1]).alias("keys")))
    return counts.join(reduce(DataFrame.unionByName, sums), "collection")


@query(f"""{_SITE_JOBS}, detail AS (
  SELECT Type, Workflow, WmagentRequestName, Site, Tier, CpuEffOutlier, sum(CpuTimeHr) AS CpuTimeHr
  FROM prepared GROUP BY ALL),
main AS (SELECT Type, Workflow, WmagentRequestName, CpuEffOutlier, sum(CpuTimeHr) AS CpuTimeHr FROM detail GROUP BY ALL),
tiers AS (SELECT Tier, Type, sum(CpuTimeHr) AS CpuTimeHr FROM detail WHERE Tier <> 'UNKNOWN' GROUP BY ALL)
SELECT 'condor_detailed' AS collection, count(*) AS n, sum(CpuTimeHr) AS cpu, count(DISTINCT Site) AS keys FROM detail
UNION ALL SELECT 'condor_main', count(*), sum(CpuTimeHr), count(DISTINCT Workflow) FROM main
UNION ALL SELECT 'condor_tiers', count(*), sum(CpuTimeHr), count(DISTINCT Tier) FROM tiers""")
def efficiency_collections(spark, sf_dir):
    """The whole batch: one pass over the jobs, one written grain, three result collections."""
    grain = materialize(eff.finest_grain(prepared_jobs(spark, sf_dir, "site")), "grain")
    tables = {
        "condor_detailed": eff.site_level(grain),
        "condor_main": eff.workflow_level(grain),
        "condor_tiers": eff.tier_level(grain),
    }
    return _contents(spark, tables, {
        "condor_detailed": ("CpuTimeHr", "Site"), "condor_main": ("CpuTimeHr", "Workflow"),
        "condor_tiers": ("TierCpuTimeHr", "Tier"),
    })


@query(f"{SUCCESSFUL_WORK_SQL} SELECT fwjr_id, task, jobtype, ts FROM wanted")
def successful_steps(spark, sf_dir):
    found = steps.successful_work(views.work(spark, sf_dir), START, END)
    return found.select("meta_data.fwjr_id", "task", "meta_data.jobtype", "meta_data.ts")


@query(f"""{FLAT_STEPS_SQL}
SELECT * REPLACE (array_to_string(acquisition_era, ', ') AS acquisition_era) FROM flat""")
def step_flatten(spark, sf_dir):
    return texts(flat_steps(spark, sf_dir))


def _totals_sql(level: str) -> str:
    """The step levels in SQL, as the table ``totals``; the sets of eras come from ``eras``."""
    keys = ", ".join(steps.LEVEL_KEYS[level])
    sites = """, array_to_string(list_sort(list(DISTINCT Site)), ', ') AS Sites,
  CAST(count(DISTINCT Site) AS INT) AS SiteCount"""
    return f"""{FLAT_STEPS_SQL}, eras AS (
  SELECT {keys}, list_sort(list(DISTINCT era)) AS AcquisitionEra
  FROM (SELECT *, unnest(acquisition_era) AS era FROM flat) GROUP BY {keys}), totals AS (
SELECT {keys}, 100 * sum(cpu_time) / nullif(sum(threads_total_job_time), 0) AS CpuEfficiency,
  avg(number_of_steps) AS NumberOfStep, avg(nthreads) AS MeanThread, avg(nstreams) AS MeanStream,
  avg(cpu_time) / 3600 AS MeanCpuTimeHr, sum(cpu_time) / 3600 AS TotalCpuTimeHr,
  avg(job_time) / 3600 AS MeanJobTimeHr, sum(job_time) / 3600 AS TotalJobTimeHr,
  sum(threads_total_job_time) / 3600 AS TotalThreadJobTimeHr,
  sum(write_total_secs) / 3600 AS WriteTotalHr, sum(read_total_secs) / 3600 AS ReadTotalHr,
  100 * sum(read_total_secs) / nullif(sum(job_time), 0) AS ReadTimePercentage,
  sum(write_total_mb) AS WriteTotalMB, sum(read_total_mb) AS ReadTotalMB,
  avg(peak_rss) AS MeanPeakRss, avg(peak_v_size) AS MeanPeakVSize{sites if level != 'site' else ''}
FROM flat GROUP BY {keys})"""


def _task_sql(level: str) -> str:
    return f"""{_totals_sql(level)}
SELECT totals.*, array_to_string(AcquisitionEra, ', ') AS AcquisitionEra, CAST(len(AcquisitionEra) AS INT) AS EraCount
FROM totals JOIN eras USING ({', '.join(steps.LEVEL_KEYS[level])})"""


@query(_task_sql("task"))
def task_efficiency(spark, sf_dir):
    return texts(task_table(spark, sf_dir, "task"))


@query(f"""{_totals_sql('task')} SELECT totals.* EXCLUDE (Sites), CAST(len(AcquisitionEra) AS INT) AS EraCount
FROM totals JOIN eras USING (Task)""")
def task_counts(spark, sf_dir):
    """Figures and numbers of eras and sites without a set of them."""
    return steps.task_counts(steps.step_grain(flat_steps(spark, sf_dir)))


@query(_task_sql("step"))
def task_step_efficiency(spark, sf_dir):
    return texts(task_table(spark, sf_dir, "step"))


@query(_task_sql("site"))
def task_step_site_efficiency(spark, sf_dir):
    return texts(task_table(spark, sf_dir, "site"))


@query(f"""{FLAT_STEPS_SQL}, detail AS (SELECT Task, StepName, JobType, Site, sum(write_total_mb) AS mb FROM flat GROUP BY ALL),
steps AS (SELECT Task, StepName, JobType, sum(mb) AS mb FROM detail GROUP BY ALL),
tasks AS (SELECT Task, sum(mb) AS mb FROM steps GROUP BY ALL)
SELECT 'sc_task' AS collection, count(*) AS n, sum(mb) AS cpu, count(DISTINCT Task) AS keys FROM tasks
UNION ALL SELECT 'sc_task_step', count(*), sum(mb), count(DISTINCT StepName) FROM steps
UNION ALL SELECT 'sc_task_step_site', count(*), sum(mb), count(DISTINCT Site) FROM detail""")
def step_collections(spark, sf_dir):
    """The step batch: one written grain, three result collections; ``cpu`` is the data written, in MB."""
    grain = materialize(steps.step_grain(flat_steps(spark, sf_dir)), "step-grain")
    tables = {name: steps.task_efficiency(grain, level) for name, level in (
        ("sc_task", "task"), ("sc_task_step", "step"), ("sc_task_step_site", "site"))}
    return _contents(spark, tables, {
        "sc_task": ("WriteTotalMB", "Task"), "sc_task_step": ("WriteTotalMB", "StepName"),
        "sc_task_step_site": ("WriteTotalMB", "Site"),
    })
