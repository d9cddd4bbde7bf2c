"""The given tables seen as grid records, in Spark and, next to it, in SQL.

All measures are whole numbers held as doubles, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstats.plans.registry import load
from fleetstats.schemas import JOB_FIELDS, WORK_FIELDS

START, END = "1996-01-01", "2000-01-01"

_TAX = "CAST(round(l_tax * 100) AS INT)"
_DISCOUNT = "CAST(round(l_discount * 100) AS INT)"
_COMMITTED = "CASE WHEN l_quantity < 3 THEN 0 ELSE l_quantity - 2 END"

# Column expressions that mean the same in Spark SQL and in the checking engine.
_JOB_COLUMNS = {
    "GlobalJobId": "concat(CAST(l_orderkey AS STRING), '#', CAST(l_linenumber AS STRING))",
    "Workflow": "concat('wf_', CAST(l_partkey AS STRING))",
    "WMAgent_RequestName": f"CASE WHEN {_DISCOUNT} > 0 THEN concat('req_', CAST(l_partkey AS STRING)) END",
    "ScheddName": "CASE WHEN l_linenumber < 7 THEN concat('schedd_', CAST(l_linenumber AS STRING)) END",
    "WMAgent_JobID": "CAST(l_orderkey AS STRING)",
    "JobFailed": f"CAST(CASE WHEN {_TAX} = 8 THEN 1 ELSE 0 END AS BIGINT)",
    "Status": "CASE WHEN l_linestatus = 'F' THEN 'Completed' ELSE 'Running' END",
    "Site": f"concat('T', CAST({_TAX} AS STRING), '_Site_', CAST(l_suppkey AS STRING))",
    "Tier": f"CASE WHEN {_TAX} = 7 THEN 'unknown' WHEN {_TAX} > 3 THEN concat('T', CAST({_TAX} - 3 AS STRING)) "
            f"WHEN {_TAX} > 0 THEN concat('t', CAST({_TAX} AS STRING)) END",
    "Type": "CASE l_returnflag WHEN 'A' THEN 'analysis' WHEN 'N' THEN 'production' ELSE 'test' END",
    "WallClockHr": "l_quantity - 1",
    "CpuTimeHr": "CAST(floor(l_extendedprice) AS DOUBLE)",
    "CommittedCoreHr": f"CAST(({_COMMITTED}) * l_linenumber AS DOUBLE)",
    "CommittedWallClockHr": f"CAST({_COMMITTED} AS DOUBLE)",
    "MaxWallTimeMins": "CAST(CASE WHEN l_linenumber = 6 THEN 0 WHEN l_linenumber < 4 THEN 480 ELSE 960 END AS DOUBLE)",
    "RequestCpus": "CAST(CASE WHEN l_linenumber < 7 THEN l_linenumber END AS DOUBLE)",
    "ChirpCMSSWReadTimeMsecs": f"CASE WHEN {_TAX} <> 1 THEN l_quantity * 125 END",
    "ChirpCMSSWElapsed": f"CASE WHEN {_TAX} <> 1 THEN l_quantity * 10 END",
    "CpuEff": "CAST(NULL AS DOUBLE)",
    "CpuEffOutlier": f"CASE WHEN {_DISCOUNT} > 8 THEN 1 ELSE 0 END",
}

_ERA = "CASE WHEN l_linenumber = 5 THEN '' WHEN l_linenumber < 7 THEN concat('Era', CAST(l_linenumber AS STRING)) END"
# Whole seconds, so hours are the only fractions.
_CPU_TIME = f"CAST(CASE WHEN {_DISCOUNT} = 0 THEN 0 ELSE l_quantity * 60 END AS DOUBLE)"
_WORK_COLUMNS = {
    "fwjr_id": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "task": f"CASE WHEN {_TAX} < 8 THEN concat('/wf_', CAST(l_partkey AS STRING), '/Chain') END",
    "jobtype": "CASE l_returnflag WHEN 'A' THEN 'Processing' WHEN 'N' THEN 'Merge' ELSE 'Cleanup' END",
    "jobstate": "CASE WHEN l_linestatus = 'F' THEN 'success' ELSE 'jobfailed' END",
    "site": f"concat('T2_Site_', CAST(l_suppkey AS STRING))",
    "threads": "CASE WHEN l_linenumber = 6 THEN 0 ELSE l_linenumber END",
    "streams": f"CASE WHEN {_DISCOUNT} <> 5 THEN l_linenumber END",
    "cpu_time": _CPU_TIME,
    "job_time": "CAST(l_quantity * 90 AS DOUBLE)",
    "era": _ERA,
    "mb": "CAST(l_quantity * 8 AS DOUBLE)",
    "read_secs": "CASE WHEN l_linenumber = 4 THEN '' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
    "rss": "CASE WHEN l_linenumber <> 3 THEN CAST(l_quantity * 16 AS DOUBLE) END",
}


def _select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


JOBS_SQL = f"SELECT {_select_list(_JOB_COLUMNS)}, epoch_ms(l_shipdate) AS RecordTime FROM lineitem"


def order_lines(spark: SparkSession, sf_dir: str, start: str | None = START, end: str | None = END) -> DataFrame:
    """The rows that records are made from; a period prunes the scan by ship date, as the day folders of an archive would."""
    lines = load(spark, sf_dir, "lineitem")
    if start is not None:
        lines = lines.where(F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        lines = lines.where(F.col("l_shipdate") < F.lit(end).cast("timestamp_ntz"))
    return lines


def jobs(spark: SparkSession, sf_dir: str, start: str | None = START, end: str | None = END) -> DataFrame:
    """Job records, one per order line. Order and line number repeat, so ids do too."""
    return job_records(order_lines(spark, sf_dir, start, end))


def job_records(lines: DataFrame, *keep: str) -> DataFrame:
    columns = {name: F.expr(expr) for name, expr in _JOB_COLUMNS.items()}
    columns["RecordTime"] = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    return lines.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in JOB_FIELDS.fields], *keep)


# Prepared jobs in SQL: filter, newest row per id, defaults, derived columns.
# Ties are broken by the columns of the level in their order, as in the operator, nulls last.
def prepared_jobs_sql(columns: list[str] | None = None) -> str:
    wanted = [f for f in JOB_FIELDS.names if columns is None or f in columns]
    ties = ", ".join(f"{f} DESC NULLS LAST" for f in wanted if f not in ("GlobalJobId", "RecordTime"))
    return f"""
WITH jobs AS ({JOBS_SQL}),
completed AS (
  SELECT * FROM jobs
  WHERE Status = 'Completed' AND JobFailed = 0
    AND RecordTime >= epoch_ms(TIMESTAMP '{START}') AND RecordTime < epoch_ms(TIMESTAMP '{END}')),
newest AS (
  SELECT * FROM completed
  QUALIFY row_number() OVER (PARTITION BY GlobalJobId ORDER BY RecordTime DESC, {ties}) = 1),
prepared AS (
  SELECT * REPLACE (upper(Tier) AS Tier, coalesce(RequestCpus, 1) AS RequestCpus),
    coalesce(WMAgent_RequestName, 'NULL') AS WmagentRequestName,
    WallClockHr * coalesce(RequestCpus, 1) AS CoreTimeHr,
    WallClockHr * coalesce(RequestCpus, 1) - CpuTimeHr AS WastedCpuTimeHr,
    60 * CommittedWallClockHr / nullif(MaxWallTimeMins, 0) AS CommittedOverMaxWallTime
  FROM newest)
"""


def work(spark: SparkSession, sf_dir: str, start: str | None = START, end: str | None = END) -> DataFrame:
    """Work records, one per order line: two payload steps, one other step, one without a name."""
    return work_records(order_lines(spark, sf_dir, start, end))


def work_records(lines: DataFrame, *keep: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    base = lines.select(
        *[F.expr(expr).alias("w_" + name) for name, expr in _WORK_COLUMNS.items()], seconds.alias("w_ts"), *keep
    )

    def step(name: str | None) -> str:
        label = f"'{name}'" if name else "CAST(NULL AS STRING)"
        return f"""named_struct('name', {label}, 'site', w_site,
            'performance', named_struct(
                'cpu', named_struct('NumberOfStreams', w_streams, 'NumberOfThreads', w_threads,
                                    'TotalJobCPU', w_cpu_time, 'TotalJobTime', w_job_time),
                'storage', named_struct('writeTotalMB', w_mb, 'readTotalMB', w_mb,
                                        'writeTotalSecs', w_read_secs, 'readTotalSecs', w_read_secs),
                'memory', named_struct('PeakValueRss', w_rss, 'PeakValueVsize', w_rss)),
            'output', array(named_struct('acquisitionEra', w_era), named_struct('acquisitionEra', 'EraCommon')))"""

    steps = f"array({step('cmsRun1')}, {step('stageOut1')}, {step('CMSRUN2')}, {step(None)}, NULL)"
    columns = {
        "task": F.col("w_task"),
        "wmats": F.col("w_ts"),
        "meta_data": F.struct(
            F.col("w_fwjr_id").alias("fwjr_id"), F.col("w_jobtype").alias("jobtype"),
            F.col("w_jobstate").alias("jobstate"), F.col("w_ts").alias("ts"),
        ),
        "steps": F.expr(steps),
    }
    return base.select(*[columns[name].alias(name) for name in WORK_FIELDS.names], *keep)


# Successful production work in SQL, and its flattened steps.
SUCCESSFUL_WORK_SQL = f"""
WITH work AS (
  SELECT {_select_list(_WORK_COLUMNS)}, CAST(epoch(l_shipdate) AS BIGINT) AS ts FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '{START}' AND l_shipdate < TIMESTAMP '{END}'),
wanted AS (
  SELECT * FROM work WHERE jobstate = 'success' AND task IS NOT NULL
    AND jobtype IN ('Production', 'Processing', 'Merge', 'LogCollect', 'Harvesting'))"""

FLAT_STEPS_SQL = f"""{SUCCESSFUL_WORK_SQL},
flat AS (
  SELECT DISTINCT ts, task AS Task, fwjr_id, jobtype AS JobType, site AS Site,
    CASE WHEN era IS NULL OR era = '' THEN ['EraCommon'] ELSE list_sort([era, 'EraCommon']) END AS acquisition_era,
    StepName, streams AS nstreams, threads AS nthreads, cpu_time, job_time,
    CASE WHEN cpu_time <> 0 AND job_time <> 0 AND threads <> 0 THEN job_time * threads END AS threads_total_job_time,
    CASE WHEN era IS NULL OR era = '' THEN 1 ELSE 2 END AS era_length, 2 AS number_of_steps,
    mb AS write_total_mb, mb AS read_total_mb,
    CAST(nullif(read_secs, '') AS DOUBLE) AS read_total_secs,
    CAST(nullif(read_secs, '') AS DOUBLE) AS write_total_secs, rss AS peak_rss, rss AS peak_v_size
  FROM wanted CROSS JOIN (VALUES ('cmsRun1'), ('CMSRUN2')) AS names(StepName) WHERE streams IS NOT NULL)
"""
