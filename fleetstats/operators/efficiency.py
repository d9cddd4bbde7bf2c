"""CPU efficiency of grid jobs per workflow, site and tier.

All levels come from one aggregate at the finest grain: it reads the jobs once, combines on
the map side, and everything above works on its few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstats.functions.numbers import percent, ratio
from fleetstats.functions.times import epoch_millis

SITE_KEYS = ["Type", "Workflow", "WmagentRequestName", "Site", "Tier", "CpuEffOutlier"]
WORKFLOW_KEYS = ["Type", "Workflow", "WmagentRequestName", "CpuEffOutlier"]
TIER_KEYS = ["Tier", "Type"]

# The tiers counted separately, and the name of jobs without a known tier.
TOP_TIERS = ("T1", "T2")
NO_TIER = "UNKNOWN"
NO_REQUEST = "NULL"

_SUMMED = [
    "RequestCpus", "CpuTimeHr", "WallClockHr", "CoreTimeHr", "CommittedCoreHr", "CommittedWallClockHr",
    "WastedCpuTimeHr", "ChirpCMSSWReadTimeMsecs", "ChirpCMSSWElapsed",
]
_SUMMED_TOP = ["RequestCpus", "CpuTimeHr", "WallClockHr", "CoreTimeHr", "WastedCpuTimeHr"]


def completed_jobs(jobs: DataFrame, start, end) -> DataFrame:
    """Successfully completed jobs recorded in ``[start, end)``."""
    when = F.col("RecordTime")
    return jobs.where(
        (F.col("Status") == "Completed")
        & (F.col("JobFailed") == 0)
        & (when >= epoch_millis(start))
        & (when < epoch_millis(end))
    )


def latest_per_key(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """One row per key: the newest, ties broken by the remaining columns in order.

    A maximum of whole rows rather than a ranking, because it shrinks a hot key to one row
    per map task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest]
    row = F.max(F.struct(*newest, *rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def dedup_jobs(jobs: DataFrame) -> DataFrame:
    return latest_per_key(jobs, ["GlobalJobId"], ["RecordTime"])


def derive_metrics(jobs: DataFrame) -> DataFrame:
    """Core time, wasted CPU time, share of the wall-time limit; defaults for absent values.

    Only what the columns at hand allow.
    """
    cpus = F.coalesce("RequestCpus", F.lit(1.0))
    core_time = F.col("WallClockHr") * cpus
    derived = {
        "Tier": F.upper("Tier"),
        "RequestCpus": cpus,
        "CoreTimeHr": core_time,
        "WastedCpuTimeHr": core_time - F.col("CpuTimeHr"),
    }
    if "WMAgent_RequestName" in jobs.columns:
        derived["WmagentRequestName"] = F.coalesce("WMAgent_RequestName", F.lit(NO_REQUEST))
    if "MaxWallTimeMins" in jobs.columns:
        derived["CommittedOverMaxWallTime"] = ratio(60.0 * F.col("CommittedWallClockHr"), F.col("MaxWallTimeMins"))
    return jobs.withColumns(derived)


# What each level reads of a job besides its id and time. The columns of a level are chosen before rows of one
# id are reduced to the newest, so only they travel, and ties between equally new rows are broken by them alone.
_TIER_COLUMNS = ["Tier", "Type", "WallClockHr", "CpuTimeHr", "RequestCpus"]
_WORKFLOW_COLUMNS = [
    "Workflow", "WMAgent_RequestName", "Tier", "Type", "WallClockHr", "CpuTimeHr", "CommittedCoreHr",
    "CommittedWallClockHr", "MaxWallTimeMins", "RequestCpus", "ChirpCMSSWReadTimeMsecs", "ChirpCMSSWElapsed",
    "CpuEffOutlier",
]
LEVEL_COLUMNS = {
    "tier": _TIER_COLUMNS,
    "workflow": _WORKFLOW_COLUMNS,
    "levels": [*_WORKFLOW_COLUMNS, "Site"],
    "site": [*_WORKFLOW_COLUMNS, "Site", "ScheddName", "WMAgent_JobID"],
}


def prepare_jobs(jobs: DataFrame, start, end, level: str = "site") -> DataFrame:
    """The newest rows of completed jobs with the derived columns that a level needs."""
    wanted = ["GlobalJobId", "RecordTime", *LEVEL_COLUMNS[level]]
    done = completed_jobs(jobs, start, end)
    return derive_metrics(dedup_jobs(done.select(*[c for c in jobs.columns if c in wanted])))


def _is_top() -> Column:
    return F.col("Tier").isin(*TOP_TIERS)


def _job_sums() -> list[Column]:
    """Everything the measures of a level are made of, over prepared jobs."""
    return [
        *[F.sum(c).alias(c) for c in _SUMMED],
        *[F.sum(F.when(_is_top(), F.col(c))).alias(c + "T1T2") for c in _SUMMED_TOP],
        F.sum("CommittedOverMaxWallTime").alias("ShareSum"),
        F.count("CommittedOverMaxWallTime").alias("ShareCount"),
    ]


def _grain_sums() -> list[Column]:
    """The same over the rows of the finest grain."""
    names = _SUMMED + [c + "T1T2" for c in _SUMMED_TOP] + ["ShareSum", "ShareCount"]
    return [F.sum(c).alias(c) for c in names]


def finest_grain(prepared: DataFrame, with_ids: bool = True) -> DataFrame:
    """Sums and counts per site-level key, from which every level can be computed.

    The schedulers' names and the largest job id are only needed at site level; leaving them
    out keeps the aggregate in the fast hash form.
    """
    ids = [F.collect_set("ScheddName").alias("Schedds"), F.max("WMAgent_JobID").alias("MaxWmagentJobId")]
    return prepared.groupBy(*SITE_KEYS).agg(*_job_sums(), *(ids if with_ids else []))


def _regroup(grain: DataFrame, keys: list[str]) -> DataFrame:
    return grain.groupBy(*keys).agg(*_grain_sums())


def _measures() -> dict[str, Column]:
    """Result columns shared by the site and workflow levels."""
    c = F.col
    cpu_eff = percent(c("CpuTimeHr"), c("CoreTimeHr"))
    non_eviction = percent(c("CpuTimeHr"), c("CommittedCoreHr"))
    return {
        "CpuEff": cpu_eff,
        "NonEvictionEff": non_eviction,
        "EvictionAwareEffDiff": non_eviction - cpu_eff,
        "ScheduleEff": percent(c("CommittedWallClockHr"), c("WallClockHr")),
        "CmsswReadTimePercentage": percent(c("ChirpCMSSWReadTimeMsecs") / 1000, c("ChirpCMSSWElapsed")),
        "Cpus": c("RequestCpus"),
        "CpuTimeHr": c("CpuTimeHr"),
        "WallClockHr": c("WallClockHr"),
        "CoreTimeHr": c("CoreTimeHr"),
        "CommittedCoreHr": c("CommittedCoreHr"),
        "CommittedWallClockHr": c("CommittedWallClockHr"),
        "WastedCpuTimeHr": c("WastedCpuTimeHr"),
        "CommittedOverMaxWallTimeAvg": ratio(c("ShareSum"), c("ShareCount")),
    }


def _top_measures() -> dict[str, Column]:
    c = F.col
    return {
        "CpuEffT1T2": percent(c("CpuTimeHrT1T2"), c("CoreTimeHrT1T2")),
        "CpusT1T2": c("RequestCpusT1T2"),
        "CpuTimeHrT1T2": c("CpuTimeHrT1T2"),
        "WallClockHrT1T2": c("WallClockHrT1T2"),
        "CoreTimeHrT1T2": c("CoreTimeHrT1T2"),
        "WastedCpuTimeHrT1T2": c("WastedCpuTimeHrT1T2"),
    }


def _tier_measures() -> dict[str, Column]:
    c = F.col
    return {
        "TierCpuEff": percent(c("CpuTimeHr"), c("CoreTimeHr")),
        "TierCpus": c("RequestCpus"),
        "TierCpuTimeHr": c("CpuTimeHr"),
        "TierWallClockHr": c("WallClockHr"),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [col.alias(name) for name, col in columns.items()]


def site_level(grain: DataFrame) -> DataFrame:
    return grain.select(*SITE_KEYS, *_named(_measures()), F.sort_array("Schedds").alias("Schedds"), "MaxWmagentJobId")


def workflow_level(grain: DataFrame) -> DataFrame:
    return _regroup(grain, WORKFLOW_KEYS).select(*WORKFLOW_KEYS, *_named(_measures()), *_named(_top_measures()))


def tier_level(grain: DataFrame) -> DataFrame:
    """Rows without a known tier are left out."""
    known = grain.where(F.col("Tier") != NO_TIER)
    return _regroup(known, TIER_KEYS).select(*TIER_KEYS, *_named(_tier_measures()))


def workflow_site_efficiency(prepared: DataFrame) -> DataFrame:
    return site_level(finest_grain(prepared))


def workflow_efficiency(prepared: DataFrame) -> DataFrame:
    """Straight from the jobs: for one level alone a single shuffle is enough."""
    grouped = prepared.groupBy(*WORKFLOW_KEYS).agg(*_job_sums())
    return grouped.select(*WORKFLOW_KEYS, *_named(_measures()), *_named(_top_measures()))


def tier_overview(prepared: DataFrame) -> DataFrame:
    known = prepared.where(F.col("Tier") != NO_TIER)
    sums = [F.sum(c).alias(c) for c in ("RequestCpus", "CpuTimeHr", "WallClockHr", "CoreTimeHr")]
    return known.groupBy(*TIER_KEYS).agg(*sums).select(*TIER_KEYS, *_named(_tier_measures()))


def all_levels(prepared: DataFrame) -> DataFrame:
    """Site, workflow and tier level in one table, from one pass over the jobs.

    The grouping sets expand the finest grain, not the jobs, so the tripled rows are few.
    """
    grain = finest_grain(prepared, with_ids=False)
    sets = [[F.col(k) for k in keys] for keys in (SITE_KEYS, WORKFLOW_KEYS, TIER_KEYS)]
    grouped = grain.groupingSets(sets, *SITE_KEYS).agg(
        F.grouping("Workflow").alias("_no_workflow"),
        F.grouping("Site").alias("_no_site"),
        *_grain_sums(),
    )
    level = (
        F.when(F.col("_no_workflow") == 1, F.lit("tier")).when(F.col("_no_site") == 1, F.lit("workflow"))
    ).otherwise(F.lit("site"))
    kept = grouped.withColumn("Level", level).where((F.col("Level") != "tier") | (F.col("Tier") != NO_TIER))
    return kept.select("Level", *SITE_KEYS, *_named(_measures()), *_named(_top_measures()))


def sort_sites(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("Type"), "Workflow", "WmagentRequestName", "Site", "CoreTimeHr")


def sort_workflows(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc("Type"), "Workflow", "WmagentRequestName", "CoreTimeHr")


def sort_tiers(table: DataFrame) -> DataFrame:
    """Production first, then type, tier and efficiency."""
    first = F.when(F.col("Type") == "production", 0).otherwise(1)
    return table.orderBy(first, "Type", "Tier", "TierCpuEff")
