"""CPU efficiency of the steps inside work records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstats.functions.numbers import filled, nonzero, percent, ratio
from fleetstats.functions.times import epoch_seconds
from fleetstats.schemas import FLAT_STEP

# The job types that count as production work, and the name of payload steps.
PRODUCTION_JOB_TYPES = ("Production", "Processing", "Merge", "LogCollect", "Harvesting")
PAYLOAD_STEP = "cmsrun"

LEVEL_KEYS = {
    "task": ["Task"],
    "step": ["Task", "StepName", "JobType"],
    "site": ["Task", "StepName", "JobType", "Site"],
}


def successful_work(work: DataFrame, start, end) -> DataFrame:
    """Records of successful production work written in ``[start, end)``."""
    return work.where(
        (F.col("meta_data.jobstate") == "success")
        & (F.col("wmats") >= epoch_seconds(start))
        & (F.col("wmats") < epoch_seconds(end))
        & F.col("task").isNotNull()
        & F.col("meta_data.jobtype").isin(*PRODUCTION_JOB_TYPES)
    )


def flatten_steps(work: DataFrame) -> DataFrame:
    """One row per payload step; equal rows once, rows without a stream count dropped.

    Zero and empty values count as absent in products and times. Done with array functions only, so nothing leaves the JVM.
    """
    payload = F.filter("steps", lambda s: F.lower(s["name"]).startswith(PAYLOAD_STEP))
    # the outer form, because the plain one would evaluate the filter once more just to test
    # for emptiness; rows without a step fall to the test of the stream count
    exploded = work.select(
        F.col("meta_data.ts").alias("ts"),
        F.col("task").alias("Task"),
        F.col("meta_data.fwjr_id").alias("fwjr_id"),
        F.col("meta_data.jobtype").alias("JobType"),
        payload.alias("payload"),
    ).withColumn("number_of_steps", F.size("payload")).withColumn("step", F.explode_outer("payload")).drop("payload")

    cpu, storage = F.col("step.performance.cpu"), F.col("step.performance.storage")
    threads, cpu_time, job_time = cpu["NumberOfThreads"], cpu["TotalJobCPU"], cpu["TotalJobTime"]
    eras = F.transform("step.output", lambda o: o["acquisitionEra"])
    eras = F.sort_array(F.array_distinct(F.filter(F.coalesce(eras, F.array()), lambda e: filled(e).isNotNull())))
    both = nonzero(cpu_time).isNotNull()

    columns: dict[str, Column] = {
        "Site": F.col("step.site"),
        "acquisition_era": eras,
        "StepName": F.col("step.name"),
        "nstreams": cpu["NumberOfStreams"],
        "nthreads": threads,
        "cpu_time": cpu_time,
        "job_time": job_time,
        "threads_total_job_time": F.when(both, nonzero(job_time) * nonzero(threads)),
        "write_total_mb": storage["writeTotalMB"],
        "read_total_mb": storage["readTotalMB"],
        "read_total_secs": nonzero(filled(storage["readTotalSecs"]).try_cast("double")),
        "write_total_secs": nonzero(filled(storage["writeTotalSecs"]).try_cast("double")),
        "peak_rss": F.col("step.performance.memory.PeakValueRss"),
        "peak_v_size": F.col("step.performance.memory.PeakValueVsize"),
    }
    flat = exploded.withColumns(columns).where(F.col("nstreams").isNotNull()).withColumn(
        "era_length", F.size("acquisition_era")
    )
    return flat.select(*[F.col(f.name).cast(f.dataType) for f in FLAT_STEP.fields]).distinct()


_SUMMED = [
    "cpu_time", "job_time", "threads_total_job_time", "write_total_secs", "read_total_secs",
    "write_total_mb", "read_total_mb", "number_of_steps", "nthreads", "nstreams", "peak_rss", "peak_v_size",
]
_COUNTED = ["cpu_time", "job_time", "number_of_steps", "nthreads", "nstreams", "peak_rss", "peak_v_size"]


def step_grain(flat: DataFrame) -> DataFrame:
    """Sums and counts per task, step, job type, site and set of eras.

    Only numeric buffers, so this first and heavy aggregate stays a hash aggregate; sets are
    collected afterwards from its rows.
    """
    return flat.groupBy("Task", "StepName", "JobType", "Site", "acquisition_era").agg(
        *[F.sum(c).alias(c) for c in _SUMMED], *[F.count(c).alias(c + "_n") for c in _COUNTED]
    )


def _figures() -> dict[str, Column]:
    """The figures of a group from its sums and counts."""
    def mean(name: str) -> Column:
        return ratio(F.col(name), F.col(name + "_n"))

    c = F.col
    return {
        "CpuEfficiency": percent(c("cpu_time"), c("threads_total_job_time")),
        "NumberOfStep": mean("number_of_steps"),
        "MeanThread": mean("nthreads"),
        "MeanStream": mean("nstreams"),
        "MeanCpuTimeHr": mean("cpu_time") / 3600,
        "TotalCpuTimeHr": c("cpu_time") / 3600,
        "MeanJobTimeHr": mean("job_time") / 3600,
        "TotalJobTimeHr": c("job_time") / 3600,
        "TotalThreadJobTimeHr": c("threads_total_job_time") / 3600,
        "WriteTotalHr": c("write_total_secs") / 3600,
        "ReadTotalHr": c("read_total_secs") / 3600,
        "ReadTimePercentage": percent(c("read_total_secs"), c("job_time")),
        "WriteTotalMB": c("write_total_mb"),
        "ReadTotalMB": c("read_total_mb"),
        "MeanPeakRss": mean("peak_rss"),
        "MeanPeakVSize": mean("peak_v_size"),
    }


def _totals() -> list[Column]:
    return [F.sum(c).alias(c) for c in (*_SUMMED, *(c + "_n" for c in _COUNTED))]


def task_efficiency(grain: DataFrame, level: str = "task") -> DataFrame:
    """Efficiency per task, per step of a task, or per step and site, with the eras and sites themselves."""
    keys = LEVEL_KEYS[level]
    with_sites = "Site" not in keys
    sets = [F.sort_array(F.array_distinct(F.flatten(F.collect_set("acquisition_era")))).alias("AcquisitionEra")]
    if with_sites:
        sets.append(F.sort_array(F.collect_set("Site")).alias("Sites"))
    else:
        # a group has a row of the grain for each set of eras that it collects, so combining before the shuffle saves nothing
        grain = grain.repartition(*keys)
    grouped = grain.groupBy(*keys).agg(*_totals(), *sets)
    result = {**_figures(), "AcquisitionEra": F.col("AcquisitionEra"), "EraCount": F.size("AcquisitionEra")}
    if with_sites:
        result |= {"Sites": F.col("Sites"), "SiteCount": F.size("Sites")}
    return grouped.select(*keys, *[col.alias(name) for name, col in result.items()])


def task_counts(grain: DataFrame, level: str = "task") -> DataFrame:
    """The figures of ``task_efficiency`` with the numbers of eras and sites, but not these themselves.

    No set is held anywhere: a row of the grain becomes one with its sums, and one for each era and its site; equal eras and
    sites of a group meet in one row, and those rows are counted. All aggregates are numeric, so a task with any number of
    eras or sites is reduced on the map side like any other.
    """
    keys = LEVEL_KEYS[level]
    eras = F.transform("acquisition_era", lambda e: F.struct(F.lit("era").alias("kind"), e.alias("element")))
    own = F.array(F.struct(F.lit("sums").alias("kind"), F.lit(None).cast("string").alias("element")))
    sites = F.array(F.struct(F.lit("site").alias("kind"), F.col("Site").alias("element")))
    has_site = F.col("Site").isNotNull() & F.lit("Site" not in keys)
    parts = F.concat(own, eras, F.when(has_site, sites).otherwise(F.filter(sites, lambda _: F.lit(False))))
    names = [*_SUMMED, *(c + "_n" for c in _COUNTED)]
    rows = grain.withColumn("part", F.explode(parts)).select(
        *keys, F.col("part.kind").alias("kind"), F.col("part.element").alias("element"),
        *[F.when(F.col("part.kind") == "sums", F.col(c)).alias(c) for c in names],
    )
    elements = rows.groupBy(*keys, "kind", "element").agg(*_totals())
    counted = {"EraCount": "era"} if "Site" in keys else {"EraCount": "era", "SiteCount": "site"}
    counts = [F.count_if(F.col("kind") == kind).cast("int").alias(name) for name, kind in counted.items()]
    grouped = elements.groupBy(*keys).agg(*_totals(), *counts)
    return grouped.select(*keys, *[col.alias(name) for name, col in _figures().items()], *counted)


def sort_tasks(table: DataFrame, level: str = "task") -> DataFrame:
    return table.orderBy(*LEVEL_KEYS[level])
