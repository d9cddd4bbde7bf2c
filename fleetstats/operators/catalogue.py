"""Catalogue tables: extracts by change time, star joins, snapshots, retention.

Joins carry no broadcast hints: a dimension is broadcast when its measured size is under the
session's limit, and joined by sort-merge (with skewed partitions split at run time) beyond it.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstats.functions.times import utc


def changed_between(
    df: DataFrame, start, end, created: str = "creation_date", modified: str = "last_modification_date",
    mode: str = "both",
) -> DataFrame:
    """Rows created or changed in ``[start, end)``.

    ``both``: either time is at or after the start, and both are before the end, so a row never
    modified, or modified after the end, is not in. ``either``: one of the times lies inside.
    """
    c, m = F.col(created), F.col(modified)
    if mode == "both":
        return df.where(((c >= start) | (m >= start)) & (c < end) & (m < end))
    if mode == "either":
        return df.where(((c >= start) & (c < end)) | ((m >= start) & (m < end)))
    raise ValueError(f"unknown mode {mode!r}")


def snapshot_as_of(df: DataFrame, moment, created: str = "creation_date", modified: str | None = None) -> DataFrame:
    """Rows that existed, and were last changed, before a moment."""
    kept = df.where(F.col(created) < moment)
    return kept if modified is None else kept.where(F.col(modified) < moment)


def range_extract(df: DataFrame, column: str, start: str, end: str, fmt: str = "%y-%m-%d %H:%M:%S") -> DataFrame:
    """Rows of a half-open range given as text; the bounds become literals the scan can use."""
    kind = df.schema[column].dataType
    low, high = (F.lit(datetime.strptime(text, fmt).isoformat(" ")).cast(kind) for text in (start, end))
    return df.where((F.col(column) >= low) & (F.col(column) < high))


def changed_files(files: DataFrame, blocks: DataFrame, datasets: DataFrame, start, end) -> DataFrame:
    """Files created or changed in the period with their block and dataset.

    The period is applied before the joins.
    """
    changed = changed_between(files, start, end, "file_creation_date", "file_modification_date", "either")
    return changed.join(blocks, "block_id").join(datasets, "dataset_id")


def popularity_star(t: Mapping[str, DataFrame], start: str, end: str) -> DataFrame:
    """Files and blocks read by the jobs finished in a period, with all their dimensions."""
    jobs = range_extract(t["job"], "FinishedTimeStamp", start, end)
    facts = jobs.join(t["job_file"], "JobId").join(t["job_block"], "JobId").join(t["task"], "TaskId")
    dims = [
        ("data_block", "BlockId"), ("input_collection", "InputCollectionId"), ("application", "ApplicationId"),
        ("task_type", "TaskTypeId"), ("submission_tool", "SubmissionToolId"), ("site", "SiteId"),
        ("scheduler", "SchedulerId"), ("users", "UserId"),
    ]
    return reduce(lambda df, dim: df.join(t[dim[0]], dim[1]), dims, facts).select(
        "JobId", "FileName", "IsParentFile", "SuccessFlag", "FileType", "BlockId", "BlockName", "InputCollection",
        "Application", "Type", "SubmissionTool", "SiteName", "SchedulerName", "TaskId", "UserId", "GridName",
        "FinishedTimeStamp",
    )


def job_state(job_end: Column, grid_end: Column) -> Column:
    """Success if the job ended well and the grid reports done or unknown, else failed."""
    good = (job_end == "S") & grid_end.isin("D", "U")
    return F.when(good, F.lit("success")).otherwise(F.lit("failed"))


def dashboard_star(t: Mapping[str, DataFrame], start: str, end: str) -> DataFrame:
    """Terminated jobs of a period with state, duration and all their dimensions."""
    jobs = range_extract(t["job"], "FinishedTimeStamp", start, end).where(
        (F.col("DboardStatusId") == "T") & F.col("DboardJobEndId").isin("S", "F") & (F.col("TimeOutFlag") != 1)
    )
    facts = jobs.join(t["task"], "TaskId").join(t["node"].withColumnRenamed("NodeId", "WNIp"), "WNIp")
    dims = [
        ("task_type", "TaskTypeId"), ("users", "UserId"), ("site", "SiteId"), ("input_collection", "InputCollectionId"),
        ("application", "ApplicationId"), ("submission_tool", "SubmissionToolId"), ("scheduler", "SchedulerId"),
    ]
    joined = reduce(lambda df, dim: df.join(t[dim[0]], dim[1]), dims, facts)
    seconds = [F.unix_seconds(F.col(c).cast("timestamp")) for c in ("FinishedTimeStamp", "StartedRunningTimeStamp")]
    return joined.select(
        "JobId", "TaskId", job_state(F.col("DboardJobEndId"), F.col("DboardGridEndId")).alias("state"),
        (seconds[0] - seconds[1]).alias("duration"), "NodeName", "Type", "GridName", "SiteName", "InputCollection",
        "Application", "SubmissionTool", "SchedulerName",
    )


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def latest_snapshot(df: DataFrame, complete: DataFrame, date_column: str = "snapshot_date") -> DataFrame:
    """Rows of the newest snapshot among those that are marked as complete.

    ``complete`` has a date per dump that passed its check, whatever its size (see ``sinks.write_snapshot``). The date is
    found by a subquery over these marks, so only that snapshot's folder is read. Without a mark there are no rows.
    """
    return df.where(F.col(date_column) == complete.agg(F.max(date_column)).scalar())


def expired_partitions(
    partitions: DataFrame, retention_days: Mapping[str, int], as_of, family: str = "family", day: str = "dt"
) -> DataFrame:
    """Partitions older than their family's retention; families without a rule never expire."""
    rules = [
        (F.col(family) == name) & (F.col(day) < F.lit((utc(as_of) - timedelta(days=days)).date()))
        for name, days in retention_days.items()
    ]
    return partitions.where(reduce(Column.__or__, rules))
