"""Time series: nested answers to rows, and histograms without holes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstats.functions.times import epoch_seconds
from fleetstats.schemas import SERIES_EXPORT, SERIES_MATRIX


def mark_series(df: DataFrame, col: str, labels: list[str]) -> DataFrame:
    """One row per sample of the range-query answers in ``col``, with ``reject_reason``.

    A sample whose time or value is no number is marked ``sample``, an answer that is no answer or has no success
    ``answer``; such rows keep the text of the answer. Answers without samples give no row.
    """
    parsed = df.withColumn("_answer", F.from_json(col, SERIES_MATRIX))
    good = F.coalesce(F.col("_answer.status") == "success", F.lit(False))
    none = F.array(F.lit(None).cast(SERIES_MATRIX["data"].dataType["result"].dataType.elementType))
    series = parsed.select("*", F.explode(F.when(good, F.col("_answer.data.result")).otherwise(none)).alias("_series"))
    empty = F.array(F.lit(None).cast("array<string>"))
    samples = series.select("*", F.explode(F.when(good, F.col("_series.values")).otherwise(empty)).alias("_sample"))
    at, value = (F.get(F.col("_sample"), F.lit(i)).try_cast("double") for i in (0, 1))
    bad = at.isNull() | F.isnan(at) | value.isNull()
    return samples.select(
        *df.columns,
        F.when(good & ~bad, F.timestamp_seconds(F.when(~bad, at).cast("long"))).alias("timestamp"),
        *[F.col("_series.metric")[name].alias(name) for name in labels],
        F.when(~bad, value).alias("value"),
        F.when(~good, F.lit("answer")).when(bad, F.lit("sample")).alias("reject_reason"),
    )


def explode_series(df: DataFrame, col: str, labels: list[str]) -> DataFrame:
    """One row per sample of the range-query answers in ``col``; for what is left out see ``mark_series``."""
    marked = mark_series(df, col, labels)
    return marked.where("reject_reason IS NULL").drop("reject_reason", col)


def element_tier(name: Column) -> Column:
    """The first two characters of a storage element's name."""
    return F.substring(name, 1, 2)


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def mark_export(df: DataFrame, col: str, labels: list[str]) -> DataFrame:
    """One row per sample of export lines, whose values and times (ms) are parallel arrays, with ``reject_reason``.

    Times may have fractions. A line that cannot be read is marked ``line``, a sample without a time ``sample``.
    """
    line = F.from_json(col, SERIES_EXPORT)
    parsed = df.withColumn("_line", line)
    read = F.coalesce(F.col("_line.timestamps").isNotNull() & F.col("_line.values").isNotNull(), F.lit(False))
    pairs = F.arrays_zip(F.col("_line.values").alias("v"), F.col("_line.timestamps").alias("t"))
    none = F.array(F.struct(F.lit(None).cast("double").alias("v"), F.lit(None).cast("double").alias("t")))
    points = parsed.select("*", F.explode(F.when(read, pairs).otherwise(none)).alias("_point"))
    return points.select(
        *df.columns,
        *[F.col("_line.metric")[name].alias(name) for name in labels],
        F.floor(F.col("_point.t") / 1000).alias("ts"),
        F.col("_point.v").alias("value"),
        F.when(~read, F.lit("line")).when(F.col("_point.t").isNull(), F.lit("sample")).alias("reject_reason"),
    )


def explode_export(df: DataFrame, col: str, labels: list[str]) -> DataFrame:
    """One row per sample of export lines; for what is left out see ``mark_export``."""
    marked = mark_export(df, col, labels)
    return marked.where("reject_reason IS NULL").drop("reject_reason", col)


def filter_series(df: DataFrame, kind: str, name_part: str = "") -> DataFrame:
    """Rows of exactly one dataset type whose name contains a text."""
    kept = df.where(F.col("dataset_type") == kind)
    return kept.where(F.col("dataset").contains(name_part)) if name_part else kept


def map_rows(df: DataFrame, col: str, value_ddl: str) -> DataFrame:
    """``{name: {...}, ...}`` objects as one row per name."""
    parsed = df.withColumn("_map", F.from_json(col, f"MAP<STRING, STRUCT<{value_ddl}>>"))
    return parsed.select(*df.drop(col).columns, F.explode("_map").alias("name", "_value")).select(
        *df.drop(col).columns, "name", "_value.*"
    )


def bucket_counts(
    df: DataFrame, ts: str, start, end, seconds: int, distinct: str | None = None, exact: bool = False,
    fill: int | None = 0,
) -> DataFrame:
    """Rows, and distinct values, per bucket of ``[start, end)``; empty buckets are kept.

    Buckets start at ``start``; their number follows from the bounds, not from the data. The
    distinct figure is approximate unless ``exact``. ``fill`` is what empty buckets show.
    """
    first, last = epoch_seconds(start), epoch_seconds(end)
    at = F.unix_seconds(F.col(ts).cast("timestamp"))
    bucket = F.floor((at - first) / seconds)
    aggregates = [F.count("*").alias("n")]
    if distinct:
        count = F.count_distinct if exact else F.approx_count_distinct
        aggregates.append(count(distinct).alias("distinct_" + distinct))
    counted = df.where(within(df, ts, first, last)).groupBy(bucket.alias("_bucket")).agg(*aggregates)
    spine = df.sparkSession.range(-(-(last - first) // seconds)).withColumnRenamed("id", "_bucket")
    joined = spine.join(counted, "_bucket", "left")
    shown = [c for c in counted.columns if c != "_bucket"]
    return joined.select(
        F.timestamp_seconds(F.lit(first) + F.col("_bucket") * seconds).alias("bucket_start"),
        *[F.coalesce(c, F.lit(fill)).alias(c) if fill is not None else F.col(c) for c in shown],
    )


def within(df: DataFrame, ts: str, first: int, last: int) -> Column:
    """Whether a time is in ``[first, last)`` of epoch seconds, as a range of the stored column that the scan can use."""
    low, high = (F.timestamp_seconds(F.lit(t)).cast(df.schema[ts].dataType) for t in (first, last))
    return (F.col(ts) >= low) & (F.col(ts) < high)


def fresh_count(df: DataFrame, ts: str, now, seconds: int = 900) -> DataFrame:
    """Number of records of the last ``seconds`` before ``now``."""
    end = epoch_seconds(now)
    return df.where(within(df, ts, end - seconds, end)).agg(F.count("*").alias("n"))
