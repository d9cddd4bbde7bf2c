"""Figures that can be rolled up: counts and sketches of distinct values, stored per short interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstats.sinks import replace_partitions

# Registers of a sketch, as a power of two: 4,096 give a relative standard error of 1.04 / sqrt(4096).
SKETCH_BITS = 12
RELATIVE_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)

DAY = "sketch_day"


def interval_start(at: Column, seconds: int) -> Column:
    """The start of the interval of some seconds, counted from the epoch, that holds a time."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(at.cast("timestamp")) / seconds) * seconds)


def interval_sketches(df: DataFrame, ts: str, distinct: str, by: Sequence[str] = (), seconds: int = 300) -> DataFrame:
    """For each interval (and value of `by`) the number of rows and a sketch of the distinct values of a column.

    Sketches are united on the map side, so an interval that holds most rows moves as one sketch per task. Rows without a
    time are left out; null values are counted as rows, not as values.
    """
    kept = df.where(F.col(ts).isNotNull())
    return kept.groupBy(interval_start(F.col(ts), seconds).alias("bucket_start"), *by).agg(
        F.count("*").alias("n"), F.hll_sketch_agg(distinct, F.lit(SKETCH_BITS)).alias("sketch")
    )


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Store the sketches of whole days, replacing those of the same days."""
    replace_partitions(sketches.withColumn(DAY, F.to_date("bucket_start")), path, DAY)


def read_sketches(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """Stored sketches, of the days from `first` to `last` only."""
    stored = spark.read.parquet(path)
    for bound, keep in ((first, F.col(DAY).__ge__), (last, F.col(DAY).__le__)):
        stored = stored if bound is None else stored.where(keep(F.lit(bound).cast("date")))
    return stored.drop(DAY)


def roll_up(sketches: DataFrame, seconds: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts and sketches of longer intervals, or of fewer groups, from those stored; the rows are not read again.

    `seconds` should be a multiple of what is stored. Uniting gives the sketch that the rows would have given.
    """
    return sketches.groupBy(interval_start(F.col("bucket_start"), seconds).alias("bucket_start"), *by).agg(
        F.sum("n").alias("n"), F.hll_union_agg("sketch").alias("sketch")
    )


def estimates(sketches: DataFrame, name: str = "distinct") -> DataFrame:
    """Sketches replaced by the number of distinct values they stand for."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")
