"""Results stored in the order of their pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstats.operators.search import PAGE_CAP, order_columns


# Where a row stands: its range and its number in it.
RANGE, ROW = "rank_range", "rank_row"


def write_ranked(
    table: DataFrame, path: str, order: Sequence[tuple[str, str]], unique: Sequence[str], files: int | None = None
) -> None:
    """Write a result sorted into ranges, a folder each, with the number of rows ahead of each range beside it.

    The unique key ends the order, so a value that many rows share is spread over several ranges. A row's place is that
    of its range and its number in it, so that no task counts more than a range.
    """
    spark, columns = table.sparkSession, order_columns(order, unique)
    spread = table.repartitionByRange(files, *columns) if files else table.repartitionByRange(*columns)
    numbered = spread.sortWithinPartitions(*columns).withColumns({
        RANGE: F.spark_partition_id(), ROW: F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1),
    })
    numbered.limit(0).write.mode("overwrite").parquet(f"{path}/schema")  # an empty result has no folders
    numbered.write.mode("overwrite").partitionBy(RANGE).parquet(f"{path}/rows")
    counts = stored_rows(spark, path).groupBy(RANGE).agg(F.count("*").alias("n"))
    counts.write.mode("overwrite").parquet(f"{path}/counts")


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ranked result, with their places."""
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")


def ranked_total(spark: SparkSession, path: str) -> int:
    """The number of rows of a ranked result."""
    return sum(r["n"] for r in spark.read.parquet(f"{path}/counts").collect())


def ranges_of(spark: SparkSession, path: str, start: int, length: int) -> list[tuple[int, int]]:
    """The ranges that hold some of the rows ``start`` to ``start + length``, and the number of rows ahead of each.

    The counts, a row for each folder, are added up on the driver.
    """
    found, ahead = [], 0
    for r in sorted(spark.read.parquet(f"{path}/counts").collect(), key=lambda r: r[RANGE]):
        if ahead < start + length and ahead + r["n"] > start:
            found.append((r[RANGE], ahead))
        ahead += r["n"]
    return found


def page_at(spark: SparkSession, path: str, start: int = 0, length: int = 0) -> DataFrame:
    """A page of a ranked result from any row on, with its ``position`` counted from 0, in order.

    Only the ranges that hold rows of the page are read, however deep it is. A length of zero or less means the largest
    page; a larger one raises. A page behind the last row is empty.
    """
    if length > PAGE_CAP:
        raise ValueError(f"a page holds at most {PAGE_CAP} rows, not {length}")
    start, size = max(start, 0), length if length > 0 else PAGE_CAP
    held = ranges_of(spark, path, start, size)
    ahead = F.lit(None).cast("long")
    for number, rows in held:
        ahead = F.when(F.col(RANGE) == number, F.lit(rows)).otherwise(ahead)
    rows = stored_rows(spark, path).where(F.col(RANGE).isin([number for number, _ in held]))
    placed = rows.withColumn("position", ahead + F.col(ROW))
    found = placed.where((F.col("position") >= start) & (F.col("position") < start + size))
    return found.drop(RANGE, ROW).orderBy("position").limit(size)
