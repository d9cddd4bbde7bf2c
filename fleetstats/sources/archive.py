"""JSON archives of job and work records, partitioned by day."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from fleetstats.functions.times import utc
from fleetstats.schemas import JOB_ARCHIVE, WORK_ARCHIVE


def _pruned(kind: DataType, names: Sequence[str]) -> DataType:
    """A nested type with the named fields alone; names are dotted, lists stand for their elements."""
    if isinstance(kind, ArrayType):
        return ArrayType(_pruned(kind.elementType, names), kind.containsNull)
    wanted: dict[str, list[str]] = {}
    for name in names:
        first, _, rest = name.partition(".")
        wanted.setdefault(first, []).append(rest)
    return StructType([
        StructField(first, kind[first].dataType if "" in rests else _pruned(kind[first].dataType, rests))
        for first, rests in wanted.items()
    ])


def read_archive(
    spark: SparkSession, path: str, schema: StructType, start=None, end=None, fields: Sequence[str] | None = None,
    margin_days: int = 1, day_column: str = "dt",
) -> DataFrame:
    """Records with a fixed schema; only the day folders of the period (and a margin) are listed.

    Giving the schema saves the extra pass of type inference. The JSON reader does not prune
    nested fields by itself, so ``fields`` names the record fields to parse, dotted if nested (``steps.name``).
    """
    wanted = StructType()
    for field in schema.fields:
        kind = field.dataType
        if field.name == "data" and fields is not None:
            kind = _pruned(kind, fields)
        wanted.add(field.name, kind)
    df = spark.read.schema(wanted.add(day_column, "date")).json(path)
    if start is not None:
        df = df.where(F.col(day_column) >= F.lit((utc(start) - timedelta(days=margin_days)).date()))
    if end is not None:
        df = df.where(F.col(day_column) <= F.lit((utc(end) + timedelta(days=margin_days)).date()))
    return df


def read_jobs(spark: SparkSession, path: str, start=None, end=None, fields: Sequence[str] | None = None) -> DataFrame:
    return read_archive(spark, path, JOB_ARCHIVE, start, end, fields).select("data.*")


def read_work(spark: SparkSession, path: str, start=None, end=None, fields: Sequence[str] | None = None) -> DataFrame:
    return read_archive(spark, path, WORK_ARCHIVE, start, end, fields).select("data.*", "metadata.timestamp")


# Records of a file at most: a compressed file is read by one task.
FILE_RECORDS = 200_000


def write_archive(
    rows: DataFrame, path: str, day, day_column: str = "dt", shape: Callable[[DataFrame], DataFrame] | None = None,
    file_records: int = FILE_RECORDS,
) -> None:
    """Records under ``data`` (and ``metadata`` if given) as compressed JSON lines in one folder per day.

    Rebalanced by day, so that a folder gets few files and a large day still has many writers. Nested records are many
    times the size of the rows they are made from: with ``shape``, a function without shuffles that makes the records of
    rows and keeps the day column, only the rows are moved and sorted.
    """
    spread = rows.withColumn(day_column, day).hint("rebalance", day_column).sortWithinPartitions(day_column)
    records = spread if shape is None else shape(spread)
    writer = records.write.mode("overwrite").option("compression", "lz4").option("maxRecordsPerFile", file_records)
    writer.partitionBy(day_column).json(path)


def read_one_or_many(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Files that hold either one JSON object or a list of them."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def nested_values(records: DataFrame, path: str, limit: int | None = None) -> DataFrame:
    """One nested field of every record, or of the first ``limit`` ones."""
    values = records.select(F.col(path).alias(path.rsplit(".", 1)[-1]))
    return values if limit is None else values.limit(limit)
