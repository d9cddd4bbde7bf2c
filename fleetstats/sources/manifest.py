"""A manifest of archive files: which times each holds, so that a period is read from the files that overlap it.

Day folders go by the time of writing, so a scan of a period has to read whole days and a margin of them. The manifest has,
for each file, its size, its rows and its least and largest record time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetstats.sources.files import file_inventory
from fleetstats.storage import materialize

COLUMNS = ["path", "size", "modified", "n_rows", "least", "largest"]
SCHEMA = "path string, size long, modified timestamp, n_rows long, least long, largest long"

# Reads some files, or folders, as records.
Reader = Callable[[list[str]], DataFrame]


def describe_files(records: DataFrame, time: Column) -> DataFrame:
    """A row per file of a scan, with the range of a numeric time; one pass that parses the time alone."""
    rows = records.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"), time.cast("long").alias("_time"),
    )
    return rows.groupBy("path", "size", "modified").agg(
        F.count("*").alias("n_rows"), F.min("_time").alias("least"), F.max("_time").alias("largest")
    )


def write_manifest(records: DataFrame, time: Column, path: str) -> None:
    """Describe all files of an archive. Files without records have no row, and none to read."""
    describe_files(records, time).select(COLUMNS).write.mode("overwrite").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def refresh_manifest(spark: SparkSession, archive: str, read: Reader, time: Column, path: str) -> int:
    """Bring a manifest up to date and return the number of files that were read for it.

    Files are told apart by path, size and time of modification: unchanged ones keep their row, those gone lose it, and
    only new or changed ones are read. The list of these passes through the driver.
    """
    known = materialize(read_manifest(spark, path), "manifest")  # a copy: the manifest itself is replaced
    same_file = ["path", "size", "modified"]
    listed = file_inventory(spark, archive).where(F.col("size") > 0).select(
        F.regexp_replace("path", "^file:/+", "file:///").alias("path"), "size", "modified"
    )
    held = known.withColumn("path", F.regexp_replace("path", "^file:/+", "file:///"))
    kept = held.join(listed, same_file, "left_semi")
    new = [r["path"] for r in listed.join(held, same_file, "left_anti").select("path").collect()]
    if new:
        kept = kept.unionByName(describe_files(read(new), time).select(COLUMNS))
    kept.select(COLUMNS).write.mode("overwrite").parquet(path)
    return len(new)


def overlapping_files(spark: SparkSession, path: str, start: int, end: int) -> list[str]:
    """The files that may hold records of ``[start, end)``, in the unit of the manifest's times."""
    hit = read_manifest(spark, path).where((F.col("least") < end) & (F.col("largest") >= start))
    return [r["path"] for r in hit.select("path").orderBy("path").collect()]


def manifest_scan(spark: SparkSession, path: str, read: Reader, schema: StructType, time: Column, start: int, end: int) -> DataFrame:
    """The records of ``[start, end)``, read from the files whose times overlap it; folders are not listed.

    Records without a time belong to no period. `schema` is that of the records, for a period without files.
    """
    files = overlapping_files(spark, path, start, end)
    records = read(files) if files else spark.createDataFrame([], schema)
    return records.where((time >= start) & (time < end))
