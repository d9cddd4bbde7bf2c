"""File listings and line-oriented text."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def day_folder(base: str, now: datetime, offset_seconds: int = 0) -> str:
    """Folder of the day ``offset_seconds`` ago, as ``base/Y/MM/DD``."""
    moment = now - timedelta(seconds=offset_seconds)
    return f"{base}/{moment.year}/{moment:%m}/{moment:%d}"


def file_inventory(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Path, size and modification time of every file below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    if pattern is not None:
        files = files.where(F.col("path").contains(pattern))
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def table_files(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The files that tables are read from: name of the table, path, size, modification time, rows."""
    found = [
        df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        .groupBy(F.lit(name).alias("name"), F.col("file_path").alias("path"), F.col("file_size").alias("size"),
                 F.col("file_modification_time").alias("modified"))
        .agg(F.count("*").alias("n_rows"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, found)


def tagged_lines(spark: SparkSession, path: str, tag: str) -> DataFrame:
    return spark.read.text(path).select(F.lit(tag).alias("tag"), "value")


def read_blocks(spark: SparkSession, path: str, end_line: str = "======") -> DataFrame:
    """Text whose records end with a separator line, one row per record."""
    blocks = spark.read.option("lineSep", end_line + "\n").text(path)
    return blocks.where(F.trim("value") != "")


def block_records(blocks: DataFrame, name_key: str, contact_suffix: str = "@Default") -> DataFrame:
    """One record per block: its name, its integer counters as a map, its contacts.

    The first word of a line is the key and the second an integer; lines whose second word is
    no integer are skipped; a word with ``@`` is a contact.
    """
    lines = F.filter(F.split("value", "\n"), lambda line: F.trim(line) != "")
    named = F.filter(lines, lambda line: line.startswith(name_key))
    others = F.filter(lines, lambda line: ~line.startswith(name_key))
    contacts = F.transform(
        F.filter(others, lambda line: line.contains("@")),
        lambda line: F.get(F.filter(F.split(F.trim(line), r"\s+"), lambda w: w.contains("@")), F.lit(0)),
    )
    words = F.transform(
        F.filter(others, lambda line: ~line.contains("@")), lambda line: F.split(F.trim(line), r"\s+")
    )
    pairs = F.transform(
        words, lambda w: F.struct(F.get(w, F.lit(0)).alias("key"), F.get(w, F.lit(1)).try_cast("long").alias("value"))
    )
    counters = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
    return blocks.select(
        F.trim(F.substring(F.get(named, F.size(named) - 1), F.lit(len(name_key) + 1), F.length("value"))).alias(name_key),
        counters.alias("counters"),
        F.array_join(F.transform(contacts, lambda c: F.replace(c, F.lit(contact_suffix), F.lit(""))), ", ").alias(
            "contacts"
        ),
    )


def lookup_table(lines: DataFrame, line: Column | str = "value") -> DataFrame:
    """``code: description`` lines without comments and blanks; a description keeps its colons."""
    text = F.col(line) if isinstance(line, str) else line
    parts = F.split(text, ":", 2)
    return lines.where(~text.startswith("#") & (text != "") & (F.size(parts) > 1)).select(
        F.trim(F.get(parts, F.lit(0))).alias("code"), F.trim(F.get(parts, F.lit(1))).alias("description")
    )
