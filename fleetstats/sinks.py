"""Writers and the rows prepared for external receivers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from fleetstats.operators.quality import fingerprint


def write_collections(tables: dict[str, DataFrame], path: str, compression: str = "none") -> DataFrame:
    """Each table as JSON lines in its own folder; returns the number of lines per collection, counted while writing."""
    spark, counts = next(iter(tables.values())).sparkSession, []
    for name, table in tables.items():
        seen = Observation(name)
        table.observe(seen, F.count("*").alias("n")).write.mode("overwrite").json(f"{path}/{name}", compression=compression)
        counts.append((name, seen.get["n"]))
    return reduce(DataFrame.unionByName, [
        spark.range(1).select(F.lit(name).alias("collection"), F.lit(n).cast("long").alias("n")) for name, n in counts
    ])


def run_record(start: Column, end: Column) -> list[Column]:
    """The period a result covers, as the texts readers expect."""
    day = "yyyy-MM-dd"
    return [
        F.date_format(end, day).alias("createdAt"),
        F.date_format(start, day).alias("startDate"),
        F.date_format(end, day).alias("endDate"),
    ]


def write_searchable(df: DataFrame, path: str, keys: list[str], files: int | None = None) -> None:
    """Range-partitioned and sorted by the search keys, so that file statistics skip the rest.

    A hash of the row ends the range key, so that a frequent key spreads over several files.
    """
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    ranges = [*keys, F.xxhash64(*hashed)]
    spread = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    spread.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Write whole partitions, replacing those already there, so a rerun adds nothing twice.

    The rows must be all of their partitions; ``append_extract`` checks that. Rebalanced first: few files per
    partition, several writers for a large one.
    """
    df.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def append_extract(df: DataFrame, path: str, partition: str, time: str, start, end) -> None:
    """Add the extract of ``[start, end)`` to a table, replacing the partitions it brings.

    Raises if rows already in one of these partitions, or rows of the extract, are outside the period: the partition
    is wider than the extract then, and replacing it would delete the rest.
    """
    spark = df.sparkSession
    outside = ~((F.col(time) >= F.lit(start)) & (F.col(time) < F.lit(end)))
    if not df.where(outside).isEmpty():
        raise ValueError(f"the extract holds rows outside {start} to {end}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        brought = df.select(partition).distinct()
        there = spark.read.schema(df.schema).parquet(path)
        if not there.where(outside).join(brought, partition, "left_semi").isEmpty():
            raise ValueError(f"a partition of {path} holds rows outside {start} to {end}; extract it whole")
    replace_partitions(df, path, partition)


def snapshot_marks(path: str) -> str:
    """Where the marks of a table's complete snapshots are."""
    return path.rstrip("/") + ".complete"


def write_snapshot(df: DataFrame, path: str, day: str, min_rows: int = 1, column: str = "snapshot_date") -> int:
    """Write a dated full dump, check it, mark it as complete, and return its number of rows.

    Raises if it holds too few. A dump that failed stays behind without a mark, and ``latest_snapshot`` passes over it,
    so the one before remains current.
    """
    replace_partitions(df.withColumn(column, F.lit(day)), path, column)
    written = df.sparkSession.read.parquet(path).where(F.col(column) == F.lit(day).cast("date")).count()
    if written < min_rows:
        raise ValueError(f"snapshot {day} holds {written} rows, expected at least {min_rows}")
    mark = df.sparkSession.range(1).select(F.lit(day).cast("date").alias(column), F.lit(written).alias("n_rows"))
    mark.write.mode("append").parquet(snapshot_marks(path))
    return written


# Metadata keys only the sender may set.
RESERVED_METADATA = ("type", "_id", "producer", "timestamp")


def envelope(
    df: DataFrame,
    producer: str,
    version: str,
    payload: list[str],
    ts_ms: Column,
    doc_type: str | None = None,
    doc_id: Column | None = None,
    metadata: dict[str, str] | None = None,
    subfield: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Each row as a notification: headers, and a body of payload and metadata, as JSON in ``value``.

    ``keep`` names columns to carry along, such as a message key.
    Null payload fields and an absent id or type leave no trace in the JSON.
    """
    reserved = sorted(set(metadata or {}) & set(RESERVED_METADATA))
    if reserved:
        raise ValueError(f"reserved metadata keys: {', '.join(reserved)}")
    meta = [F.lit(v).alias(k) for k, v in (metadata or {}).items()]
    meta += [F.lit(producer).alias("producer"), ts_ms.alias("timestamp")]
    if doc_id is not None:
        meta.append(F.nullif(doc_id, F.lit("")).alias("_id"))
    if doc_type:
        meta.append(F.lit(doc_type).alias("type"))
    body = [F.struct(*payload).alias(subfield)] if subfield else [F.col(c) for c in payload if c != "metadata"]
    note = F.struct(
        F.lit(version).alias("version"),
        F.lit(producer).alias("producer"),
        F.struct(*body, F.struct(*meta).alias("metadata")).alias("body"),
    )
    return df.select(*keep, F.to_json(note).alias("value"))


def new_id() -> Column:
    """A random id, for records that bring none; a repeated task gives other ones."""
    return F.uuid()


def content_id(df: DataFrame, columns: Sequence[str]) -> Column:
    """An id that follows from the record, so that a record sent again has the same one."""
    return fingerprint(df, columns)


def chunk_records(df: DataFrame, size: int = 1000) -> DataFrame:
    """Number the rows of every partition and group them into chunks of at most ``size``.

    Chunks never cross partitions, so no row is moved. Apply it to rows in a repeatable order
    (a scan, or sorted within partitions), so that a repeated task makes the same chunks.
    """
    # monotonically_increasing_id() = partition number << 33 | row number in the partition
    row_id = F.monotonically_increasing_id()
    return df.withColumn("_row", row_id).select(
        *df.columns,
        F.shiftright("_row", 33).cast("int").alias("sender"),
        F.floor(F.col("_row").bitwiseAND((1 << 33) - 1) / size).alias("chunk"),
    )


def bulk_documents(df: DataFrame, index: str, source: list[Column], keep: Sequence[str] = ()) -> DataFrame:
    """Bulk-index actions as JSON in ``value``."""
    action = F.struct(F.lit("index").alias("_op_type"), F.lit(index).alias("_index"), F.struct(*source).alias("_source"))
    return df.select(*keep, F.to_json(action).alias("value"))


def metric_lines(df: DataFrame, name: str, value: str, labels: list[str]) -> DataFrame:
    """``name{label="text",...} value``, the exposition format of metric gateways.

    Backslashes, quotes and line feeds of a label are written with a backslash before them.
    """
    def escaped(text: Column) -> Column:
        for plain, written in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
            text = F.replace(text, F.lit(plain), F.lit(written))
        return text

    texts = [escaped(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in labels]
    pairs = [F.concat(F.lit(f'{c}="'), text, F.lit('"')) for c, text in zip(labels, texts)]
    inside = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}")) if labels else F.lit("")
    return df.select(F.concat(F.lit(name), inside, F.lit(" "), F.col(value).cast("string")).alias("line"))


def keyed_metric_lines(df: DataFrame, job: str, key: str, value: str) -> DataFrame:
    """``job_key value`` with a topic as job name: dots become underscores, ``>`` becomes ``metric``."""
    prefix = job.replace(".", "_").replace(">", "metric")
    return df.select(
        F.concat(F.lit(prefix + "_"), F.col(key).cast("string"), F.lit(" "), F.col(value).cast("string")).alias("line")
    )
