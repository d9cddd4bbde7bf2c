"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fleetstats.session import INITIAL_PARTITIONS, TUNING_CONF, size_shuffles
from fleetstats.storage import new_path

# Rows and bytes a Python worker gets at once: whole texts may be long.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20

# Of the library's settings one is left out: groups here hold lists, so few of them are kept before sorting.
TEXT_CONF = {k: v for k, v in TUNING_CONF.items() if "objectHashAggregate" not in k} | {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
}

PREPARED = "spark.fleetstats.texts.prepared"

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once, by way of the shared folder."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{new_path(spark, 'package')}/{package.name}.zip")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(target)
    stream.write(bytearray(held.getvalue()))
    stream.close()
    context.addPyFile(files.makeQualified(target).toString())
    _shipped.add(context.applicationId)


def text_session(spark: SparkSession, *tables: DataFrame) -> SparkSession:
    """Make the package known to the workers, keep the Arrow batches of long texts small and split skewed joins.

    What the owner of the session sets afterwards stays. On a cluster shuffles start with the partitions that the largest of the given tables asks for.
    """
    ship_package(spark)
    if spark.conf.get(PREPARED, None) is None:
        for key, value in TEXT_CONF.items():
            spark.conf.set(key, value)
        spark.conf.set(PREPARED, "true")
    wanted = []
    for table in tables:
        size_shuffles(table)
        if partitions := spark.conf.get(INITIAL_PARTITIONS, None):
            wanted.append(int(partitions))
    if wanted:
        spark.conf.set(INITIAL_PARTITIONS, str(max(wanted)))
    return spark


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """A table of the given folder. It does not change the shuffles: labels and benchmarks are read beside documents."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def row_key(*columns: str) -> tuple[Column, Column]:
    """128 bits that stand for the values of some columns; rows alike in them are one document.

    Nulls are skipped by the hash, so whether a column is null is hashed beside its value.
    """
    parts = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    return F.xxhash64(*parts), F.xxhash64(F.lit(7), *parts)


def fresh(columns: Iterable[str], name: str) -> str:
    """A column name that is not taken."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.Table]:
    """Successive batches joined until their texts hold `limit` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text).nbytes
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def release_memory() -> None:
    """Give back what a finished task has freed: workers stay for later tasks, beside the executor's own memory."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def add_columns(
    docs: DataFrame, text: str, added: T.StructType, compute: Callable[[list[str | None]], list[list]],
    chunk_bytes: int = 0,
) -> DataFrame:
    """The rows with columns computed from a text column, in Python workers.

    `compute` takes the texts of some rows and returns a list or an Arrow array per added column. An input
    column of the name of an added one is replaced.
    """
    names = {f.name.lower() for f in added}
    kept = [c for c in docs.columns if c.lower() not in names]
    carried = docs.select(*[F.col(f"`{c}`") for c in kept])
    if text not in kept:
        raise ValueError(f"column {text} would be replaced by an added column")
    schema = T.StructType([*carried.schema.fields, *added.fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        groups = chunks(batches, text, chunk_bytes) if chunk_bytes else (pa.Table.from_batches([b]) for b in batches)
        for table in groups:
            if table.num_rows == 0:
                continue
            values = compute(table.column(text).to_pylist())
            arrays = [
                v.cast(arrow.field(f.name).type) if isinstance(v, pa.Array) else pa.array(v, type=arrow.field(f.name).type)
                for f, v in zip(added.fields, values)
            ]
            columns = [*table.columns, *arrays]
            yield from pa.Table.from_arrays(columns, names=arrow.names).to_batches(max_chunksize=BATCH_ROWS)
        release_memory()

    return carried.mapInArrow(run, schema)
