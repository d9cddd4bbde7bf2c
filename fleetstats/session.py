"""Session settings the operators rely on."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Settings that change results, so every entry point applies them to the session it is given.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Settings that only change speed: run-time re-planning, skew splitting.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where its partitioning was to serve the next operator
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # aggregates with sets keep this many groups in memory before they turn to sorting
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "10000",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PREPARED = "spark.fleetstats.prepared"

# Bytes of the scanned tables to one shuffle partition.
PARTITION_BYTES = 128 << 20

# Bytes of shuffled rows that run-time re-planning may merge into one task, at most. Two wide hash aggregates, one on top
# of the other, take 13 to 17 times these bytes in the task's memory. Those of a task that scans follow its split.
ADVISORY, SPLIT = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
MERGED_BYTES = 16 << 20
MOST_BYTES = {ADVISORY: MERGED_BYTES, SPLIT: 32 << 20}

# Registered queries start with a shuffle partition for so many bytes of their tables, up to this number of partitions.
FINE_BYTES = 16 << 20
FINE_PARTITIONS = 10_000
SIZED = "spark.fleetstats.sized"


def shuffle_partitions(settings: Mapping[str, str], parallelism: int, scanned_bytes: int = 0) -> int:
    """Shuffle partitions to start from on a cluster: by the data, and at least three per core it can grow to.

    Run-time re-planning merges what turns out small; it cannot split an aggregate's partition
    that was planned too large.
    """
    executors = settings.get("spark.dynamicAllocation.maxExecutors") or settings.get("spark.executor.instances")
    cores = int(executors) * int(settings.get("spark.executor.cores", "1")) if executors else parallelism
    by_data = -(-scanned_bytes // PARTITION_BYTES)
    return max(3 * cores, int(settings.get("spark.sql.shuffle.partitions", "200")), by_data)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session, the first time; what its owner sets afterwards stays."""
    if spark.conf.get(PREPARED, None) is None:
        for key, value in {**SEMANTIC_CONF, **TUNING_CONF}.items():
            spark.conf.set(key, value)
        for key, most in MOST_BYTES.items():
            if set_bytes(spark, key) > most:
                spark.conf.set(key, str(most))
        spark.conf.set(PREPARED, "true")
    return spark


def set_bytes(spark: SparkSession, key: str) -> int:
    """A size among the settings, which may be written as 64m, 64MB or 67108864b."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


def scanned_bytes(df: DataFrame) -> int:
    """The size of the tables that a query reads, as its plan knows it; rows made in the session do not count."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    tables = [leaves.apply(i) for i in range(leaves.size())]
    return sum(int(str(t.stats().sizeInBytes())) for t in tables if t.getClass().getSimpleName().endswith("Relation")
               and t.getClass().getSimpleName() != "LocalRelation")


def size_shuffles(df: DataFrame, fine: bool = False) -> DataFrame:
    """Start the query's shuffles with partitions that follow the data it reads.

    A local master keeps its owner's number unless the data are too many for it, and only where `fine` asks for
    partitions of ``FINE_BYTES``: no re-planning splits the partition of an aggregate.
    """
    spark, context = df.sparkSession, df.sparkSession.sparkContext
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = scanned_bytes(df) if fine or not context.master.startswith("local") else 0
    by_data = min(-(-read // FINE_BYTES), FINE_PARTITIONS) if fine else 0
    if not context.master.startswith("local"):
        settings = dict(context.getConf().getAll()) | {"spark.sql.shuffle.partitions": str(given)}
        spark.conf.set(INITIAL_PARTITIONS, str(max(by_data, shuffle_partitions(settings, context.defaultParallelism, read))))
    elif by_data > given:
        spark.conf.set(INITIAL_PARTITIONS, str(by_data))
        spark.conf.set(SIZED, "true")
    elif spark.conf.get(SIZED, None):
        spark.conf.unset(INITIAL_PARTITIONS)
        spark.conf.unset(SIZED)
    return df


def local_session(cpus: int | str = "*", name: str = "fleetstats") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FLEETSTATS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", os.environ.get("FLEETSTATS_CHECKPOINTS", "/tmp/fleetstats-checkpoints"))
    )
    for key, value in {**SEMANTIC_CONF, **TUNING_CONF}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())
