"""Where intermediate tables, stream checkpoints and stream outputs go.

On a cluster this is the shared folder named by ``spark.checkpoint.dir``. Only a local master, where every task sees
the same disk, may leave it unset. What is written there belongs to the session and is deleted when it ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context = spark.sparkContext._jsc.sc()
    if not context.getCheckpointDir().isDefined():
        temporary = spark._jvm.java.lang.System.getProperty("java.io.tmpdir")
        context.setCheckpointDir(f"{temporary}/fleetstats-checkpoints")
    return context.getCheckpointDir().get().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path nothing else uses, below the shared folder; deleted with the session."""
    path = f"{shared_root(spark)}/fleetstats/{label}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write once, read back: cuts lineage and lets several consumers share one computation."""
    path = new_path(df.sparkSession, label)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)
