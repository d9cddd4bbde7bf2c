"""Sources and sinks of stream runs.

The operators are those of ``fleetstats.operators``; a production source would be Kafka
(``readStream.format("kafka")``), here it is a folder that files arrive in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(path)


def log_stream(spark: SparkSession, path: str) -> DataFrame:
    """Lines of log files, from the beginning; the position is kept in the checkpoint."""
    return spark.readStream.text(path)


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Process all that has arrived, append it to a table, and return the table.

    Run again with the same checkpoint it goes on where it stopped, watermark and state included.
    """
    run = (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("checkpointLocation", checkpoint).option("path", path)
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def drain_latest(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Process all that has arrived; the latest row of each key, groups still open included.

    Each micro-batch stores the groups it changed in a folder of its own number, which a repeat replaces. Run again
    with the same checkpoint it goes on where it stopped, and late rows that find their group closed are dropped.
    """
    run = (
        stream.writeStream.outputMode("update").foreachBatch(batch_folder(path))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    schema = StructType([*stream.schema.fields, StructField("batch", LongType())])
    values = F.struct(*[c for c in stream.columns if c not in keys])
    latest = stream.sparkSession.read.schema(schema).parquet(path).groupBy(*keys).agg(F.max_by(values, "batch").alias("_row"))
    return latest.select(*[F.col(c) if c in keys else F.col("_row." + c) for c in stream.columns])


def deliver(stream: DataFrame, send: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand every micro-batch and its number to ``send``.

    A batch repeated after a failure comes with the same number, which makes it the key to
    recognise it by.
    """
    run = (
        stream.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A receiver for ``deliver`` that stores each batch in its own folder, replacing a repeat."""

    def send(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return send
