"""Records sent to a receiver in chunks, each task its own, with what was refused as rows.

The records are written first, so that a repeated task has the same records in the same order and sends the same chunks
under the same ids; a receiver that knows a chunk's id takes it once. A task sends a chunk again if the receiver fails, up
to a number of attempts; the records it refuses, or does not take in the end, go to a file of the task. The commit message
of a task names that file, and only the files of committed tasks are read back: nothing is returned twice, or lost with an
executor.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from fleetstats.storage import new_path, shared_root

CHUNK_RECORDS = 1000

REFUSED = pa.schema([("chunk_id", pa.string()), ("place", pa.int64()), ("value", pa.string()), ("reason", pa.string())])


class DeliveryError(Exception):
    """The receiver did not take a chunk now; it may later."""


class Receiver:
    """Where chunks go. It is sent to the workers, so it holds addresses, not connections."""

    def send(self, chunk_id: str, records: list[str]) -> dict[int, str]:
        """Take a chunk, once for each id. Returns the reasons of refused records by their place in the chunk.

        Raises DeliveryError if the chunk was not taken at all.
        """
        raise NotImplementedError


@dataclass
class FolderReceiver(Receiver):
    """Keeps each chunk as a file of lines named by its id, in any file system Arrow knows by its address."""

    path: str
    refuse: Callable[[str], str | None] = lambda record: None

    def send(self, chunk_id: str, records: list[str]) -> dict[int, str]:
        refused = {i: reason for i, r in enumerate(records) if (reason := self.refuse(r)) is not None}
        write_file(f"{self.path}/{chunk_id}.txt", "".join(r + "\n" for i, r in enumerate(records) if i not in refused).encode())
        return refused


def write_file(path: str, content: bytes) -> None:
    """A file that is there whole or not at all under its name."""
    system, name = fs.FileSystem.from_uri(path)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    part = f"{name}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(part) as out:
        out.write(content)
    system.move(part, name)


@dataclass
class Sent(WriterCommitMessage):
    """What a task has done."""

    file: str | None
    chunks: int
    delivered: int
    refused: int


class ChunkWriter(DataSourceArrowWriter):
    """Sends the records of each partition; commits the names of the files with refused ones."""

    def __init__(self, receiver: Receiver, delivery: str, path: str, size: int, attempts: int, pause: float):
        self.receiver, self.delivery, self.path = receiver, delivery, path
        self.size, self.attempts, self.pause = size, attempts, pause

    def chunks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
        held: list[str] = []
        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= self.size:
                yield held[:self.size]
                held = held[self.size:]
        if held:
            yield held

    def take(self, chunk_id: str, records: list[str]) -> dict[int, str]:
        """The reasons of what was refused; all records if the receiver keeps failing."""
        for attempt in range(self.attempts):
            try:
                return self.receiver.send(chunk_id, records)
            except DeliveryError as error:
                reason = str(error)
                time.sleep(self.pause * 2**attempt)
        return dict.fromkeys(range(len(records)), reason)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Sent:
        task, file, out = TaskContext.get().partitionId(), None, None
        chunks = delivered = refused = 0
        try:
            for number, records in enumerate(self.chunks(iterator)):
                chunk_id = f"{self.delivery}-{task}-{number}"
                reasons = self.take(chunk_id, records)
                chunks, delivered, refused = chunks + 1, delivered + len(records) - len(reasons), refused + len(reasons)
                if reasons and out is None:
                    file = f"{self.path}/refused/{task}-{uuid.uuid4().hex}.parquet"
                    system, name = fs.FileSystem.from_uri(file)
                    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
                    out = pq.ParquetWriter(name, REFUSED, filesystem=system)
                if reasons:
                    rows = [(chunk_id, i, records[i], reason) for i, reason in sorted(reasons.items())]
                    out.write_table(pa.Table.from_arrays(list(map(pa.array, zip(*rows))), schema=REFUSED))
        finally:
            if out is not None:
                out.close()
        return Sent(file, chunks, delivered, refused)

    def commit(self, messages: list[Sent | None]) -> None:
        done = [m for m in messages if m is not None]
        report = {
            "files": [m.file for m in done if m.file], "chunks": sum(m.chunks for m in done),
            "delivered": sum(m.delivered for m in done), "refused": sum(m.refused for m in done),
        }
        write_file(f"{self.path}/report.json", json.dumps(report).encode())

    def abort(self, messages: list[Sent | None]) -> None:
        """What some tasks have sent stays with the receiver; the same delivery, repeated, sends it under the same ids."""
        for message in messages:
            if message is not None and message.file:
                system, name = fs.FileSystem.from_uri(message.file)
                system.delete_file(name)


def data_source(name: str, writer: ChunkWriter) -> type[DataSource]:
    class Delivery(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite):
            return writer

    return Delivery


@dataclass(frozen=True)
class Outcome:
    """Figures of a delivery, and the records that were not taken: `chunk_id`, `place`, `value`, `reason`."""

    chunks: int
    delivered: int
    refused: int
    rejects: DataFrame


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file is there; what is stored for a delivery goes when the session ends."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = file.getFileSystem(spark._jsc.hadoopConfiguration())
    system.deleteOnExit(file.getParent())
    return system.exists(file)


def deliver_chunks(
    records: DataFrame, receiver: Receiver, value: str = "value", delivery: str | None = None, size: int = CHUNK_RECORDS,
    attempts: int = 3, pause: float = 1.0,
) -> Outcome:
    """Send the texts of a column to a receiver in chunks of at most `size`; null texts are not sent.

    Each record ends up with the receiver or among the rejects. Chunks have ids that start with that of the delivery. A
    delivery that failed may be repeated under its id in the same session: it sends the records that were stored the first
    time, as the same chunks.
    """
    spark = records.sparkSession
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package
    delivery = delivery or uuid.uuid4().hex
    path = new_path(spark, "delivery")
    outgoing = f"{shared_root(spark)}/fleetstats/outgoing-{delivery}"
    if not exists(spark, f"{outgoing}/_SUCCESS"):
        records.where(records[value].isNotNull()).select(value).write.mode("overwrite").parquet(outgoing)
    stored = spark.read.parquet(outgoing)
    writer = ChunkWriter(receiver, delivery, path, size, attempts, pause)
    name = f"delivery_{uuid.uuid4().hex}"
    spark.dataSource.register(data_source(name, writer))
    stored.write.format(name).mode("append").save()
    system, report_name = fs.FileSystem.from_uri(f"{path}/report.json")
    with system.open_input_stream(report_name) as file:
        report = json.loads(file.read())
    schema = "chunk_id string, place long, value string, reason string"
    files = report["files"]
    rejects = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return Outcome(report["chunks"], report["delivered"], report["refused"], rejects)
