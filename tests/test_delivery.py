"""Chunks sent to a receiver that refuses, fails and is sent to again."""

import os
from collections import Counter

import pyarrow as pa
import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fleetstats import delivery
from fleetstats.delivery import ChunkWriter, DeliveryError, FolderReceiver, Receiver, deliver_chunks


def received(path):
    """The records of each chunk a receiver holds."""
    out = {}
    for name in os.listdir(path) if os.path.isdir(path) else []:
        with open(f"{path}/{name}") as file:
            out[name.removesuffix(".txt")] = file.read().splitlines()
    return out


def table(spark, n):
    return spark.range(n).repartition(4).select(F.concat(F.lit("r"), "id").alias("value"), "id")


def test_every_record_is_taken_or_returned(spark, tmp_path):
    def refuse(record):
        return f"ends in {record[-1]}" if record[-1] in "37" else None

    outcome = deliver_chunks(table(spark, 2500), FolderReceiver(f"{tmp_path}/in", refuse), size=100)
    held = received(f"{tmp_path}/in")
    taken = [r for records in held.values() for r in records]
    back = rows(outcome.rejects, "value", "reason")
    assert sorted(taken + [v for v, _ in back]) == sorted(f"r{i}" for i in range(2500))
    assert all(reason == f"ends in {v[-1]}" and v[-1] in "37" for v, reason in back)
    assert (outcome.delivered, outcome.refused, outcome.chunks) == (2000, 500, len(held))
    assert max(map(len, held.values())) <= 100


def test_a_receiver_that_fails_at_times(spark, tmp_path):
    folder = str(tmp_path)

    class Unsteady(FolderReceiver):
        def send(self, chunk_id, records):
            mark = f"{folder}/seen-{chunk_id}"
            if not os.path.exists(mark):
                open(mark, "w").close()
                raise DeliveryError("busy")
            return super().send(chunk_id, records)

    outcome = deliver_chunks(table(spark, 500), Unsteady(f"{folder}/in"), size=50, attempts=2, pause=0)
    assert outcome.refused == 0 and rows(outcome.rejects) == []
    assert Counter(r for c in received(f"{folder}/in").values() for r in c) == Counter(f"r{i}" for i in range(500))


def test_what_is_never_taken_comes_back(spark):
    class Closed(Receiver):
        def send(self, chunk_id, records):
            raise DeliveryError("closed")

    outcome = deliver_chunks(table(spark, 120), Closed(), size=50, attempts=2, pause=0)
    assert outcome.delivered == 0 and outcome.refused == 120
    assert {r[0] for r in rows(outcome.rejects, "reason")} == {"closed"}
    assert sorted(rows(outcome.rejects, "value")) == sorted((f"r{i}",) for i in range(120))


def test_a_delivery_that_broke_is_sent_again_as_the_same_chunks(spark, tmp_path):
    folder = str(tmp_path)

    class Broken(FolderReceiver):
        def send(self, chunk_id, records):
            if "r77" in records and not os.path.exists(f"{folder}/mended"):
                raise RuntimeError("broken")
            return super().send(chunk_id, records)

    records = table(spark, 400).withColumn("value", F.concat("value", F.lit(""))).where("id >= 0")
    with pytest.raises(PySparkException):
        deliver_chunks(records, Broken(f"{folder}/in"), delivery="day-1", size=10)
    first = received(f"{folder}/in")
    open(f"{folder}/mended", "w").close()
    outcome = deliver_chunks(records, Broken(f"{folder}/in"), delivery="day-1", size=10)
    whole = received(f"{folder}/in")
    assert 0 < len(first) < len(whole) and all(whole[c] == first[c] for c in first)
    assert Counter(r for c in whole.values() for r in c) == Counter(f"r{i}" for i in range(400))
    assert outcome.delivered == 400


class Batches:
    def __init__(self, n):
        self.batches = [pa.record_batch([pa.array([f"r{j}" for j in range(i, i + 7)])], ["value"]) for i in range(0, n, 7)]

    def __iter__(self):
        return iter(self.batches)


def test_a_repeated_task_leaves_one_file_committed(tmp_path, monkeypatch):
    monkeypatch.setattr(delivery.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 3})()))
    refuse = {"r5": "no", "r20": "never"}.get
    writer = ChunkWriter(FolderReceiver(f"{tmp_path}/in", refuse), "d", f"{tmp_path}/out", 10, 1, 0)
    lost, kept = writer.write(iter(Batches(28))), writer.write(iter(Batches(28)))
    assert lost.file != kept.file and (kept.chunks, kept.delivered, kept.refused) == (3, 26, 2)
    writer.commit([kept, None])
    assert len(received(f"{tmp_path}/in")) == 3 and os.path.exists(f"{tmp_path}/out/report.json")
    writer.abort([kept, lost, None])
    assert os.listdir(f"{tmp_path}/out/refused") == []


def test_no_records(spark, tmp_path):
    outcome = deliver_chunks(spark.createDataFrame([(None,)], "value STRING"), FolderReceiver(str(tmp_path / "in")))
    assert (outcome.chunks, outcome.delivered, outcome.refused) == (0, 0, 0) and rows(outcome.rejects) == []
