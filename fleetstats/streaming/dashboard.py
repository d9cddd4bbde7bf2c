"""The state of a message dashboard: counts of an interval of arrival, emitted and reset together.

Each task counts its messages per site and code first, so a site that sends most of them is a row per code and task. These
counts are dealt over buckets by their pair. A bucket adds them up; when the interval ends, by the clock, all buckets emit
their counts in one micro-batch and start anew. That batch is rolled up into the four views: total, by code, by site, by site
and code.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fleetstats.streaming.runs import batch_folder

BUCKETS = 64

# Pairs of site and code that a task holds in Python before it hands them on.
PAIRS_HELD = 200_000

# Pairs to a chunk of the state.
CHUNK = 10_000

COUNTS = "interval_end timestamp, site string, code string, n long"

# The state store that keeps timers.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class IntervalCounts(StatefulProcessor):
    """Counts per site and code of one bucket until its interval ends.

    They are held in chunks, because each look at the state is a call to the JVM. A pair has a row for each micro-batch of the
    interval that brought it, and more if a micro-batch has many pairs.
    """

    def __init__(self, interval_ms: int):
        self.interval_ms = interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "number long", "site array<string>, code array<string>, n array<long>")
        self.due = handle.getValueState("due", "at long, chunks long")

    def emptied(self, due: int) -> Iterator[pd.DataFrame]:
        """What has been counted up to the end of an interval; the counts start anew."""
        for _, (sites, codes, counts) in self.chunks.iterator():
            out = pd.DataFrame({"site": list(sites), "code": list(codes), "n": list(counts)})
            out.insert(0, "interval_end", pd.Timestamp(due, unit="ms"))
            yield out
        self.chunks.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        due, number = self.due.get() if self.due.exists() else (None, 0)
        if due is not None and due <= now:  # these messages belong to a later interval
            yield from self.emptied(due)
            self.handle.deleteTimer(due)
            due, number = None, 0
        if due is None:
            due = (now // self.interval_ms + 1) * self.interval_ms
            self.handle.registerTimer(due)
        for seen in summed(rows):
            for i in range(0, len(seen), CHUNK):
                part = seen[i:i + CHUNK]
                self.chunks.updateValue((number,), tuple(list(values) for values in zip(*part)))
                number += 1
        self.due.update((due, number))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        if self.due.exists() and self.due.get()[0] == due:
            yield from self.emptied(due)
            self.due.clear()

    def close(self) -> None:
        pass


def summed(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    """Counts (site, code, n) added up per pair, handed on whenever there are ``PAIRS_HELD`` pairs."""
    seen: Counter = Counter()
    for batch in batches:
        for site, code, n in zip(batch["site"], batch["code"], batch["n"]):
            seen[site, code] += int(n)
        if len(seen) >= PAIRS_HELD:
            yield [(*pair, n) for pair, n in seen.items()]
            seen.clear()
    if seen:
        yield [(*pair, n) for pair, n in seen.items()]


def part_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The messages of a task as counts per site and code, several rows to a pair if there are many pairs."""
    for seen in summed(batches):
        yield pd.DataFrame(seen, columns=["site", "code", "n"])


def interval_state(messages: DataFrame, site: str = "site", code: str = "code", every_s: int = 10, buckets: int = BUCKETS) -> DataFrame:
    """A stream of the counts per site and code of each interval of ``every_s`` seconds, several rows to a pair.

    A null site or code is counted as such.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package
    pairs = messages.select(F.col(site).cast("string").alias("site"), F.col(code).cast("string").alias("code"))
    counted = pairs.withColumn("n", F.lit(1)).mapInPandas(part_counts, "site string, code string, n long")
    # one pair's counts of many tasks go to one bucket, so that a state holds its share of the pairs and not all of them
    dealt = counted.withColumn("bucket", F.pmod(F.xxhash64("site", "code"), F.lit(buckets)).cast("int"))
    return dealt.groupBy("bucket").transformWithStateInPandas(
        IntervalCounts(1000 * every_s), COUNTS, "Update", "ProcessingTime"
    )


def views(counts: DataFrame) -> DataFrame:
    """The four views of each interval: ``view`` (total, code, site, site_code), ``site``, ``code``, ``n``."""
    grouped = counts.groupingSets(
        [["interval_end"], ["interval_end", "code"], ["interval_end", "site"], ["interval_end", "site", "code"]],
        "interval_end", "site", "code",
    ).agg(F.sum("n").alias("n"), F.grouping("site").alias("_s"), F.grouping("code").alias("_c"))
    view = F.when((F.col("_s") == 1) & (F.col("_c") == 1), "total").when(F.col("_s") == 1, "code").when(F.col("_c") == 1, "site")
    return grouped.select("interval_end", view.otherwise("site_code").alias("view"), "site", "code", "n")


@contextmanager
def timer_store(spark: SparkSession):
    """State with timers needs its own kind of store; other streams of the session keep theirs."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def start_dashboard(counts: DataFrame, path: str, checkpoint: str, trigger_s: int = 1) -> StreamingQuery:
    """Start the stream; the views that a micro-batch emits replace those of a repeat of it.

    Micro-batches go on without messages, because the ends of intervals do.
    """
    store = batch_folder(path)

    def emit(batch: DataFrame, number: int) -> None:
        rolled = views(batch).persist()  # else each look at the batch would run the timers' stage again
        if number == 0 or not rolled.isEmpty():
            store(rolled, number)
        rolled.unpersist()

    with timer_store(counts.sparkSession):
        return (
            counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(emit).trigger(processingTime=f"{trigger_s} seconds").start()
        )


def drain_dashboard(counts: DataFrame, path: str, checkpoint: str, every_s: int) -> DataFrame:
    """Process all that has arrived, wait for its last interval to end, and return the views of all intervals.

    Run again with the same checkpoint it goes on where it stopped.
    """
    run = start_dashboard(counts, path, checkpoint)
    first, last, ended = None, None, False
    while not ended and run.isActive:
        time.sleep(0.2)
        for progress in run.recentProgress:
            at = datetime.fromisoformat(progress.timestamp)
            first = progress.batchId if first is None else first
            if progress.numInputRows > 0:
                last = at
            # a batch without messages, begun when the interval of the last messages was over; the first batch may be
            # the repeat of one that a run before left off at
            over = last is None or at >= last + timedelta(seconds=every_s)
            ended = progress.numInputRows == 0 and progress.batchId > first and over
    run.stop()
    if run.exception():
        raise run.exception()
    schema = "interval_end timestamp, view string, site string, code string, n long"
    return counts.sparkSession.read.schema(schema).parquet(path)
