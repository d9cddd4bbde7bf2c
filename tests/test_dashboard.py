"""Dashboard counts by intervals of arrival."""

from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetstats.streaming import dashboard

SCHEMA = "site STRING, code STRING, id LONG"


def messages(first, n):
    # one site sends most of them
    return [("hot" if i % 3 else f"s{i % 5}", None if i % 11 == 0 else str(i % 4), i) for i in range(first, first + n)]


def test_intervals_start_anew_and_their_views_agree(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    waves = [messages(0, 600), messages(600, 150)]
    state = None
    for wave in waves:
        spark.createDataFrame(wave, SCHEMA).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(SCHEMA).parquet(inbox)
        state = dashboard.interval_state(stream, every_s=2, buckets=4)
        table = dashboard.drain_dashboard(state, out, checkpoint, 2)
    found = rows(table, "interval_end", "view", "site", "code", "n")
    every = [m for wave in waves for m in wave]
    expected = {
        "total": Counter((None, None) for _ in every), "code": Counter((None, c) for _, c, _ in every),
        "site": Counter((s, None) for s, _, _ in every), "site_code": Counter((s, c) for s, c, _ in every),
    }
    for view, counts in expected.items():
        seen = Counter()
        for _, v, s, c, n in found:
            if v == view:
                seen[s, c] += n
        assert seen == counts, view
    ends = {end for end, *_ in found}
    assert len(ends) >= 2  # the second wave did not add to the first
    for end in ends:
        sums = {view: sum(n for e, v, _, _, n in found if e == end and v == view) for view in expected}
        assert len(set(sums.values())) == 1  # emitted together
        assert len([1 for e, v, *_ in found if e == end and v == "total"]) == 1


def test_other_streams_keep_their_state_store(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), dashboard.timer_store(spark):
        assert "RocksDB" in spark.conf.get(key)
        raise RuntimeError
    assert spark.conf.get(key) == before


def test_no_messages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    table = dashboard.drain_dashboard(dashboard.interval_state(stream, every_s=1), f"{tmp_path}/out", f"{tmp_path}/checkpoint", 1)
    assert rows(table) == []


def test_a_site_is_dealt_over_buckets(spark, tmp_path):
    spark.createDataFrame(messages(0, 400), SCHEMA).write.parquet(f"{tmp_path}/in")
    dealt = spark.read.parquet(f"{tmp_path}/in").where("site = 'hot'").select(
        F.pmod(F.xxhash64("site", "code", "id"), F.lit(8)).alias("b")).groupBy("b").count()
    counts = [n for _, n in rows(dealt)]
    assert len(counts) == 8 and max(counts) < 2 * sum(counts) / 8


def test_the_state_is_written_by_chunks():
    import pandas as pd
    from unittest.mock import MagicMock

    calls = dashboard.IntervalCounts(1000)
    calls.init(MagicMock())
    calls.chunks, calls.due = MagicMock(), MagicMock()
    calls.due.exists.return_value = False
    clock = MagicMock()
    clock.getCurrentProcessingTimeInMs.return_value = 1500
    batches = [pd.DataFrame({"site": [f"s{i}" for i in range(500)], "code": [None] * 500, "n": [2] * 500}) for _ in range(10)]
    assert list(calls.handleInputRows((0,), iter(batches), clock)) == []
    (key, (sites, codes, counts)), = [call.args for call in calls.chunks.updateValue.call_args_list]
    assert key == (0,) and len(set(sites)) == len(sites) == 500 and set(codes) == {None} and set(counts) == {20}
    calls.due.update.assert_called_once_with((2000, 1))
