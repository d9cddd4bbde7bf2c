"""Messages in batch and as a stream."""

from datetime import datetime

from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetstats import sinks
from fleetstats.operators import messages as msg
from fleetstats.storage import new_path
from fleetstats.streaming import runs

DOC = {"site": "T3_US_Test", "campaign": "campaign-0", "task": "/task0/part0", "system": "system", "exitCode": "0"}


def docs(spark, *records):
    return spark.createDataFrame([(i, r) for i, r in enumerate(records)], "id INT, record MAP<STRING, STRING>")


def test_topics_of_one_document(spark):
    out = msg.fan_out(docs(spark, DOC), "record")
    value = "campaign:campaign-0   exitCode:0   site:T3_US_Test   task:/task0/part0"
    assert {r[0] for r in rows(out, "value")} == {value}
    assert sorted(r[0] for r in rows(out, "topic")) == [
        "cms.system.campaign.campaign-0", "cms.system.exitCode.0", "cms.system.site.T3.US.Test",
        "cms.system.task.task0.part0",
    ]


def test_prefix_belongs_to_its_document(spark):
    out = msg.fan_out(docs(spark, {"system": "a", "k": "1"}, {"system": "b", "k": "2"}, {"k": "3"}), "record")
    assert sorted(r[0] for r in rows(out, "topic")) == ["cms.a.k.1", "cms.b.k.2", "cms.k.3"]


def test_empty_values_make_no_topic(spark):
    out = msg.fan_out(docs(spark, {"site": "", "k": "1"}, {"site": ""}), "record")
    assert sorted(rows(out, "id", "topic", "value")) == [(0, "cms.k.1", "k:1   site:"), (1, "cms", "site:")]


def test_given_topics_attrs_and_transform(spark):
    out = msg.fan_out(
        docs(spark, DOC, {"other": "x"}), "record", topics=["a", "b"], attrs=["site", "exitCode"],
        transform=lambda df: df.where(F.col("record")["site"].isNotNull()),
    )
    assert sorted(rows(out, "topic", "value")) == [
        ("a", "exitCode:0   site:T3_US_Test"), ("b", "exitCode:0   site:T3_US_Test"),
    ]


def test_dataset_levels(spark):
    out = msg.fan_out(docs(spark, {"dataset": "/A/B/C"}), "record")
    assert rows(out, "topic") == [("cms.dataset.A.B.C",)]


def test_decoder_keeps_colons_and_last_duplicates(spark):
    df = spark.createDataFrame([("a:x:y   b:1   b:2   c",)], "value STRING")
    assert rows(df.select(msg.decode(F.col("value")).alias("m"))) == [({"a": "x:y", "b": "2", "c": None},)]


_word = st.text(st.characters(codec="ascii", categories=["L", "N"], include_characters="/_-."), min_size=1, max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(_word, _word, min_size=1, max_size=4), min_size=1, max_size=5))
def test_encode_decode(spark, records):
    df = docs(spark, *records)
    back = df.select("id", msg.decode(msg.encode(F.col("record"))).alias("m"))
    assert dict(rows(back)) == dict(enumerate(records))


def test_topic_patterns(spark):
    topics = ["cms.a.exitCode.1", "cms.a.exitCode.1.x", "cms.exitCode.1", "cms.a.exitCode", "cmsxaxexitCodex1"]
    df = spark.createDataFrame([(t,) for t in topics], "t STRING")
    assert [r[0] for r in rows(df.where(msg.topic_matches(F.col("t"), "cms.*.exitCode.>")))] == topics[:2]
    assert [r[0] for r in rows(df.where(msg.topic_matches(F.col("t"), "cms.exitCode.1")))] == topics[2:3]


def test_counts_and_ranks(spark):
    seen = [("s1", "5")] * 3 + [("s1", "6")] * 2 + [("s1", "0")] * 9 + [("s2", "7")] * 4 + [("s3", "8")]
    df = spark.createDataFrame(seen, "site STRING, exitCode STRING")
    codes = msg.failing_codes(df)
    assert sorted(rows(codes)) == [("s1", "5", 3), ("s1", "6", 2), ("s2", "7", 4), ("s3", "8", 1)]
    top = msg.top_codes_of_top_sites(codes, sites=2, codes=1)
    assert sorted(rows(top, "site", "exitCode")) == [("s1", "5"), ("s2", "7")]
    assert rows(msg.distinct_sites_and_codes(df)) == [(3, 5)]


def test_stream_equals_batch_for_closed_intervals(spark, sf_dir):
    from fleetstats.plans.messages import to_documents
    from fleetstats.plans.registry import load
    from fleetstats.plans.streams import _event_stream

    streamed = runs.drain(
        msg.interval_counts(to_documents(_event_stream(spark, sf_dir)), "ts", ["site"], "1 hour"),
        new_path(spark, "t"), new_path(spark, "c"),
    )
    batch = msg.interval_counts(to_documents(load(spark, sf_dir, "events")), "ts", ["site"], "1 hour")
    assert streamed.exceptAll(batch).count() == 0
    last = streamed.agg(F.max("interval_end")).first()[0]
    assert batch.where(F.col("interval_end") <= F.lit(last)).exceptAll(streamed).count() == 0


def test_deliver_batches_with_their_number(spark):
    inbox, out, checkpoint = (new_path(spark, n) for n in ("in", "out", "cp"))
    spark.range(5).write.parquet(inbox)
    for more in (5, 3):
        spark.range(more).write.mode("append").parquet(inbox) if more == 3 else None
        stream = runs.file_stream(spark, inbox, spark.range(1).schema)
        runs.deliver(stream, runs.batch_folder(out), checkpoint)
    assert sorted(rows(spark.read.parquet(out).groupBy("batch").count())) == [(0, 5), (1, 3)]


def test_late_rows_are_dropped(spark):
    inbox, out, checkpoint = (new_path(spark, n) for n in ("in", "out", "cp"))

    def arrive(*times):
        data = [(datetime.fromisoformat("2024-01-01T" + t),) for t in times]
        spark.createDataFrame(data, "ts TIMESTAMP").write.mode("append").parquet(inbox)
        stream = runs.file_stream(spark, inbox, spark.createDataFrame(data, "ts TIMESTAMP").schema)
        return runs.drain(msg.interval_counts(stream, "ts", every="1 minute"), out, checkpoint)

    arrive("10:00:30", "10:30:00")
    table = arrive("10:00:40", "10:25:00", "11:00:00")
    assert [(r[0].strftime("%H:%M"), r[1]) for r in sorted(rows(table, "interval_start", "n"))] == [
        ("10:00", 1), ("10:25", 1), ("10:30", 1),
    ]


def test_envelope_rules(spark):
    df = spark.createDataFrame([(1, "x", None)], "id INT, a STRING, b STRING")
    note = sinks.envelope(df, "p", "0.1", ["a", "b"], F.lit(5).cast("long"), doc_id=F.lit(""))
    assert rows(note) == [('{"version":"0.1","producer":"p","body":{"a":"x","metadata":{"producer":"p","timestamp":5}}}',)]
    try:
        sinks.envelope(df, "p", "0.1", ["a"], F.lit(5), metadata={"type": "x"})
    except ValueError as error:
        assert "type" in str(error)
    else:
        raise AssertionError("reserved key accepted")


def test_chunks_cover_all_rows(spark):
    chunks = sinks.chunk_records(spark.range(0, 1050, 1, 3), 100)
    sizes = rows(chunks.groupBy("sender", "chunk").count(), "count")
    assert sum(s[0] for s in sizes) == 1050 and max(s[0] for s in sizes) == 100 and len(sizes) == 12


def test_metric_text(spark):
    df = spark.createDataFrame([("a", None, 3)], "x STRING, y STRING, n INT")
    assert rows(sinks.metric_lines(df, "m", "n", ["x", "y"])) == [('m{x="a",y=""} 3',)]
    assert rows(sinks.metric_lines(df, "m", "n", [])) == [("m 3",)]
    assert rows(sinks.keyed_metric_lines(df, "cms.site.>", "x", "n")) == [("cms_site_metric_a 3",)]


def test_ids_are_unique(spark):
    made = spark.range(50).select(sinks.new_id().alias("id"))
    assert made.distinct().count() == 50
