"""The stream operators, run over the events until all is processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetstats.operators import logs
from fleetstats.operators import messages as msg
from fleetstats.plans.logs import access_line
from fleetstats.plans.messages import ATTRIBUTES, MESSAGES_SQL, to_documents
from fleetstats.plans.registry import load, query
from fleetstats.storage import new_path
from fleetstats.streaming import dashboard, runs

# The watermark after the given latest time; it has millisecond precision.
_MARK = "(date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE)"


def _event_stream(spark, sf_dir):
    schema = load(spark, sf_dir, "events").schema
    # a pattern, because the table may be one file or a folder of files
    return runs.file_stream(spark, f"{sf_dir}/events.parque[t]", schema)


def _drain(stream, label):
    spark = stream.sparkSession
    return runs.drain(stream, new_path(spark, label), new_path(spark, label + "-checkpoint"))


def _drain_counts(stream, label):
    spark, keys = stream.sparkSession, [c for c in stream.columns if c != "n"]
    return runs.drain_latest(stream, keys, new_path(spark, label), new_path(spark, label + "-checkpoint"))


@query(f"""{MESSAGES_SQL}, counted AS (
  SELECT time_bucket(INTERVAL 10 SECOND, ts) AS interval_start, campaign, count(*) AS n FROM docs GROUP BY ALL)
SELECT interval_start, interval_start + INTERVAL 10 SECOND AS interval_end, campaign, n FROM counted""")
def stream_counts(spark, sf_dir):
    """All intervals, those too that are still open when the input ends."""
    docs = to_documents(_event_stream(spark, sf_dir))
    return _drain_counts(msg.interval_counts(docs, "ts", ["campaign"]), "counts")


@query(f"""{MESSAGES_SQL}, counted AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS interval_start, site, "exitCode", count(*) AS n FROM docs
  WHERE "exitCode" <> '0' GROUP BY ALL)
SELECT interval_start, interval_start + INTERVAL 1 HOUR AS interval_end, site, "exitCode", n FROM counted""")
def stream_site_codes(spark, sf_dir):
    docs = to_documents(_event_stream(spark, sf_dir)).where(F.col("exitCode") != "0")
    return _drain_counts(msg.interval_counts(docs, "ts", ["site", "exitCode"], every="1 hour"), "site-codes")


@query(f"""{MESSAGES_SQL} SELECT CASE WHEN s = 1 AND c = 1 THEN 'total' WHEN s = 1 THEN 'code' WHEN c = 1 THEN 'site' ELSE 'site_code' END AS view,
  site, code, n FROM (SELECT site, "exitCode" AS code, count(*) AS n, grouping(site) AS s, grouping("exitCode") AS c
  FROM docs GROUP BY GROUPING SETS ((), ("exitCode"), (site), (site, "exitCode")))""")
def stream_dashboard(spark, sf_dir):
    """The four views of a dashboard whose counts start anew with each interval of arrival, added up."""
    docs = to_documents(_event_stream(spark, sf_dir)).select("event_id", "site", F.col("exitCode").alias("code"))
    out, checkpoint = new_path(spark, "dashboard"), new_path(spark, "dashboard-checkpoint")
    counts = dashboard.interval_state(docs, every_s=2, buckets=8)
    seen = dashboard.drain_dashboard(counts, out, checkpoint, 2)
    return seen.groupBy("view", "site", "code").agg(F.sum("n").alias("n"))


@query(f"""{MESSAGES_SQL}, first AS (SELECT {_MARK} AS mark FROM docs WHERE campaign <> 'campaign-signup'),
rows AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS interval_start, campaign FROM docs),
kept AS (SELECT * FROM rows WHERE campaign <> 'campaign-signup'
  OR interval_start + INTERVAL 1 HOUR > (SELECT mark FROM first))
SELECT interval_start, interval_start + INTERVAL 1 HOUR AS interval_end, count(*) AS n FROM kept
GROUP BY interval_start""")
def stream_late_data(spark, sf_dir):
    """The sign-ups arrive after all other events; those behind the watermark are dropped."""
    inbox, out, checkpoint = (new_path(spark, name) for name in ("inbox", "hours", "hours-checkpoint"))
    docs = to_documents(load(spark, sf_dir, "events")).select("ts", "campaign")
    late = F.col("campaign") == "campaign-signup"
    for part in (docs.where(~late), docs.where(late)):
        part.write.mode("append").parquet(inbox)
        arrived = runs.file_stream(spark, inbox, docs.schema)
        counts = msg.interval_counts(arrived, "ts", every="1 hour")
        table = runs.drain_latest(counts, ["interval_start", "interval_end"], out, checkpoint)
    return table


@query(f"""{MESSAGES_SQL}, subjects AS (SELECT *, CASE WHEN system = '' THEN 'cms' ELSE concat('cms.', system) END AS subject FROM sent)
SELECT event_id, concat(subject, '.site.', replace(site, '_', '.')) AS topic,
  concat('exitCode:', "exitCode", '   site:', site) AS value FROM subjects
UNION ALL SELECT event_id, concat(subject, '.exitCode.', "exitCode"), concat('exitCode:', "exitCode", '   site:', site) FROM subjects""")
def stream_topic_fanout(spark, sf_dir):
    docs = to_documents(_event_stream(spark, sf_dir)).withColumn("record", msg.record_of(ATTRIBUTES))
    sent = msg.fan_out(docs, "record", attrs=["site", "exitCode"])
    return _drain(sent.select("event_id", "topic", "value"), "sent")


@query("""SELECT CAST(code AS BIGINT) AS code, api, count(*) AS n FROM (
  SELECT CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS code,
    CASE WHEN event_type <> 'error' THEN event_type END AS api FROM events) GROUP BY ALL""")
def stream_access_log(spark, sf_dir):
    """Log files as a stream: the batch parser; rejects are kept in the same table, without code and API."""
    inbox = new_path(spark, "log")
    events = load(spark, sf_dir, "events")
    request = F.concat(F.lit("/dbs/prod/"), "event_type")
    events.select(access_line(request, F.lit("error")).alias("value")).write.text(inbox)
    marked = logs.mark_access_log(runs.log_stream(spark, inbox)).select("code", "api", "is_record", "value")
    table = _drain(marked, "access")
    known = [F.when(F.col("is_record"), F.col(c)).alias(c) for c in ("code", "api")]
    return table.groupBy(*known).agg(F.count("*").alias("n"))


@query("SELECT event_id, event_type, true AS numbered FROM events")
def stream_delivery(spark, sf_dir):
    """Numbered batches handed to a receiver, which keeps each in its own folder."""
    path = new_path(spark, "delivered")
    stream = _event_stream(spark, sf_dir).select("event_id", "event_type")
    runs.deliver(stream, runs.batch_folder(path), new_path(spark, "delivered-checkpoint"))
    return spark.read.parquet(path).select("event_id", "event_type", (F.col("batch") >= 0).alias("numbered"))
