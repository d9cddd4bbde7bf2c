"""Messages in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetstats import delivery, sinks
from fleetstats.operators import messages as msg
from fleetstats.plans.registry import load, query
from fleetstats.sources.files import lookup_table
from fleetstats.storage import new_path

ATTRIBUTES = ["campaign", "exitCode", "site", "system", "task"]

# Each event as a grid document. Users stand for sites, a fifth of the codes for success.
DOCS_SQL = """SELECT event_id, ts, concat('campaign-', event_type) AS campaign,
  CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) < 20 THEN '0'
    ELSE json_extract_string(props, '$.k') END AS "exitCode",
  concat('T3_US_', user_id) AS site,
  CASE event_type WHEN 'click' THEN 'dbs' WHEN 'view' THEN '' ELSE 'jobs' END AS system,
  CASE WHEN event_type <> 'error' THEN concat('/task', user_id, '/part:', json_extract_string(props, '$.k')) END AS task
FROM events"""

# The text of the message; the system is in it only where it makes no topic level.
_TASK_SQL = "coalesce('   task:' || task, '')"
_VALUE_SQL = (
    """concat('campaign:', campaign, '   exitCode:', "exitCode", '   site:', site, """
    f"CASE WHEN system = '' THEN '   system:' ELSE '' END, {_TASK_SQL})"
)
MESSAGES_SQL = f"WITH docs AS ({DOCS_SQL}), sent AS (SELECT *, {_VALUE_SQL} AS value FROM docs)"


def documents(spark, sf_dir):
    return to_documents(load(spark, sf_dir, "events"))


def to_documents(events):
    code = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("campaign-"), kind).alias("campaign"),
        F.when(code.cast("int") < 20, F.lit("0")).otherwise(code).alias("exitCode"),
        F.concat(F.lit("T3_US_"), "user_id").alias("site"),
        F.when(kind == "click", "dbs").when(kind == "view", "").otherwise("jobs").alias("system"),
        F.when(kind != "error", F.concat(F.lit("/task"), "user_id", F.lit("/part:"), code)).alias("task"),
    )


def records(spark, sf_dir):
    return documents(spark, sf_dir).select("event_id", "ts", msg.record_of(ATTRIBUTES).alias("record"))


def sent(spark, sf_dir):
    """Encoded messages without their topics, as a consumer sees them."""
    body = F.map_filter("record", lambda k, v: ~((k == "system") & (v != "")))
    return records(spark, sf_dir).select("event_id", "ts", msg.encode(body).alias("value"))


def decoded(spark, sf_dir):
    pairs = sent(spark, sf_dir).withColumn("pairs", msg.decode(F.col("value")))
    return pairs.select("event_id", "ts", *[F.col("pairs")[a].alias(a) for a in ("site", "exitCode", "campaign")])


@query(f"{MESSAGES_SQL} SELECT event_id, value FROM sent")
def message_encode(spark, sf_dir):
    return sent(spark, sf_dir).select("event_id", "value")


@query(f'{MESSAGES_SQL} SELECT event_id, campaign, "exitCode", site, task FROM docs')
def message_decode(spark, sf_dir):
    pairs = sent(spark, sf_dir).withColumn("pairs", msg.decode(F.col("value")))
    return pairs.select("event_id", *[F.col("pairs")[a].alias(a) for a in ("campaign", "exitCode", "site", "task")])


@query(f"""{MESSAGES_SQL}, subjects AS (SELECT *, CASE WHEN system = '' THEN 'cms' ELSE concat('cms.', system) END AS subject FROM sent)
SELECT event_id, concat(subject, '.campaign.', campaign) AS topic, value FROM subjects
UNION ALL SELECT event_id, concat(subject, '.exitCode.', "exitCode"), value FROM subjects
UNION ALL SELECT event_id, concat(subject, '.site.', replace(site, '_', '.')), value FROM subjects
UNION ALL SELECT event_id, concat(subject, '.task.', substr(replace(task, '/', '.'), 2)), value FROM subjects
  WHERE task IS NOT NULL""")
def topic_fanout(spark, sf_dir):
    return msg.fan_out(records(spark, sf_dir), "record").select("event_id", "topic", "value")


@query(f"""{MESSAGES_SQL}, subjects AS (SELECT *, CASE WHEN system = '' THEN 'cms' ELSE concat('cms.', system) END AS subject FROM sent)
SELECT concat(subject, '.exitCode.', "exitCode") AS topic, count(*) AS n FROM subjects WHERE system <> '' GROUP BY ALL""")
def topic_match(spark, sf_dir):
    out = msg.fan_out(records(spark, sf_dir), "record")
    return msg.counts_by(out.where(msg.topic_matches(F.col("topic"), "cms.*.exitCode.>")), "topic")


@query(f"""{MESSAGES_SQL} SELECT event_id, concat('campaign:', campaign, '   site:', site) AS value FROM docs""")
def attr_subset(spark, sf_dir):
    kept = msg.attr_subset(F.col("record"), ["site", "campaign", "dataset"])
    return records(spark, sf_dir).select("event_id", msg.encode(kept).alias("value"))


@query(f"""{MESSAGES_SQL} SELECT event_id,
  concat('{{"metric":"cms.","value":1,"tags":{{"campaign":"', campaign, '","exitCode":"', "exitCode", '","site":"', site, '"',
    CASE WHEN system = '' THEN ',"system":""' ELSE '' END, coalesce(',"task":"' || task || '"', ''), '}}}}') AS point
FROM sent""")
def metric_points(spark, sf_dir):
    return msg.metric_points(sent(spark, sf_dir), "cms.*.>").select("event_id", "point")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS code, concat(p_name, ': of ', p_brand) AS description
FROM part WHERE p_size > 3""")
def exit_code_lookup(spark, sf_dir):
    lines = load(spark, sf_dir, "part").select(
        F.when(F.col("p_size") == 1, "").when(F.col("p_size") == 2, "# comment: none")
        .when(F.col("p_size") == 3, "no colon")
        .otherwise(F.concat(F.lit(" "), "p_partkey", F.lit(" : "), "p_name", F.lit(": of "), "p_brand")).alias("value")
    )
    return lookup_table(lines)


@query(f"""{MESSAGES_SQL} SELECT "exitCode", count(*) AS n,
  coalesce(min(p_name || ':' || p_brand), '') AS description
FROM docs LEFT JOIN (SELECT * FROM part WHERE p_size % 3 > 0) ON CAST(p_partkey AS VARCHAR) = "exitCode"
GROUP BY "exitCode" ORDER BY n DESC, "exitCode" """)
def exit_code_counts(spark, sf_dir):
    mark = F.when(F.col("p_size") % 3 == 0, "# ").otherwise("")
    lines = load(spark, sf_dir, "part").select(
        F.concat(mark, "p_partkey", F.lit(": "), "p_name", F.lit(":"), "p_brand").alias("value")
    )
    counts = msg.counts_by(decoded(spark, sf_dir), "exitCode")
    return msg.largest_first(msg.describe_codes(counts, lookup_table(lines)), "exitCode")


@query(f"{MESSAGES_SQL} SELECT site, count(*) AS n FROM docs GROUP BY site")
def site_counts(spark, sf_dir):
    return msg.largest_first(msg.counts_by(decoded(spark, sf_dir), "site"), "site")


_SITE_CODES_SQL = f"""{MESSAGES_SQL}, pairs AS (
  SELECT site, "exitCode", count(*) AS n FROM docs WHERE "exitCode" <> '0' GROUP BY ALL)"""


@query(f"{_SITE_CODES_SQL} SELECT * FROM pairs")
def site_code_counts(spark, sf_dir):
    return msg.failing_codes(decoded(spark, sf_dir))


@query(f"""{MESSAGES_SQL} SELECT count(DISTINCT site) AS sites, count(DISTINCT "exitCode") AS codes FROM docs""")
def distinct_sites_codes(spark, sf_dir):
    return msg.distinct_sites_and_codes(decoded(spark, sf_dir))


@query(f"""{_SITE_CODES_SQL}, best AS (
  SELECT site, CAST(sum(n) AS BIGINT) AS site_total FROM pairs GROUP BY site ORDER BY site_total DESC, site LIMIT 3)
SELECT site, "exitCode", n, site_total, CAST(row_number() OVER (PARTITION BY site ORDER BY n DESC, "exitCode") AS INT) AS rank
FROM pairs JOIN best USING (site) QUALIFY rank <= 5""")
def top_codes_top_sites(spark, sf_dir):
    return msg.top_codes_of_top_sites(msg.failing_codes(decoded(spark, sf_dir)))


# ---- rows for receivers ---------------------------------------------------------------------


@query(f"""{MESSAGES_SQL} SELECT event_id, concat('{{"version":"0.1","producer":"grid","body":{{"data":{{"campaign":"', campaign, '"',
  coalesce(',"task":"' || task || '"', ''), '}},"metadata":{{"env":"test","producer":"grid","timestamp":',
  CAST(epoch_us(ts) // 1000 AS VARCHAR), ',"_id":"', md5(CAST(event_id AS VARCHAR)), '","type":"job"}}}}}}') AS value FROM docs""")
def notification_envelope(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return sinks.envelope(
        docs, "grid", "0.1", ["campaign", "task"], F.unix_millis("ts"), doc_type="job",
        doc_id=F.md5(F.col("event_id").cast("string")), metadata={"env": "test"}, subfield="data", keep=["event_id"],
    )


@query(f"""{MESSAGES_SQL} SELECT event_id, CASE WHEN campaign = 'campaign-signup' THEN 'no sign-ups' END AS reason FROM docs""")
def deliver_chunks(spark, sf_dir):
    """Messages sent in chunks to a receiver that takes no sign-ups: what it keeps, and what came back."""
    def refuse(record: str) -> str | None:
        return "no sign-ups" if '"campaign":"campaign-signup"' in record else None

    docs = documents(spark, sf_dir)
    notes = sinks.envelope(docs, "grid", "0.1", ["campaign", "event_id"], F.unix_millis("ts"))
    path = new_path(spark, "received")
    outcome = delivery.deliver_chunks(notes, delivery.FolderReceiver(path, refuse), size=500)
    kept = spark.read.schema("value string").text(path).select("value", F.lit(None).cast("string").alias("reason"))
    every = kept.unionByName(outcome.rejects.select("value", "reason"))
    return every.select(F.get_json_object("value", "$.body.event_id").cast("long").alias("event_id"), "reason")


@query("""SELECT s_suppkey, md5(concat('{"s_name": "', s_name, '", "s_nationkey": ', s_nationkey, '}')) AS id FROM supplier""")
def record_ids(spark, sf_dir):
    """Ids for records that bring none."""
    supplier = load(spark, sf_dir, "supplier")
    return supplier.select("s_suppkey", sinks.content_id(supplier, ["s_name", "s_nationkey"]).alias("id"))


@query("SELECT count(*) AS records, count(DISTINCT event_id) AS ids, true AS chunks_fit FROM events")
def chunk_records(spark, sf_dir):
    chunks = sinks.chunk_records(load(spark, sf_dir, "events").select("event_id"), 1000)
    sizes = chunks.groupBy("sender", "chunk").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))
    return sizes.agg(
        F.sum("n").alias("records"), F.sum("ids").alias("ids"), (F.max("n") <= 1000).alias("chunks_fit")
    )


@query("""SELECT s_suppkey, concat('{"_op_type":"index","_index":"usage","_source":{"rse":"', s_name, '","nation":',
  s_nationkey, '}}') AS value FROM supplier""")
def bulk_index_docs(spark, sf_dir):
    source = [F.col("s_name").alias("rse"), F.col("s_nationkey").alias("nation")]
    return sinks.bulk_documents(load(spark, sf_dir, "supplier"), "usage", source, keep=["s_suppkey"])


@query(f"""{MESSAGES_SQL} SELECT concat('messages{{site="', site, '",campaign="', campaign, '"}} ', count(*)) AS line
FROM docs GROUP BY site, campaign
UNION ALL SELECT concat('cms_metric_', "exitCode", ' ', count(*)) FROM docs GROUP BY "exitCode" """)
def metric_lines(spark, sf_dir):
    seen = decoded(spark, sf_dir)
    labeled = sinks.metric_lines(msg.counts_by(seen, "site", "campaign"), "messages", "n", ["site", "campaign"])
    keyed = sinks.keyed_metric_lines(msg.counts_by(seen, "exitCode"), "cms.>", "exitCode", "n")
    return labeled.unionByName(keyed)
