"""Record checks and store comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetstats.operators import quality
from fleetstats.operators import reconcile as rec
from fleetstats.plans.registry import load, query
from fleetstats.schemas import ALLOWED_JOB_VALUES

_K = "CAST(json_extract_string(props, '$.k') AS INT)"

# Documents that break the contract in ways that depend on the event.
_DOCS_SQL = f"""SELECT event_id, {_K} AS k, event_type, user_id, value FROM events"""

EXAMPLE = {"id": 1, "kind": "text", "score": 1.5, "flag": True, "list": [1, 2], "inner": {"a": "x", "b": {"c": 1}}}


def _documents(spark, sf_dir):
    """JSON texts; every tenth value of k spoils one key."""
    k = F.get_json_object("props", "$.k").cast("int")
    parts = {
        "id": F.when(k == 0, '"x"').when(k == 1, "true").when(k == 2, "1.5").otherwise(F.col("event_id").cast("string")),
        "kind": F.when(k == 3, "7").when(k == 4, "null").otherwise(F.concat(F.lit('"'), "event_type", F.lit('"'))),
        "score": F.when(k == 5, "3").when(k == 6, '"1.5"').otherwise("2.25"),
        "flag": F.when(k == 7, "1").otherwise("false"),
        "list": F.when(k == 8, "[]").when(k == 9, '[1,"2"]').when(k == 10, "[1.5]").when(k == 11, "[null]")
        .when(k == 12, "5").otherwise("[1,2,3]"),
        "inner": F.when(k == 13, '{"a":1}').when(k == 14, '{"b":{"c":"z"}}').when(k == 15, '{"new":1}')
        .when(k == 16, "3").otherwise('{"a":"y","b":{"c":2}}'),
    }
    body = F.concat_ws(",", *[F.concat(F.lit(f'"{name}":'), text) for name, text in parts.items()])
    extra = F.when(k == 17, ',"zzz":1,"extra":{}').otherwise("")
    text = F.when(k == 18, "[1]").when(k == 19, "{bad").otherwise(F.concat(F.lit("{"), body, extra, F.lit("}")))
    return load(spark, sf_dir, "events").select("event_id", text.alias("doc"))


@query(f"""WITH d AS ({_DOCS_SQL}) SELECT event_id,
  CASE WHEN k IN (18, 19) THEN NULL WHEN k IN (0, 2) THEN 'id' WHEN k = 3 THEN 'kind' WHEN k = 6 THEN 'score'
    WHEN k = 7 THEN 'flag' WHEN k BETWEEN 8 AND 12 THEN 'list' WHEN k IN (13, 14, 16) THEN 'inner' ELSE '' END AS offending,
  CASE WHEN k IN (18, 19) THEN NULL WHEN k = 17 THEN 'extra,zzz' ELSE '' END AS unknown,
  CASE WHEN k IN (18, 19) THEN NULL WHEN k IN (0, 2, 3, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16) THEN 5 ELSE 6 END AS kept_keys
FROM d""")
def schema_validate(spark, sf_dir):
    checked = quality.validate_records(_documents(spark, sf_dir), "doc", EXAMPLE, True, True)
    return checked.select(
        "event_id",
        F.when(F.col("offending_keys").isNotNull(), F.array_join("offending_keys", ",")).alias("offending"),
        F.when(F.col("unknown_keys").isNotNull(), F.array_join("unknown_keys", ",")).alias("unknown"),
        F.json_object_keys("payload").alias("keys"),
    ).select("event_id", "offending", "unknown", F.when(F.col("keys").isNotNull(), F.size("keys")).alias("kept_keys"))


_CONTRACT = {
    "required": ["id", "kind", "zzz_optional_by_type"],
    "properties": {
        "id": {"type": "integer"}, "kind": {"type": ["string", "null"]}, "score": {"type": "number"},
        "flag": {"type": "boolean"}, "list": {"type": "array"}, "inner": {"type": "object"}, "free": {},
    },
}


@query(f"""WITH d AS ({_DOCS_SQL}) SELECT event_id,
  CASE WHEN k IN (18, 19) THEN 'id,kind' ELSE '' END AS missing,
  CASE WHEN k IN (0, 1, 2) THEN 'id' WHEN k = 3 THEN 'kind' WHEN k = 6 THEN 'score' WHEN k = 7 THEN 'flag'
    WHEN k = 12 THEN 'list' WHEN k = 16 THEN 'inner' ELSE '' END AS mistyped,
  k NOT IN (0, 1, 2, 3, 6, 7, 12, 16, 18, 19) AS valid FROM d""")
def contract_validate(spark, sf_dir):
    contract = _CONTRACT | {"required": ["id", "kind"]}
    checked = quality.validate_contract(_documents(spark, sf_dir), "doc", contract)
    return checked.select(
        "event_id", F.array_join("missing_keys", ",").alias("missing"),
        F.array_join("mistyped_keys", ",").alias("mistyped"), "valid",
    )


_ALLOWED = {"l_returnflag": ["A", "N"], "l_linestatus": ["F"], "l_linenumber": [1, 2, 3, 4, 5, 6]}


@query("""SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'l_returnflag' END,
  CASE WHEN l_linestatus <> 'F' THEN 'l_linestatus' END, CASE WHEN l_linenumber > 6 THEN 'l_linenumber' END) AS bad FROM lineitem""")
def enum_validate(spark, sf_dir):
    checked = quality.validate_enums(load(spark, sf_dir, "lineitem"), _ALLOWED, list(_ALLOWED))
    return checked.select("l_orderkey", "l_linenumber", F.array_join("bad_keys", ",").alias("bad"))


@query("""SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN l_returnflag = 'R' THEN 'Type' END,
  CASE WHEN l_linenumber % 3 = 2 THEN 'JobFailed' END, CASE WHEN l_linestatus = 'O' THEN 'Pool' END) AS bad FROM lineitem""")
def job_value_check(spark, sf_dir):
    """Job fields against the values that job documents may hold."""
    jobs = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.expr("CASE l_returnflag WHEN 'A' THEN 'Analysis' WHEN 'N' THEN 'Production' ELSE 'Other' END").alias("Type"),
        (F.col("l_linenumber") % 3).alias("JobFailed"),
        F.expr("CASE l_linestatus WHEN 'F' THEN 'Global' ELSE 'Local' END").alias("Pool"),
    )
    checked = quality.validate_enums(jobs, ALLOWED_JOB_VALUES, ["Type", "JobFailed", "Pool"])
    return checked.select("l_orderkey", "l_linenumber", F.array_join("bad_keys", ",").alias("bad"))


@query("""SELECT doc_id, concat_ws(',', CASE WHEN n_chars < 100 THEN 'short' END, CASE WHEN lang <> 'en' THEN 'lang' END,
  CASE WHEN regexp_matches(text, '[0-9]{4}') THEN 'digits' END) AS reasons FROM documents""")
def dead_letter_split(spark, sf_dir):
    marked = quality.mark_rejects(load(spark, sf_dir, "documents"), {
        "short": F.col("n_chars") < 100, "lang": F.col("lang") != "en", "digits": F.col("text").rlike("[0-9]{4}"),
    })
    return marked.select("doc_id", F.array_join("reject_reasons", ",").alias("reasons"))


@query("""SELECT o_orderkey, concat('{"status":"', o_orderstatus, '"',
  CASE WHEN o_orderpriority <> '5-LOW' THEN concat(',"priority":"', o_orderpriority, '"') ELSE '' END, '}') AS doc FROM orders""")
def drop_null_keys(spark, sf_dir):
    record = F.create_map(
        F.lit("status"), F.col("o_orderstatus"),
        F.lit("priority"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")),
    )
    orders = load(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.to_json(quality.drop_null_keys(record)).alias("doc"))


@query("""SELECT c_custkey, md5(concat('{"c_custkey": ', c_custkey, ', "c_mktsegment": "', c_mktsegment, '", "c_name": "', c_name,
  '", "c_nationkey": ', CASE WHEN c_nationkey > 20 THEN 'null' ELSE CAST(c_nationkey AS VARCHAR) END, '}')) AS print FROM customer""")
def record_fingerprint(spark, sf_dir):
    customer = load(spark, sf_dir, "customer").withColumn(
        "c_nationkey", F.when(F.col("c_nationkey") <= 20, F.col("c_nationkey"))
    )
    names = ["c_name", "c_custkey", "c_nationkey", "c_mktsegment"]
    return customer.select("c_custkey", quality.fingerprint(customer, names).alias("print"))


# ---- stores ---------------------------------------------------------------------------------


_STORES_SQL = """WITH e AS (SELECT CAST(ts AS DATE) AS day, event_id, event_type, user_id FROM events),
a AS (SELECT * FROM e WHERE user_id <> 7), b AS (SELECT * FROM e WHERE NOT (event_type = 'click' AND user_id < 20)),
m AS (SELECT coalesce(a.day, b.day) AS day, a.event_id IS NOT NULL AS in_a, b.event_id IS NOT NULL AS in_b
  FROM a FULL JOIN b ON a.event_id = b.event_id AND a.day = b.day)
SELECT CAST(day AS VARCHAR) AS day, count(*) FILTER (NOT in_b) AS only_a, count(*) FILTER (NOT in_a) AS only_b, count(*) FILTER (in_a) AS ids_a,
  count(*) FILTER (in_b) AS ids_b, count(*) FILTER (NOT in_a OR NOT in_b) AS missing FROM m GROUP BY day HAVING missing > 0"""


def _stores(spark, sf_dir):
    """Two stores of events that lack some each."""
    events = load(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date").cast("string"))
    return events.where("user_id <> 7"), events.where("NOT (event_type = 'click' AND user_id < 20)")


@query(_STORES_SQL)
def id_diff_by_day(spark, sf_dir):
    return rec.id_diff(*_stores(spark, sf_dir), "event_id", "day")


@query(_STORES_SQL)
def id_diff_by_digest(spark, sf_dir):
    """Digests of days and buckets first, then the ids of those that differ."""
    return rec.id_diff_by_digest(*_stores(spark, sf_dir), "event_id", "day")


@query("""WITH l AS (SELECT CASE l_linestatus WHEN 'F' THEN 'Completed' ELSE 'Running' END AS status FROM lineitem),
o AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Running' ELSE 'Idle' END AS status FROM orders),
s AS (SELECT DISTINCT status FROM o),
n AS (SELECT status, (SELECT count(*) FROM l WHERE l.status = s.status) AS "search",
  (SELECT count(*) FROM l WHERE l.status = s.status AND s.status <> 'Idle') AS copy,
  (SELECT count(*) FROM o WHERE o.status = s.status) AS influx FROM s)
SELECT *, ("search" - copy) / nullif(CAST("search" AS DOUBLE), 0) AS search_copy_diff,
  CASE WHEN "search" = 0 THEN copy <> 0 ELSE abs(("search" - copy) / CAST("search" AS DOUBLE)) > 0.01 END AS search_copy_flag,
  (copy - influx) / nullif(CAST(copy AS DOUBLE), 0) AS copy_influx_diff,
  CASE WHEN copy = 0 THEN influx <> 0 ELSE abs((copy - influx) / CAST(copy AS DOUBLE)) > 0.01 END AS copy_influx_flag FROM n""")
def source_reconcile(spark, sf_dir):
    lines, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    by_line = {"Completed": F.col("l_linestatus") == "F", "Running": F.col("l_linestatus") == "O"}
    by_order = {
        "Completed": F.col("o_orderstatus") == "F", "Running": F.col("o_orderstatus") == "O",
        "Idle": F.col("o_orderstatus").rlike("P"),
    }
    return rec.reconcile({"search": (lines, by_line), "copy": (lines, by_line), "influx": (orders, by_order)}, 0.01)


@query("""SELECT o_orderkey, concat_ws(',', CASE WHEN o_totalprice > 400000 THEN 'price' END,
  CASE WHEN o_orderstatus = 'P' THEN 'status' END) AS reasons FROM orders""")
def rejects_with_reasons(spark, sf_dir):
    """Good and bad rows apart, brought together again: none is lost, the bad ones have their reasons."""
    orders = load(spark, sf_dir, "orders")
    good, bad = quality.split_rejects(orders, {
        "price": F.col("o_totalprice") > 400_000, "status": F.col("o_orderstatus") == "P"})
    reasons = F.array_join("reject_reasons", ",").alias("reasons")
    return good.select("o_orderkey", F.lit("").alias("reasons")).unionByName(bad.select("o_orderkey", reasons))
