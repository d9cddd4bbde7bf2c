"""Series, histograms, quotas, storage and campaigns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetstats.functions.sizes import bytes_from_text
from fleetstats.functions.times import epoch_millis, flexible_epoch, period_chunks as chunks_of, seconds_text
from fleetstats.operators import reports as rep
from fleetstats.operators import rollups
from fleetstats.operators import timeseries as ts
from fleetstats.plans.registry import load, query
from fleetstats.sources import files
from fleetstats.storage import new_path

# ---- series ---------------------------------------------------------------------------------

_DAY = "CAST(epoch(o_orderdate) AS BIGINT)"


@query(f"""WITH o AS (SELECT *, {_DAY} AS s FROM orders WHERE o_orderstatus <> 'P')
SELECT o_orderkey, strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS time, rse, substr(rse, 1, 2) AS tier, country,
  v AS used_bytes FROM (
  SELECT o_orderkey, s AS t, concat('T1_', o_orderpriority) AS rse, o_orderstatus AS country, o_totalprice AS v FROM o
  UNION ALL SELECT o_orderkey, s + 3600, concat('T1_', o_orderpriority), o_orderstatus, 2.5 FROM o
  UNION ALL SELECT o_orderkey, s, 'T2_Tape', NULL, CAST(o_custkey AS DOUBLE) FROM o)""")
def explode_series(spark, sf_dir):
    at = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    answer = F.concat(
        F.lit('{"status":"'), F.when(F.col("o_orderstatus") == "P", "error").otherwise("success"),
        F.lit('","data":{"resultType":"matrix","result":[{"metric":{"rse":"T1_'), "o_orderpriority",
        F.lit('","country":"'), "o_orderstatus", F.lit('"},"values":[['), at, F.lit(',"'),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit('"],['), at + 3600,
        F.lit(',"2.5"]]},{"metric":{"rse":"T2_Tape"},"values":[['), at, F.lit(',"'), "o_custkey",
        F.lit('"]]},{"metric":{"rse":"T0_None"},"values":[]}]}}'),
    )
    answers = load(spark, sf_dir, "orders").select("o_orderkey", answer.alias("answer"))
    samples = ts.explode_series(answers, "answer", ["rse", "country"])
    return samples.select(
        "o_orderkey", ts.iso_utc(F.col("timestamp")).alias("time"), "rse",
        ts.element_tier(F.col("rse")).alias("tier"), "country", F.col("value").alias("used_bytes"),
    )


_EXPORT_SQL = f"""SELECT concat('/', p_name, '/', o_orderpriority) AS dataset, p_type AS dataset_type, ts, CAST(value AS DOUBLE) AS value FROM (
  SELECT p_name, p_type, o_orderpriority, {_DAY} AS ts, o_orderkey AS value FROM orders JOIN part ON p_partkey = o_custkey
  UNION ALL SELECT p_name, p_type, o_orderpriority, {_DAY} + 60, 1 FROM orders JOIN part ON p_partkey = o_custkey)"""


def _export(spark, sf_dir):
    at = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) * 1000 + 123
    line = F.concat(
        F.lit('{"metric":{"__name__":"dbs","dataset":"/'), "p_name", F.lit("/"), "o_orderpriority",
        F.lit('","dataset_type":"'), "p_type", F.lit('"},"values":['), "o_orderkey", F.lit(',1],"timestamps":['),
        at, F.lit(","), at + 60000, F.lit("]}"),
    )
    joined = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "part"), F.col("p_partkey") == F.col("o_custkey"))
    return ts.explode_export(joined.select(line.alias("line")), "line", ["dataset", "dataset_type"])


@query("""SELECT s_suppkey, 'answer' AS reject_reason, 1 AS n FROM supplier WHERE s_suppkey % 3 = 0
UNION ALL SELECT s_suppkey, 'sample', 2 FROM supplier WHERE s_suppkey % 3 <> 0""")
def series_rejects(spark, sf_dir):
    """Samples that are no numbers and answers that are none, kept with a reason."""
    answer = F.concat(
        F.lit('{"status":"success","data":{"resultType":"matrix","result":[{"metric":{"rse":"x"},"values":[['),
        "s_suppkey", F.lit(',"1.5"],["soon","2"],[7,"many"]]}]}}'))
    text = F.when(F.col("s_suppkey") % 3 == 0, F.lit('{"status":"error"}')).otherwise(answer)
    marked = ts.mark_series(load(spark, sf_dir, "supplier").select("s_suppkey", text.alias("j")), "j", ["rse"])
    bad = marked.where("reject_reason IS NOT NULL")
    return bad.groupBy("s_suppkey", "reject_reason").agg(F.count("*").cast("int").alias("n"))


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'line' WHEN 1 THEN 'sample' END AS reject_reason,
  CASE WHEN s_suppkey % 3 = 2 THEN s_suppkey + 0.5 END AS value FROM supplier""")
def export_rejects(spark, sf_dir):
    """Export lines with fractional times and values, without a time, and unreadable ones."""
    key = F.col("s_suppkey")
    line = F.when(key % 3 == 0, F.concat(F.lit("no json "), key)).otherwise(F.concat(
        F.lit('{"metric":{"a":"b"},"values":['), F.when(key % 3 == 2, F.concat(key, F.lit(".5"))).otherwise("null"),
        F.lit('],"timestamps":['), F.when(key % 3 == 2, "1700000000123.5").otherwise("null"), F.lit("]}")))
    return ts.mark_export(load(spark, sf_dir, "supplier").select("s_suppkey", line.alias("j")), "j", ["a"]).select(
        "s_suppkey", "reject_reason", "value")


@query(_EXPORT_SQL)
def explode_parallel_arrays(spark, sf_dir):
    return _export(spark, sf_dir)


@query(f"WITH e AS ({_EXPORT_SQL}) SELECT * FROM e WHERE dataset_type = 'SMALL' AND contains(dataset, 'blue')")
def series_filter(spark, sf_dir):
    return ts.filter_series(_export(spark, sf_dir), "SMALL", "blue")


@query("""SELECT s_name AS name, 'elasticsearch' AS type, s_suppkey AS id, concat('[db_', s_nationkey, '*]') AS database FROM supplier
UNION ALL SELECT concat(s_name, '_copy'), 'influxdb', s_suppkey + 1, NULL FROM supplier""")
def map_to_rows(spark, sf_dir):
    text = F.concat(
        F.lit('{"'), "s_name", F.lit('":{"type":"elasticsearch","id":'), "s_suppkey", F.lit(',"database":"[db_'),
        "s_nationkey", F.lit('*]"},"'), "s_name", F.lit('_copy":{"type":"influxdb","id":'), F.col("s_suppkey") + 1,
        F.lit("}}"),
    )
    objects = load(spark, sf_dir, "supplier").select(text.alias("text"))
    return ts.map_rows(objects, "text", "type: STRING, id: BIGINT, database: STRING")


# ---- histograms -----------------------------------------------------------------------------

_BUCKETS_SQL = """WITH spine AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-31 12:00:00', TIMESTAMP '2024-02-09 23:59:59',
    INTERVAL {minutes} MINUTE)) AS bucket_start),
hits AS (SELECT time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '2023-12-31 12:00:00') AS bucket_start, * FROM events {where})
SELECT bucket_start, {columns} FROM spine LEFT JOIN hits USING (bucket_start) GROUP BY bucket_start"""


@query(_BUCKETS_SQL.format(minutes=5, where="", columns="count(event_id) AS n, count(DISTINCT user_id) AS distinct_user_id"))
def status_histogram(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return ts.bucket_counts(events, "ts", "2023-12-31 12:00:00", "2024-02-10", 300, "user_id", exact=True)


@query(_BUCKETS_SQL.format(minutes=5, where="", columns="count(event_id) AS n, true AS near"))
def status_histogram_approx(spark, sf_dir):
    """The approximate distinct figure, held against the exact one: at most three times its error of 5 % away."""
    events = load(spark, sf_dir, "events")
    exact, approx = (
        ts.bucket_counts(events, "ts", "2023-12-31 12:00:00", "2024-02-10", 300, "user_id", exact=e) for e in (True, False))
    both = approx.withColumnRenamed("distinct_user_id", "estimate").join(exact.drop("n"), "bucket_start")
    near = F.abs(F.col("estimate") - F.col("distinct_user_id")) <= F.greatest(F.lit(1), 0.15 * F.col("distinct_user_id"))
    return both.select("bucket_start", "n", near.alias("near"))


_ROLLED_SQL = """SELECT '{unit}' AS unit, date_trunc('{unit}', ts) AS bucket_start, {by} AS kind, count(*) AS n, true AS near
FROM events GROUP BY ALL"""


@query(" UNION ALL ".join([_ROLLED_SQL.format(unit="hour", by="event_type"), _ROLLED_SQL.format(unit="day", by="event_type"),
                           _ROLLED_SQL.format(unit="day", by="NULL")]))
def status_sketch_rollup(spark, sf_dir):
    """Distinct users per hour and day from stored sketches of five minutes, held against the exact numbers: at most three
    times the error of a sketch away."""
    path, events = new_path(spark, "sketches"), load(spark, sf_dir, "events").withColumnRenamed("event_type", "kind")
    rollups.write_sketches(rollups.interval_sketches(events, "ts", "user_id", ["kind"]), path)
    stored, parts = rollups.read_sketches(spark, path), []
    for unit, seconds, by in (("hour", 3600, ["kind"]), ("day", 86400, ["kind"]), ("day", 86400, [])):
        rolled = rollups.estimates(rollups.roll_up(stored, seconds, by))
        exact = events.groupBy(rollups.interval_start(F.col("ts"), seconds).alias("bucket_start"), *by).agg(
            F.count_distinct("user_id").alias("exact"))
        both = rolled.join(exact, ["bucket_start", *by])
        near = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1), 3 * rollups.RELATIVE_ERROR * F.col("exact"))
        kind = F.col("kind") if by else F.lit(None).cast("string")
        parts.append(both.select(F.lit(unit).alias("unit"), "bucket_start", kind.alias("kind"), "n", near.alias("near")))
    return reduce(DataFrame.unionByName, parts)


@query(_BUCKETS_SQL.format(minutes=12, where="WHERE event_type = 'error'", columns="nullif(count(event_id), 0) AS n"))
def status_histogram_null(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    errors = events.where(F.col("event_type") == "error")
    return ts.bucket_counts(errors, "ts", "2023-12-31 12:00:00", "2024-02-10", 720, fill=None)


@query("""SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10 11:45:00' AND ts < TIMESTAMP '2024-01-10 12:00:00'""")
def freshness_count(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return ts.fresh_count(events, "ts", "2024-01-10 12:00:00")


# ---- times ----------------------------------------------------------------------------------


@query("""SELECT o_orderkey, concat(o_orderkey // 3600, 'h ', (o_orderkey % 3600) // 60, 'm ', o_orderkey % 60, 's') AS text FROM orders""")
def secs_to_human(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", seconds_text(F.col("o_orderkey")).alias("text"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 WHEN o_orderstatus = 'F'
  THEN CAST(epoch(o_orderdate) AS BIGINT) ELSE 1700000000 + o_orderkey END AS epoch FROM orders""")
def flex_epoch(spark, sf_dir):
    given = (
        F.when(F.col("o_orderstatus") == "P", F.lit(0).cast("long"))
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyyMMdd").cast("long"))
        .otherwise(F.col("o_orderkey") + 1700000000)
    )
    return load(spark, sf_dir, "orders").select("o_orderkey", flexible_epoch(given).alias("epoch"))


@query("""WITH p AS (SELECT o_custkey, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders GROUP BY o_custkey),
c AS (SELECT o_custkey, last, unnest(generate_series(first, last, INTERVAL 30 DAY)) AS chunk_start FROM p)
SELECT o_custkey, chunk_start, least(chunk_start + INTERVAL 30 DAY, last) AS chunk_end FROM c WHERE chunk_start < last""")
def period_chunks(spark, sf_dir):
    periods = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    return periods.select("o_custkey", F.inline(chunks_of(F.col("first"), F.col("last"))))


# ---- sizes, quotas, storage -----------------------------------------------------------------


@query("""SELECT p_partkey, CASE WHEN p_size = 50 THEN NULL ELSE p_size * power(1024, p_size % 6) END AS bytes FROM part""")
def human_size(spark, sf_dir):
    unit = F.get(F.array(*[F.lit(u) for u in ("", " K", " M", "G", " t", " P")]), F.col("p_size") % 6)
    text = F.when(F.col("p_size") == 50, "5 X").otherwise(F.concat("p_size", unit))
    return load(spark, sf_dir, "part").select("p_partkey", bytes_from_text(text).alias("bytes"))


_ELEMENTS_SQL = """elements AS (SELECT p_partkey, concat('T_', p_partkey) AS rse, CASE WHEN p_size > 10 THEN 'DISK' ELSE 'TAPE' END AS rse_type,
  CASE p_type WHEN 'SMALL' THEN 'test' ELSE 'real' END AS cms_type, p_size % 4 AS tier FROM part)"""


@query(f"""WITH {_ELEMENTS_SQL}, figures AS (SELECT l_partkey, max(l_extendedprice) FILTER (l_linestatus = 'F') * 1e9 AS static,
  max(l_extendedprice) FILTER (l_linestatus = 'O' AND l_returnflag = 'A') * 1e9 AS used FROM lineitem
  GROUP BY l_partkey)
SELECT rse, round_even(used * 1e-12, 1) AS used_tb, round_even(static * 1e-12, 1) AS total_tb,
  round_even(100.0 * (used * 1e-12) / (static * 1e-12), 1) AS used_percent, round_even(static * 1e-12 - used * 1e-12, 1) AS free_tb
FROM elements JOIN figures ON p_partkey = l_partkey
WHERE rse_type = 'DISK' AND cms_type = 'real' AND tier > 0 AND tier < 3 AND rse NOT IN ('T_1', 'T_2')
  AND static IS NOT NULL AND used IS NOT NULL""")
def storage_quota(spark, sf_dir):
    elements = load(spark, sf_dir, "part").selectExpr(
        "concat('T_', p_partkey) AS rse", "CASE WHEN p_size > 10 THEN 'DISK' ELSE 'TAPE' END AS rse_type",
        "CASE p_type WHEN 'SMALL' THEN 'test' ELSE 'real' END AS cms_type", "p_size % 4 AS tier",
    )
    usage = load(spark, sf_dir, "lineitem").selectExpr(
        "concat('T_', l_partkey) AS rse",
        "CASE WHEN l_linestatus = 'F' THEN 'static' WHEN l_returnflag = 'A' THEN 'rucio' ELSE 'other' END AS source",
        "l_extendedprice * 1e9 AS used",
    )
    return rep.storage_quota(elements, usage, ["T_1", "T_2"])


@query("""WITH p AS (SELECT s_name AS quota_node, CAST(round(s_acctbal * 100) AS BIGINT) + 2000000 AS q, s_suppkey * 10 AS r, s_nationkey * 60 AS e FROM supplier),
rows AS (SELECT quota_node, q AS max_logical_quota, r + e AS total_used_logical_bytes, r AS logical_rep_bytes, e AS logical_ec_bytes,
  r * 2 + e * 1.2::DOUBLE AS total_used_physical_bytes, r * 2 AS physical_rep_bytes, e * 1.2::DOUBLE AS physical_ec_bytes,
  q * 2 - (r * 2 + e * 1.2::DOUBLE) AS free_physical, round((q * 2 - (r * 2 + e * 1.2::DOUBLE)) / 1.2::DOUBLE, 3) AS free_physical_for_ec,
  (q * 2 - (r * 2 + e * 1.2::DOUBLE)) / 2 AS free_physical_for_rep, q - r - e AS free_logical FROM p)
SELECT * FROM rows UNION ALL SELECT 'TOTAL', CAST(sum(max_logical_quota) AS BIGINT), CAST(sum(total_used_logical_bytes) AS BIGINT),
  CAST(sum(logical_rep_bytes) AS BIGINT), CAST(sum(logical_ec_bytes) AS BIGINT), sum(total_used_physical_bytes),
  CAST(sum(physical_rep_bytes) AS BIGINT), sum(physical_ec_bytes), sum(free_physical),
  round(sum(free_physical) / 1.2::DOUBLE, 3), sum(free_physical_for_rep), CAST(sum(free_logical) AS BIGINT) FROM rows""")
def eos_quota_report(spark, sf_dir):
    paths = load(spark, sf_dir, "supplier").selectExpr(
        "s_name AS quota_node", "CAST(round(s_acctbal * 100) AS BIGINT) + 2000000 AS max_logical_quota",
        "s_suppkey * 10 AS logical_rep_bytes", "CAST(s_nationkey AS BIGINT) * 60 AS logical_ec_bytes",
    )
    return rep.replicated_quota(paths).withColumn("free_physical_for_ec", F.round("free_physical_for_ec", 3))


_FAMILY = "grid_prod_"
_INDICES_SQL = "SELECT concat('grid_prod_', source, '_raw_metric_', lang, '-', doc_id) AS name, n_chars AS size FROM documents"


def _indices(spark, sf_dir):
    name = F.concat(F.lit(_FAMILY), "source", F.lit("_raw_metric_"), "lang", F.lit("-"), "doc_id")
    return load(spark, sf_dir, "documents").select(name.alias("name"), F.col("n_chars").alias("size_in_bytes"))


def _patterns(spark, sf_dir):
    database = F.concat(F.lit("["), F.lit(_FAMILY), "source", F.lit("*][other_"), "source", F.lit("_*] "))
    return load(spark, sf_dir, "documents").select(database.alias("database")).distinct()


_USAGE_SQL = f"""SELECT name, size, 'elasticsearch' AS type, '' AS location,
  string_split(replace(name, 'grid_prod_', ''), '_raw_')[1] AS "group"
FROM ({_INDICES_SQL}) JOIN (SELECT DISTINCT concat('grid_prod_', source) AS prefix FROM documents) ON starts_with(name, prefix)"""


@query(_USAGE_SQL)
def index_usage(spark, sf_dir):
    return rep.index_usage(_indices(spark, sf_dir), _patterns(spark, sf_dir), _FAMILY)


@query(f"""WITH usage AS ({_USAGE_SQL})
SELECT type, "group", CAST(sum(size) AS BIGINT) AS size, count(*) AS n FROM (
  SELECT type, "group", size FROM usage
  UNION ALL SELECT 'hdfs', '', CAST(p_size * power(1024, p_size % 5) AS BIGINT) FROM part) GROUP BY ALL""")
def storage_usage(spark, sf_dir):
    unit = F.get(F.array(*[F.lit(u) for u in ("", " K", " M", " G", " T")]), F.col("p_size") % 5)
    paths = load(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"), F.concat(F.lit("/store/"), "p_partkey").alias("path"),
        F.concat("p_size", unit).alias("size_text"),
    )
    indices = rep.index_usage(_indices(spark, sf_dir), _patterns(spark, sf_dir), _FAMILY)
    return rep.usage_totals(indices, rep.path_usage(paths, bytes_from_text(F.col("size_text"))))


# ---- accounting -----------------------------------------------------------------------------

_BLOCKS_SQL = """SELECT c_name AS "openstackProjectName", c_custkey AS cores,
  CASE WHEN c_nationkey > 12 THEN CAST(c_nationkey AS BIGINT) END AS ips,
  CASE WHEN c_mktsegment = 'BUILDING' THEN concat('u', c_custkey, ', v@example.org') ELSE '' END AS contacts FROM customer"""


def _projects(spark, sf_dir):
    """Block text written from the customers, read back as records."""
    customer = load(spark, sf_dir, "customer")
    block = F.concat(
        F.lit("openstackProjectName "), "c_name", F.lit("\nmaxTotalCores "), "c_custkey", F.lit("\nstate unknown\nlonely\n"),
        F.when(F.col("c_nationkey") > 12, F.concat(F.lit("totalFloatingIpsUsed "), "c_nationkey", F.lit("\n"))).otherwise(""),
        F.when(F.col("c_mktsegment") == "BUILDING",
               F.concat(F.lit("u"), "c_custkey", F.lit("@Default\nowner v@example.org\n"))).otherwise(""),
    )
    path = new_path(spark, "blocks")
    customer.select(block.alias("value")).write.option("lineSep", "======\n").text(path)
    return files.block_records(files.read_blocks(spark, path), "openstackProjectName")


@query(_BLOCKS_SQL)
def block_text_records(spark, sf_dir):
    counters = F.col("counters")
    return _projects(spark, sf_dir).select(
        "openstackProjectName", counters["maxTotalCores"].alias("cores"), counters["totalFloatingIpsUsed"].alias("ips"),
        "contacts",
    )


@query(f"""WITH b AS (SELECT "openstackProjectName" AS "Openstack Project Name", cores AS "Max Total Cores",
  coalesce(ips, 0) AS "Total Floating Ips Used", CAST(0 AS BIGINT) AS "Max Personality", contacts AS "Contacts" FROM ({_BLOCKS_SQL}))
SELECT * FROM b UNION ALL SELECT 'TOTAL', CAST(sum("Max Total Cores") AS BIGINT), CAST(sum("Total Floating Ips Used") AS BIGINT), 0, '' FROM b""")
def accounting_totals(spark, sf_dir):
    counters = F.col("counters")
    projects = _projects(spark, sf_dir).select(
        "openstackProjectName", counters["maxTotalCores"].alias("maxTotalCores"),
        counters["totalFloatingIpsUsed"].alias("totalFloatingIpsUsed"), "contacts",
    )
    shown = {
        "openstackProjectName": "Openstack Project Name", "maxTotalCores": "Max Total Cores",
        "totalFloatingIpsUsed": "Total Floating Ips Used", "maxPersonality": "Max Personality", "contacts": "Contacts",
    }
    table = rep.renamed_counters(projects, shown, ["maxTotalCores", "contacts"], "openstackProjectName")
    sums = ["Max Total Cores", "Total Floating Ips Used", "Max Personality"]
    return rep.with_total(table, "Openstack Project Name", sums)


# ---- campaigns ------------------------------------------------------------------------------

_CAMPAIGN_SQL = """WITH jobs AS (SELECT concat('Campaign', l_linenumber) AS "Campaign",
    concat('/chain/REQ', l_suppkey % 10, '_', l_partkey, '/step') AS "WMAgent_SubTaskName", floor(l_extendedprice) AS hs06
  FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'F' AND l_linenumber IN (2, 3, 5)
    AND l_shipdate > TIMESTAMP '1997-01-01' AND l_shipdate <= TIMESTAMP '1999-01-01'),
sums AS (SELECT "Campaign", "WMAgent_SubTaskName", sum(hs06) AS "HS06CoreHr" FROM jobs GROUP BY ALL)"""


def _campaign_jobs(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").where(
        "l_shipdate >= TIMESTAMP_NTZ '1997-01-01' AND l_shipdate <= TIMESTAMP_NTZ '1999-01-01'")
    jobs = lines.select(
        F.expr("CASE l_returnflag WHEN 'N' THEN 'production' ELSE 'analysis' END").alias("Type"),
        F.expr("CASE l_linestatus WHEN 'F' THEN 'Completed' ELSE 'Running' END").alias("Status"),
        F.concat(F.lit("Campaign"), "l_linenumber").alias("Campaign"),
        F.concat(F.lit("/chain/REQ"), F.col("l_suppkey") % 10, F.lit("_"), "l_partkey", F.lit("/step"))
        .alias("WMAgent_SubTaskName"),
        F.floor("l_extendedprice").cast("double").alias("HS06CoreHr"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("RecordTime"),
    )
    wanted = ["Campaign2", "Campaign3", "Campaign5"]
    return rep.campaign_jobs(jobs, wanted, epoch_millis("1997-01-01"), epoch_millis("1999-01-01"))


@query(f'{_CAMPAIGN_SQL} SELECT * FROM sums ORDER BY "Campaign", "WMAgent_SubTaskName"')
def campaign_hs06(spark, sf_dir):
    return rep.campaign_sums(_campaign_jobs(spark, sf_dir)).orderBy("Campaign", "WMAgent_SubTaskName")


@query(f"""{_CAMPAIGN_SQL} SELECT string_split(string_split("WMAgent_SubTaskName", '/')[3], '_')[1] AS prefix,
  sum("HS06CoreHr") AS total, count(*) AS subtasks FROM sums GROUP BY prefix""")
def prepid_totals(spark, sf_dir):
    return rep.prefix_totals(rep.campaign_sums(_campaign_jobs(spark, sf_dir)))


@query(f'{_CAMPAIGN_SQL} SELECT DISTINCT "WMAgent_SubTaskName" FROM jobs')
def distinct_subtasks(spark, sf_dir):
    return _campaign_jobs(spark, sf_dir).select("WMAgent_SubTaskName").distinct()
