"""Log lines made from events and page addresses, and parsed again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetstats.operators import logs
from fleetstats.plans.registry import load, query
from fleetstats.sources import files
from fleetstats.storage import new_path

_K = "json_extract_string(props, '$.k')"


def access_line(request, garbage_type):
    """A front-end access line per event; events of one type give a line of another kind.

    Some lines have a bracket ahead of their time, some a bracket in the authorisation, some quotes in the client.
    """
    k = F.get_json_object("props", "$.k")
    line = F.concat(
        F.when(k.cast("int") % 3 == 0, "web1 httpd[17]: ").otherwise(""), F.lit("["), F.date_format(F.col("ts").cast("timestamp"), "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0200] fe"), "user_id",
        F.lit(".example.org 192.0.2."), F.col("user_id") % 250, F.lit(' "GET '), request, F.lit(' HTTP/1.1" '), k,
        F.lit(" [data: "), F.col("event_id"), F.lit(" in 20480 out 1024 body "), F.col("user_id") * 7,
        F.lit(' us ] [auth: TLSv1.2 ECDHE-RSA "/DC=ch/CN=u'), "user_id", F.lit('/CN=123456/CN=Jane Doe" "-'),
        F.when(F.col("user_id") % 4 == 0, "[x] [y").otherwise(""), F.lit('" ] [ref: "-" "curl/'), k,
        F.when(k.cast("int") % 5 == 0, ' "beta" x').otherwise(""), F.lit('" ]'), F.when(F.col("user_id") > 50, F.concat(F.lit(" "), F.col("user_id") + 8000)).otherwise(""),
    )
    return F.when(F.col("event_type") == garbage_type, F.concat(F.lit("started "), k)).otherwise(line)


def _requests():
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    return (
        F.when(kind == "click", F.concat(F.lit("/dbs/prod/global/DBSReader/datasets?dataset=/A/"), k))
        .when(kind == "view", F.concat(F.lit("/reqmgr2/data/"), k, F.lit("/")))
        .when(kind == "purchase", F.concat(F.lit("/couchdb/one/"), k, F.lit("/list/?x="), k))
        .otherwise("/single")
    )


def _lines(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", access_line(_requests(), F.lit("error")).alias("value"))


_ACCESS_SQL = f"""WITH e AS (SELECT *, {_K} AS k FROM events WHERE event_type IN ('click', 'view', 'purchase'))
SELECT event_id, strftime(ts, '%d/%b/%Y:%H:%M:%S +0200') AS tstamp, 'fe' || user_id || '.example.org' AS frontend,
  '192.0.2.' || user_id % 250 AS clientip, 'GET' AS method,
  CASE event_type WHEN 'click' THEN '/dbs/prod/global/DBSReader/datasets?dataset=/A/' || k
    WHEN 'view' THEN '/reqmgr2/data/' || k || '/' ELSE '/couchdb/one/' || k || '/list/?x=' || k END AS request,
  'HTTP/1.1' AS httpversion, CAST(k AS BIGINT) AS code, event_id AS bytes_sent, CAST(20480 AS BIGINT) AS bytes_received, CAST(1024 AS BIGINT) AS body_size,
  user_id * 7 AS time_spent_us, 'TLSv1.2' AS tls, 'ECDHE-RSA' AS crypto, '/DC=ch/CN=u' || user_id || '/CN=Jane Doe' AS dn,
  'curl/' || k || CASE WHEN CAST(k AS INT) % 5 = 0 THEN ' "beta" x' ELSE '' END AS client, CASE WHEN user_id > 50 THEN CAST(user_id + 8000 AS VARCHAR) END AS fe_port,
  CASE event_type WHEN 'click' THEN 'dbs' WHEN 'view' THEN 'reqmgr2' ELSE 'couchdb' END AS system,
  CASE event_type WHEN 'click' THEN '/prod/global/DBSReader/datasets' WHEN 'view' THEN '/data/' || k || '/'
    ELSE '/one/' || k || '/list/' END AS uri_path,
  CASE event_type WHEN 'click' THEN '?dataset=/A/' || k WHEN 'purchase' THEN '?x=' || k END AS uri_params,
  CASE event_type WHEN 'click' THEN 'datasets' WHEN 'view' THEN k ELSE 'list' END AS api,
  CAST(floor(epoch(ts)) AS BIGINT) - 7200 AS rec_timestamp, (CAST(floor(epoch(ts)) AS BIGINT) - 7200) * 1000 AS timestamp,
  make_timestamp((CAST(floor(epoch(ts)) AS BIGINT) - 7200) * 1000000) AS rec_date,
  concat(CASE WHEN CAST(k AS INT) % 3 = 0 THEN 'web1 httpd[17]: ' ELSE '' END, '[', tstamp, '] ', frontend, ' ', clientip, ' GET ', request, ' HTTP/1.1 ', k, ' [data: ', event_id,
    ' in 20480 out 1024 body ', user_id * 7, ' us ] [auth: TLSv1.2 ECDHE-RSA /DC=ch/CN=u', user_id,
    '/CN=123456/CN=Jane Doe -', CASE WHEN user_id % 4 = 0 THEN '[x] [y' ELSE '' END, ' ] [ref: - curl/', k,
    CASE WHEN CAST(k AS INT) % 5 = 0 THEN ' beta x' ELSE '' END, ' ]', coalesce(' ' || fe_port, '')) AS message,
  'frontend' AS type FROM e"""


@query(_ACCESS_SQL)
def parse_access_log(spark, sf_dir):
    records, _ = logs.parse_access_log(_lines(spark, sf_dir))
    return records


@query("""SELECT event_id, event_type = 'error' AS unreadable FROM events WHERE event_type IN ('error', 'signup')""")
def access_log_rejects(spark, sf_dir):
    _, rejects = logs.parse_access_log(_lines(spark, sf_dir))
    return rejects.select("event_id", F.col("value").startswith("started").alias("unreadable"))


@query(r"""WITH r AS (SELECT page_id, regexp_replace(url, '^https?://[^/]+', '') AS request FROM pages),
p AS (SELECT *, regexp_extract(request, '^/([\w\-]+)(/[^?#]*)', 1) AS sys, regexp_extract(request, '^/([\w\-]+)(/[^?#]*)', 2) AS path,
  CASE WHEN contains(request, '?') THEN '?' || split_part(request, '?', 2) END AS params FROM r),
s AS (SELECT *, CASE WHEN params IS NULL THEN request ELSE path END AS source FROM p),
a AS (SELECT *, string_split(source, '/') AS parts FROM s),
f AS (SELECT *, CASE WHEN len(parts) < 3 THEN NULL WHEN parts[-1] <> '' THEN parts[-1]
  WHEN len(parts) > 3 THEN parts[-2] END AS found FROM a)
SELECT page_id, request, coalesce(CASE WHEN found IS NULL THEN NULL ELSE sys END, request) AS system, path AS uri_path,
  params AS uri_params, coalesce(found, request) AS api, found IS NOT NULL AS api_found FROM f""")
def parse_request(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    requests = pages.select("page_id", F.regexp_replace("url", r"^https?://[^/]+", "").alias("request"))
    return logs.parse_request(requests)


def _backend_lines(spark, sf_dir):
    k, when = F.get_json_object("props", "$.k"), F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    service = F.concat(
        F.when(k.cast("int") % 3 == 0, "be[9]: ").otherwise(""), F.lit("INFO ["), F.date_format(when, "dd/MMM/yyyy:HH:mm:ss"), F.lit("] be"), "user_id", F.lit(' 10.0.0.1 "PUT '),
        F.when(kind == "click", F.concat(F.lit("/dbs/int/global/DBSWriter/files?x="), k))
        .when(kind == "view", F.concat(F.lit("/reqmgr2/data/"), k)).otherwise("/dbs/nothing"),
        F.lit(' HTTP/1.1" '), k, F.lit(' OK [data: 1 in 2 out] [auth: OK "/CN=a/CN=77/CN=b" "" ] [ref: "" "py "3"" ]'),
    )
    database = F.concat(
        F.when(k.cast("int") % 3 == 0, "couch[4]: ").otherwise(""), F.lit("["), F.date_format(when, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT] [info] [<0.1.2>] 10.1.1.1 - - GET /db/one/"),
        k, F.lit("/docs "), k,
    )
    tag = F.when(kind.isin("click", "purchase"), "dbs").when(kind == "view", "reqmgr2").when(kind == "error", "couchdb")
    line = F.when(kind == "error", database).when(kind == "signup", "any text").otherwise(service)
    return load(spark, sf_dir, "events").select(
        "event_id", F.coalesce(tag, F.lit("das")).alias("tag"), line.alias("value")
    )


@query(f"""WITH e AS (SELECT *, {_K} AS k FROM events WHERE event_type <> 'purchase')
SELECT event_id, CASE event_type WHEN 'click' THEN 'dbs' WHEN 'view' THEN 'reqmgr2' WHEN 'error' THEN 'couchdb' ELSE 'das' END AS type,
  CASE WHEN event_type IN ('click', 'view') THEN 'be' || user_id END AS backend,
  CASE event_type WHEN 'error' THEN '10.1.1.1' WHEN 'signup' THEN NULL ELSE '10.0.0.1' END AS clientip,
  CASE event_type WHEN 'error' THEN 'GET' WHEN 'signup' THEN NULL ELSE 'PUT' END AS method,
  CASE event_type WHEN 'click' THEN '/dbs/int/global/DBSWriter/files?x=' || k WHEN 'view' THEN '/reqmgr2/data/' || k
    WHEN 'error' THEN '/db/one/' || k || '/docs' END AS request,
  CASE WHEN event_type <> 'signup' THEN CAST(k AS BIGINT) END AS code,
  CASE WHEN event_type IN ('click', 'view') THEN '/CN=a/CN=b' END AS dn,
  CASE event_type WHEN 'click' THEN 'files' WHEN 'error' THEN 'docs' END AS api,
  CASE event_type WHEN 'click' THEN 'DBSWriter' END AS instance_kind, CASE event_type WHEN 'error' THEN 'db' END AS system,
  CASE WHEN event_type <> 'signup' THEN CAST(floor(epoch(ts)) AS BIGINT) END AS rec_timestamp FROM e""")
def parse_backend_log(spark, sf_dir):
    records, _ = logs.parse_backend_log(_backend_lines(spark, sf_dir))
    return records.select(
        "event_id", "type", "backend", "clientip", "method", "request", "code", "dn",
        "api", "instance_kind", "system", "rec_timestamp",
    )


def _long_lines(spark, sf_dir):
    """Backend lines, those of one kind grown to many openings of their fields or holding control characters."""
    lines = _backend_lines(spark, sf_dir)
    grown = F.when(F.col("tag") == "dbs", F.concat("value", F.repeat(F.lit(' [a "GET '), 400)))
    marked = F.when(F.col("tag") == "reqmgr2", F.concat(F.lit("\u0001"), "value", F.lit("\u0001")))
    return lines.withColumn("value", F.coalesce(grown, marked, F.col("value")))


@query("""SELECT event_id, 'dbs' AS tag, CAST(9 * 400 AS BIGINT) AS grown FROM events WHERE event_type = 'purchase'""")
def backend_log_rejects(spark, sf_dir):
    """Lines that fit no layout; long ends and control characters of the others do no harm."""
    lines = _long_lines(spark, sf_dir)
    _, rejects = logs.parse_backend_log(lines)
    end = F.length(F.regexp_extract("value", r'((?: \[a "GET )*)$', 1)).cast("long")
    return rejects.select("event_id", "tag", end.alias("grown"))


@query("""SELECT event_type AS tag, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY event_type""")
def tagged_log_files(spark, sf_dir):
    """Log files of several services, each read with its tag."""
    path, events = new_path(spark, "logs"), load(spark, sf_dir, "events")
    kinds = ["click", "error", "purchase", "signup", "view"]
    for kind in kinds:
        lines = events.where(F.col("event_type") == kind).select(F.concat(F.lit("id "), "event_id").alias("value"))
        lines.write.text(f"{path}/{kind}")
    read = reduce(DataFrame.unionByName, [files.tagged_lines(spark, f"{path}/{kind}", kind) for kind in kinds])
    return read.groupBy("tag").agg(F.count("*").alias("n"), F.count_distinct("value").alias("ids"))
