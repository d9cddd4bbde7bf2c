"""Alerts and annotations made from events."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetstats.functions.times import UTC, calendar_difference, time_range
from fleetstats.operators import alerts as al
from fleetstats.plans.registry import load, query

NOW = "2024-01-15 12:00:00"
_K = "CAST(json_extract_string(props, '$.k') AS INT)"
_SEVERITY_SQL = """CASE k % 7 WHEN 0 THEN 'info' WHEN 1 THEN 'warning' WHEN 2 THEN 'medium' WHEN 3 THEN 'high'
  WHEN 4 THEN 'critical' WHEN 5 THEN 'urgent' ELSE 'odd' END"""

# Starts and ends are whole seconds; one in ten ends is open.
ALERTS_SQL = f"""WITH e AS (SELECT *, {_K} AS k FROM events), alerts AS (
  SELECT event_id, 'alert_' || user_id AS name, event_type AS service, {_SEVERITY_SQL} AS severity,
    CASE WHEN k > 50 THEN 'tag_' || k % 3 ELSE '' END AS tag, date_trunc('second', ts) AS "startsAt",
    CASE WHEN k % 10 = 0 THEN make_timestamp(32516091806000000)
      ELSE date_trunc('second', ts) + to_hours(CAST(floor(value * 24) AS INT)) + to_seconds(k * 61) END AS "endsAt"
  FROM e)"""


def rows(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("int")
    severity = F.get(F.array(*[F.lit(s) for s in (*al.SEVERITIES, "odd")]), k % 7)
    start = F.date_trunc("second", F.col("ts").cast("timestamp"))
    end = F.timestamp_seconds(F.unix_seconds(start) + F.floor(F.col("value") * 24) * 3600 + k * 61)
    labels = F.map_filter(F.create_map(
        F.lit("alertname"), F.concat(F.lit("alert_"), "user_id"), F.lit("service"), F.col("event_type"),
        F.lit("severity"), severity, F.lit("host"), F.concat(F.lit("h"), k),
        F.lit("tag"), F.when(k > 50, F.concat(F.lit("tag_"), k % 3)),
    ), lambda _, v: v.isNotNull())
    annotations = F.create_map(F.lit("summary"), F.concat(F.lit("event "), "event_id"), F.lit("href"), F.col("event_type"))
    return al.alert_rows(load(spark, sf_dir, "events").select(
        "event_id", labels.alias("labels"), annotations.alias("annotations"), start.alias("startsAt"),
        F.when(k % 10 == 0, F.timestamp_seconds(F.lit(al.OPEN_END_SECONDS))).otherwise(end).alias("endsAt"),
    ))


@query(f"""{ALERTS_SQL} SELECT event_id, name, service, severity, tag FROM alerts
WHERE name IN (SELECT name FROM alerts WHERE service = 'error' AND severity = 'urgent' AND tag = 'tag_1')""")
def alert_filter(spark, sf_dir):
    kept = al.filter_alerts(rows(spark, sf_dir), service="error", severity="urgent", tag="tag_1")
    return kept.select("event_id", "name", "service", "severity", "tag")


@query(f"""{ALERTS_SQL} SELECT event_id, name, severity FROM alerts
ORDER BY list_position(['info', 'warning', 'medium', 'high', 'critical', 'urgent'], severity), event_id""")
def alert_sort(spark, sf_dir):
    return al.sort_alerts(rows(spark, sf_dir), "severity", "event_id").select("event_id", "name", "severity")


# Calendar differences written with the engine's own month arithmetic: whole months are those
# after which the earlier time, its day unchanged, is not past the later one.
_PARTS_SQL = """
  CAST(date_part('second', b) - date_part('second', a) AS INT) AS s0,
  date_part('minute', b) - date_part('minute', a) AS m0, date_part('hour', b) - date_part('hour', a) AS h0,
  date_part('day', b) - date_part('day', a) AS d0,
  (date_part('year', b) - date_part('year', a)) * 12 + date_part('month', b) - date_part('month', a) AS mon0,
  day(last_day(a)) AS dim, CAST(b AS TIME) < CAST(a AS TIME) AS clock_back"""


def _difference_sql(source: str) -> str:
    return f"""parts AS (SELECT *, {_PARTS_SQL} FROM ({source})),
clock AS (SELECT *, (epoch(CAST(b AS TIME)) - epoch(CAST(a AS TIME)) + CASE WHEN clock_back THEN 86400 ELSE 0 END)::BIGINT AS secs,
  d0 - CASE WHEN clock_back THEN 1 ELSE 0 END AS d1 FROM parts),
diff AS (SELECT *, secs // 3600 AS h, secs % 3600 // 60 AS mi, secs % 60 AS s, CASE WHEN d1 < 0 THEN d1 + dim ELSE d1 END AS d,
  mon0 - CASE WHEN d1 < 0 THEN 1 ELSE 0 END AS months FROM clock),
texts AS (SELECT *, concat_ws(' ', CASE WHEN months // 12 > 0 THEN (months // 12) || 'Y' END, CASE WHEN months % 12 > 0 THEN (months % 12) || 'M' END,
  CASE WHEN d > 0 THEN d || 'D' END, CASE WHEN h > 0 THEN h || 'h' END, CASE WHEN mi > 0 THEN mi || 'm' END,
  CASE WHEN s > 0 THEN s || 's' END) AS txt FROM diff)"""


@query(f"""{ALERTS_SQL}, {_difference_sql(
    'SELECT *, "startsAt" AS a, "endsAt" AS b FROM alerts')} SELECT event_id,
  CASE WHEN epoch("endsAt") = 32516091806 THEN 'Undefined' ELSE txt END AS duration FROM texts""")
def alert_duration(spark, sf_dir):
    table = rows(spark, sf_dir)
    texts = al.time_texts(F.col("startsAt"), F.col("endsAt"), F.lit(NOW).cast("timestamp"))
    return table.select("event_id", texts["duration"].alias("duration"))


def _span_sql(kind: str, a: str, b: str) -> str:
    return f"SELECT event_id, '{kind}' AS kind, least({a}, {b}) AS a, greatest({a}, {b}) AS b FROM alerts"


def _relative_sql(time: str, text: str) -> str:
    return f"trim(CASE WHEN {time} < TIMESTAMP '{NOW}' THEN {text} || ' AGO' ELSE 'IN ' || {text} END)"


_SPANS_SQL = " UNION ALL ".join([
    _span_sql("starts", '"startsAt"', f"TIMESTAMP '{NOW}'"), _span_sql("ends", '"endsAt"', f"TIMESTAMP '{NOW}'"),
    _span_sql("duration", '"startsAt"', '"endsAt"'),
])


@query(f"""{ALERTS_SQL}, {_difference_sql(_SPANS_SQL)}, t AS (
  SELECT event_id, max(txt) FILTER (kind = 'starts') AS s, max(txt) FILTER (kind = 'ends') AS e,
    max(txt) FILTER (kind = 'duration') AS d FROM texts GROUP BY event_id)
SELECT name, service, tag, severity, {_relative_sql('"startsAt"', 's')} AS starts,
  CASE WHEN epoch("endsAt") = 32516091806 THEN 'Undefined' ELSE {_relative_sql('"endsAt"', 'e')} END AS ends,
  CASE WHEN epoch("endsAt") = 32516091806 THEN 'Undefined' ELSE d END AS duration
FROM alerts JOIN t USING (event_id)""")
def alert_table(spark, sf_dir):
    return al.alert_table(rows(spark, sf_dir), F.lit(NOW).cast("timestamp"))


@query(f"""{ALERTS_SQL} SELECT name, event_id, "startsAt" FROM alerts
QUALIFY row_number() OVER (PARTITION BY name ORDER BY "startsAt" DESC, "endsAt" DESC) = 1""")
def alert_latest(spark, sf_dir):
    latest = al.latest_alerts(rows(spark, sf_dir))
    number = F.substring_index(F.col("annotations")["summary"], " ", -1).cast("long")
    return latest.select("name", number.alias("event_id"), "startsAt")


@query(f"""{ALERTS_SQL} SELECT event_id, name, concat_ws(', ', 'service: ' || service, 'severity: ' || severity,
  CASE WHEN tag <> '' THEN 'tag: ' || tag END) AS labels, 'href: ' || service || ', summary: event ' || event_id AS annotations
FROM alerts WHERE name = 'alert_7'""")
def alert_detail(spark, sf_dir):
    detail = al.alert_detail(rows(spark, sf_dir), "alert_7")
    number = F.regexp_extract(F.element_at("annotations", -1), r"(\d+)$", 1).cast("long")
    return detail.select(
        number.alias("event_id"), "name", F.array_join("labels", ", ").alias("labels"),
        F.array_join("annotations", ", ").alias("annotations"),
    )


@query(f"""WITH e AS (SELECT *, {_K} AS k FROM events), kept AS (
  SELECT event_id, k, event_type, date_trunc('second', ts) AS s, date_trunc('second', ts) + INTERVAL 1 HOUR AS e FROM e
  WHERE event_type = 'error' AND k = 42 AND epoch_us(ts) // 1000 + 3600000 >= epoch_ms(TIMESTAMP '2024-01-10')
    AND epoch_us(ts) // 1000 <= epoch_ms(TIMESTAMP '2024-01-25') ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC LIMIT 10),
{_difference_sql(" UNION ALL ".join(f"SELECT event_id, '{c}' AS kind, least({c}, TIMESTAMP '{NOW}') AS a, greatest({c}, TIMESTAMP '{NOW}') AS b FROM kept" for c in "se"))},
t AS (SELECT event_id, max(txt) FILTER (kind = 's') AS ts, max(txt) FILTER (kind = 'e') AS te FROM texts GROUP BY event_id)
SELECT event_id AS id, k AS "dashboardId", 'note ' || k AS text, ['grid', event_type] AS tags,
  {_relative_sql('s', 'ts')} AS starts, {_relative_sql('e', 'te')} AS ends, '1h' AS duration
FROM kept JOIN t USING (event_id)""")
def annotation_filter(spark, sf_dir):
    kept = al.filter_annotations(_annotations(spark, sf_dir), ["grid", " error"], 42, 1704844800000, 1706140800000, 10)
    return al.annotation_table(kept, F.lit(NOW).cast("timestamp"))


def _annotations(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("int")
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), k.alias("dashboardId"), start.alias("time"),
        (start + 3600000).alias("timeEnd"), F.concat(F.lit("note "), k, F.lit("\n<a href='x'>more</a>")).alias("text"),
        F.array(F.lit("grid"), "event_type").alias("tags"),
    )


# Ranges as they are typed, seen from the first of the two times, and the bounds they stand for.
_SEEN_FROM = datetime(2024, 1, 20, 12, tzinfo=UTC)
_RANGES = {
    "now-2h": ("2024-01-20 10:00:00", "2024-01-20 12:00:00"), "3d-90m": ("2024-01-17 12:00:00", "2024-01-20 10:30:00"),
    "2024-01-10T06:00:00--2024-01-12": ("2024-01-10 06:00:00", "2024-01-12 00:00:00"),
    "1705708800-now": ("2024-01-20 00:00:00", "2024-01-20 12:00:00"),
}


@query(" UNION ALL ".join(f"""SELECT '{text}' AS range, event_id AS id, epoch_us(ts) // 1000 AS time FROM events
WHERE CAST(json_extract_string(props, '$.k') AS INT) = 42 AND epoch_us(ts) // 1000 + 3600000 >= epoch_ms(TIMESTAMP '{a}')
  AND epoch_us(ts) // 1000 <= epoch_ms(TIMESTAMP '{b}')""" for text, (a, b) in _RANGES.items()))
def annotation_range(spark, sf_dir):
    """Annotations that touch a range of time typed as text."""
    notes = _annotations(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        al.filter_annotations(notes, ["grid"], 42, *sorted(time_range(text, _SEEN_FROM))).select(F.lit(text).alias("range"), "id", "time")
        for text in _RANGES
    ])


@query(f"""WITH p AS (SELECT l_orderkey, l_linenumber, least(l_shipdate, o_orderdate) AS a, greatest(l_shipdate, o_orderdate) AS b
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey), {_difference_sql('SELECT * FROM p')}
SELECT l_orderkey, l_linenumber, CAST(months // 12 AS INT) AS years, CAST(months % 12 AS INT) AS months, CAST(d AS INT) AS days FROM texts""")
def calendar_parts(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    both = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    parts = dict(calendar_difference(*[F.col(c).cast("timestamp") for c in ("o_orderdate", "l_shipdate")]))
    return both.select(
        "l_orderkey", "l_linenumber", parts["Y"].alias("years"), parts["M"].alias("months"), parts["D"].alias("days")
    )
