"""Alerts and annotations: filters, order, durations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstats.functions.times import duration_text, once, relative_text

# Ranks of the severities (others rank zero), the labels shown, and the second
# that stands for an open end.
SEVERITIES = ("info", "warning", "medium", "high", "critical", "urgent")
SHOWN_LABELS = ("service", "tag", "severity")
OPEN_END_SECONDS = 32516091806
OPEN_END_TEXT = "Undefined"


def alert_rows(df: DataFrame) -> DataFrame:
    """Alerts with their main labels as columns; an absent label is empty text."""
    labels = {"name": "alertname", "service": "service", "severity": "severity", "tag": "tag"}
    return df.withColumns({c: F.coalesce(F.col("labels")[key], F.lit("")) for c, key in labels.items()})


def filter_alerts(rows: DataFrame, service: str = "", severity: str = "", tag: str = "") -> DataFrame:
    """All rows of every alert name that passes in at least one row."""
    given = {"service": service, "severity": severity, "tag": tag}
    passing = rows
    for column, wanted in given.items():
        if wanted:
            passing = passing.where(F.col(column) == wanted)
    if not any(given.values()):
        return rows
    return rows.join(passing.select("name").distinct(), "name", "left_semi")


def severity_rank(severity: Column) -> Column:
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), severity)
    return F.greatest(rank - 1, F.lit(0).cast("long"))


def sort_key(by: str) -> Column:
    """Order of alerts: ``severity``, ``starts``, ``ends`` or ``duration``."""
    keys = {
        "severity": severity_rank(F.col("severity")),
        "starts": F.col("startsAt"),
        "ends": F.col("endsAt"),
        "duration": F.unix_micros("endsAt") - F.unix_micros("startsAt"),
    }
    return keys[by.lower()]


def sort_alerts(rows: DataFrame, by: str, *ties: str) -> DataFrame:
    """Sorted rows; give ties a unique column, or all alerts of a severity are sorted by one task."""
    return rows.orderBy(sort_key(by), *ties)


def time_texts(start: Column, end: Column, now: Column) -> Column:
    """Start, end and duration for people, as fields; an open end has neither end nor duration.

    Each text is worked out once a row. Keep the result as a column before taking several fields.
    """
    pairs = F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in ((now, start), (now, end), (start, end))])
    # one expression for the three texts: three copies of it would be too large to compile
    said = F.transform(pairs, lambda p: once(duration_text(p["a"], p["b"]), lambda text: F.struct(
        relative_text(p["a"], p["b"], text).alias("relative"), text.alias("plain"))))

    def fields(texts: Column) -> Column:
        starts, ends, length = (F.get(texts, F.lit(i)) for i in range(3))
        is_open = F.unix_seconds(end) == OPEN_END_SECONDS
        # a reversed interval reads like a past time
        length = F.when(start > end, length["relative"]).otherwise(length["plain"])
        return F.struct(
            starts["relative"].alias("starts"),
            F.when(is_open, F.lit(OPEN_END_TEXT)).otherwise(ends["relative"]).alias("ends"),
            F.when(is_open, F.lit(OPEN_END_TEXT)).otherwise(length).alias("duration"),
        )

    return once(said, fields)


def alert_table(rows: DataFrame, now: Column) -> DataFrame:
    texts = time_texts(F.col("startsAt"), F.col("endsAt"), now)
    return rows.withColumn("_texts", texts).select("name", "service", "tag", "severity", "_texts.starts", "_texts.ends", "_texts.duration")


def latest_alerts(rows: DataFrame) -> DataFrame:
    """The newest row of every alert name. Maps have no order, so sorted entries stand in."""
    newest = F.max(F.struct(
        "startsAt", "endsAt",
        F.sort_array(F.map_entries("labels")).alias("labels"),
        F.sort_array(F.map_entries("annotations")).alias("annotations"),
    )).alias("_row")
    return rows.groupBy("name").agg(newest).select(
        "name", "_row.startsAt", "_row.endsAt",
        F.map_from_entries("_row.labels").alias("labels"),
        F.map_from_entries("_row.annotations").alias("annotations"),
    )


def alert_detail(rows: DataFrame, name: str) -> DataFrame:
    """One alert: the shown labels and all annotations as text lines in key order."""
    labels = F.map_filter("labels", lambda k, _: k.isin(*SHOWN_LABELS))

    def lines(entries: Column) -> Column:
        return F.transform(F.sort_array(F.map_entries(entries)), lambda e: F.concat_ws(": ", e["key"], e["value"]))

    return rows.where(F.col("name") == name).select(
        "name", lines(labels).alias("labels"), lines(F.col("annotations")).alias("annotations")
    )


def filter_annotations(
    df: DataFrame,
    tags: Sequence[str] = (),
    dashboard: int | None = None,
    start_ms: int | None = None,
    end_ms: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Annotations with all the tags, of a dashboard, that touch a time range; newest first."""
    kept = df
    for wanted in tags:
        kept = kept.where(F.array_contains("tags", wanted.strip()))
    if dashboard is not None:
        kept = kept.where(F.col("dashboardId") == dashboard)
    if start_ms is not None:
        kept = kept.where(F.col("timeEnd") >= start_ms)
    if end_ms is not None:
        kept = kept.where(F.col("time") <= end_ms)
    return kept if limit is None else kept.orderBy(F.desc("time"), F.desc("id")).limit(limit)


def annotation_table(df: DataFrame, now: Column) -> DataFrame:
    start, end = F.timestamp_millis("time"), F.timestamp_millis("timeEnd")
    return df.withColumn("_texts", time_texts(start, end, now)).select(
        "id", "dashboardId", F.substring_index("text", "\n<a", 1).alias("text"), "tags",
        "_texts.starts", "_texts.ends", "_texts.duration",
    )
