"""Messages: documents as text on dotted topics, and counts of them.

The same functions serve batch and streaming DataFrames.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the message format: pair separator, root topic, the attributes whose own
# separator becomes a topic level, and the attribute that becomes a level below the root.
PAIR_SEPARATOR = "   "
ROOT_TOPIC = "cms"
LEVEL_SEPARATORS = {"site": "_", "task": "/", "dataset": "/"}
SYSTEM_KEY = "system"


def record_of(columns: Sequence[str]) -> Column:
    """A text map of the given columns; a null column is an absent attribute."""
    pairs = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def attr_subset(record: Column, attrs: Sequence[str] | None) -> Column:
    """Only the listed attributes, or all of them."""
    return F.map_filter(record, lambda k, _: k.isin(*attrs)) if attrs else record


def encode(record: Column, sep: str = PAIR_SEPARATOR) -> Column:
    """``key:value`` pairs in key order."""
    pairs = F.transform(F.sort_array(F.map_entries(record)), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    return F.array_join(pairs, sep)


def decode(message: Column, sep: str = PAIR_SEPARATOR) -> Column:
    """The pairs as a map; a value keeps its own colons."""
    return F.str_to_map(message, F.lit(re.escape(sep)), F.lit(":"))


def topic(subject: Column, key: Column, value: Column) -> Column:
    """Topic of one attribute."""
    levels = value
    for name, sep in LEVEL_SEPARATORS.items():
        dotted = F.regexp_replace(F.replace(value, F.lit(sep), F.lit(".")), r"^\.", "")
        levels = F.when(key == name, dotted).otherwise(levels)
    return F.concat_ws(".", subject, key, levels)


def fan_out(
    df: DataFrame,
    record: str,
    root: str = ROOT_TOPIC,
    topics: Sequence[str] | None = None,
    attrs: Sequence[str] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    sep: str = PAIR_SEPARATOR,
) -> DataFrame:
    """Each document as one message per attribute, or one per given topic.

    ``transform`` may filter or enrich the documents first. A document none of whose attributes
    makes a topic goes to the root topic.
    """
    docs = df if transform is None else df.transform(transform)
    if topics:
        return docs.withColumn("value", encode(attr_subset(F.col(record), attrs), sep)).withColumn(
            "topic", F.explode(F.array(*[F.lit(t) for t in topics]))
        )
    system = F.coalesce(F.col(record)[SYSTEM_KEY], F.lit(""))
    subject = F.when(system != "", F.concat_ws(".", F.lit(root), system)).otherwise(F.lit(root))
    body = F.map_filter(record, lambda k, _: ~((k == SYSTEM_KEY) & (system != "")))
    kept = docs.withColumns({"_body": attr_subset(body, attrs), "_subject": subject})
    names = F.transform(
        F.map_entries(F.map_filter("_body", lambda _, v: v != "")),
        lambda e: topic(F.col("_subject"), e["key"], e["value"]),
    )
    names = F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(root)))
    return (
        kept.withColumn("value", encode(F.col("_body"), sep))
        .withColumn("topic", F.explode(names))
        .drop("_body", "_subject")
    )


def topic_matches(col: Column, pattern: str) -> Column:
    """Pattern over dotted topics: ``*`` is one level, a last ``>`` is one or more levels."""
    levels = {"*": r"[^.]+", ">": r".+"}
    regex = r"\.".join(levels.get(level) or re.escape(level) for level in pattern.split("."))
    return col.rlike(f"^{regex}$")


def metric_points(df: DataFrame, subscription: str, message: str = "value", sep: str = PAIR_SEPARATOR) -> DataFrame:
    """Each message as a point of value 1, named after the subscription, tagged with its pairs."""
    name = subscription.replace(".>", "").replace("*", "")
    point = F.struct(
        F.lit(name).alias("metric"), F.lit(1).alias("value"), decode(F.col(message), sep).alias("tags")
    )
    return df.withColumn("point", F.to_json(point))


def interval_counts(
    df: DataFrame, ts: str, by: Sequence[str] = (), every: str = "10 seconds", late: str = "10 minutes"
) -> DataFrame:
    """Messages per interval of event time, in total or by attributes.

    On a stream, intervals are final once ``late`` has passed, so state stays bounded.
    """
    source = df.withWatermark(ts, late) if df.isStreaming else df
    counted = source.groupBy(F.window(ts, every), *by).agg(F.count("*").alias("n"))
    return counted.select(
        F.col("window.start").alias("interval_start"), F.col("window.end").alias("interval_end"), *by, "n"
    )


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def failing_codes(df: DataFrame, site: str = "site", code: str = "exitCode") -> DataFrame:
    """Messages per site and exit code, without code zero."""
    return counts_by(df.where(F.col(code) != "0"), site, code)


def largest_first(counts: DataFrame, *keys: str) -> DataFrame:
    return counts.orderBy(F.desc("n"), *keys)


def describe_codes(counts: DataFrame, lookup: DataFrame, code: str = "exitCode") -> DataFrame:
    """Descriptions next to the codes, empty where there is none."""
    named = lookup.select(F.col("code").alias(code), "description")
    return counts.join(named, code, "left").withColumn("description", F.coalesce("description", F.lit("")))


def top_codes_of_top_sites(
    counts: DataFrame, sites: int = 3, codes: int = 5, site: str = "site", code: str = "exitCode"
) -> DataFrame:
    """The most frequent codes of the sites with the most failures.

    Ranks the counts, not the messages, in one pass; of a site ``codes`` rows are held together.
    """
    own = Window.partitionBy(site)
    rank = F.row_number().over(own.orderBy(F.desc("n"), code))
    ranked = counts.withColumns({"site_total": F.sum("n").over(own), "rank": rank}).where(F.col("rank") <= codes)
    rest = [c for c in ranked.columns if c not in (site, "site_total")]
    best = ranked.groupBy(site, "site_total").agg(F.collect_list(F.struct(*rest)).alias("_codes"))
    best = best.orderBy(F.desc("site_total"), site).limit(sites)
    return best.select(site, "site_total", F.explode("_codes").alias("_code")).select(
        *[F.col(c) if c in (site, "site_total") else F.col(f"_code.{c}") for c in (*counts.columns, "site_total", "rank")]
    )


def distinct_sites_and_codes(df: DataFrame, site: str = "site", code: str = "exitCode") -> DataFrame:
    """Numbers of distinct sites and codes, counted over the distinct pairs."""
    return df.groupBy(site, code).agg(F.lit(1).alias("_")).agg(
        F.count_distinct(site).alias("sites"), F.count_distinct(code).alias("codes")
    )
