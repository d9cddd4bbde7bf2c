"""Accounting, quota and storage reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetstats.functions.numbers import percent
from fleetstats.storage import materialize
from fleetstats.functions.text import index_group

TOTAL = "TOTAL"

# ---- campaigns ------------------------------------------------------------------------------


def campaign_jobs(jobs: DataFrame, campaigns: Sequence[str], after_ms: int, until_ms: int) -> DataFrame:
    """Completed production jobs of some campaigns with record time in ``(after, until]``."""
    return jobs.where(
        (F.col("Type") == "production") & (F.col("Status") == "Completed") & F.col("Campaign").isin(*campaigns)
        & (F.col("RecordTime") > after_ms) & (F.col("RecordTime") <= until_ms)
    )


def campaign_sums(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("Campaign", "WMAgent_SubTaskName").agg(F.sum("HS06CoreHr").alias("HS06CoreHr"))


def prefix_totals(sums: DataFrame) -> DataFrame:
    """Totals per request prefix: path element two of the sub-task, up to its first ``_``."""
    request = F.get(F.split("WMAgent_SubTaskName", "/", -1), F.lit(2))
    return sums.groupBy(F.substring_index(request, "_", 1).alias("prefix")).agg(
        F.sum("HS06CoreHr").alias("total"), F.count("*").alias("subtasks")
    )


# ---- accounting -----------------------------------------------------------------------------


def with_total(df: DataFrame, name: str, sums: Sequence[str]) -> DataFrame:
    """The rows and one more named TOTAL; its other text columns are empty.

    The rows are written once; the sums are taken from what was written.
    """
    df = materialize(df, "totalled")
    others = [c for c in df.columns if c != name and c not in sums]
    total = df.agg(*[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in sums]).select(
        F.lit(TOTAL).alias(name), *sums, *[F.lit("").alias(c) for c in others]
    )
    return df.unionByName(total)


def renamed_counters(df: DataFrame, columns: Mapping[str, str], required: Sequence[str], name: str) -> DataFrame:
    """Columns in order under their display names; optional counters default to zero."""
    out = []
    for source, shown in columns.items():
        if source == name or source in required:
            out.append(F.col(source).alias(shown))
        elif source in df.columns:
            out.append(F.coalesce(F.col(source).try_cast("long"), F.lit(0)).alias(shown))
        else:
            out.append(F.lit(0).cast("long").alias(shown))
    return df.select(*out)


def storage_quota(elements: DataFrame, usage: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Used, total and free space in TB of real disk elements at tiers 1 and 2.

    Elements that lack either the static or the used figure are left out. Rounded to one
    decimal, halves to even.
    """
    wanted = elements.where(
        (F.col("rse_type") == "DISK") & (F.col("cms_type") == "real") & (F.col("tier") > 0) & (F.col("tier") < 3)
        & ~F.col("rse").isin(*exclude)
    ).select("rse")
    # one row per element before the join
    figures = usage.groupBy("rse").agg(
        F.max(F.when(F.col("source") == "static", F.col("used"))).alias("static"),
        F.max(F.when(F.col("source") == "rucio", F.col("used"))).alias("rucio"),
    ).where(F.col("static").isNotNull() & F.col("rucio").isNotNull())
    static, used = F.col("static") * 1e-12, F.col("rucio") * 1e-12
    return wanted.join(figures, "rse").select(
        "rse",
        F.bround(used, 1).alias("used_tb"),
        F.bround(static, 1).alias("total_tb"),
        F.bround(percent(used, static), 1).alias("used_percent"),
        F.bround(static - used, 1).alias("free_tb"),
    )


def replicated_quota(paths: DataFrame) -> DataFrame:
    """Physical and logical space per quota folder, and a TOTAL row.

    Replicated files take twice, erasure-coded files 1.2 times their logical size.
    """
    # The names of the source's columns.
    rep, ec, quota = F.col("logical_rep_bytes"), F.col("logical_ec_bytes"), F.col("max_logical_quota")
    physical = rep * 2 + ec * 1.2
    free = quota * 2 - physical
    report = paths.select(
        "quota_node",
        quota.alias("max_logical_quota"),
        (rep + ec).alias("total_used_logical_bytes"),
        rep.alias("logical_rep_bytes"),
        ec.alias("logical_ec_bytes"),
        physical.alias("total_used_physical_bytes"),
        (rep * 2).alias("physical_rep_bytes"),
        (ec * 1.2).alias("physical_ec_bytes"),
        free.alias("free_physical"),
        (free / 1.2).alias("free_physical_for_ec"),
        (free / 2).alias("free_physical_for_rep"),
        (quota - rep - ec).alias("free_logical"),
    )
    return with_total(report, "quota_node", [c for c in report.columns if c != "quota_node"])


# ---- storage --------------------------------------------------------------------------------


def prefix_matches(df: DataFrame, name: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """Rows joined to every prefix their name starts with, one row per match.

    An equality join: each name is cut at the lengths that occur among the prefixes, so no
    name is compared with all prefixes.
    """
    lengths = prefixes.agg(F.sort_array(F.collect_set(F.length(prefix))).alias("lengths")).scalar()
    cuts = df.withColumn("_lengths", lengths).withColumn(
        prefix,
        F.explode(F.transform(
            F.filter("_lengths", lambda n: (n > 0) & (n <= F.length(name))),
            lambda n: F.substring(F.col(name), F.lit(1), n),
        )),
    )
    return cuts.drop("_lengths").join(prefixes, prefix)


def index_usage(indices: DataFrame, patterns: DataFrame, family_prefix: str) -> DataFrame:
    """Storage records of the indexes that start with a catalogue pattern, one per match."""
    clean = patterns.select(F.explode(F.split("database", "]")).alias("prefix")).select(
        F.trim(F.translate("prefix", "[*", "")).alias("prefix")
    ).where(F.col("prefix") != "")
    return prefix_matches(indices, "name", clean, "prefix").select(
        "name",
        F.col("size_in_bytes").alias("size"),
        F.lit("elasticsearch").alias("type"),
        F.lit("").alias("location"),
        index_group(F.col("name"), family_prefix).alias("group"),
    )


def path_usage(paths: DataFrame, size) -> DataFrame:
    """Storage records of folders."""
    return paths.select(
        "name", size.cast("long").alias("size"), F.lit("hdfs").alias("type"), F.col("path").alias("location"),
        F.lit("").alias("group"),
    )


def usage_totals(*records: DataFrame) -> DataFrame:
    """Sizes per store type and group over all storage records."""
    everything = records[0]
    for more in records[1:]:
        everything = everything.unionByName(more)
    return everything.groupBy("type", "group").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
