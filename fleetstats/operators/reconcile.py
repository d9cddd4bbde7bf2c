"""Two or more stores compared. Aggregates instead of joins, so a hot key shrinks before it moves."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstats.storage import materialize


def id_presence(a: DataFrame, b: DataFrame, id_col: str, day_col: str) -> DataFrame:
    """Each id of each day once, with the stores it is in."""
    sides = [
        df.select(day_col, id_col, F.lit(first).alias("in_a"), F.lit(not first).alias("in_b"))
        for df, first in ((a, True), (b, False))
    ]
    return sides[0].unionByName(sides[1]).groupBy(day_col, id_col).agg(
        F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b")
    )


def id_diff(a: DataFrame, b: DataFrame, id_col: str, day_col: str) -> DataFrame:
    """Per day the number of ids that only one store has; days that agree are left out."""
    counted = id_presence(a, b, id_col, day_col).groupBy(day_col).agg(
        F.count_if(~F.col("in_b")).alias("only_a"),
        F.count_if(~F.col("in_a")).alias("only_b"),
        F.count_if("in_a").alias("ids_a"),
        F.count_if("in_b").alias("ids_b"),
    )
    return counted.withColumn("missing", F.col("only_a") + F.col("only_b")).where(F.col("missing") > 0)


def bucket_digests(df: DataFrame, id_col: str, day_col: str, buckets: int) -> DataFrame:
    """For each day and bucket of ids what tells two sets of ids apart: their number, and sums over two hashes.

    A sum too large is null, which agrees with nothing.
    """
    hashes = [F.xxhash64(id_col), F.xxhash64(F.lit(7), id_col)]
    halves = [half for h in hashes for half in (F.shiftright(h, 32), h.bitwiseAND(0xFFFFFFFF))]
    return df.groupBy(F.col(day_col).alias(day_col), id_bucket(id_col, buckets).alias("bucket")).agg(
        F.count("*").alias("n"), *[F.try_sum(h).alias(f"s{i}") for i, h in enumerate(halves)]
    )


def id_bucket(id_col: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int")


def compare_buckets(a: DataFrame, b: DataFrame, id_col: str, day_col: str, buckets: int = 64) -> DataFrame:
    """Each day and bucket, whether the stores agree in it (``same``), and their rows; one row per part and task moves."""
    names = ["n", "s0", "s1", "s2", "s3"]
    sides = [bucket_digests(df, id_col, day_col, buckets).withColumn("store", F.lit(i)) for i, df in enumerate((a, b))]
    held = [F.max(F.when(F.col("store") == i, F.struct(*names))).alias(f"d{i}") for i in (0, 1)]
    both = sides[0].unionByName(sides[1]).groupBy(day_col, "bucket").agg(*held)
    same = reduce(Column.__and__, [F.col(f"d0.{c}") == F.col(f"d1.{c}") for c in names])
    return both.select(day_col, "bucket", F.coalesce(same, F.lit(False)).alias("same"), F.col("d0.n").alias("n"))


def in_parts(df: DataFrame, parts: DataFrame, id_col: str, day_col: str, buckets: int) -> DataFrame:
    """The ids of a store that are in some days and buckets; a row for each of these, so the rows themselves stay."""
    wanted = parts.select(F.col(day_col).alias("_day"), F.col("bucket").alias("_bucket"))
    here = F.col(day_col).eqNullSafe(F.col("_day")) & (id_bucket(id_col, buckets) == F.col("_bucket"))
    return df.select(day_col, id_col).join(wanted, here, "left_semi")


def id_diff_by_digest(
    a: DataFrame, b: DataFrame, id_col: str, day_col: str, buckets: int = 64, repeated: bool = False
) -> DataFrame:
    """As ``id_diff``, for stores that mostly agree: only ids of the days and buckets whose digests differ are shuffled.

    Each store is read twice, for its digests and for the ids of what differs. ``ids_a`` and ``ids_b`` count the rows of
    the parts that agree, which is the same if an id stands once in its day; with ``repeated`` the ids of these parts of
    the days that differ are counted too, from one store. Parts that differ and yet agree in their number and 128 bits of
    sums would go unseen.
    """
    compared = materialize(compare_buckets(a, b, id_col, day_col, buckets), "digests")
    parts = compared.where(~F.col("same"))
    differing = id_diff(*(in_parts(df, parts, id_col, day_col, buckets) for df in (a, b)), id_col, day_col)
    days = differing.select(F.col(day_col).alias("_day"))
    agreeing = compared.where("same").join(days, F.col(day_col).eqNullSafe(F.col("_day")), "left_semi")
    if repeated:
        agreeing = in_parts(a, agreeing, id_col, day_col, buckets).distinct().withColumn("n", F.lit(1))
    more = agreeing.groupBy(F.col(day_col).alias("_day")).agg(F.sum("n").alias("_n"))
    whole = differing.join(more, F.col(day_col).eqNullSafe(F.col("_day")), "left")
    ids = {c: F.col(c) + F.coalesce("_n", F.lit(0)) for c in ("ids_a", "ids_b")}
    return whole.withColumns(ids).select(differing.columns)


def reconcile(sources: Mapping[str, tuple[DataFrame, Mapping[str, Column]]], threshold: float = 0.01) -> DataFrame:
    """Counts per status in every store, and how neighbouring stores differ.

    Each store comes with its own predicate per status; each status is counted by itself, so predicates may overlap,
    and one without rows counts as zero. The relative difference of a pair is measured against the first store; it
    is flagged above the threshold, or if only the first count is zero.
    """
    counts = []
    for name, (df, predicates) in sources.items():
        counted = df.agg(*[F.count_if(p).alias(f"_{i}") for i, p in enumerate(predicates.values())])
        pairs = [F.struct(F.lit(s).alias("status"), F.col(f"_{i}").alias("n")) for i, s in enumerate(predicates)]
        if pairs:
            rows = counted.select(F.explode(F.array(*pairs)).alias("_row"))
            counts.append(rows.select("_row.status", "_row.n", F.lit(name).alias("source")))
    table = reduce(DataFrame.unionByName, counts).groupBy("status").agg(
        *[F.coalesce(F.max(F.when(F.col("source") == name, F.col("n"))), F.lit(0)).alias(name) for name in sources]
    )
    for x, y in pairwise(sources):
        gap = F.try_divide((F.col(x) - F.col(y)).cast("double"), F.col(x).cast("double"))
        table = table.withColumn(f"{x}_{y}_diff", gap).withColumn(
            f"{x}_{y}_flag", F.when(F.col(x) == 0, F.col(y) != 0).otherwise(F.abs(gap) > threshold)
        )
    return table
