"""Removal of repeated lines by overlapping windows of three lines, in built-in functions only.

Every run of consecutive lines of the window's length is hashed. Windows are counted over the whole corpus; of one that
occurs more than once, the first occurrence stays, by document and then by position, and the lines that later
occurrences cover go. A window that a third of all documents hold is reduced to one row per task before the
shuffle; the rows that look up the repeated windows meet them in a join that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstats.llm.common import fresh
from fleetstats.llm.simhash import keys
from fleetstats.storage import materialize

WIDTH = 3


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty text has none."""
    return F.when(F.length(text) > 0, F.split(text, "\n")).otherwise(F.array().cast("array<string>"))


def windows(keyed: DataFrame, width: int) -> DataFrame:
    """(id, k1, k2, pos, h1, h2) of every window, by the position of its first line."""
    hashed = keyed.select("id", "k1", "k2", F.transform("lines", lambda x: F.xxhash64(x)).alias("a"),
                          F.transform("lines", lambda x: F.xxhash64(F.lit(7), x)).alias("b"))
    n = F.size("a") - width + 1

    def combined(name, i):
        return F.xxhash64(*[F.get(F.col(name), i + j) for j in range(width)])

    spots = F.when(n > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1),
        lambda i: F.struct(i.cast("int").alias("pos"), combined("a", i).alias("h1"), combined("b", i).alias("h2")),
    ))
    return hashed.select("id", "k1", "k2", F.explode(spots).alias("w")).select("id", "k1", "k2", "w.pos", "w.h1", "w.h2")


def repeats(keyed: DataFrame, width: int) -> DataFrame:
    """For each document with repeated windows: (k1, k2, gone), its covered lines as intervals in order."""
    every = windows(keyed, width)
    place = F.struct(F.col("id").isNotNull().alias("named"), "id", "k1", "k2", "pos")
    grouped = every.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = materialize(
        grouped.where(F.col("first") != F.col("last")).select("h1", "h2", "first"), "repeated-windows"
    )
    found = every.join(repeated, ["h1", "h2"])
    same = (F.col("k1") == F.col("first.k1")) & (F.col("k2") == F.col("first.k2"))
    # in the document of the first occurrence, lines of that occurrence stay
    start = F.when(same, F.greatest("pos", F.col("first.pos") + width)).otherwise(F.col("pos"))
    later = found.where(~(same & (F.col("pos") == F.col("first.pos"))))
    return (
        later.select("k1", "k2", F.explode(F.sequence(start, F.col("pos") + width - 1)).alias("line"))
        .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("line")).alias("gone"))
    )


def line_dedup(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with their text less its repeated lines, and `n_lines`, `n_removed`.

    A window is `width` consecutive lines of one text, compared as they are; blank lines count. The order of
    occurrences is that of the ids (null ids first), then of the row's key, then of the position. Where later
    occurrences in the document of the first one overlap it, its lines stay. Texts of fewer lines than a window are
    kept; a null text stays null and has no lines, an empty text stays empty. A text may lose all its lines and is
    empty then. Rows alike in all columns are one document and share their result; rows that share an id only are
    told apart. An empty table gives an empty result. Input columns named like the added ones are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    high, low = keys(docs)
    k1, k2, gone, lines = (fresh(docs.columns, c) for c in ("_k1", "_k2", "_gone", "_lines"))
    keyed = docs.select(F.col(id_col).alias("id"), high.alias("k1"), low.alias("k2"),
                        lines_of(F.col(text)).alias("lines"))
    found = repeats(keyed, width).select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("gone").alias(gone))
    joined = docs.withColumns({k1: high, k2: low}).join(found, [k1, k2], "left")
    split = joined.withColumn(lines, lines_of(F.col(text)))
    removed = F.coalesce(F.size(gone), F.lit(0))
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.array_join(F.transform(F.array_except(places, F.col(gone)), lambda i: F.get(F.col(lines), i)), "\n")
    return split.withColumns({
        "n_lines": F.size(lines).cast("long"),
        "n_removed": removed.cast("long"),
        text: F.when(F.col(gone).isNull(), F.col(text)).otherwise(kept),
    }).drop(k1, k2, gone, lines)
