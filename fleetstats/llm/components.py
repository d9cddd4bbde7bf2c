"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join on tables written to the shared folder, so a node of very many links is
split like any skewed join and a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetstats.storage import materialize


def _minima(links: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours."""
    return materialize(links.groupBy("u").agg(F.min("v").alias("m")), "minima").select("u", F.least("u", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_minima(both), "u").where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    minima = _minima(links)
    joined = links.join(minima, "u").where(F.col("v") != F.col("m"))
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(minima.select("u", F.col("m").alias("v")))


def _step(links: DataFrame) -> DataFrame:
    return materialize(links.where(F.col("u") != F.col("v")).distinct(), "links")


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(links: DataFrame) -> DataFrame:
    """From links (u, v) the columns `node` and `root`: the smallest node that each linked node reaches.

    Order and direction of the links, repeated ones and links of a node to itself do not matter; nodes without a link
    to another one have no row, an empty table gives an empty result. Nulls link nothing.
    """
    links = links.where(F.col("u").isNotNull() & F.col("v").isNotNull())
    links = _step(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    mark = _mark(links)
    while True:
        links = _step(_small_star(_step(_large_star(links))))
        before, mark = mark, _mark(links)
        if mark == before:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
