"""Benchmark decontamination by spaced seeds, in built-in functions only.

A fixed mask names the tokens of a window that are hashed; the others may differ. The seeds of all windows of the
benchmark and of the corpus meet by hash, and around each hit the tokens are compared: a window of `WINDOW` aligned
tokens that holds the seed must agree in four fifths of them. Items of under a window are found whole, by the hash of
all their tokens.

The corpus has far more windows than hits. Two small bit tables of the benchmark, of fixed size whatever its length,
tell most windows apart before they become rows; the join decides. The benchmark's side of the join is broadcast
where its counted rows are few, and is shuffled otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetstats.llm.common import fresh
from fleetstats.llm.simhash import keys
from fleetstats.storage import materialize

# Hashed positions of each mask. All hold the first two, by which windows are told apart early.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 4, 5, 8, 9), (0, 1, 3, 6, 7, 9))
WINDOW = 13
AGREEING = 11  # at least 0.8 of the window
BITS = 18  # a bit table has 2**18 bits
BROADCAST_SEEDS = 100_000  # rows of the benchmark's side, of some 200 bytes each

# Letters of scripts that are written without spaces are tokens of their own.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\u30FC\uFF70]"

SPAN = max(m[-1] for m in MASKS) + 1
BEFORE = WINDOW - min(m[-1] + 1 for m in MASKS)  # tokens before a seed that a window around it may hold


def tokens(text: Column) -> Column:
    """Runs of letters and digits, in lower case, single letters in scripts without spaces; a null text has none."""
    apart = F.when(text.rlike(UNSPACED), F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text)
    return F.coalesce(
        F.array_remove(F.split(F.lower(apart), r"[^\p{L}\p{N}]+"), ""), F.array().cast("array<string>")
    )


def seed(w: Column, p: Column, mask: int) -> Column:
    """The hash of the masked tokens of the window at `p`; null where it does not fit."""
    held = [F.get(w, p + o) for o in MASKS[mask]]
    return F.when(held[-1].isNotNull(), F.xxhash64(F.lit(mask), *held))


def opening(w: Column, p: Column) -> Column:
    """The hash of the two tokens that all masks begin with."""
    return F.xxhash64(F.get(w, p), F.get(w, p + 1))


def bit_table(hashes: DataFrame) -> Column:
    """The bits of the hashes `h` as one array of longs."""
    word = F.shiftright("h", 6).bitwiseAND(F.lit((1 << (BITS - 6)) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
    words = hashes.groupBy(word.alias("i")).agg(F.bit_or(bit).alias("bits"))
    every = hashes.sparkSession.range(1 << (BITS - 6)).join(words, F.col("id") == F.col("i"), "left")
    filled = F.transform(
        F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))),
        lambda x: x["bits"],
    )
    return every.agg(filled).scalar()


def in_table(table: Column, h: Column) -> Column:
    word = F.get(table, F.shiftright(h, 6).bitwiseAND(F.lit((1 << (BITS - 6)) - 1)).cast("int"))
    shifted = F.call_function("shiftrightunsigned", word, h.bitwiseAND(F.lit(63)).cast("int"))
    return shifted.bitwiseAND(F.lit(1).cast("long")) == 1


def around(w: Column, p: Column) -> Column:
    """The tokens that windows around a seed at `p` may hold, and where the seed begins among them."""
    start = F.greatest(p - BEFORE, F.lit(0))
    return F.struct((p - start).alias("at"), F.slice(w, start + 1, p + WINDOW - start).alias("w"))


def seeds(w: Column, spots: Column, test=None) -> Column:
    """(mask, h, p, near) of the windows at some positions."""
    def of(p):
        made = F.array(*[F.struct(F.lit(m).alias("mask"), seed(w, p, m).alias("h")) for m in range(len(MASKS))])
        kept = F.filter(made, lambda s: s["h"].isNotNull() & (test(s["h"]) if test else F.lit(True)))
        return F.transform(kept, lambda s: F.struct(s["mask"].alias("mask"), s["h"].alias("h"), p.alias("p")))
    return F.flatten(F.transform(spots, of))


def positions(w: Column) -> Column:
    shortest = min(m[-1] for m in MASKS)
    last = F.size(w) - shortest - 1
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def short_hits(made: DataFrame, short: DataFrame, side: DataFrame) -> DataFrame:
    """(id, k1, k2, item): where a document of tokens `w` holds all tokens of a short item (n, h, item, b) in their order."""
    w = F.col("w")

    def first(w, p):
        return F.xxhash64(F.get(w, p))

    start = F.when(F.col("n") == 1, first(F.col("b"), F.lit(0))).otherwise(opening(F.col("b"), F.lit(0)))
    told = made.select(
        "id", "k1", "k2", "w", bit_table(short.select(start.alias("h"))).alias("early"),
        bit_table(short.select("h")).alias("table"), short.agg(F.collect_set("n")).scalar().alias("lengths"))
    every = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)))).otherwise(
        F.array().cast("array<int>"))
    single = F.array_contains("lengths", 1)
    spots = F.filter(every, lambda p: in_table(F.col("early"), opening(w, p)) | (
        single & in_table(F.col("early"), first(w, p))))

    def windows(p):
        fitting = F.filter("lengths", lambda n: p + n <= F.size(w))
        made = F.transform(fitting, lambda n: F.struct(
            n.alias("n"), F.xxhash64(n, F.slice(w, p + 1, n)).alias("h"), p.alias("p")))
        return F.filter(made, lambda s: in_table(F.col("table"), s["h"]))

    found = told.withColumn("spots", spots).withColumn("found", F.flatten(F.transform("spots", windows)))
    hits = found.select("id", "k1", "k2", F.explode(F.transform("found", lambda s: F.struct(
        s["n"].alias("n"), s["h"].alias("h"), F.slice(w, s["p"] + 1, s["n"]).alias("a")))).alias("s"))
    met = hits.select("id", "k1", "k2", "s.n", "s.h", "s.a").join(side, ["n", "h"])
    return met.where(F.col("a") == F.col("b")).select("id", "k1", "k2", "item")


def agreeing() -> tuple[Column, Column]:
    """Which compared tokens are the same, as column `same`, and whether a window around the hit agrees: at (mask, a, b), `a` the document's tokens and `b` the item's."""
    a, b = F.col("a"), F.col("b")
    back = F.least(a["at"], b["at"])
    ahead = F.least(F.size(a["w"]) - a["at"], F.size(b["w"]) - b["at"])
    same = F.transform(
        F.sequence(-back, ahead - 1), lambda k: (F.get(a["w"], a["at"] + k) == F.get(b["w"], b["at"] + k)).cast("int")
    )
    span = F.get(F.array(*[F.lit(m[-1] + 1) for m in MASKS]), F.col("mask"))
    starts = F.filter(  # windows, as offsets among the compared tokens, that hold the whole seed
        F.sequence(F.lit(0), F.greatest(back + ahead - WINDOW, F.lit(0))),
        lambda s: (s <= back) & (s + WINDOW >= back + span),
    )
    counted = F.exists(starts, lambda s: F.aggregate(
        F.slice(F.col("same"), s + 1, WINDOW), F.lit(0), lambda n, x: n + x) >= AGREEING)
    return same, (back + ahead >= WINDOW) & counted


def beside(counted: DataFrame) -> DataFrame:
    """The benchmark's side of a join, broadcast where its rows are few."""
    return F.broadcast(counted) if counted.count() <= BROADCAST_SEEDS else counted


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The documents that overlap with the benchmark: `id_col`, `n_items`, `item_ids` (in order), `n_hits`, `k1`, `k2`.

    An overlap is a window of 13 aligned tokens, runs of letters and digits in lower case, of which 11 agree and which
    holds a seed: a masked window of the benchmark found in the document. An item of under 13 tokens overlaps where all of
    its tokens stand in a row, be it one. Null and empty texts and items overlap with nothing. A null item id contaminates but is not listed. Rows alike in all columns are
    one document; rows that share an id are told apart by `k1`, `k2`, the keys of the row. Repeated items change nothing
    but `n_hits`. Empty tables give an empty result.
    """
    items = benchmark.select(F.col(item_col).alias("item"), tokens(F.col(item_text)).alias("t"))
    every = items.select("item", F.transform("t", lambda x: F.xxhash64(x)).alias("w"))
    items, w = every.where(F.size("w") >= WINDOW), F.col("w")
    short = materialize(every.where((F.size(w) > 0) & (F.size(w) < WINDOW)).select(
        F.size(w).alias("n"), F.xxhash64(F.size(w), w).alias("h"), "item", w.alias("b")), "short")
    item_seeds = materialize(
        items.select("item", "w", F.explode(seeds(w, positions(w))).alias("s"))
        .select("s.mask", "s.h", "item", around(w, F.col("s.p")).alias("b")), "seeds"
    )
    item_openings = items.select("w", F.explode(positions(w)).alias("p")).select(opening(w, F.col("p")).alias("h"))
    table, early = bit_table(item_seeds.select("h")), bit_table(item_openings)

    high, low = keys(docs)
    made = docs.select(F.col(id_col).alias("id"), high.alias("k1"), low.alias("k2"), tokens(F.col(text)).alias("t"))
    hashed = made.select("id", "k1", "k2", F.transform("t", lambda x: F.xxhash64(x)).alias("w"))
    made = hashed.withColumns({"early": early, "table": table})
    spots = F.filter(positions(w), lambda p: in_table(F.col("early"), opening(w, p)))
    found = made.select("id", "k1", "k2", "w", "table", spots.alias("spots")).select(
        "id", "k1", "k2", "w", seeds(w, F.col("spots"), lambda h: in_table(F.col("table"), h)).alias("found")
    )
    # no filter on arrays made from the tokens: it would be pushed down and make them anew for every element
    hits = found.select(
        "id", "k1", "k2",
        F.explode(F.transform("found", lambda s: F.struct(
            s["mask"].alias("mask"), s["h"].alias("h"), around(w, s["p"]).alias("a")))).alias("s"),
    ).select("id", "k1", "k2", "s.mask", "s.h", "s.a")
    side = beside(item_seeds)
    same, agrees = agreeing()
    met = hits.join(side, ["mask", "h"]).withColumn("same", same).where(agrees).select("id", "k1", "k2", "item")
    if not short.isEmpty():
        met = met.unionByName(short_hits(hashed, short, beside(short)))
    return (
        met.groupBy("k1", "k2").agg(
            F.min("id").alias(id_col), F.sort_array(F.collect_set("item")).alias("item_ids"),
            F.count("*").alias("n_hits"),
        ).withColumn("n_items", F.size("item_ids").cast("long"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows without those that overlap with the benchmark (see `contaminated`)."""
    k1, k2 = fresh(docs.columns, "_k1"), fresh(docs.columns, "_k2")
    high, low = keys(docs)
    found = contaminated(docs, benchmark, id_col, text).select(F.col("k1").alias(k1), F.col("k2").alias(k2))
    found = materialize(found, "contaminated")
    return docs.withColumns({k1: high, k2: low}).join(found, [k1, k2], "left_anti").drop(k1, k2)
