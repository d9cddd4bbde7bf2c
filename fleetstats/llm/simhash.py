"""SimHash near-duplicates through anchor points.

Two fingerprints of 64 bits that differ in 3 bits at most differ in at most one bit of their lower or of their upper
half. Each half is covered by a perfect code: a Hamming code on 31 bits, with covering radius 1, beside one free bit.
The code words are the anchors. A fingerprint is copied to every anchor within the covering radius plus the threshold
of the half (1 + 1), that is to 17 per half; the nearest one is its home. Of two fingerprints that are at most one bit
apart in a half, each reaches the home of the other there. Fingerprints are compared per anchor in all 64 bits.

Equal fingerprints are one before they are copied. The members of an anchor with very many of them are dealt out by
pairs of slices, so that a task compares bounded sets; of the links inside a set only as many leave the task as
connect it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetstats.llm.common import add_columns, fresh, row_key
from fleetstats.llm.components import components
from fleetstats.llm.substring_dedup import word_spans
from fleetstats.storage import materialize

SEED = 42
MAX_BITS = 3  # what two halves with a threshold of one bit each can promise
SLICE = 4000  # members of an anchor that are compared with as many others in one set
SHINGLES_AT_ONCE = 1 << 17
SPACES = re.compile(rb"[\x20\x09-\x0D]+")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a text: bits that are set in over half of the hashes of its shingles."""
    joined = SPACES.sub(b" ", (text or "").encode("utf-8", "surrogatepass").lower()).strip(b" ")  # of bytes: ASCII only
    if not joined:
        return 0
    starts, ends = word_spans(joined)
    width = min(shingle, len(starts))
    digest, n = xxhash.xxh64_intdigest, len(starts) - width + 1
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, n, SHINGLES_AT_ONCE):
        j = min(i + SHINGLES_AT_ONCE, n)
        spans = zip(starts[i:j].tolist(), ends[i + width - 1:j + width - 1].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """The rows with the fingerprint of their text as a signed long."""
    added = T.StructType([T.StructField(out, T.LongType(), False)])

    def compute(texts):
        return [np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)]

    return add_columns(docs, text, added, compute)


def flips() -> list[list[int]]:
    """By syndrome of a half, the bits to flip to get to each of its anchors; the first leads home.

    Bit i of a half, from 1 to 31, is column i of the parity checks; bit 0 is free. A word of syndrome s is one flip
    (bit s) from its code word and two flips (bits i and j with i xor j = s) from the others in reach.
    """
    table = []
    for s in range(32):
        home = 1 << s if s else 0
        pairs = [1 << i | 1 << (i ^ s) for i in range(1, 32) if s and i < (i ^ s)]
        table.append([home, home ^ 1, *pairs])
    return table


def syndrome(half: Column) -> Column:
    checks = [sum(1 << i for i in range(1, 32) if i >> k & 1) for k in range(5)]
    bits = [F.shiftleft(F.bit_count(half.bitwiseAND(F.lit(m))).bitwiseAND(F.lit(1)), k) for k, m in enumerate(checks)]
    return sum(bits[1:], bits[0])


def anchored(fps: DataFrame) -> DataFrame:
    """Each distinct fingerprint at each of its anchors, as (anchor, fp, home)."""
    table = F.array(*[F.array(*[F.lit(m).cast("long") for m in row]) for row in flips()])
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned(F.col("fp"), 32)
    halves = [
        F.struct(F.lit(h).cast("long").alias("side"), half.alias("half"), syndrome(half).alias("s"))
        for h, half in enumerate((low, high))
    ]
    each = fps.select("fp", F.explode(F.array(*halves)).alias("h"))
    reached = each.select("fp", "h", F.posexplode(F.get(table, F.col("h.s"))).alias("pos", "flip"))
    anchor = F.shiftleft(F.col("h.side"), 32).bitwiseOR(F.col("h.half").bitwiseXOR(F.col("flip")))
    return reached.select(anchor.alias("anchor"), "fp", (F.col("pos") == 0).alias("home"))


def in_sets(members: DataFrame) -> DataFrame:
    """Members with the set they are compared in: the whole anchor, or for large ones each pair of slices."""
    sizes = members.groupBy("anchor").agg(F.count("*").alias("n"), F.max("home").alias("lived_in"))
    large = materialize(sizes.where((F.col("n") > SLICE) & F.col("lived_in")).select("anchor", "n"), "large-anchors")
    dealt = members.join(large, "anchor", "left")
    slices = F.ceil(F.col("n") / SLICE).cast("int")
    own = F.pmod(F.xxhash64("fp"), slices).cast("int")
    whole = dealt.where(F.col("n").isNull()).select("anchor", F.lit(0).alias("part"), "fp", "home")
    parts = (
        dealt.where(F.col("n").isNotNull())
        .select("anchor", "fp", slices.alias("k"), own.alias("own"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("other"))
        # a slice pair may hold no member that lives there: what lives in other slices is compared there
        .select("anchor", (F.least("own", "other") * F.col("k") + F.greatest("own", "other")).alias("part"), "fp",
                F.lit(True).alias("home"))
    )
    return whole.unionByName(parts)


def spanning_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what pairs of at most `max_bits` differing bits connect."""
    links, left = [], fps.view(np.uint64)  # of signed numbers, the bits of the magnitude would be counted
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found, left = left[near], left[~near]
                links += [(x, y) for y in found]
                queue += list(found)
    return links


LINKS = T.StructType([T.StructField("u", T.LongType(), False), T.StructField("v", T.LongType(), False)])


def compare_sets(batches, max_bits: int):
    """Links of rows that come sorted by anchor and part."""
    rest = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if rest is not None:
            columns = [np.concatenate(p) for p in zip(rest, columns)]
        new = np.flatnonzero((np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0)) + 1
        cut = int(new[-1]) if len(new) else 0
        rest = [c[cut:] for c in columns]  # the last set may go on in the next batch
        yield from linked(columns, new[:-1] if len(new) else new, cut, max_bits)
    if rest is not None:
        yield from linked(rest, np.zeros(0, np.int64), len(rest[0]), max_bits)


def linked(columns, inner: np.ndarray, end: int, max_bits: int):
    starts = np.concatenate([[0], inner]).astype(np.int64)
    ends = np.concatenate([inner, [end]]).astype(np.int64)
    if not end:
        return
    homes = np.add.reduceat(columns[3][:end].astype(np.int64), starts)
    links = []
    for a, b in zip(starts[(homes > 0) & (ends - starts > 1)], ends[(homes > 0) & (ends - starts > 1)]):
        links += spanning_links(columns[2][a:b], max_bits)
    if links:
        ends_of_links = np.array(links, dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(e) for e in ends_of_links.T], names=["u", "v"])


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints of at most `max_bits` differing bits."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be from 0 to {MAX_BITS}")
    sets = in_sets(anchored(fps))
    dealt = sets.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return dealt.mapInArrow(lambda batches: compare_sets(batches, max_bits), LINKS)


def classes(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per row: `id_col`, `fp`, `component_id`, and `first`, the key of the document that stands for its class.

    Fingerprints link at `max_bits` or fewer differing bits; a component is what links reach, and `component_id` its
    smallest id. A null or blank text has fingerprint zero, linked like any other. A null id takes part but names a
    component only if all its ids are null. Repeated rows are in one component; rows that share an id are told apart
    by their other columns. An empty table gives an empty result.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be from 0 to {MAX_BITS}")
    high, low = keys(docs)
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"), high.alias("k1"), low.alias("k2"))
    marked = materialize(fingerprints(keyed, "t", shingle).drop("t"), "fingerprints")
    entry = F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2")
    fps = materialize(marked.groupBy("fp").agg(F.min(entry).alias("first")), "distinct-fingerprints")
    found = components(materialize(fingerprint_links(fps.select("fp"), max_bits), "fingerprint-links"))
    rooted = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = materialize(rooted.withColumn("root", F.coalesce("root", "fp")), "rooted")
    named = materialize(rooted.groupBy("root").agg(F.min("first").alias("first")), "components")
    by_fp = materialize(rooted.select("fp", "root").join(named, "root").drop("root"), "classes")
    return marked.join(by_fp, "fp").select(
        F.col("id").alias(id_col), "fp", F.col("first.id").alias("component_id"), "first", "k1", "k2",
    )


def keys(docs: DataFrame) -> tuple[Column, Column]:
    """The key of a row: all columns that can be hashed."""
    return row_key(*[f"`{f.name}`" for f in docs.schema if "map<" not in f.dataType.simpleString()
                     and "variant" not in f.dataType.simpleString()])


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows without near-duplicates: of each component its smallest document stays, once if it is repeated."""
    found = classes(docs, id_col, text, shingle, max_bits)
    kept = materialize(found.select("first.k1", "first.k2").distinct(), "kept")
    k1, k2 = fresh(docs.columns, "_k1"), fresh(docs.columns, "_k2")
    high, low = keys(docs)
    kept = kept.select(F.col("k1").alias(k1), F.col("k2").alias(k2))
    rows = docs.withColumns({k1: high, k2: low}).join(kept, [k1, k2], "left_semi")
    return rows.dropDuplicates([k1, k2]).drop(k1, k2)
