"""A trie of conversation prefixes from vertical bitmaps.

Conversations, in the order of their ids, form shards of 1,024; a conversation is a bit. For each position and turn
of a shard a bitset says which conversations have that turn there. From the root on, depth first, the bitset of a node
is intersected with those of the turns its members have next: that gives its children, their numbers of members and
the conversations that end there. The same prefix found in several shards is one node, whose figures are added up.

A conversation is cut into blocks of 256 positions, so that no task holds a long one; a block starts from the prefixes
that its conversations have come by. A prefix is known by 128 bits, the xor of the hashes of its positions and turns.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fleetstats.llm.common import release_memory
from fleetstats.storage import materialize

SHARD_BITS = 10
BLOCK_BITS = 8

WORD = r"[^\x20\x09-\x0D]+"

PATH, PARENT = ["p1", "p2"], ["up1", "up2"]

NODE = T.StructType([
    *[T.StructField(c, T.LongType()) for c in (*PATH, *PARENT, "depth", "n_convs", "conv_id", "words", "shard")],
    T.StructField("ends", T.ArrayType(T.LongType())),
])
NODE_ARROW = to_arrow_schema(NODE)


@dataclass(frozen=True)
class Trie:
    """`nodes`: a row per prefix, known by `p1`, `p2`, with `up1`, `up2` of its parent (null for the root);
    `conv_id`, its smallest member, `parent_conv_id`, `depth`, `n_convs`, `n_children`, `n_leaves`, `n_ends`,
    `saved_tokens`. `ends`: `p1`, `p2`, `shard` and up to 1,024 ids, ascending, of conversations that end there;
    all ids of a shard are below those of the next."""

    nodes: DataFrame
    ends: DataFrame


def turn_keys(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`conv_id`, `turn` and, for role and text, 128 bits (`k1`, `k2`) and the number of words."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    return turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.xxhash64(*said).alias("k1"), F.xxhash64(F.lit(7), *said).alias("k2"),
        F.regexp_count(said[1], F.lit(WORD)).cast("long").alias("words"),
    )


def positions(keys: DataFrame) -> DataFrame:
    """The turns with their `position` in the conversation, from 1.

    Turns of 256 successive numbers are ordered together and follow those of the numbers before, so a conversation of
    any length is spread over many tasks.
    """
    lowest = F.lit(-(1 << 63)).cast("long")  # no shifted number is as low: null comes first
    keys = keys.withColumn("block", F.when(F.col("turn").isNull(), lowest).otherwise(F.shiftright("turn", BLOCK_BITS)))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = keys.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    counts = counts.select("conv_id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "k1", "k2")
    placed = keys.withColumn("row", F.row_number().over(within)).join(counts, ["conv_id", "block"])
    return placed.select("conv_id", (F.col("before") + F.col("row")).alias("position"), "k1", "k2", "words")


def lengths(rows: DataFrame) -> DataFrame:
    """`conv_id` and its number of turns."""
    return rows.groupBy("conv_id").agg(F.max("position").alias("turns"))


def postings(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """What the shards are built of: for each conversation and block a `head` row with the prefix it comes by, and a row
    for each turn with the hash of its position and turn."""
    ordered = convs.repartitionByRange("conv_id").sortWithinPartitions("conv_id")
    members = materialize(ordered.withColumn("member", F.monotonically_increasing_id()), "members")
    placed = materialize(rows.join(members, "conv_id").select(
        "conv_id", "member", "turns", F.shiftright(F.col("position") - 1, BLOCK_BITS).alias("block"), "position",
        F.xxhash64("position", "k1", "k2").alias("h1"), F.xxhash64(F.lit(7), "position", "k1", "k2").alias("h2"), "words",
    ), "turns")
    long = placed.where(F.col("turns") > 1 << BLOCK_BITS).groupBy("conv_id", "member", "turns", "block")
    long = long.agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    earlier = Window.partitionBy("member").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = long.withColumns({h: F.bit_xor(h).over(earlier) for h in ("h1", "h2")}).where(F.col("block") > 0)
    later = later.withColumn("position", F.shiftleft("block", BLOCK_BITS))
    zeros = {c: F.lit(0).cast("long") for c in ("block", "position", "h1", "h2")}
    heads = later.unionByName(members.withColumns(zeros)).withColumns({"words": F.lit(0).cast("long"), "head": F.lit(True)})
    every = placed.withColumn("head", F.lit(False)).unionByName(heads)
    return every.select(
        F.shiftright("member", SHARD_BITS).alias("shard"), "block", F.col("member").bitwiseAND((1 << SHARD_BITS) - 1).alias("bit"),
        "conv_id", "position", "h1", "h2", "words", "head", (F.col("position") == F.col("turns")).alias("last"),
    )


def grow(block: pa.Table) -> pa.Table:
    """The nodes of one block of a shard, by depth-first intersection."""
    index: dict[tuple, int] = defaultdict(int)  # (position, turn): the conversations that have the turn there
    roots: dict[tuple, int] = defaultdict(int)  # (position, prefix): the conversations that come by it
    here: dict[int, int] = defaultdict(int)  # position: the conversations that have a turn there
    ended: dict[int, int] = defaultdict(int)  # position: the conversations that end there
    turn_at: dict[tuple, tuple] = {}
    words_of: dict[tuple, int] = {}
    ids: dict[int, int] = {}
    first_block = block.column("block")[0].as_py() == 0
    shard = block.column("shard")[0].as_py()
    columns = ("bit", "conv_id", "position", "h1", "h2", "words", "head", "last")
    for bit, conv, position, h1, h2, words, head, last in zip(*(block.column(c).to_pylist() for c in columns)):
        one, key = 1 << bit, (position, h1, h2)
        if head:
            roots[key] |= one
            ids[bit] = conv
        else:
            index[key] |= one
            here[position] |= one
            turn_at[bit, position] = key
            words_of[key] = words
        if last and (not head or first_block):  # a later block starts where the one before has told of the end
            ended[position] |= one
    out = []
    stack = [(key, None, members, None) for key, members in roots.items()]
    while stack:
        path, parent, members, key = stack.pop()
        position, p1, p2 = path
        if parent is not None or first_block:
            up = (parent[1], parent[2]) if parent else (None, None)
            ends, low = members & ended[position], (members & -members).bit_length() - 1
            out.append((p1, p2, *up, position, members.bit_count(), ids[low], words_of[key] if key else 0, shard,
                        [ids[b] for b in set_bits(ends)]))
        rest = members & here[position + 1]
        while rest:
            turn = turn_at[(rest & -rest).bit_length() - 1, position + 1]
            child = members & index[turn]
            rest &= ~child
            stack.append(((position + 1, p1 ^ turn[1], p2 ^ turn[2]), path, child, turn))
    return pa.Table.from_pylist([dict(zip(NODE_ARROW.names, row)) for row in out], schema=NODE_ARROW)


def set_bits(bits: int) -> Iterator[int]:
    """The numbers of the set bits, ascending."""
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def subtree_sums(shared: DataFrame) -> DataFrame:
    """`leaves` and `saved` of each node added up over its subtree.

    Every round doubles the distance that sums have come from, so their number is the logarithm of the depth.
    """
    state = shared.select(*PATH, F.col("up1").alias("a1"), F.col("up2").alias("a2"), "leaves", "saved")
    while True:
        state = materialize(state, "sums")
        open_ = state.where(F.col("a1").isNotNull())
        if open_.isEmpty():
            return state.select(*PATH, "leaves", "saved")
        given = open_.groupBy("a1", "a2").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        given = given.select(F.col("a1").alias("p1"), F.col("a2").alias("p2"), "more_leaves", "more_saved")
        above = state.select(F.col("p1").alias("a1"), F.col("p2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
        state = state.join(given, PATH, "left").join(above, ["a1", "a2"], "left").select(
            *PATH, F.col("b1").alias("a1"), F.col("b2").alias("a2"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )


def trie(rows: DataFrame, convs: DataFrame) -> Trie:
    """The trie of conversations given by their turns (`conv_id`, `position` from 1 without gaps, `k1`, `k2`, `words`)
    and their lengths (`conv_id`, `turns`, also 0)."""
    shards = postings(rows, convs).groupBy("shard", "block")
    found = materialize(shards.applyInArrow(grow, NODE), "shards")
    merged = found.groupBy(*PATH).agg(
        F.max("up1").alias("up1"), F.max("up2").alias("up2"), F.max("depth").alias("depth"), F.max("words").alias("words"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum(F.size("ends")).alias("n_ends"),
    )
    nodes = materialize(merged, "nodes")
    children = nodes.where(F.col("up1").isNotNull()).groupBy(F.col("up1").alias("p1"), F.col("up2").alias("p2")).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("n_single"),
    )
    nodes = nodes.join(children, PATH, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "n_single": F.coalesce("n_single", F.lit(0)),
    })
    # below a node of one conversation there is one leaf and nothing to save: only shared nodes have sums
    shared = nodes.where(F.col("n_convs") > 1).select(
        *PATH, *PARENT, (F.col("n_single") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    parents = nodes.select(F.col("p1").alias("up1"), F.col("p2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.join(subtree_sums(shared), PATH, "left").join(parents, PARENT, "left").select(
        *PATH, *PARENT, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"), "n_ends", F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
    )
    return Trie(whole, found.where(F.size("ends") > 0).select(*PATH, "shard", "ends"))


def prefix_trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Trie:
    """The trie of all conversations: a node for each distinct sequence of first turns (role, text).

    Turns stand in the order of their number, null first, and those of equal numbers in the order of their hashes; null
    roles and texts are empty ones. Repeated rows are turns of their own. Rows without a conversation id belong to none.
    The root, of depth 0, has all conversations; without any there is no root. `saved_tokens` of a node are the words of
    the last turns of its subtree's nodes, each counted for all its conversations but one. Other columns do not matter.
    """
    rows = positions(turn_keys(turns, conv, turn, role, text))
    return trie(rows, lengths(rows))


def ends_digests(ends: DataFrame) -> DataFrame:
    """`ends_sha256` of each node with ends: SHA-256 of their ids in decimal, ascending, joined by commas.

    The ids of a node are hashed shard by shard as they come in order, never held together.
    """
    ordered = ends.repartition(*PATH).sortWithinPartitions(*PATH, "shard")

    def run(batches):
        node, digest = None, None
        for batch in batches:
            done = []
            for p1, p2, ids in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "ends"))):
                listed = ",".join(map(str, ids)).encode()
                if node == (p1, p2):
                    digest.update(b"," + listed)
                    continue
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (p1, p2), hashlib.sha256(listed)
            yield digest_batch(done)
        if node:
            yield digest_batch([(*node, digest.hexdigest())])
        release_memory()

    return ordered.mapInArrow(run, "p1 long, p2 long, ends_sha256 string")


def digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    p1, p2, digests = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(p1, pa.int64()), pa.array(p2, pa.int64()), pa.array(digests, pa.string())], ["p1", "p2", "ends_sha256"]
    )
