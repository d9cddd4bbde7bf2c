"""Conversation prefixes against a plain trie."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from fleetstats.llm import common, prefix_trie
from fleetstats.llm.queries import QUERIES

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, n_convs string, p1 string, words map<string,string>"


def ordered(rows):
    """The turns of each conversation as (role, text)."""
    out = defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out[conv].append((role or "", text or ""))
    return out


def rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + own[h:]
    return out


def plain_trie(turns):
    members, ends = defaultdict(list), defaultdict(list)
    for c, said in sorted(turns.items()):
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
        ends[tuple(said)].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        saved[path] = (len(members[path]) - 1) * words + sum(saved[c] for c in children[path])
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()) for p, m in members.items()
    )


def nodes(found):
    digests = prefix_trie.ends_digests(found.ends)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    whole = found.nodes.join(digests, prefix_trie.PATH, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    return sorted(tuple(r) for r in whole.select(COLUMNS).collect())


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-45, 90), 60):
        n = rng.choice([1, 2, 3, 5, 9])
        numbers = rng.sample(range(-600, 600), n)
        if rng.random() < 0.2:
            numbers[0] = None
        for i, turn in enumerate(sorted(numbers, key=lambda t: (t is not None, t or 0))):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["", None, "a b", "a  b\n", "c", f"own {c}"])
                         if i > 1 else "hello there"))
    rows += [(200 + i, t, "user", f"turn {t}") for i in range(3) for t in range(40 - i)]
    rows += [(None, 1, "user", "no conversation"), (300, 1, "user", "twice"), (300, 1, "user", "twice"), (301, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def table(spark):
    common.text_session(spark)

    def make(rows):
        return spark.createDataFrame([(*r, "clash", "clash", {"a": "b"}) for r in rows], SCHEMA).repartition(3)

    return make


@pytest.mark.parametrize("bits", [(10, 8), (1, 1)])
def test_trie(table, monkeypatch, bits):
    """Also with two conversations to a shard and two positions to a block."""
    monkeypatch.setattr(prefix_trie, "SHARD_BITS", bits[0])
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", bits[1])
    rows = random_rows(bits[0])
    assert nodes(prefix_trie.prefix_trie(table(rows))) == plain_trie(ordered(rows))


def test_ties_are_ordered_alike_in_all_conversations(table):
    rows = [(c, 1, "user", t) for c in (1, 2) for t in ("x", "y", "z")]
    found = nodes(prefix_trie.prefix_trie(table(rows)))
    assert [(r[1], r[3]) for r in sorted(found, key=lambda r: r[1])] == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_no_conversations(table):
    assert nodes(prefix_trie.prefix_trie(table([]))) == []
    assert nodes(prefix_trie.prefix_trie(table([(None, 1, "user", "x")]))) == []


def test_query(spark, sf_dir, table, tmp_path):
    assert compare(QUERIES["op12_prefix_trie"](spark, sf_dir), connect(sf_dir), "op12_prefix_trie") is None
    rows = random_rows(4)
    table(rows).write.parquet(f"{tmp_path}/conversations.parquet")
    found = QUERIES["op12_prefix_trie"](spark, str(tmp_path))
    expected = rebuilt(ordered(rows))
    assert [] in expected.values()
    assert sorted(tuple(r) for r in found.select(COLUMNS).collect()) == plain_trie(expected)
