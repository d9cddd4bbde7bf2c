"""Periodic runs against all lags at all places."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from fleetstats.llm import periodic
from fleetstats.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def all_runs(words):
    """(start, length, period), by comparing words at every lag from every place on."""
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > s and i - s + q >= max(12, 2 * q):
                out.setdefault((s, i - s + q), q)
            i += i == s
    return sorted((s, n, q) for (s, n), q in out.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    n, kinds = rng.choice([0, 1, 5, 12, 30, 80, 150]), rng.choice([1, 2, 3, 10, 60])
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n > 6 else 0):
        a, p = rng.randrange(n), rng.randint(1, n // 3)
        for i in range(a, min(n, a + rng.randint(0, n))):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("pairs", [1, 50, 1 << 20])
def test_runs_of_random_words(monkeypatch, pairs):
    monkeypatch.setattr(periodic, "PAIRS", pairs)
    rng = random.Random(11)
    for _ in range(150):
        texts = [random_words(rng) for _ in range(rng.randint(1, 4))]
        found, left = periodic.collapse_texts([" ".join(w) for w in texts])
        assert found == [all_runs(w) for w in texts]
        assert [t.decode() for t in left] == [collapsed(w, r) for w, r in zip(texts, found)]


def test_runs_inside_runs():
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for words in (list(fibonacci[-1]), list("ab" * 40 + "c" + "ab" * 40), ["x"] * 100, list("aab" * 9 + "aabaac" * 9)):
        found, _ = periodic.collapse_texts([" ".join(words)])
        assert found == [all_runs(words)]


def test_long_texts_take_little_time(monkeypatch):
    monkeypatch.setattr(periodic, "LONG_TEXT", 1000)
    period = [f"v{i}" for i in range(60001)]
    began = time.perf_counter()
    for words, q in ((["same"] * 300000, 1), (period * 3, 60001)):
        (runs,), (left,) = periodic.collapse_texts([" ".join(words)])
        assert runs == [(0, len(words), q)] and left.decode() == " ".join(words[:q])
    assert time.perf_counter() - began < 30


def test_odd_rows(odd, none, odd_rows):
    rows = periodic.collapse_runs(odd).collect()
    assert len(rows) == len(odd_rows) and rows[0]["n_words"] == "clash"
    for r in rows:
        words = WORD.findall(r["text"] or "")
        runs = [tuple(x) for x in r["runs"]]
        assert len(words) > 2000 or runs == all_runs(words)
        assert r["collapsed"] == collapsed(words, runs)
    assert periodic.collapse_runs(none).collect() == []


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    return words


def lag_runs(words):
    """`all_runs` for longer texts: whole arrays are compared at each lag."""
    number = {}
    w = np.array([number.setdefault(x, len(number)) for x in words])
    out = {}
    for q in range(1, len(w) // 2 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], w[:-q] == w[q:], [0]])))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if e - s + q >= max(12, 2 * q):
                out.setdefault((s, e - s + q), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for i, text in docs:
        words, r = planted(i, text), found[i]
        runs = lag_runs(words)
        longest = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == (longest or (None, None, None))
        assert r["exponent_milli"] == (longest and 1000 * longest[1] // longest[2])
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
