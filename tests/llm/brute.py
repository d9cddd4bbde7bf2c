"""Plain versions of the text operators, over all pairs and all rows."""

from __future__ import annotations

import re
from collections import defaultdict

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return [w.decode() for w in WORD.findall((text or "").encode())]


def kept_without_substrings(docs, width=13):
    """(id, number of words, of removed words, kept text) for (id, text) rows."""
    ids = defaultdict(set)
    for i, text in docs:
        w = words(text)
        if i is not None:
            for p in range(len(w) - width + 1):
                ids[tuple(w[p:p + width])].add(i)
    out = []
    for i, text in docs:
        w = words(text)
        gone = set()
        for p in range(len(w) - width + 1):
            if i is not None and min(ids[tuple(w[p:p + width])]) < i:
                gone.update(range(p, p + width))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def lines(text):
    return text.split("\n") if text else []


def without_repeated_lines(docs, width=3):
    """[(id, text)] less the lines of repeated windows, for rows in the order of their ids."""
    first, out = {}, []
    for i, text in docs:
        own, gone = lines(text), set()
        for p in range(len(own) - width + 1):
            where = first.setdefault(tuple(own[p:p + width]), (i, p))
            if where != (i, p):
                gone.update(range(max(p, where[1] + width) if where[0] == i else p, p + width))
        out.append((i, "\n".join(x for p, x in enumerate(own) if p not in gone) if gone else text))
    return out


def simhash(text, shingle=3):
    w = [x.lower() for x in WORD.findall((text or "").encode())]
    shingles = [b" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(prints, max_bits=3):
    """The smallest position that each fingerprint reaches."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= max_bits:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(prints))]


def tokens(text):
    return [t for t in re.split(r"[\W_]+", (text or "").lower()) if t]


def overlaps(text, item, masks, window=13, agreeing=11):
    """Whether a masked window of the item is in the text, and a window around it agrees."""
    a, b = tokens(text), tokens(item)
    if len(b) < window:
        return False
    for mask in masks:
        span = mask[-1] + 1
        seeds = defaultdict(list)
        for q in range(len(b) - span + 1):
            seeds[tuple(b[q + o] for o in mask)].append(q)
        for p in range(len(a) - span + 1):
            for q in seeds.get(tuple(a[p + o] for o in mask), ()):
                for k in range(span - window, 1):
                    if min(p, q) + k >= 0 and p + k + window <= len(a) and q + k + window <= len(b):
                        if sum(a[p + k + j] == b[q + k + j] for j in range(window)) >= agreeing:
                            return True
    return False
