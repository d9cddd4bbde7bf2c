"""Runs of periodically repeated words.

A run is a stretch of words in which words `q` apart are identical, `q` being the smallest such period, of at least
`max(12, 2 * q)` words, that no neighbouring word extends.

Each word of a run occurs in it at least twice. So a text is cut at the words that occur once in it, and its segments
at the words that occur once in them, until no segment changes; this is done for the segments of many texts at once.
Ordinary prose leaves nothing. What survives is scanned lag by lag: a run of period `q` covers two successive
multiples of `q`, so only these are compared, and a match is grown both ways by comparing hashes of stretches.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fleetstats.llm.common import add_columns

LEAST_WORDS, LEAST_PERIODS = 12, 2

# Texts whose segments are split together, and pairs of positions that are compared together.
CHUNK_BYTES = 4 << 20
PAIRS = 1 << 20
LONG_TEXT = 1 << 20

WORD = re.compile(rb"[^\x20\x09-\x0D]+")  # as bytes.split() cuts

# Fixed values of the hash of a stretch: two primes below 2^31 and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1566083941)

RUN = T.StructType([
    T.StructField("start", T.LongType(), False), T.StructField("length", T.LongType(), False),
    T.StructField("period", T.LongType(), False),
])


def repeated_segments(words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The stretches, within texts that end at `ends`, whose words all occur at least twice in the stretch."""
    place = np.arange(len(words))
    segment = np.searchsorted(ends, place, side="right")
    size = int(words.max()) + 1 if len(words) else 1
    done = []
    while len(place):
        key = segment * size + words[place]
        _, back, times = np.unique(key, return_inverse=True, return_counts=True)
        kept = times[back] > 1
        # a new segment begins where the word ahead is gone, or belonged to another one
        begins = np.diff(place[kept], prepend=-2) != 1
        begins |= np.diff(segment[kept], prepend=-1) != 0
        lost = np.zeros(int(segment[-1]) + 1, dtype=bool)
        lost[segment[~kept]] = True
        whole, place = ~lost[segment[kept]], place[kept]
        segment = np.cumsum(begins) - 1
        starts = np.flatnonzero(begins)
        lengths = np.diff(starts, append=len(place))
        stable = whole[starts] if len(starts) else np.zeros(0, dtype=bool)
        long = lengths >= LEAST_WORDS
        firsts = place[starts]
        done += [(int(a), int(a + n)) for a, n in zip(firsts[stable & long], lengths[stable & long])]
        alive = (~stable & long)[segment] if len(starts) else np.zeros(0, dtype=bool)
        place, segment = place[alive], segment[alive]
        if len(segment):
            segment = np.cumsum(np.diff(segment, prepend=segment[0]) != 0)
    return sorted(done)


class Stretches:
    """Hashes by which stretches of some words are compared."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.powers, self.sums = [], []
        for prime, base in zip(PRIMES, BASES):
            powers = np.ones(self.n + 1, dtype=np.uint64)
            filled = 1
            while filled <= self.n:  # powers doubled: base^(filled + i) = base^filled * base^i
                step = min(filled, self.n + 1 - filled)
                powers[filled:filled + step] = powers[:step] * np.uint64(pow(base, filled, prime)) % np.uint64(prime)
                filled += step
            terms = (words.astype(np.uint64) + np.uint64(1)) * powers[:-1] % np.uint64(prime)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64) % np.uint64(prime)])
            self.powers.append(powers)
            self.sums.append(sums)

    def alike(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of some lengths from `a` and from `b`, each behind its `a`, agree."""
        out = np.ones(len(a), dtype=bool)
        for prime, powers, sums in zip(PRIMES, self.powers, self.sums):
            p = np.uint64(prime)
            left = (sums[a + length] + p - sums[a]) % p * powers[b - a] % p
            out &= left == (sums[b + length] + p - sums[b]) % p
        return out

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words agree from `a` and `b` on, or back from before them, `most` at the most."""
        low, high = np.zeros_like(most), most.copy()
        while len(open_ := np.flatnonzero(low < high)):
            mid = (low[open_] + high[open_] + 1) // 2
            shift = mid if back else 0
            same = self.alike(a[open_] - shift, b[open_] - shift, mid)
            low[open_[same]] = mid[same]
            high[open_[~same]] = mid[~same] - 1
        return low


def lag_scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of some words."""
    n = len(words)
    stretches = Stretches(words)
    found: dict[tuple[int, int], int] = {}
    lag = 1
    while LEAST_PERIODS * lag <= n:
        # lags whose pairs of successive multiples make up a block
        last, pairs = lag, n // lag
        while LEAST_PERIODS * (last + 1) <= n and pairs + n // (last + 1) <= PAIRS:
            last += 1
            pairs += n // last
        lags = np.arange(lag, last + 1)
        count = (n - 1) // lags
        q = np.repeat(lags, count)
        a = (np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)) * q
        same = words[a] == words[a + q]
        q, a = q[same], a[same]
        # where a whole period ahead agrees too, the pair before this one tells of the same run
        ahead = a >= q
        ahead[ahead] = stretches.alike(a[ahead] - q[ahead], a[ahead], q[ahead])
        q, a = q[~ahead], a[~ahead]
        b = a + q
        after = stretches.common(a, b, n - b, back=False)
        before = stretches.common(a, b, np.minimum(a, q - 1), back=True)
        long = before + after >= np.maximum(LEAST_WORDS - q, (LEAST_PERIODS - 1) * q)
        for start, length, period in zip((a - before)[long], (before + after + q)[long], q[long]):
            found.setdefault((int(start), int(length)), int(period))  # lags ascend: the smallest stays
        lag = last + 1
    return sorted((start, length, period) for (start, length), period in found.items())


def runs_of(words: np.ndarray, ends: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some texts, given one after the other as numbered words; starts count from their text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in ends]
    for a, b in repeated_segments(words, ends):
        text = int(np.searchsorted(ends, a, side="right"))
        first = int(ends[text - 1]) if text else 0
        out[text] += [(start + a - first, length, period) for start, length, period in lag_scan(words[a:b])]
    return out


def kept_places(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """The places of n words that no run contains behind its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    start, length, period = np.array(runs).T
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.flatnonzero(np.cumsum(change[:-1]) == 0)


class Words(dict):
    """Numbers words in the order they come; those of a long text are not all held at once."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number

    def of(self, text: bytes) -> np.ndarray:
        found = text.split() if len(text) < LONG_TEXT else (m[0] for m in WORD.finditer(text))
        return np.fromiter(map(self.__getitem__, found), dtype=np.int64)


def joined(vocabulary: list[bytes], words: np.ndarray) -> bytes:
    """Numbered words joined by one blank."""
    parts = (words[i:i + LONG_TEXT].tolist() for i in range(0, len(words), LONG_TEXT))
    return b" ".join([b" ".join([vocabulary[w] for w in part]) for part in parts])


def collapse_texts(texts: list[str | None]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """The runs of each text, and what is left of it."""
    numbers = Words()
    words = [numbers.of((t or "").encode()) for t in texts]
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    found = runs_of(np.concatenate([np.zeros(0, dtype=np.int64), *words]), ends)
    vocabulary = list(numbers)
    left = [joined(vocabulary, w[kept_places(len(w), r)] if r else w) for w, r in zip(words, found)]
    return found, left


def collapse_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """The rows with the runs of their text, by start and period, and the text of the words that stay.

    A word is dropped if a run contains it after that run's first period. Words are parted by blanks, tabs and line
    ends; those that stay are joined by one blank. A null, empty or blank text has no words and no runs, and collapses
    to the empty text. Rows are independent of each other: repeated rows give repeated results, an empty table an
    empty one. A text of n words takes about n log n steps, whatever repeats in it; its words are held as numbers. An
    input column of the name of an added one is replaced.
    """
    added = T.StructType([
        T.StructField(runs, T.ArrayType(RUN, False), False), T.StructField(collapsed, T.StringType(), False),
    ])

    def compute(texts):
        found, left = collapse_texts(texts)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
        fields = np.array([r for own in found for r in own], dtype=np.int64).reshape(-1, 3)
        structs = pa.StructArray.from_arrays(list(map(pa.array, fields.T)), fields=list(to_arrow_schema(RUN)))
        return [pa.ListArray.from_arrays(pa.array(offsets), structs), pa.array(left, type=pa.string())]

    return add_columns(docs, text, added, compute, CHUNK_BYTES)
