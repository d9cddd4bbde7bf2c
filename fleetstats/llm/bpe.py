"""BPE encoding and decoding through an index of pair occurrences.

The distinct words of a part of a partition stand in one array of symbols. Every pair of neighbours that the
merge table knows is filed under its rank with all its positions. The active ranks are applied in ascending
order, each to all its positions at once, and ranks that cannot make each other's pairs together; a merge files
the two new pairs it makes. A word is segmented once however often it occurs.

Vocabulary files are given by path (see ``public_tokenizers``); ids, pieces and the treatment of special
strings are those of the published tokenizers.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetstats.llm.common import add_columns

# How the two vocabularies split text into words (\s and \p{White_Space} are the same there).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
BYTE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

# Texts segmented together, and words whose pieces a worker remembers.
CHUNK_BYTES = 4 << 20
REMEMBERED = 100_000

LONG_TEXT = 1 << 20

UNKNOWN = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next free one above 255."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    symbols, spare = [], 256
    for b in range(256):
        symbols.append(chr(b) if b in printable else chr(spare))
        spare += b not in printable
    return symbols


@dataclass
class Vocabulary:
    """A merge table, and how its tokenizer prepares text."""

    tokens: list[str]
    first: np.ndarray  # id of each byte inside a word
    last: np.ndarray  # id of each byte at the end of a word
    keys: np.ndarray  # sorted pairs, left id * size + right id
    rank_of_key: np.ndarray
    left: np.ndarray  # by rank
    right: np.ndarray
    merged: np.ndarray
    block_of_rank: np.ndarray
    special: dict[str, int]
    words: regex.Pattern
    normalize: bool
    pieces: dict[str, bytes] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def size(self) -> int:
        return len(self.tokens)

    @functools.cached_property
    def special_pattern(self):
        return regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")


def blocks(left: list[int], right: list[int], merged: list[int]) -> np.ndarray:
    """For each rank its block: a new one begins where a rank uses a symbol that the current one makes."""
    out, made, block = [], set(), 0
    for a, b, m in zip(left, right, merged):
        if a in made or b in made:
            made, block = set(), block + 1
        made.add(m)
        out.append(block)
    return np.array(out, dtype=np.int32)


@functools.lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """The vocabulary of a tokenizer file, once per process."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    suffix = model.get("end_of_word_suffix") or ""
    ids = dict(model["vocab"])
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in [*ids.items(), *special.items()]:
        tokens[i] = token
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left = np.array([ids[a] for a, _ in pairs], dtype=np.int32)
    right = np.array([ids[b] for _, b in pairs], dtype=np.int32)
    merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int32)
    keys = left.astype(np.int64) * len(tokens) + right
    order = np.argsort(keys).astype(np.int32)
    symbols = byte_symbols()
    return Vocabulary(
        tokens=tokens,
        first=np.array([ids[s] for s in symbols], dtype=np.int32),
        last=np.array([ids[s + suffix] for s in symbols], dtype=np.int32),
        keys=keys[order], rank_of_key=order, left=left, right=right, merged=merged,
        block_of_rank=blocks(left.tolist(), right.tolist(), merged.tolist()), special=special,
        words=regex.compile(WORD_PATTERN if suffix else BYTE_PATTERN), normalize=spec.get("normalizer") is not None,
    )


class PairIndex:
    """Words as linked symbols, and for each block of ranks the positions of its pairs.

    A block is a run of ranks of which none uses a symbol that another makes. The pairs a block makes belong to later
    blocks, so its ranks can be applied together: of two pairs that share a symbol the lower rank goes first, and
    of equal ranks the left one.
    """

    def __init__(self, vocabulary: Vocabulary, words: list[bytes]):
        self.v = vocabulary
        lengths = np.fromiter(map(len, words), dtype=np.int32, count=len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        self.ends = np.cumsum(lengths)
        n = len(data)
        self.symbol = vocabulary.first[data]
        self.symbol[self.ends - 1] = vocabulary.last[data[self.ends - 1]]
        self.after = np.arange(1, n + 1, dtype=np.int32)
        self.after[self.ends - 1] = -1
        self.before = np.arange(-1, n - 1, dtype=np.int32)
        self.before[self.ends - lengths] = -1
        self.due = np.full(n + 1, UNKNOWN, dtype=np.int32)  # the rank due at a position; the last one stands for none
        self.filed: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.active: list[int] = []
        self._file(np.flatnonzero(self.after >= 0).astype(np.int32))

    def _file(self, positions: np.ndarray) -> None:
        """Put the pairs that begin at these positions under the blocks of their ranks."""
        key = self.symbol[positions].astype(np.int64) * self.v.size + self.symbol[self.after[positions]]
        at = np.minimum(np.searchsorted(self.v.keys, key), len(self.v.keys) - 1)
        known = self.v.keys[at] == key
        ranks, positions = self.v.rank_of_key[at[known]], positions[known]
        if not len(ranks):
            return
        blocks = self.v.block_of_rank[ranks]
        order = np.argsort(blocks, kind="stable")
        blocks, ranks, positions = blocks[order], ranks[order], positions[order]
        starts = np.flatnonzero(np.diff(blocks, prepend=-1))
        for block, a, b in zip(blocks[starts].tolist(), starts, [*starts[1:], len(blocks)]):
            if block not in self.filed:
                self.filed[block] = []
                heapq.heappush(self.active, block)
            self.filed[block].append((positions[a:b], ranks[a:b]))

    def _present(self, at: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that still stand."""
        following = self.after[at]
        stands = (following >= 0) & (self.symbol[at] == self.v.left[ranks])
        stands &= self.symbol[following] == self.v.right[ranks]
        return at[stands], ranks[stands]

    def merge(self) -> None:
        """Apply the active ranks in ascending order."""
        while self.active:
            groups = self.filed.pop(heapq.heappop(self.active))
            at, ranks = self._present(*map(np.concatenate, zip(*groups)))
            made = []
            while len(at):
                self.due[at] = ranks
                ready = (self.due[self.before[at]] > ranks) & (self.due[self.after[at]] >= ranks)
                self.due[at] = UNKNOWN
                now, merged = at[ready], self.v.merged[ranks[ready]]
                gone = self.after[now]
                beyond = self.after[gone]
                self.symbol[now] = merged
                self.symbol[gone] = -1
                self.after[now] = beyond
                self.before[beyond[beyond >= 0]] = now[beyond >= 0]
                made.append(now)
                at, ranks = self._present(at[~ready], ranks[~ready])
            if made:
                new = np.concatenate(made)
                new = new[self.symbol[new] >= 0]
                new = np.unique(np.concatenate([new, self.before[new]]))
                self._file(new[(new >= 0) & (self.after[new] >= 0)])

    def counts(self) -> list[int]:
        """The number of symbols that each word has left."""
        return np.diff(np.concatenate([[0], np.cumsum(self.symbol >= 0)])[self.ends], prepend=0).tolist()

    def pieces(self) -> list[bytes]:
        """The ids of each word, as 32-bit numbers."""
        alive = self.symbol >= 0
        ends = (4 * np.concatenate([[0], np.cumsum(alive)])[self.ends]).tolist()
        raw = self.symbol[alive].tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]


def segment(v: Vocabulary, words: list[str]) -> list[bytes]:
    """The ids of each of some distinct words; those a worker has met lately are looked up."""
    pieces = v.pieces
    new = [w for w in words if w not in pieces]
    if new:
        index = PairIndex(v, [w.encode("utf-8", "surrogatepass") for w in new])
        index.merge()
        if len(pieces) + len(new) > REMEMBERED:
            met = {w: pieces[w] for w in words if w in pieces}
            pieces.clear()
            pieces.update(met)
        pieces.update(zip(new, index.pieces()))
    return [pieces[w] for w in words]


def lowered(text: str) -> str:
    """Lower case, each character by itself: a final sigma is not told from others."""
    return text.lower() if text.isascii() else text.replace("Σ", "σ").lower()


def words_of(v: Vocabulary, text: str):
    """The words of a text; those of a long one are not all held at once."""
    return v.words.findall(text) if len(text) < LONG_TEXT else (found[0] for found in v.words.finditer(text))


def parts(v: Vocabulary, text: str):
    """The words of a text in order, as (special id, None) or (None, words)."""
    at = 0
    for found in v.special_pattern.finditer(text):
        yield None, words_of(v, prepared(v, text[at:found.start()]))
        yield v.special[found[0]], None
        at = found.end()
    yield None, words_of(v, prepared(v, text[at:] if at else text))


def prepared(v: Vocabulary, text: str) -> str:
    if not v.normalize:
        return text
    return lowered(text if text.isascii() else unicodedata.normalize("NFC", text))


class Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Numbering:
    """The words of texts by number; special tokens have numbers of their own below zero."""

    def __init__(self, v: Vocabulary):
        self.v, self.numbers = v, Numbers()

    def of(self, text: str | None) -> np.ndarray:
        out = []
        for special, words in parts(self.v, text or ""):
            if words is None:
                out.append(np.array([-1 - special], dtype=np.int64))
            else:
                out.append(np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64))
        return out[0] if len(out) == 1 else np.concatenate(out)

    def words(self) -> list[str]:
        return list(self.numbers)


def encode_texts(path: str, texts: list[str | None]) -> list[np.ndarray]:
    """The ids of each text."""
    v = load(path)
    numbering = Numbering(v)
    numbered = [numbering.of(t) for t in texts]
    # special tokens stand at the end, so that -1 - id finds them from there
    pieces = segment(v, numbering.words()) + [np.int32(i).tobytes() for i in range(v.size - 1, -1, -1)]
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // 4
    starts = np.cumsum(lengths) - lengths
    flat = np.frombuffer(b"".join(pieces), dtype=np.int32)
    out = []
    for words in numbered:
        own = lengths[words]
        ends = np.cumsum(own)
        total = int(ends[-1]) if len(ends) else 0
        out.append(flat[np.arange(total) + np.repeat(starts[words] - ends + own, own)])
    return out


def decode_ids(path: str, ids) -> str:
    """The text of some ids as a tokenizer without a decoder writes it: its tokens joined by spaces."""
    tokens = load(path).tokens
    return " ".join([tokens[i] for i in ids])


def list_array(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *rows])))


def encode(
    docs: DataFrame, path: str, text: str = "text", out: str = "ids", decoded: str | None = None
) -> DataFrame:
    """The rows with the token ids of their text, and if asked for with the text that these ids decode to.

    A null text is encoded as an empty one; an empty text has no ids. Rows are independent of each other: repeated
    rows give repeated results, an empty table an empty one. Special strings inside a text become special ids.
    """
    fields = [T.StructField(out, T.ArrayType(T.IntegerType()), False)]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType(), False))

    def compute(texts):
        ids = encode_texts(path, texts)
        return [list_array(ids), *([[decode_ids(path, r.tolist()) for r in ids]] if decoded else [])]

    return add_columns(docs, text, T.StructType(fields), compute, CHUNK_BYTES)


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the text of their token ids; null ids give null, no ids the empty text."""
    added = T.StructType([T.StructField(out, T.StringType(), True)])

    def compute(rows):
        return [[None if r is None else decode_ids(path, r) for r in rows]]

    return add_columns(docs, ids, added, compute)
