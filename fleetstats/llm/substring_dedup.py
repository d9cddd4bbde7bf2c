"""Removal of repeated token windows.

Rabin-Karp hashes of all windows of a fixed number of words are counted in Spark. A task gathers the windows of
some texts, keeps for each distinct window its smallest document and sends the sorted hashes, packed, to the task
that owns their range of hashes. So a window that a third of all documents hold is one entry per part of the
input. The owner answers, by blocks of documents, which of their windows start in a smaller document too; each text
then merges its repeated windows into maximal intervals and drops the words they cover.

Ranges follow the number of words in the corpus; where there would be more of them than `FAN_OUT`, windows are
dealt out in several rounds.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fleetstats.llm.common import add_columns, chunks, fresh, release_memory

CHUNK_BYTES = 6 << 20  # texts whose windows are gathered before they are sent
RANGE_CHARS = 6_000_000  # characters of the corpus to one range of hashes: about a million windows
FAN_OUT = 512  # ranges that a task writes to at once

PIECE_BYTES = 1 << 20  # of a text that are hashed at once
SPACE = re.compile(rb"[\x20\x09-\x0D]")

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
BYTE_BASE = np.uint64(0x00000100000001B3)

NO_ENTRIES = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def inverse(base: np.uint64) -> np.uint64:
    """The inverse of an odd number modulo 2**64."""
    return np.uint64(pow(int(base), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word: bytes between space, tab, and the four line breaks of ASCII."""
    b = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = (b != 32) & ((b < 9) | (b > 13))
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def rolling(values: np.ndarray, base: np.uint64) -> np.ndarray:
    """Prefix sums of values times ascending powers of the base."""
    return np.concatenate([[np.uint64(0)], np.cumsum(values * powers(base, len(values)), dtype=np.uint64)])


def pieces(data: bytes) -> Iterator[bytes]:
    """A long text in pieces, cut between words."""
    at = 0
    while len(data) - at > PIECE_BYTES:
        gap = SPACE.search(data, at + PIECE_BYTES)
        if not gap:
            break
        yield data[at:gap.start()]
        at = gap.end()
    yield data[at:] if at else data


def word_hashes(data: bytes) -> np.ndarray:
    """64 bits for each word of a text, the same wherever the word stands."""
    if len(data) > PIECE_BYTES:
        return np.concatenate([hashes_of_piece(p) for p in pieces(data)])
    return hashes_of_piece(data)


def hashes_of_piece(data: bytes) -> np.ndarray:
    starts, ends = word_spans(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = rolling(np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1), BYTE_BASE)
    back = powers(inverse(BYTE_BASE), len(data) + 1)
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * BASE)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The Rabin-Karp hash of each window of `width` words, by the position of its first word."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = rolling(words, BASE)
    return mixed((sums[width:] - sums[:-width]) * powers(inverse(BASE), n))


def text_windows(text: str | None, width: int) -> np.ndarray:
    return window_hashes(word_hashes((text or "").encode("utf-8", "surrogatepass")), width)


def packed(values: np.ndarray, ids: np.ndarray) -> bytes:
    """Sorted hashes as differences, and their document ids, by byte planes."""
    least = int(ids.min())
    steps = np.diff(values, prepend=np.uint64(0))
    planes = [np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T) for x in (steps, ids - least)]
    body = b"".join(p.tobytes() for p in planes)
    return struct.pack("<Iq", len(values), least) + zstandard.ZstdCompressor(level=1).compress(body)


def unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, least = struct.unpack_from("<Iq", payload)
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload[12:]), dtype=np.uint8).reshape(2, 8, n)
    steps, ids = (np.ascontiguousarray(plane.T).view("<u8").ravel() for plane in body)
    return np.cumsum(steps, dtype=np.uint64), ids.astype(np.int64) + least


def by_value(values: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries in the order of their hashes, equal ones by document."""
    order = np.argsort(values, kind="stable")
    values, ids = values[order], ids[order]
    tied = np.flatnonzero(values[1:] == values[:-1])
    if len(tied) and (ids[tied + 1] < ids[tied]).any():
        order = np.lexsort((ids, values))
        values, ids = values[order], ids[order]
    return values, ids


def split_by_smallest(values: np.ndarray, ids: np.ndarray):
    """Of sorted entries: one per hash with its smallest document, and the entries with a larger one."""
    if not len(values):
        return NO_ENTRIES, NO_ENTRIES
    first = np.concatenate([[True], values[1:] != values[:-1]])
    least = ids[first][np.cumsum(first) - 1]
    later = ids > least
    return (values[first], ids[first]), (values[later], ids[later])


def range_rows(values: np.ndarray, ids: np.ndarray, bits: int, done: int) -> Iterator[tuple[int, bytes]]:
    """Sorted entries by ranges, named by the `bits` bits after the first `done` ones and those."""
    names = values >> np.uint64(64 - done - bits) if done + bits else np.zeros(len(values), np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else []
    for a, b in zip(starts, [*starts[1:], len(names)]):
        yield int(names[a]), packed(values[a:b], ids[a:b])


def block_rows(values: np.ndarray, ids: np.ndarray, blocks: int) -> Iterator[tuple[int, bytes]]:
    """Answers, the windows of documents that are to go, by blocks of documents."""
    names = (mixed(ids.astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)
    order = np.lexsort((values, names))
    names, values, ids = names[order], values[order], ids[order]
    starts = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else []
    for a, b in zip(starts, [*starts[1:], len(names)]):
        yield int(names[a]), packed(values[a:b], ids[a:b])


# Rows that travel: entries of a range of hashes, or answers for a block of documents that are known already.
TRAVELLING = T.StructType([
    T.StructField("range", T.LongType(), False), T.StructField("known", T.BooleanType(), False),
    T.StructField("payload", T.BinaryType(), False),
])
BLOCKS = T.StructType([T.StructField("block", T.LongType(), False), T.StructField("payload", T.BinaryType(), False)])
ANSWERS = T.StructType([T.StructField("doc", T.LongType(), False), T.StructField("hashes", T.BinaryType(), False)])


def rows_of(schema: T.StructType, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    types = to_arrow_schema(schema).types
    for i in range(0, len(rows), 256):
        columns = [pa.array(c, t) for c, t in zip(zip(*rows[i:i + 256]), types)]
        yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())


def sent(values: np.ndarray, ids: np.ndarray, bits: int, done: int, blocks: int) -> Iterator[pa.RecordBatch]:
    """Entries to the owners of their ranges; what is decided already goes along as answers."""
    (values, ids), later = split_by_smallest(*by_value(values, ids))
    rows = [(name, False, p) for name, p in range_rows(values, ids, bits, done)]
    # answers ride with any range: with the one that has the first bits of their block's number
    rows += [(name * (1 << (done + bits)) // blocks, True, struct.pack("<q", name) + p)
             for name, p in block_rows(*later, blocks)]
    yield from rows_of(TRAVELLING, rows)


def repeated_windows(docs: DataFrame, width: int, id_col: str, text: str) -> DataFrame:
    """For each document the hashes of its windows that start in a document with a smaller id too."""
    chars = docs.agg(F.sum(F.length(text).cast("double"))).first()[0] or 0.0
    total_bits = max(0, math.ceil(math.log2(max(1.0, chars / RANGE_CHARS))))
    rounds = max(1, math.ceil(total_bits / math.log2(FAN_OUT)))
    widths = [total_bits * (i + 1) // rounds - total_bits * i // rounds for i in range(rounds)]
    blocks = 1 << total_bits

    def gather(batches):
        for table in chunks(batches, text, CHUNK_BYTES):
            ids = np.array(table.column(id_col).to_pylist(), dtype=np.int64)
            hashes = [text_windows(t.as_py(), width) for t in table.column(text)]
            if sum(map(len, hashes)):
                yield from sent(np.concatenate(hashes), np.repeat(ids, list(map(len, hashes))), widths[0], 0, blocks)
        release_memory()

    def resend(bits, done):
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in batches:
                for name, known, payload in zip(*(c.to_pylist() for c in batch.columns)):
                    if known:
                        block = struct.unpack_from("<q", payload)[0]
                        yield from rows_of(TRAVELLING, [(block * (1 << (done + bits)) // blocks, True, payload)])
                        continue
                    held.append(unpacked(payload))
                    size += len(held[-1][0])
                    if size >= 1_000_000:
                        yield from sent(*map(np.concatenate, zip(*held)), bits, done, blocks)
                        held, size = [], 0
            if held:
                yield from sent(*map(np.concatenate, zip(*held)), bits, done, blocks)
        return deal

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for known, payload in zip(batch.column("known").to_pylist(), batch.column("payload").to_pylist()):
                if known:
                    yield from rows_of(BLOCKS, [(struct.unpack_from("<q", payload)[0], payload[8:])])
                else:
                    held.append(unpacked(payload))
        if held:
            _, later = split_by_smallest(*by_value(*map(np.concatenate, zip(*held))))
            yield from rows_of(BLOCKS, list(block_rows(*later, blocks)))

    def by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [unpacked(p) for batch in batches for p in batch.column("payload").to_pylist()]
        values, ids = map(np.concatenate, zip(*held))
        order = np.argsort(ids, kind="stable")
        values, ids = values[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        rows = [(int(ids[a]), values[a:b].tobytes()) for a, b in zip(starts, [*starts[1:], len(ids)])]
        yield from rows_of(ANSWERS, rows)

    texts = docs.select(F.col(id_col).cast("long").alias(id_col), text).where(F.col(id_col).isNotNull())
    sent_rows = texts.mapInArrow(gather, TRAVELLING)
    done = widths[0]
    for bits in widths[1:]:
        sent_rows = sent_rows.groupBy("range").applyInArrow(resend(bits, done), TRAVELLING)
        done += bits
    return sent_rows.groupBy("range").applyInArrow(resolve, BLOCKS).groupBy("block").applyInArrow(by_document, ANSWERS)


def kept_words(text: str | None, answer: bytes | None, width: int) -> tuple[int, int, str, list[dict]]:
    """Number of words, of removed words, the kept words joined by spaces, and the removed intervals."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not answer:
        return len(words), 0, b" ".join(words).decode("utf-8", "surrogatepass"), []
    gone = np.frombuffer(answer, dtype=np.uint64)
    starts = np.flatnonzero(np.isin(window_hashes(word_hashes(data), width), gone))
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + width, -1)
    removed = np.cumsum(cover)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], removed.view(np.int8), [0]])))
    kept = b" ".join([w for w, r in zip(words, removed.tolist()) if not r])
    intervals = [{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)]
    return len(words), int(removed.sum()), kept.decode("utf-8", "surrogatepass"), intervals


def substring_dedup(docs: DataFrame, width: int = 13, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with `n_words`, `n_removed`, `kept` and `removed` (word intervals, end exclusive).

    A word goes if a window of `width` consecutive words covers it whose words also start in a document with a smaller
    id. Words are the bytes between ASCII white space, compared unchanged. A null text has no words; texts shorter than
    a window are kept. Rows with a null id are kept whole and remove nothing; rows that share an id remove nothing from
    each other and lose the same windows. An empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType
    if not isinstance(id_type, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    doc, answer, pair = (fresh([*docs.columns, "n_words", "n_removed", "kept", "removed"], c) for c in ("_doc", "_answer", "_pair"))
    gone = repeated_windows(docs, width, id_col, text).select(F.col("doc").alias(doc), F.col("hashes").alias(answer))
    joined = docs.drop("n_words", "n_removed", "kept", "removed").join(gone, F.col(id_col) == F.col(doc), "left").drop(doc)
    packed_text = joined.withColumn(pair, F.struct(F.col(text).alias("text"), F.col(answer).alias("answer"))).drop(answer)
    added = T.StructType([
        T.StructField("n_words", T.LongType(), False), T.StructField("n_removed", T.LongType(), False),
        T.StructField("kept", T.StringType(), False),
        T.StructField("removed", T.ArrayType(T.StructType([
            T.StructField("start", T.IntegerType(), False), T.StructField("end", T.IntegerType(), False),
        ]), False), False),
    ])

    def compute(pairs):
        return list(map(list, zip(*(kept_words(p["text"], p["answer"], width) for p in pairs))))

    return add_columns(packed_text, pair, added, compute).drop(pair)
