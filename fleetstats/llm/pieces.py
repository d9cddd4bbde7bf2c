"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of such a vocabulary goes on beyond a whitespace marker, so a text falls into chunks, each a run of markers
and the word behind it, that are segmented apart. Some megabytes of text make one table: its distinct chunks are
segmented once by the library, and the ids are joined back to every place a chunk stands at.

The vocabulary file is read once, on the driver, and sent to the workers.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass, field
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as protocol

from fleetstats.llm.common import add_columns

MARK = "▁"

# Texts that share a table, chunks a worker remembers beyond it, and how long those may be.
TABLE_BYTES = 8 << 20
REMEMBERED = 200_000
REMEMBERED_LENGTH = 64

LONG_TEXT = 1 << 20

# A chunk behind its first marker, which the library puts before every text by itself.
CHUNK = re.compile(" ( *[^ ]*)")


@dataclass
class Model:
    """A vocabulary, and the chunks a worker has met: ids as 32-bit numbers, and the text they decode to."""

    library: sentencepiece.SentencePieceProcessor
    marked: np.ndarray  # whether a piece begins with a marker
    control: np.ndarray
    met: dict[str, tuple[bytes, str]] = field(default_factory=dict)


@functools.lru_cache(maxsize=4)
def load(content: bytes) -> Model:
    """The model of a vocabulary file, once per process.

    Raises ValueError if its pieces may cross a marker, or if it changes texts by more than writing blanks as markers:
    then chunks cannot be told before segmenting.
    """
    spec = protocol.ModelProto.FromString(content)
    library = sentencepiece.SentencePieceProcessor(model_proto=content)
    pieces = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    n = spec.normalizer_spec
    if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix:
        raise ValueError("the vocabulary normalizes texts")
    if any(MARK in p.lstrip(MARK) for p in pieces) or not spec.trainer_spec.byte_fallback:
        raise ValueError("pieces cross whitespace markers, or characters may be unknown")
    control = [library.is_control(i) for i in range(len(pieces))]
    return Model(library, np.array([p.startswith(MARK) for p in pieces]), np.array(control))


def chunks(text: str):
    """The chunks of a text in order, each without its first marker; an empty text has none."""
    if MARK in text:
        text = text.replace(MARK, " ")
    if not text:
        return []
    if len(text) >= LONG_TEXT:
        return (found[1] for found in CHUNK.finditer(" " + text))
    if text[0] != " " and "  " not in text:
        return text.split(" ")
    return CHUNK.findall(" " + text)


def segment(model: Model, found: list[str]) -> list[tuple[bytes, str]]:
    """Ids and decoded text of each of some distinct chunks; those a worker has met are looked up."""
    met, library = model.met, model.library
    new = [c for c in found if c not in met]
    if new:
        ids = library.encode(new, out_type=int, num_threads=1)
        alone = library.piece_to_id(MARK)
        ids = [i or [alone] for i in ids]  # only the empty chunk has none: a marker by itself
        raw = np.fromiter(chain.from_iterable(ids), "<i4").tobytes()
        ends = (4 * np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))).tolist()
        decoded = library.decode(ids, num_threads=1)
        made = {c: (raw[a:b], " " + t) for c, a, b, t in zip(new, [0, *ends], ends, decoded)}
        if len(met) + len(new) > REMEMBERED:
            kept = {c: met[c] for c in found if c in met}
            met.clear()
        else:
            kept = met
        out = [made.get(c) or kept[c] for c in found]
        if len(new) <= REMEMBERED:
            met.update((c, v) for c, v in made.items() if len(c) <= REMEMBERED_LENGTH)
        return out
    return [met[c] for c in found]


class Numbers(dict):
    """Numbers chunks in the order they come."""

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        return number


class Table:
    """The distinct chunks of some texts, numbered as they come."""

    def __init__(self, model: Model):
        self.model, self.number = model, Numbers()

    def places(self, text: str | None) -> np.ndarray:
        """The number of the chunk at each place of a text."""
        return np.fromiter(map(self.number.__getitem__, chunks(text or "")), dtype=np.int64)

    def segmented(self) -> tuple[np.ndarray, np.ndarray, tuple[str, ...]]:
        """The ids of all chunks one after the other, how many each has, and its text."""
        rows = segment(self.model, list(self.number))
        ids, texts = zip(*rows) if rows else ((), ())
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        return np.frombuffer(b"".join(ids), "<i4"), lengths, texts


def at_places(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The ids of the chunks at some places, in a row."""
    own = lengths[places]
    ends = np.cumsum(own)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts[places] - ends + own, own)]


def encode_texts(content: bytes, texts: list[str | None], control: bool = True) -> tuple[list[np.ndarray], list[str]]:
    """Ids of each text, between the begin and the end id if asked for, and what they decode to."""
    model = load(content)
    table = Table(model)
    placed = [table.places(t) for t in texts]
    flat, lengths, surface = table.segmented()
    starts = np.cumsum(lengths) - lengths
    begin, end = ([model.library.bos_id()], [model.library.eos_id()]) if control else ([], [])
    ids = [np.concatenate([begin, at_places(flat, starts, lengths, p), end]).astype("<i4") for p in placed]
    decoded = ["".join(map(surface.__getitem__, p.tolist()))[1:] for p in placed]
    return ids, decoded


def decode_rows(content: bytes, rows: list) -> list[str | None]:
    """The text of each row of ids: cut before pieces that begin with a marker and at control ids; each distinct part is
    decoded once."""
    model = load(content)
    table: dict[bytes, int] = {}
    placed = []
    for row in rows:
        ids = np.array([] if row is None else row, dtype="<i4")
        text = np.flatnonzero(~model.control[ids])
        ids = ids[text[0] if len(text) else len(ids):]  # control ids ahead leave no trace; later ones end runs of bytes
        raw, marked = ids.tobytes(), model.marked[ids]
        cuts = sorted({0, len(ids), *np.flatnonzero(marked | model.control[ids]).tolist()})
        parts = [table.setdefault(raw[4 * a:4 * b], len(table)) for a, b in zip(cuts, cuts[1:])]
        placed.append(list(zip(parts, [False, *marked[cuts[1:-1]].tolist()])))
    decoded = model.library.decode([np.frombuffer(raw, "<i4").tolist() for raw in table], num_threads=1) if table else []
    return [
        None if row is None else "".join([" " + decoded[i] if marked else decoded[i] for i, marked in parts])
        for row, parts in zip(rows, placed)
    ]


def read_model(path: str) -> bytes:
    return Path(path).read_bytes()


def encode(
    docs: DataFrame, path: str, text: str = "text", out: str | None = "ids", packed: str | None = None,
    decoded: str | None = None, control: bool = True,
) -> DataFrame:
    """The rows with the ids of their text, as numbers and, if asked for, packed as little-endian 32-bit numbers.

    `decoded` names a column for the text that the ids decode to: the text itself, with U+2581 as a blank. A null text
    is encoded as an empty one; that has the begin and end ids alone (none without `control`). Strings such as `<s>`
    inside a text are ordinary text. Rows are independent of each other: repeated rows give repeated results, an empty
    table an empty one; very long texts are cut into chunks one at a time. An input column of the name of an added
    one is replaced.
    """
    fields = [(out, T.ArrayType(T.IntegerType())), (packed, T.BinaryType()), (decoded, T.StringType())]
    model = docs.sparkSession.sparkContext.broadcast(read_model(path))

    def compute(texts):
        ids, texts = encode_texts(model.value, texts, control)
        columns = []
        if out:
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, "<i4"), *ids])
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
        if packed:
            columns.append([i.tobytes() for i in ids])
        return columns + ([texts] if decoded else [])

    added = T.StructType([T.StructField(name, kind, False) for name, kind in fields if name])
    return add_columns(docs, text, added, compute, TABLE_BYTES)


def decode(docs: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the text of their ids as the library decodes them; null ids give null, no ids the empty text."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(path))
    added = T.StructType([T.StructField(out, T.StringType(), True)])
    return add_columns(docs, ids, added, lambda rows: [decode_rows(model.value, rows)])
