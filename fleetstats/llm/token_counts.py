"""Token counts without token ids.

The words (pre-tokens) of a part of a partition become two tables: the frequencies of the words per document, and the
number of pieces of each distinct word, which is the number of symbols that stand in it after the last merge. They are
joined by the number of the word and summed by document; no ids are made. A worker keeps the second table for the parts
that follow, so a word is segmented again only after it was dropped from there.

The join stays inside the task: a row of the first table is longer than the word it stands for, so shuffling them would
move more than the texts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetstats.llm.bpe import CHUNK_BYTES, Numbering, PairIndex, Vocabulary, load
from fleetstats.llm.common import add_columns

# Words whose number of pieces a worker keeps, and the longest of them.
KEPT_WORDS = 400_000
KEPT_LENGTH = 64


def count_pieces(v: Vocabulary, words: list[str]) -> np.ndarray:
    """The number of pieces of each of some distinct words."""
    known = v.counts
    new = [w for w in words if w not in known]
    counted = {}
    if new:
        index = PairIndex(v, [w.encode("utf-8", "surrogatepass") for w in new])
        index.merge()
        counted = dict(zip(new, index.counts()))
    out = np.fromiter((counted[w] if w in counted else known[w] for w in words), dtype=np.int64, count=len(words))
    if len(known) + len(counted) > KEPT_WORDS:
        known.clear()
    known.update((w, n) for w, n in counted.items() if len(w) <= KEPT_LENGTH)
    return out


def count_texts(path: str, texts: list[str | None]) -> list[int]:
    """The number of tokens of each text."""
    v = load(path)
    numbering = Numbering(v)
    frequencies = [np.unique(numbering.of(t), return_counts=True) for t in texts]
    pieces = count_pieces(v, numbering.words())
    out = []
    for words, times in frequencies:
        special = words < 0  # a special token is one piece
        out.append(int(times[special].sum() + (pieces[words[~special]] * times[~special]).sum()))
    return out


def token_counts(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """The rows with the number of tokens of their text.

    A null text counts as an empty one, which has none. Rows are independent: repeated rows give repeated results, an
    empty table an empty one. Special strings inside a text count as the tokenizer takes them, one token each. Of a very
    long text the distinct words and their frequencies are held, not its ids.
    """
    added = T.StructType([T.StructField(out, T.LongType(), False)])
    return add_columns(docs, text, added, lambda texts: [count_texts(path, texts)], CHUNK_BYTES)
