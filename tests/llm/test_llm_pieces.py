"""Pieces of the published vocabulary: against its library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from fleetstats.llm import pieces
from fleetstats.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "abcdefghij  '\n\tÀÉßıİΣςσ<|>s/0129½٣ ́ᾳ\x1c\x00!?#▁  日本🎉​"
EDGES = ["", None, " ", "  ", "a ", " a", "▁", "▁▁a", "a▁b", "x" * 70000, " " * 100, "a" + " " * 50 + "b",
         "<s>hi</s> <unk> <0x0A>", "﻿a", "a\r\nb", "naïve 日本語 🎉🎉"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def random_texts(n):
    rng = random.Random(5)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def matches(library, texts):
    ids, decoded = pieces.encode_texts(pieces.read_model(PATH), texts)
    expected = [library.encode(t or "", add_bos=True, add_eos=True) for t in texts]
    assert [i.tolist() for i in ids] == expected
    assert decoded == [library.decode(e) for e in expected]


def test_ids_are_those_of_the_library(library):
    matches(library, EDGES + random_texts(4000))


def test_a_worker_forgets_chunks_without_losing_any(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 30)
    monkeypatch.setattr(pieces, "REMEMBERED_LENGTH", 3)
    texts = random_texts(400)
    for i in range(0, 400, 40):
        matches(library, texts[i:i + 40])


def test_long_texts(library, monkeypatch):
    monkeypatch.setattr(pieces, "LONG_TEXT", 20)
    matches(library, EDGES + random_texts(500))


def test_any_ids_are_decoded_as_by_the_library(library):
    rng = random.Random(3)

    def one():
        return rng.choice([1, 2, 29871, 259, rng.randint(3, 258), rng.randint(3, 31999)])

    rows = [None, [], [1, 2], *[[one() for _ in range(rng.randint(0, 12))] for _ in range(5000)]]
    assert pieces.decode_rows(pieces.read_model(PATH), rows) == [None if r is None else library.decode(r) for r in rows]


def test_a_vocabulary_whose_pieces_cross_markers_is_refused():
    from sentencepiece import sentencepiece_model_pb2 as protocol

    spec = protocol.ModelProto.FromString(pieces.read_model(PATH))
    spec.pieces[5000].piece = "of▁the"
    with pytest.raises(ValueError, match="cross"):
        pieces.load(spec.SerializeToString())


def test_odd_rows(odd, none, odd_rows, library):
    coded = pieces.encode(odd, PATH, packed="packed", decoded="decoded")
    rows = coded.collect()
    assert len(rows) == len(odd_rows) and rows[0]["n_tokens"] == "clash" and coded.columns.count("ids") == 1
    for r in rows:
        expected = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert r["ids"] == expected == np.frombuffer(r["packed"], "<u4").tolist()
        assert r["decoded"] == library.decode(expected)
    back = pieces.decode(coded.drop("decoded"), PATH).collect()
    assert {(r["doc_id"], r["decoded"]) for r in back} == {(r["doc_id"], r["decoded"]) for r in rows}
    assert pieces.encode(none, PATH).collect() == []
    bare = pieces.encode(odd, PATH, control=False).where("text = ''").select("ids").collect()
    assert [r[0] for r in bare] == [[]]


def test_query(spark, sf_dir, library):
    """Every row of the query against the library."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    coded = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_piece_codec"](spark, sf_dir).collect()}
    assert set(coded) == set(docs)
    for i, text in docs.items():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        packed = np.array(ids, "<u4").tobytes()
        assert coded[i] == (len(ids), hashlib.sha256(packed).hexdigest(),
                            hashlib.sha256(library.decode(ids).encode()).hexdigest())
