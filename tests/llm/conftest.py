from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetstats.llm.common import text_session  # noqa: E402

PASSAGE = " ".join(f"word{i}" for i in range(20))
ODD = [
    (1, f"Intro one. {PASSAGE} end one\nsecond line\nthird line\nfourth line"),
    (2, f"Other {PASSAGE} tail two\nsecond line\nthird line\nfourth line\nfifth"),
    (2, f"Other {PASSAGE} tail two\nsecond line\nthird line\nfourth line\nfifth"),
    (2, "the same id, another text"),
    (3, None), (4, ""), (5, " \n\t \n "), (6, "\n\n\n\n\n\n"),
    (None, f"no id {PASSAGE}"), (None, None),
    (7, " ".join(f"w{i % 97}x{i % 89}" for i in range(30000))),
    (8, "x" * 70000), (9, "naïve İstanbul ΣΑΣ <|endoftext|> 日本語 café"),
    (10, f"Intro one. {PASSAGE} end one\nsecond line\nthird line\nfourth line"),
    (-3, "same line\n" * 9 + "same line"),
]
CLASHES = "n_tokens ids decoded score places fp n_lines n_removed n_words kept removed _k1 _k2 _gone _answer _pair _doc doc answer pii h w".split()
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in CLASHES], T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, blanks, repeats, shared ids, long texts and columns of clashing names."""
    text_session(spark)
    rows = [(i, t, *["clash"] * len(CLASHES), {"a": "b"}) for i, t in ODD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark, odd):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    return list(ODD)
