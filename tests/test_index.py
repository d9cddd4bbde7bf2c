"""Trigram postings and ranked ranges."""

import random
import re

import pytest
from helpers import plan_text, rows
from pyspark.sql import functions as F

from fleetstats.functions.text import regex_any_case
from fleetstats.operators import ranges, text_index
from fleetstats.operators.text_index import required_trigrams, search_text


@pytest.mark.parametrize(("pattern", "expected"), [
    ("MIT lic", [{"mit", "it ", "t l", " li", "lic"}]),
    ("ab.cde", [{"cde"}]),
    ("abc|xyz+", [{"abc"}, {"xyz"}]),
    ("(abc)?def", [{"def"}]),
    ("(?:ab){2}c", None),
    ("a(bc|de)f", [{"abc", "bcf"}, {"ade", "def"}]),
    ("^ab$", None),
    ("ab", None),
    ("abc|d", None),
    ("(?i)abc", None),
    (r"\0141bc", None),
    (r"\p{L}abc", None),
    (r"a\.bc", [{"a.b", ".bc"}]),
    ("É to", [{"É t", " to"}]),
    ("a[b]c", [{"abc"}]),
    ("abc(?=def)", [{"abc"}]),
    ("x" * 5, [{"xxx"}]),
    ("(", None),
])
def test_required_trigrams(pattern, expected):
    assert required_trigrams(pattern) == (expected and [frozenset(e) for e in expected])


def test_many_alternatives_keep_what_they_share():
    many = "(" + "|".join(f"a{i}" for i in range(20)) + ")"
    assert required_trigrams(f"{many}xyz") == [frozenset({"xyz"})]
    assert required_trigrams(f"abc{many}") == [frozenset({"abc", "bca"})]  # all go on with an a


def test_matches_contain_the_trigrams_of_an_alternative():
    rng = random.Random(9)
    parts = ["a", "b", "C", "ab", "(?:ab|c)", "(a|bC)+", "b?", "a*", ".", "[ab]", "c{2}", "^", r"\b", "(?:abc)"]
    checked = 0
    for _ in range(30000):
        pattern = "".join(rng.choice(parts) for _ in range(rng.randint(1, 7)))
        text = "".join(rng.choice("abcABC ") for _ in range(rng.randint(0, 14)))
        found = required_trigrams(pattern)
        if found and re.search(pattern, text, re.IGNORECASE | re.MULTILINE):
            folded = text.lower()
            grams = {folded[i:i + 3] for i in range(len(folded) - 2)}
            assert any(f <= grams for f in found), (pattern, text, found)
            checked += 1
    assert checked > 100


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = random.Random(3)
    words = ["wf_task", "Production", "merge", "T1_US", "T2_CH_CERN", "É tude", "line\nbreak", "🎉🎉🎉 party", "xx"]
    table = spark.createDataFrame(
        [(i, None if i % 50 == 7 else " ".join(rng.choice(words) for _ in range(i % 4)) + f" id{i:05}", f"site{i % 900}")
         for i in range(4000)], "id INT, name STRING, site STRING",
    )
    path = str(tmp_path_factory.mktemp("indexed"))
    text_index.write_text_index(table, path, ["id"], ["name", "site"], files=40, buckets=16)
    return table, path


@pytest.mark.parametrize("pattern", [
    "ID0123", "id0+12[0-9]$", "é tude", "É tude.*id039", "K\nB", "🎉 party id002", "xx", "nowhere", "id0(01|02)3", "^ID", "id01|nothing at all",
    "break$", "id00999|id.*39", "",
])
def test_search_equals_a_scan(spark, indexed, pattern):
    table, path = indexed
    expected = rows(table.where(regex_any_case(F.col("name"), pattern)).orderBy("id"))
    found = search_text(spark, path, {"name": pattern})
    assert found.columns == table.columns and rows(found.orderBy("id")) == expected


@pytest.mark.parametrize(("slice_", "places"), [(text_index.SLICE, text_index.PLACES), (50, 8)])
def test_postings_are_lists_of_rows(spark, tmp_path, monkeypatch, slice_, places):
    """Each row once for each of its trigrams, whatever its characters, in far fewer rows than that."""
    monkeypatch.setattr(text_index, "SLICE", slice_)
    monkeypatch.setattr(text_index, "PLACES", places)
    rng = random.Random(5)
    letters = "aabbcAÉß\n 🎉" + ("".join(map(chr, range(0x4e00, 0x4e00 + 300))) if places > 8 else "")
    texts = [None, "", "ab", "aaaaaa", *("".join(rng.choice(letters[:rng.choice([4, len(letters)])]) for _ in range(rng.randint(0, 60))) for _ in range(400))]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id INT, name STRING")
    text_index.write_text_index(table, str(tmp_path), ["id"], ["name"], files=3, buckets=4)
    stored = spark.read.parquet(f"{tmp_path}/grams/name")
    listed = stored.select("gram", text_index.PART, F.explode(text_index.ROW).alias(text_index.ROW))
    found = rows(listed.join(text_index.stored_rows(spark, str(tmp_path)), [text_index.PART, text_index.ROW]), "gram", "id")
    fold = str.maketrans("ABC", "abc")
    wanted = {(t.translate(fold)[k:k + 3], i) for i, t in enumerate(texts) if t for k in range(len(t) - 2)}
    assert len(found) == len(wanted) and set(found) == wanted
    assert stored.count() < len(wanted)


def test_search_by_several_columns(spark, indexed):
    table, path = indexed
    also = F.col("id") > 1500
    wanted = regex_any_case(F.col("name"), "id0[0-3]") & regex_any_case(F.col("site"), "site12") & also
    found = search_text(spark, path, {"name": "id0[0-3]", "site": "site12"}, also)
    assert rows(found.orderBy("id")) == rows(table.where(wanted).orderBy("id"))


def test_only_folders_with_candidates_are_read(spark, indexed):
    _, path = indexed
    grams = plan_text(text_index.candidates(spark, path, "name", "id00123"))
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", grams) and re.search(r"PushedFilters: \[[^\]]*In\(gram|EqualTo\(gram", grams)
    found = search_text(spark, path, {"name": "id00123"})
    filters = re.search(r"PartitionFilters: \[([^\]]*)", plan_text(found))[1]
    assert re.search(r"index_part#\d+ = \d+\)|index_part#\d+ IN \(\d+\)", filters), filters  # one folder of 40
    assert text_index.candidates(spark, path, "name", "id0") is None  # in all rows
    assert text_index.candidates(spark, path, "name", "id") is None


def test_empty_collection(spark, tmp_path):
    table = spark.createDataFrame([], "id INT, name STRING")
    text_index.write_text_index(table, str(tmp_path), ["id"], ["name"])
    assert rows(search_text(spark, str(tmp_path), {"name": "abc"})) == []


@pytest.fixture(scope="module")
def ranked(spark, tmp_path_factory):
    rng = random.Random(4)
    table = spark.createDataFrame(
        [(i, rng.choice([None, 1, 1, 1, 1, 2, 3]), rng.random()) for i in range(3000)], "id INT, n INT, x DOUBLE"
    )
    path = str(tmp_path_factory.mktemp("ranked"))
    ranges.write_ranked(table, path, [("n", "desc"), ("x", "asc"), ("id", "sideways")], ["id"], files=23)
    order = sorted(rows(table), key=lambda r: (r[1] is None, -(r[1] or 0), r[2], r[0]))
    return path, order


@pytest.mark.parametrize(("start", "length"), [(0, 10), (1490, 25), (2990, 25), (2999, 1), (3000, 5), (-4, 3), (100, 2900), (700, 0)])
def test_page_from_any_row(spark, ranked, start, length):
    path, order = ranked
    begin = max(start, 0)
    expected = [(*r, begin + i) for i, r in enumerate(order[begin:begin + (length or 10_000)])]
    assert rows(ranges.page_at(spark, path, start, length)) == expected


def test_a_deep_page_reads_its_ranges_alone(spark, ranked):
    path, _ = ranked
    assert ranges.ranked_total(spark, path) == 3000
    page = ranges.page_at(spark, path, 1500, 20)
    assert 1 <= len(ranges.ranges_of(spark, path, 1500, 20)) <= 2
    plan = plan_text(page)
    assert "TakeOrderedAndProject" in plan and "Window" not in plan and "SinglePartition" not in plan
    assert re.search(r"PartitionFilters: \[[^\]]*rank_range", plan)


def test_one_value_in_most_rows_is_spread(spark, ranked):
    path, _ = ranked
    counts = [r["n"] for r in spark.read.parquet(f"{path}/counts").collect()]
    assert len(counts) == 23 and max(counts) < 3 * 3000 / 23


def test_empty_result(spark, tmp_path):
    ranges.write_ranked(spark.createDataFrame([], "id INT, n INT"), str(tmp_path), [("n", "asc")], ["id"])
    assert ranges.ranked_total(spark, str(tmp_path)) == 0 and rows(ranges.page_at(spark, str(tmp_path), 5, 5)) == []


def test_too_large_a_page_is_refused(spark, ranked):
    with pytest.raises(ValueError, match="at most"):
        ranges.page_at(spark, ranked[0], 0, 10_001)
