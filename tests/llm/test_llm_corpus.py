"""Operators across texts, against plain versions over all pairs."""

import hashlib
import random

import brute
import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from fleetstats import session
from fleetstats.llm import common, components, decontaminate, fingerprints, line_dedup, simhash, substring_dedup
from fleetstats.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, con, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), con, name) is None


@pytest.mark.parametrize("name", ["op1_line_dedup", "op4_fingerprints", "op10_decontamination"])
def test_native_plans_have_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "InArrow", "InPandas", "ExistingRDD", "CartesianProduct") if w in plan]


def test_shuffles_of_text_queries_follow_their_tables(spark, sf_dir, monkeypatch):
    """On a cluster, with a table of one terabyte."""
    monkeypatch.setattr(session, "scanned_bytes", lambda df: 1 << 40)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://cluster")
    try:
        plan = QUERIES["op1_line_dedup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert ", 8192, " in plan or ", 8192)" in plan
        monkeypatch.setattr(session, "scanned_bytes", lambda df: 100 << 40)
        common.text_session(spark, common.documents(spark, sf_dir))
        assert spark.conf.get(session.INITIAL_PARTITIONS) == "819200"
        common.documents(spark, sf_dir, "labels")
        assert spark.conf.get(session.INITIAL_PARTITIONS) == "819200"
    finally:
        spark.conf.unset(session.INITIAL_PARTITIONS)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def as_tuples(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_substrings_odd_rows(odd, none, odd_rows):
    found = substring_dedup.substring_dedup(odd)
    expected = brute.kept_without_substrings(odd_rows)
    assert as_tuples(found, "doc_id", "n_words", "n_removed", "kept") == sorted(expected, key=str)
    assert any(n for _, _, n, _ in expected)
    for r in found.where("n_removed > 0").collect():
        assert sum(i["end"] - i["start"] for i in r["removed"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))
    assert set(odd.columns) <= set(found.columns)
    clashing = [c for c in odd.columns if c not in ("doc_id", "text", "n_words", "n_removed", "kept", "removed", "tags")]
    assert {v for r in found.select(clashing).collect() for v in r} == {"clash"}
    assert substring_dedup.substring_dedup(none).collect() == []


def test_substrings_in_several_rounds(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))) for i in range(-20, 60)]
    rows += [(70 + i, rows[i][1]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(substring_dedup, "RANGE_CHARS", 100)
    monkeypatch.setattr(substring_dedup, "FAN_OUT", 4)
    found = substring_dedup.substring_dedup(docs, width=5)
    assert as_tuples(found, "doc_id", "n_words", "n_removed", "kept") == sorted(
        brute.kept_without_substrings(rows, 5), key=str)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    rng = random.Random(11)
    text = " \n".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(3000)).encode()
    whole = substring_dedup.word_hashes(text)
    monkeypatch.setattr(substring_dedup, "PIECE_BYTES", 50)
    assert (substring_dedup.word_hashes(text) == whole).all()
    assert (substring_dedup.word_hashes(b"x" * 200) == substring_dedup.hashes_of_piece(b"x" * 200)).all()
    text = text.decode()
    assert simhash.fingerprint(text) == brute.simhash(text)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert simhash.fingerprint(text) == brute.simhash(text)


def test_packed_entries_come_back():
    rng = np.random.default_rng(1)
    values = np.sort(rng.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    ids = rng.integers(-(1 << 62), 1 << 62, 1000)
    back = substring_dedup.unpacked(substring_dedup.packed(values, ids))
    assert (back[0] == values).all() and (back[1] == ids).all()


def test_lines_odd_rows(odd, none, odd_rows):
    rows = [r.asDict() for r in line_dedup.line_dedup(odd).collect()]
    assert len(rows) == len(odd_rows)
    texts = {}
    for r in rows:
        texts.setdefault(r["doc_id"], set()).add(r["text"])
    assert texts[-3] == {"same line\nsame line\nsame line"}
    assert texts[1] == {odd_rows[0][1]}
    assert texts[2] == {odd_rows[1][1].split("\n")[0] + "\nfifth", "the same id, another text"}
    assert texts[10] == {odd_rows[0][1].split("\n")[0]} or texts[10] == {""}
    assert texts[3] == {None} and texts[4] == {""} and texts[None] == {odd_rows[8][1], None}
    assert texts[6] == {"\n\n"}
    assert {r["n_removed"] for r in rows if r["doc_id"] == -3} == {7}
    assert line_dedup.line_dedup(none).collect() == []


def test_lines_against_the_plain_version(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice("abcd") for _ in range(rng.randint(0, 9)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert as_tuples(line_dedup.line_dedup(docs), "doc_id", "text") == sorted(brute.without_repeated_lines(rows), key=str)


def test_anchors_cover_halves():
    table = simhash.flips()
    assert len(table) == 32 and max(map(len, table)) == 17
    rng = random.Random(4)
    for _ in range(200):
        x = rng.getrandbits(32)
        y = x ^ (1 << rng.randrange(32))

        def reached(v):
            s = 0
            for i in range(1, 32):
                s ^= i * (v >> i & 1)
            return [v ^ m for m in table[s]]

        assert reached(x)[0] in reached(y) and reached(y)[0] in reached(x)
        assert all((x ^ a).bit_count() <= 3 for a in reached(x))


def fingerprints_with_links(rng, n):
    prints = [rng.getrandbits(64) for _ in range(n)]
    for i in range(n // 2):  # chains and balls of near ones
        base = prints[rng.randrange(len(prints))]
        for _ in range(rng.randint(1, 4)):
            base ^= 1 << rng.randrange(64)
        prints.append(base)
    centre = rng.getrandbits(64)
    return [*prints, *{centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(80)}, 0, (1 << 64) - 1]


@pytest.mark.parametrize("slice_size", [4000, 7])
@pytest.mark.parametrize("max_bits", [3, 1])
def test_links_connect_all_near_fingerprints(spark, monkeypatch, slice_size, max_bits):
    monkeypatch.setattr(simhash, "SLICE", slice_size)
    prints = sorted(set(fingerprints_with_links(random.Random(6), 200)))
    fps = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long").repartition(3)
    links = simhash.fingerprint_links(fps, max_bits).collect()
    place = {(p - (1 << 64) if p >> 63 else p): i for i, p in enumerate(prints)}
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        assert ((u ^ v) & (1 << 64) - 1).bit_count() <= max_bits
        x, y = sorted((find(place[u]), find(place[v])))
        parent[y] = x
    assert [find(i) for i in range(len(prints))] == brute.classes_of(prints, max_bits)


def test_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, 900 + i) for i in range(50)]
    links += [(rng.randrange(40), rng.randrange(40)) for _ in range(30)] + [(7, 7), (None, 3), (1 << 62, -(1 << 62))]
    df = spark.createDataFrame(links, "u long, v long").repartition(3)
    found = dict(map(tuple, components.components(df).collect()))
    parent = {x: x for pair in links for x in pair if x is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        if u is not None:
            x, y = sorted((find(u), find(v)))
            parent[y] = x
    linked = {x for u, v in links if u is not None and u != v for x in (u, v)}
    assert found == {x: find(x) for x in linked}
    assert components.components(df.limit(0)).collect() == []


def test_simhash_odd_rows(odd, none, odd_rows):
    rows = simhash.classes(odd).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        texts = {brute.simhash(t) for i, t in odd_rows if i == r["doc_id"]}
        assert r["fp"] & (1 << 64) - 1 in texts
    blank = [r for r in rows if r["fp"] == 0]
    assert {r["doc_id"] for r in blank} == {3, 4, 5, 6, None} and {r["component_id"] for r in blank} == {3}
    kept = simhash.drop_near_duplicates(odd).collect()
    assert kept and len({r["doc_id"] for r in kept} - {None}) + 1 >= len(kept) - 1
    assert [r["doc_id"] for r in kept if not (r["text"] or "").strip()] == [3]
    assert [r["doc_id"] for r in kept].count(10) == 0
    assert simhash.classes(none).collect() == [] and simhash.drop_near_duplicates(none).collect() == []


def test_simhash_query(spark, sf_dir):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    prints = [brute.simhash(t) for _, t in rows]
    classes = brute.classes_of(prints)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op5_simhash"](spark, sf_dir).collect()}
    assert found == {i: (f"{p:016x}", rows[c][0]) for (i, _), p, c in zip(rows, prints, classes)}


ITEM = " ".join(f"item{i}" for i in range(18))


def substituted(*places):
    w = ITEM.split()
    for p in places:
        w[p] = "other"
    return " ".join(w)


def test_decontamination_odd_rows(spark, odd, none):
    texts = [
        (100, f"before {ITEM} after"), (101, f"x {substituted(8)} y"), (102, f"x {substituted(3, 13)} y"),
        (103, " ".join(ITEM.split()[:12])), (104, f"x {substituted(*range(0, 18, 2))} y"),
        (105, ITEM.upper().replace(" ", ", ")), (None, ITEM), (100, f"before {ITEM} after"),
    ]
    docs = odd.select("doc_id", "text", "w", "h").unionByName(
        spark.createDataFrame([(*t, "clash", "clash") for t in texts], "doc_id long, text string, w string, h string"))
    items = spark.createDataFrame(
        [(1, ITEM, 0), (1, ITEM, 0), (2, None, 0), (3, "", 0), (4, "too short", 0), (None, " ".join(f"word{i}" for i in range(15)), 0)],
        "item_id long, text string, doc_id int")
    rows = decontaminate.contaminated(docs, items).collect()
    every = [(i, t) for i, t in texts] + [(r["doc_id"], r["text"]) for r in odd.collect()]
    expected = {
        (i, any(brute.overlaps(t, x["text"], decontaminate.MASKS) for x in items.collect() if x["item_id"] == 1))
        for i, t in every if any(brute.overlaps(t, x["text"], decontaminate.MASKS) for x in items.collect())
    }
    assert {(r["doc_id"], r["item_ids"] == [1]) for r in rows} == expected
    assert {100, 101, 102, 105, 1, 2, 10} <= {i for i, _ in expected} and not {103, 104} & {i for i, _ in expected}
    clean = decontaminate.decontaminate(docs, items)
    assert clean.columns == docs.columns
    assert sorted(map(str, clean.select("text").collect())) == sorted(
        f"Row(text={t!r})" for i, t in every
        if not any(brute.overlaps(t, x["text"], decontaminate.MASKS) for x in items.collect()))
    assert decontaminate.contaminated(none, items).collect() == []
    assert decontaminate.contaminated(docs, items.limit(0)).collect() == []


def test_short_items_are_found_whole(spark, monkeypatch):
    cjk = "中国的首都是哪一座城市请回答问题"
    items = [(1, "Which river runs through Rome?"), (2, "Madrid"), (3, " ".join(f"t{i}" for i in range(12))), (4, cjk),
             (5, "首都は東京"), (6, "two words"), (7, " ... "), (1, "Which river runs through Rome?"), (8, "two words more")]
    texts = [
        "Q: which RIVER runs through Rome", "which river runs through old Rome", "madrid", "In Madrid, two words", "words two",
        "x " + items[2][1] + " y", " ".join(f"t{i}" for i in range(11)), "问:" + cjk.replace("座", "个") + "?", "首都は、東京", "首都が東京",
        "two words more", None, "", "two", "t0 " * 2000 + "madrid two",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = {0: [1], 2: [2], 3: [2, 6], 5: [3], 7: [4], 8: [5], 10: [6, 8], 14: [2]}
    for rows in (100_000, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", rows)
        found = decontaminate.contaminated(docs, benchmark)
        assert {r["doc_id"]: r["item_ids"] for r in found.collect()} == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_large_benchmarks_are_not_broadcast(spark, monkeypatch, sf_dir):
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    shuffled = as_tuples(decontaminate.contaminated(docs, items), "doc_id", "item_ids")
    assert shuffled == as_tuples(QUERIES["op10_decontamination"](spark, sf_dir), "doc_id", "item_ids")


def jaccard(a, b):
    a, b = set(brute.lines(a)), set(brute.lines(b))
    return len(a & b) / len(a | b) if a | b else 1.0


def check_fingerprints(rows):
    """Rows of a result with their text and the text after it."""
    for r, text, following in rows:
        n = len(text)
        edited = text[:n - n // 2] + following[:n // 2]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r["near_edited"] - jaccard(text, edited)) < 1e-12
        assert abs(r["near_next"] - jaccard(text, following)) < 1e-12


def test_fingerprints_of_sparse_ids(spark):
    rng = random.Random(9)
    texts = ["\n".join(f"line {rng.randint(0, 40)}" for _ in range(n)) for n in (0, 1, 2, 3, 9, 30, 200, 700)]
    ids = [-(1 << 40), -5, 3, 4, 300, 70000, 1 << 33, (1 << 33) + 1]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    check_fingerprints([(found[i], t, n) for i, t, n in zip(ids, texts, texts[1:] + texts[:1])])
    assert len({r["fingerprint"] for r in found.values()}) == len({frozenset(brute.lines(t)) for t in texts})


def test_fingerprints_of_many_lines(spark):
    """Retries take a time in proportion to the lines, not to their square."""
    texts = ["\n".join(f"a{i}" for i in range(5000)), "\n".join(f"{'ab'[i % 2]}{i}" for i in range(5000)), "short\ntext"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    check_fingerprints([(found[i], texts[i], texts[(i + 1) % 3]) for i in range(3)])


def test_fingerprints_query(spark, sf_dir):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    found = {r["doc_id"]: r for r in QUERIES["op4_fingerprints"](spark, sf_dir).collect()}
    assert len(found) == len(rows)
    check_fingerprints([(found[i], t, n) for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1])])
    equal = {}
    for i, text in rows:
        assert equal.setdefault(text, found[i]["fingerprint"]) == found[i]["fingerprint"]


def test_fingerprints_odd_rows(spark, odd, none, odd_rows):
    rows = fingerprints.fingerprints(odd).collect()
    assert len(rows) == len(odd_rows)
    lengths = sorted((i is not None, i or 0, len(t or "")) for i, t in odd_rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"]) for r in rows) == lengths
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["fingerprint"] == by_id[10]["fingerprint"] and by_id[3]["fingerprint"] == by_id[4]["fingerprint"]
    assert by_id[3]["near_next"] == 1.0
    assert fingerprints.fingerprints(none).collect() == []
    one = fingerprints.fingerprints(odd.where("doc_id = 1")).collect()[0]
    assert one["near_next"] == 1.0


def test_pipeline_against_the_plain_version(spark, sf_dir):
    from tokenizers import Tokenizer
    import public_tokenizers
    from fleetstats.llm import quality

    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    rows = [(i, t) for i, t in rows if model.score(t) >= quality.THRESHOLD]
    rows = brute.without_repeated_lines(rows)
    classes = brute.classes_of([brute.simhash(t) for _, t in rows])
    rows = [r for i, r in enumerate(rows) if classes[i] == i]
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(brute.overlaps(t, x, decontaminate.MASKS) for x in items)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = [(i, tokenizer.encode(t, add_special_tokens=False).ids) for i, t in rows]
    found = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r["doc_id"], r["ids"]) for r in found.collect()) == expected


def test_stages_take_odd_rows(spark, odd, none, sf_dir):
    for docs in (odd.withColumn("n_chars", F.length("text")), none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.schema.names == docs.schema.names and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
