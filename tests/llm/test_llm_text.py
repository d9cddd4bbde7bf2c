"""Operators on single texts: tokens, personal data, pages, quality."""

import hashlib
import html
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetstats.llm import bpe, html_text, pii, quality, token_counts
from fleetstats.llm.queries import QUERIES

WORDS, BYTES = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ALPHABET = "abcdefghij '\n\tÀÉßıİΣςσ<|>endoftx 0129½٣ ́ᾳ\x1c!?#  日本"


def random_texts(n, alphabet=ALPHABET, longest=60):
    rng = random.Random(7)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


EDGES = ["", None, " ", "  a  b\n\n c ", "İstanbul ΣΑΣ ΟΔΟΣ", "<|endoftext|>a<|startoftext|> b <|endoftext|>",
         "I'm don't we'LL 'S", "a\x85b c d", "a" * 40 + " " + "ha" * 30, "x" * 5000, "\u0000 �"]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_are_those_of_the_tokenizer(path):
    texts = EDGES + random_texts(3000)
    tokenizer = Tokenizer.from_file(path)
    expected = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    ours = bpe.encode_texts(path, texts)
    assert [o.tolist() for o in ours] == [e.ids for e in expected]
    assert token_counts.count_texts(path, texts) == [len(e.ids) for e in expected]
    if path == WORDS:
        assert [bpe.decode_ids(path, o.tolist()) for o in ours] == [
            tokenizer.decode(e.ids, skip_special_tokens=False) for e in expected
        ]


def test_a_worker_forgets_words_without_losing_any(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    texts = random_texts(300)
    expected = Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)
    for i in range(0, 300, 30):
        assert [o.tolist() for o in bpe.encode_texts(BYTES, texts[i:i + 30])] == [e.ids for e in expected[i:i + 30]]


def test_counts_are_made_once_per_word_and_without_ids(monkeypatch):
    def refused(*_):
        raise AssertionError("ids were made")

    bpe.load.cache_clear()
    monkeypatch.setattr(bpe.PairIndex, "pieces", refused)
    texts = random_texts(600)
    for i in range(0, 600, 200):
        token_counts.count_texts(BYTES, texts[i:i + 200])
    assert bpe.load(BYTES).counts and not bpe.load(BYTES).pieces
    monkeypatch.setattr(token_counts, "PairIndex", refused)
    expected = Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)
    assert token_counts.count_texts(BYTES, texts) == [len(e.ids) for e in expected]


def test_a_worker_forgets_counts_without_losing_any(monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_WORDS", 50)
    monkeypatch.setattr(token_counts, "KEPT_LENGTH", 3)
    texts = random_texts(300)
    expected = Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)
    for i in range(0, 300, 30):
        assert token_counts.count_texts(BYTES, texts[i:i + 30]) == [len(e.ids) for e in expected[i:i + 30]]


def test_long_texts(monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 20)
    texts = random_texts(500)
    for path in (WORDS, BYTES):
        expected = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
        assert [o.tolist() for o in bpe.encode_texts(path, texts)] == [e.ids for e in expected]


def test_ranks_of_a_block_do_not_make_each_others_symbols():
    for path in (WORDS, BYTES):
        v = bpe.load(path)
        made_in = dict(zip(v.merged.tolist(), v.block_of_rank.tolist()))
        for side in (v.left, v.right):
            assert all(made_in.get(s, -1) < b for s, b in zip(side.tolist(), v.block_of_rank.tolist()))


def test_encode_odd_rows(odd, none, odd_rows):
    rows = bpe.encode(odd, WORDS, decoded="decoded").collect()
    tokenizer = Tokenizer.from_file(WORDS)
    assert len(rows) == len(odd_rows) and rows[0]["n_tokens"] == "clash"
    for r in rows:
        expected = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == expected and r["decoded"] == tokenizer.decode(expected, skip_special_tokens=False)
    back = bpe.decode(bpe.encode(odd, WORDS).drop("decoded"), WORDS).collect()
    assert {(r["doc_id"], r["decoded"]) for r in back} == {(r["doc_id"], r["decoded"]) for r in rows}
    assert bpe.encode(none, WORDS).collect() == []


def test_token_counts_odd_rows(odd, none):
    tokenizer = Tokenizer.from_file(BYTES)
    for r in token_counts.token_counts(odd, BYTES).collect():
        assert r["n_tokens"] == len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)
    assert token_counts.token_counts(none, BYTES).collect() == []


def test_token_queries(spark, sf_dir):
    """Every row of both queries against the published tokenizers."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    words, pieces = Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    coded = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op3_bpe_codec"](spark, sf_dir).collect()}
    counted = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op6_token_counts"](spark, sf_dir).collect()}
    assert set(coded) == set(counted) == set(docs)
    for i, text in docs.items():
        ids = words.encode(text, add_special_tokens=False).ids
        assert coded[i] == (len(ids), digest(" ".join(map(str, ids))), digest(words.decode(ids, skip_special_tokens=False)))
        n = len(pieces.encode(text, add_special_tokens=False).ids)
        assert counted[i] == (len(text.encode()), n, n > 1024)


def base_spans(text):
    """The base kinds by their patterns."""
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 16, 19),
                                     ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, text):
            d = [int(c) for c in m[0] if c in "0123456789"]
            doubled = [x if i % 2 == 0 else sum(map(int, str(2 * x))) for i, x in enumerate(reversed(d))]
            if low <= len(d) <= high and (kind == "phone" or sum(doubled) % 10 == 0):
                out.append((kind, *m.span()))
    return out


def test_base_spans_are_those_of_the_patterns():
    for text in random_texts(20000, "ab@.+-0123456789 ()%_é", 50):
        assert [s for s in pii.spans(text) if s[0] in pii.BASE_KINDS] == base_spans(text)


def test_added_spans():
    text = 'see HTTPS://user.example.org/a?b=1. and token = "ab12cd34ef" but token ring, é password:none1234'
    found = [(k, text[a:b]) for k, a, b in pii.spans(text)]
    assert found == [("url", "HTTPS://user.example.org/a?b=1"), ("account", "ab12cd34ef"), ("account", "none1234")]


def test_accounts_of_all_lengths_and_wordings():
    def accounts(text):
        return [text[a:b] for k, a, b in pii.spans(text) if k == "account"]

    for n in (6, 128, 129, 5000):
        assert accounts(f"api_key={'a1' * n} next") == ["a1" * n]
    found = {
        "account number: 12345678": "12345678", "Account No. 12345678, ok": "12345678", "my password is hunter22!": "hunter22",
        "account_id = '12345678'": "12345678", '"secret key": "ab-12-cd"': "ab-12-cd", "passport: no. X1234567": "X1234567",
        "IBAN GB29 NWBK 6016 1331 9268 19 and more": "GB29 NWBK 6016 1331 9268 19",
        "iban: GB29 NWBK 6016 1331 9268 19": "GB29 NWBK 6016 1331 9268 19", "iban is de89370400440532013000.": "de89370400440532013000",
        "IBAN: ES91 2100 0418 4502 0005 1332 AND": "ES91 2100 0418 4502 0005 1332", "iban=GB30NWBK60161331926819": "GB30NWBK60161331926819",
    }
    assert {t: accounts(t) for t in found} == {t: [v] for t, v in found.items()}
    found = {  # secrets without a digit, short, quoted or with other characters
        "password=correct-horse next": "correct-horse", "Password: hunter.": "hunter", "token: a1": "a1",
        "api key: abcdefghij, more": "abcdefghij", "API-KEY = 'x y z' more": "x y z", "secret=pä$$": "pä$$",
        "password is: geheim": "geheim", "password: is geheim!": "geheim", '"password": "let me in"': "let me in",
        "api key 12345678": None, "api key is 12345678": "12345678",
    }
    assert {t: accounts(t) for t in found} == {t: [v] if v else [] for t, v in found.items()}
    for text in ("IBAN GB30 NWBK 6016 1331 9268 19", "token ring12345", "account number", "password is unknown", "account: a1",
                 "password:", "the secret; it is", "token == ", "password: ..."):
        assert accounts(text) == []


def test_pii_odd_rows(odd, none, odd_rows):
    rows = pii.find_pii(odd).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert [tuple(s) for s in r["pii"]] == pii.spans(r["text"])
    assert pii.find_pii(none).collect() == []


def test_pii_query(spark, sf_dir):
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op7_pii"](spark, sf_dir).collect():
        base = base_spans(text[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
        assert set(filter(None, r["spans"].split(","))) >= {f"{k}:{a}:{b}" for k, a, b in base}


PAGE = """<html><head><title>T</title><body class="home"><div class="cookie-notice">we use</div>
<header><h1>Site</h1></header><main><h1>Head &amp; x</h1><p>One
 two&nbsp;three<p>Four <b>five</b><br>six<aside>side</aside><form><p>mail</p></form><script>var a="<p>no</p>";</script>
<section class="readerComments"><p>nice</p></section><div class="post-header">Lead</div><!-- <p>hidden --><p title="a > b">Last</p></main>
<div>after</div><footer>f</footer>"""


def test_page_lines():
    assert html_text.main_text(html_text.lines_of(PAGE), None) == "Head & x\nOne two three\nFour five\nsix\nLead\nLast"
    assert html_text.lines_of(None) == [] and html_text.lines_of("") == []


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def article(page):
    return html_text.main_text(html_text.lines_of(page), None)


@pytest.mark.parametrize(("page", "text"), [
    ("<main><p class=a'>One text</p><p>don't drop</p><p>Two</p></main>", "One text\ndon't drop\nTwo"),
    ("<p title=\"a > b\">x</p><p title = 'c>d'>y</p><p \"odd\">z</p>", "x\ny\nz"),
    ("<article><p>Let <math>x = 2</math> hold</p><object>still</object> <canvas>shown</canvas></article>", "Let x = 2 hold\nstill shown"),
    ('<article><section id="notice">Stays</section><ul class="menu"><li>Soup</li></ul><div class="comments">No</div></article>',
     "Stays\nSoup"),
    ('x <script a="1" b="2" c="3" d="4" e="5" f="6" g="7" h="8" i="9" j="10" ' * 20, "x"),
])
def test_article_text_is_kept(page, text):
    assert article(page) == text


def test_doubtful_names_go_if_the_neighbour_has_the_line():
    lines = html_text.lines_of('<article><div class="menu">Home and more</div><p>Own</p><p>Text</p><p>Here</p></article>')
    other = html_text.lines_of('<article><div class="menu">Home and more</div><p>Other</p><p>Words</p><p>There</p></article>')
    assert html_text.main_text(lines, html_text.compared(other)) == "Own\nText\nHere"


def test_malformed_and_very_long_pages_take_linear_time():
    began = time.perf_counter()
    lines = html_text.lines_of("<article>" + "".join(f"<font><p>t{i}</p></b>" for i in range(10000)))
    assert len(lines) == 10000 and time.perf_counter() - began < 5
    rng = random.Random(2)
    own = [rng.randrange(1 << 40) for _ in range(30000)]
    other = own[:9000] + [rng.randrange(1 << 40) for _ in range(3000)] + own[10000:]
    tracemalloc.start()
    found = html_text.shared(own, other)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(found) == 29000 and found[:9000] == [True] * 9000 and peak < 50e6


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(3000):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        picked = [x for x, s in zip(a, html_text.shared(a, b)) if s]
        rest = iter(b)
        assert len(picked) == longest(a, b) and all(x in rest for x in picked)


def plain(body):
    return "<body><div>Home</div><div>About us</div>" + body + "<div>Contact</div>"


def test_pages_lose_what_their_neighbour_has(spark):
    rows = [
        (1, "http://h.org/a/1", plain("<p>first page</p>")), (2, "http://h.org/a/2?x=1", plain("<p>second page</p>")),
        (3, "http://h.org/z", plain("<article><p>About us</p></article>")), (4, None, plain("<p>nowhere</p>")),
        (5, "http://alone.org/", plain("<p>alone</p>")), (6, "http://h.org/a/1#top", plain("<p>first page</p>")),
        (7, "http://c.org/1", plain("copy")), (8, "http://c.org/2", plain("copy")), (9, "http://h.org/a/3", None),
        (None, "bad url [", ""), (10, "http://[broken", plain("x")), (1, "http://h.org/a/1", plain("<p>first page</p>")),
    ]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, _host string, n_chars long")
    out = {}
    for r in html_text.extract_text(pages).collect():
        out.setdefault(r["page_id"], set()).add(r["text"])
    whole = "Home\nAbout us\n{}\nContact"
    assert out == {
        1: {"first page"}, 2: {"second page"}, 3: {"About us"}, 4: {whole.format("nowhere")}, 5: {whole.format("alone")},
        6: {"first page"}, 7: {whole.format("copy")}, 8: {whole.format("copy")}, 9: {""}, None: {""},
        10: {whole.format("x")},
    }
    assert html_text.extract_text(pages.limit(0)).collect() == []


def test_shared_lines_inside_articles():
    def text(own, other):
        own, other = (html_text.lines_of(f"<body><div>Menu</div><main>{p}</main>") for p in (own, other))
        return html_text.main_text(own, html_text.compared(other))

    bar = "<div>Subscribe now for more</div>"
    assert text(bar + "<p>x</p>", bar + "<p>y</p>") == "x"
    assert text(bar + "<p>x</p><p>z</p>", "<p>y</p>") == "Subscribe now for more\nx\nz"
    copy = "<p>a</p><p>b</p><p>c</p>"
    assert text(copy + "<p>x</p>", copy + "<p>y</p>") == "a\nb\nc\nx"
    assert text(copy, copy) == "a\nb\nc"
    assert text(bar + "<p>x</p>", bar + copy) == "x"


def test_names_inside_articles():
    def text(own, other=None):
        return html_text.main_text(html_text.lines_of(own), other and html_text.compared(html_text.lines_of(other)))

    heads = '<article><h2 id="related-work">Related work</h2><h3 id="api-responses">API responses</h3><p>x</p></article>'
    assert text(heads) == "Related work\nAPI responses\nx"
    unclosed = "<article><h1>T</h1><p class=ad>buy<p>Para one<p>Para two</article>"
    assert text(unclosed) == "T\nbuy\nPara one\nPara two"
    other = "<article><h1>S</h1><p class=ad>buy<p>another<p>and one</article>"
    assert text(unclosed, other) == "T\nPara one\nPara two" and text(unclosed, unclosed) == text(unclosed)
    inline = "<main>A <b>bold</b> word, an<span class=notice>ad</span>, no <i class=promo>go</i> more</main>"
    assert text(inline) == "A bold word, anad, no go more"
    assert text(inline, "<main><p>ad<p>B<p>go</main>") == "A bold word, an, no more"
    assert text("<main><p>x</p><p><b class=ad>y</b> z</p></main>", "<main>y<p>u<p>v</main>") == "x\nz"
    assert text("<article><p>x</p><div class=share>share</div></article>") == "x"
    assert text("<div><ul><li class=ad>one<ul><li>in</li></ul>still<li>two</ul></div><p class=menu>a<table><tr><td class=ad>b<td>c<tr><td>d</table>") == "two\nc\nd"
    assert text("<dl><dt class=ad>a<dd>b</dl><table><tr class=ad><td>x<tr><td>y</table>") == "b\ny"


def test_pages_of_one_path_and_odd_addresses(spark):
    rows = [(f"http://q.org/index.php?id={i}", plain(f"<p>page {i}</p>")) for i in range(9)]
    rows += [(f"http://q.org/index.php?id={i}&x=#top", plain(f"<p>page {i}</p>")) for i in range(9)]
    rows += [(f"http://my_host.org:80/a/{i}", plain(f"<p>host {i}</p>")) for i in range(3)]
    rows += [(f"HTTP://u@My-Host.org/b c/{i}|{i}", plain(f"<p>path {i}</p>")) for i in range(3)]
    rows += [(f"http://v.org/x?utm={i}", plain(f"<p>{'long text ' * 50}</p><p>offer {i}</p>")) for i in range(2)]
    pages = spark.createDataFrame(rows, "url string, html string")
    out = {r["url"]: r["text"] for r in html_text.extract_text(pages).collect()}
    assert len(out) == len(rows)
    for url, page in rows:
        alone = html_text.main_text(html_text.lines_of(page), None)
        assert out[url] == (alone if "v.org" in url else re.search("<p>(.*)</p>", page)[1])
    cut = spark.createDataFrame([("http://u:p@A_b.org:8/c d?e=f#g",), ("//x_y",), ("no address",), (None,)], "url string")
    found = [tuple(r)[:2] for r in cut.select(*html_text.address(F.col("url"))).collect()]
    assert found == [("a_b.org", "/c d"), ("x_y", "/"), (None, "/"), (None, "/")]


def test_neighbours_do_not_depend_on_the_partitions(spark):
    paths = spark.createDataFrame([(f"h{i % 3}", f"/{i // 7:03d}/{i}") for i in range(200)], "host string, path string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for n in ("1", "2", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(sorted(map(tuple, html_text.nearest(paths).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 200


def test_page_query(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op8_html_text"](spark, sf_dir).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.DOTALL)[1]
        blocks = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)\b[^>]*>", "\n", article)).split("\n")
        expected = "\n".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())
        assert (r["text"], r["n_chars"]) == (expected, len(expected))


def test_quality_on_held_out_rows(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op2_quality"](spark, sf_dir).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == q for p, q in judged) / len(judged) >= 0.95
    assert all(p for p, q in judged if q)


def test_weights_are_those_of_a_plain_dense_fit(monkeypatch):
    """The dual of the hinge loss by projected gradients over dense rows, and a count of each n-gram by loops."""
    monkeypatch.setattr(quality, "TABLE_BITS", 5)
    monkeypatch.setattr(quality, "EPOCHS", 3000)
    rng = np.random.default_rng(3)
    rows = [np.flatnonzero(rng.random(32) < 0.3).astype(np.int32) for _ in range(40)]
    positive = np.array([len(set(r.tolist()) & set(range(8))) + rng.random() > 3 for r in rows])
    counts = [[1.0 + sum(k in r and p == label for r, p in zip(rows, positive)) for k in range(32)] for label in (0, 1)]
    ratios = np.log(np.array(counts[1]) / sum(counts[1])) - np.log(np.array(counts[0]) / sum(counts[0]))
    assert np.allclose(quality.log_count_ratios(rows, positive), ratios)

    dense = np.zeros((40, 33))
    for row, places in zip(dense, rows):
        row[places] = ratios[places] / np.linalg.norm(ratios[places])
        row[32] = 1.0
    signs = np.where(positive, 1.0, -1.0)
    signed = dense * signs[:, None]
    alpha, kernel = np.zeros(40), signed @ signed.T
    step = 1 / np.linalg.norm(kernel, 2)
    for _ in range(50_000):
        alpha = np.clip(alpha - step * (kernel @ alpha - 1), 0, quality.COST)
    plain = signed.T @ alpha
    weights, bias = quality.dual_coordinate_descent(rows, [d[r] for d, r in zip(dense, rows)], signs)
    assert np.allclose([*weights, bias], plain, atol=0.02)


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (3, 0), (4, 1), (7, 0), (None, 1), (8, None), (9, 5), (10, 1), (10, 1)],
        "doc_id long, quality int")
    model = quality.train(odd, labels)
    rows = quality.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(none, model).collect() == []
    assert quality.keep_good(odd, model).columns == odd.columns
    assert quality.train(odd, labels.limit(0)).score("x") == 0.5
    assert quality.train(none, labels).score("x") == 0.5
    assert quality.train(odd, labels.where("doc_id = 10")).score("x") in (0.5, 1.0)
    again = quality.train(odd.repartition(5), labels)
    assert [again.score(t) for t in ("a b", "", None)] == [model.score(t) for t in ("a b", "", None)]


def test_held_out_labels_teach_nothing(spark, odd):
    ids = [i for i in range(1, 11)]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    out = labels.where(quality.held_out("doc_id"))
    flipped = labels.where(~quality.held_out("doc_id")).unionByName(out.withColumn("quality", 1 - F.col("quality")))
    assert quality.train(odd, flipped).score("word1 word2") == quality.train(odd, labels).score("word1 word2")
