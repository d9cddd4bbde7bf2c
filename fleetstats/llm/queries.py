"""The registered queries of the text operators, and the SQL that gives the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstats.llm import bpe, common, decontaminate, html_text, pieces, pii, quality, simhash
from fleetstats.llm import fingerprints as sketches
from fleetstats.llm import line_dedup as lines
from fleetstats.llm import periodic, prefix_trie
from fleetstats.llm import substring_dedup as substrings
from fleetstats.llm import token_counts as counts
from fleetstats.session import prepare
from fleetstats.storage import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, table: str = "documents"):
    """Register a query under its name; its shuffles are sized by its main table."""
    def register(run):
        @functools.wraps(run)
        def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
            common.text_session(spark, common.documents(spark, sf_dir, table))
            return run(spark, sf_dir)

        QUERIES[run.__name__] = sized
        if sql:
            ORACLE[run.__name__] = sql
        return sized

    return register


def digest(text) -> F.Column:
    """SHA-256 of a text in UTF-8, lower-case hex."""
    return F.sha2(text.cast("binary"), 256)


@query()
def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    coded = bpe.encode(docs, path, decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    counted = counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 1024).alias("over_limit"),
    )


@query("""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), spots AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words
), windows AS (
  SELECT doc_id, p, array_to_string(list_slice(w, p, p + 12), ' ') AS k FROM spots
), firsts AS (
  SELECT k, min(doc_id) AS f FROM windows GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM windows JOIN firsts USING (k) WHERE doc_id > f
), lists AS (
  SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id
), kept AS (
  SELECT doc_id, w, coalesce(len(g), 0) AS n,
    list_filter(w, lambda x, i: NOT list_contains(coalesce(g, []), i)) AS k
  FROM words LEFT JOIN lists USING (doc_id)
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed,
  sha256(array_to_string(k, ' ')) AS kept_sha256
FROM kept
""")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.substring_dedup(common.documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", digest(F.col("kept")).alias("kept_sha256"))


@query()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(common.documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("""
WITH lines AS (
  SELECT doc_id, CASE WHEN length(text) > 0 THEN string_split(text, chr(10)) ELSE [] END AS l FROM documents
), windows AS (
  SELECT doc_id, p, l[p] || chr(10) || l[p + 1] || chr(10) || l[p + 2] AS w
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM lines)
), ranked AS (
  SELECT doc_id, p, first_value(doc_id) OVER o AS fd, first_value(p) OVER o AS fp
  FROM windows WINDOW o AS (PARTITION BY w ORDER BY doc_id, p)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = fd THEN greatest(p, fp + 3) ELSE p END, p + 3)) AS i
  FROM ranked WHERE doc_id <> fd OR p <> fp
), lists AS (
  SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id
)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(l, lambda x, i: NOT list_contains(coalesce(g, []), i)), chr(10))) AS kept_sha256
FROM lines LEFT JOIN lists USING (doc_id)
""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.line_dedup(common.documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id", "n_lines", "n_removed", digest(F.coalesce("text", F.lit(""))).alias("kept_sha256")
    )


@query("""
WITH masks(mask, o) AS (
  VALUES (0, [0, 1, 2, 3, 4, 5]), (1, [0, 1, 4, 5, 8, 9]), (2, [0, 1, 3, 6, 7, 9])
), dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents
), iw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), ds AS (
  SELECT doc_id, w, p, mask, o[6] AS last, array_to_string(list_transform(o, lambda k: w[p + k + 1]), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(len(w))) AS p FROM dw), masks WHERE p + o[6] < len(w)
), si AS (
  SELECT item_id, w, p, mask, array_to_string(list_transform(o, lambda k: w[p + k + 1]), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(len(w))) AS p FROM iw WHERE len(w) >= 13), masks WHERE p + o[6] < len(w)
), hits AS (
  SELECT doc_id, item_id, ds.w AS dw, si.w AS iw, ds.p AS p, si.p AS q, last FROM ds JOIN si USING (mask, s)
), shifted AS (
  SELECT *, unnest(range(last - 12, 1)) AS k FROM hits
), counted AS (
  SELECT doc_id, item_id, p, q, last, max(len(list_filter(range(13), lambda j: dw[p + k + j + 1] = iw[q + k + j + 1]))) AS n
  FROM shifted WHERE p + k >= 0 AND q + k >= 0 AND p + k + 13 <= len(dw) AND q + k + 13 <= len(iw)
  GROUP BY ALL
)
SELECT doc_id, count(DISTINCT item_id) AS n_items, list_sort(list(DISTINCT item_id)) AS item_ids
FROM counted WHERE n >= 11 GROUP BY doc_id
""")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    found = decontaminate.contaminated(docs, common.documents(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_items", "item_ids")


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    model = quality.train(docs, common.documents(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(common.documents(spark, sf_dir).select("doc_id", "text"))
    written = F.transform("pii", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    in_base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    base = F.transform(in_base, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))

    def number(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number(k) for k in pii.BASE_KINDS], digest(F.array_join(base, ",")).alias("base_sha256"),
        F.array_join(written, ",").alias("spans"),
    )


@query(table="pages")
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_text(common.documents(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(common.documents(spark, sf_dir).select("doc_id", "text"))


@query()
def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode(docs, path, out=None, packed="packed", decoded="decoded")
    return coded.select(
        "doc_id",
        (F.octet_length("packed") / 4).cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents; of those with a crc32 of the id divisible by ten, the words repeat from some word on.

    With g a tenth of the checksum, n words and a = g % n, the words from a on are those of the first
    1 + (n - a) / (3 + g % 8), over and over.
    """
    blanks = " \t\n\x0b\f\r"
    bare = F.trim(F.coalesce("text", F.lit("")), F.lit(blanks))
    checked = docs.withColumn("_h", F.crc32(F.col("doc_id").cast("string")))
    chosen = (F.col("_h") % 10 == 0) & (bare != "")
    split = checked.withColumn("_w", F.when(chosen, F.split(bare, r"[\x20\x09-\x0D]+")))
    w, g, n = F.col("_w"), F.floor(F.col("_h") / 10), F.size("_w")
    sized = split.withColumn("_a", (g % n).cast("int"))
    a = F.col("_a")
    sized = sized.withColumn("_p", (1 + F.floor((n - a) / (3 + g % 8))).cast("int"))
    again = F.array_repeat(F.slice(w, a + 1, F.col("_p")), F.ceil((n - a) / F.col("_p")).cast("int"))
    words = F.concat(F.slice(w, F.lit(1), a), F.slice(F.flatten(again), F.lit(1), n - a))
    return sized.withColumn("text", F.when(w.isNull(), F.col("text")).otherwise(F.array_join(words, " "))).select("doc_id", "text")


@query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse_runs(with_planted_runs(common.documents(spark, sf_dir).select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    found = found.withColumn("longest", longest)
    length, start, period = F.col("longest")["length"], -F.col("longest")["col2"], -F.col("longest")["col3"]
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"),
        digest(listed).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


def with_shared_heads(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with positions, and lengths, of conversations of which each starts with turns of another.

    With h the checksum of its id modulo 4, a conversation takes the first h turns of the one whose id is the
    next multiple of 20 towards zero, in place of its own first h.
    """
    sizes = prefix_trie.lengths(rows)
    convs = sizes.withColumns({
        "h": F.crc32(F.col("conv_id").cast("string")) % 4, "head_id": F.col("conv_id") - F.col("conv_id") % 20,
    })
    heads = sizes.select(F.col("conv_id").alias("head_id"), F.col("turns").alias("head_turns"))
    convs = convs.join(heads, "head_id", "left").withColumn(
        "taken", F.least("h", F.coalesce("head_turns", F.lit(0)))
    )
    convs = materialize(convs.withColumn("own", F.greatest(F.col("turns") - F.col("h"), F.lit(0))), "conversations")
    own = rows.join(convs, "conv_id").where(F.col("position") > F.col("h"))
    own = own.withColumn("position", F.col("position") - F.col("h") + F.col("taken"))
    first = rows.where((F.col("conv_id") % 20 == 0) & (F.col("position") <= 3)).withColumnRenamed("conv_id", "head_id")
    borrowed = first.join(convs.where("taken > 0"), "head_id").where(F.col("position") <= F.col("taken"))
    names = ["conv_id", "position", "k1", "k2", "words"]
    return own.select(names).unionByName(borrowed.select(names)), convs.select("conv_id", (F.col("taken") + F.col("own")).alias("turns"))


@query("""
WITH ordered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
    {'r': coalesce(role, ''), 't': coalesce(text, '')} AS said
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))
    ), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM ordered)
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, p, said FROM convs c JOIN ordered o ON o.conv_id = c.conv_id - c.conv_id % 20 AND p <= h
  UNION ALL
  SELECT conv_id, 1 AS part, p, said FROM convs JOIN ordered USING (conv_id) WHERE p > h
), seqs AS (
  SELECT conv_id, coalesce(s, []) AS s
  FROM convs LEFT JOIN (SELECT conv_id, list(said ORDER BY part, p) AS s FROM rebuilt GROUP BY conv_id) USING (conv_id)
), paths AS (
  SELECT conv_id, d, list_slice(s, 1, d) AS path, d = len(s) AS ends FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM seqs)
), nodes AS (
  SELECT d, path, min(conv_id) AS node, count(*) AS n,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS listed,
    CASE WHEN d = 0 THEN 0
      ELSE len(list_filter(regexp_split_to_array(path[d]['t'], '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) END AS words
  FROM paths GROUP BY d, path
), placed AS (
  SELECT conv_id, d, node FROM paths JOIN nodes USING (d, path)
), tree AS (
  SELECT n.*, a.node AS up FROM nodes n LEFT JOIN placed a ON a.conv_id = n.node AND a.d = n.d - 1
), fanned AS (
  SELECT t.*, coalesce(c.k, 0) AS k
  FROM tree t LEFT JOIN (SELECT up, d - 1 AS d, count(*) AS k FROM tree WHERE d > 0 GROUP BY ALL) c ON c.up = t.node AND c.d = t.d
), sums AS (
  SELECT a.d, a.node, sum(CASE WHEN f.k = 0 THEN 1 ELSE 0 END) AS leaves, sum((f.n - 1) * f.words) AS saved
  FROM fanned f JOIN placed a ON a.conv_id = f.node AND a.d <= f.d GROUP BY a.d, a.node
)
SELECT node AS conv_id, CAST(d AS BIGINT) AS depth, up AS parent_conv_id, n AS n_convs, CAST(k AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(listed) AS ends_sha256
FROM fanned JOIN sums USING (d, node)
""", table="conversations")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    turns = common.documents(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = materialize(prefix_trie.positions(prefix_trie.turn_keys(turns)), "positions")
    found = prefix_trie.trie(*with_shared_heads(rows))
    digests = prefix_trie.ends_digests(found.ends)
    return found.nodes.join(digests, prefix_trie.PATH, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
