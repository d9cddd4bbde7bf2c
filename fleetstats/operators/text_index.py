"""Pattern search over stored text columns by an index of trigrams.

Beside the rows of a collection stands, for each indexed column, a table of postings: for each three characters (A to Z in
lower case) lists of the rows that hold them, one list or more for each folder of rows. A search takes from its pattern the characters that every match must
contain, intersects the postings of the rarest of them, reads the folders of rows these name, and lets the pattern itself
decide. A pattern without three such characters, or with none rarer than ``SCAN_SHARE``, is searched by scan.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from re import _constants as op
from re import _parser as regex_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstats.functions.text import regex_any_case
from fleetstats.storage import materialize

# Trigrams of a pattern that are intersected, and the share of rows from which on a scan is cheaper than postings.
PROBES = 3
SCAN_SHARE = 0.1

# Alternatives of a pattern that are followed apart; beyond, only what they have in common counts.
ALTERNATIVES = 16

# Code points that are listed at once, at least one text; and the places of a table of trigrams by their characters.
SLICE = 2_000_000
PLACES = 1 << 24

# Where a row stands: its folder and its number in it.
PART, ROW = "index_part", "index_row"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)

# What the two dialects read differently: flags inside the pattern, numbered escapes.
_FOREIGN = re.compile(r"\(\?[a-zA-Z]|\\[0-9]")

_REPEATS = (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT)


def trigrams(rows: DataFrame, column: str) -> DataFrame:
    """For each three characters of a text column, as the patterns of a search compare them, the rows that hold them.

    Rows are those of ``stored_rows``. A list (``gram``, `PART`, `ROW`) covers some texts of one folder, a row at most once;
    other lists may go on with the same trigram.
    """
    def lists(batches):  # nested, so that it travels to workers that do not know this package
        for batch in batches:
            folder, number = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts = [t.decode("utf-8", "replace") for t in batch.column(2).cast(pa.binary()).to_pylist()]
            first, held = 0, 0
            for i, text in enumerate(texts):
                held += len(text)
                if i + 1 == len(texts) or folder[i + 1] != folder[i] or held + len(texts[i + 1]) > SLICE:
                    if (found := of_slice(texts[first:i + 1], number[first:i + 1], folder[i])) is not None:
                        yield found
                    first, held = i + 1, 0

    def of_slice(texts, number, folder):
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        if codes.size < 3:
            return None
        codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
        known = np.zeros(0x110000, np.int64)
        known[codes] = 1
        alphabet = np.flatnonzero(known)
        size = alphabet.size
        known[alphabet] = np.arange(size)
        place = known[codes]
        grams = (place[:-2] * size + place[1:-1]) * size + place[2:]
        ids = grams
        if size ** 3 > PLACES:
            distinct, ids = np.unique(grams, return_inverse=True)
        # the last place of a trigram in its text stays in the table, so that place alone finds itself there
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        last, places, keep = np.empty(min(size ** 3, max(PLACES, ids.size)), np.int64), np.arange(ids.size), np.zeros(ids.size, bool)
        for start, end in zip((ends - lengths).tolist(), (ends - 2).tolist()):
            if start < end:
                last[ids[start:end]] = places[start:end]
                keep[start:end] = last[ids[start:end]] == places[start:end]
        kept = np.flatnonzero(keep)
        if not kept.size:
            return None
        kept = kept[np.argsort(ids[kept], kind="stable")]
        sorted_ids = ids[kept]
        starts = np.concatenate(([0], np.flatnonzero(sorted_ids[1:] != sorted_ids[:-1]) + 1))
        named = grams[kept[starts]]
        chars = alphabet[np.stack([named // (size * size), named // size % size, named % size], axis=1)]
        spelled = chars.astype("<u4").tobytes().decode("utf-32-le")
        rows_of = number[np.searchsorted(ends, kept, side="right")]
        return pa.RecordBatch.from_arrays([
            pa.array([spelled[i:i + 3] for i in range(0, len(spelled), 3)], pa.string()),
            pa.array(np.full(starts.size, folder), pa.int32()),
            pa.ListArray.from_arrays(pa.array(np.append(starts, kept.size), pa.int32()), pa.array(rows_of, pa.int64())),
        ], ["gram", PART, ROW])

    texts = rows.where(F.col(column).isNotNull()).select(PART, ROW, F.col(column).cast("string").alias("text"))
    return texts.mapInArrow(lists, f"gram string, {PART} int, {ROW} array<bigint>")


def _followed(tokens, alternatives: list[tuple[str, frozenset]]) -> list[tuple[str, frozenset]]:
    """Alternatives (last characters, trigrams so far) after some tokens of a parsed pattern."""
    for kind, value in tokens:
        if kind is op.LITERAL:
            grown = [((end + chr(value).translate(_FOLD))[-3:], found) for end, found in alternatives]
            alternatives = [(end, found | {end} if len(end) == 3 else found) for end, found in grown]
        elif kind is op.SUBPATTERN:
            alternatives = _followed(value[3], alternatives)
        elif kind is op.ATOMIC_GROUP:
            alternatives = _followed(value, alternatives)
        elif kind is op.BRANCH:
            alternatives = [a for branch in value[1] for a in _followed(branch, alternatives)]
        elif kind in _REPEATS and value[0] > 0:
            alternatives = _followed(value[2], alternatives)
            if value[1] != 1:
                alternatives = [("", found) for _, found in alternatives]
        elif kind is not op.AT:
            alternatives = [("", found) for _, found in alternatives]
        if len(alternatives) > ALTERNATIVES:
            alternatives = [("", frozenset.intersection(*(found for _, found in alternatives)))]
    return alternatives


def required_trigrams(pattern: str) -> list[frozenset[str]] | None:
    """For each alternative of a pattern the trigrams that all its matches contain; None if one has none."""
    if _FOREIGN.search(pattern):
        return None
    try:
        parsed = regex_parser.parse(pattern)
    except (re.error, OverflowError):
        return None
    found = [grams for _, grams in _followed(parsed, [("", frozenset())])]
    return found if all(found) else None


def write_text_index(
    table: DataFrame, path: str, keys: Sequence[str], columns: Sequence[str], files: int | None = None, buckets: int = 64,
) -> None:
    """Write a collection, sorted by its keys into ranges, and the postings of some text columns.

    Null texts have no postings. A search reads only the buckets of its trigrams and the ranges they name; a range is a
    folder, so `files` should stay in the thousands.
    """
    spark = table.sparkSession
    ranges = table.repartitionByRange(files, *keys) if files else table.repartitionByRange(*keys)
    row_number = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    numbered = ranges.sortWithinPartitions(*keys).withColumns({PART: F.spark_partition_id(), ROW: row_number})
    numbered.limit(0).write.mode("overwrite").parquet(f"{path}/schema")  # an empty collection has no folders
    numbered.write.mode("overwrite").partitionBy(PART).parquet(f"{path}/rows")
    rows = stored_rows(spark, path)
    for column in columns:
        grams = trigrams(rows, column).withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets)).cast("int"))
        postings = grams.hint("rebalance", "bucket").sortWithinPartitions("bucket", "gram", PART)
        postings.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/grams/{column}")
        written = spark.read.schema(grams.schema).parquet(f"{path}/grams/{column}")
        total = rows.agg(F.lit("").alias("gram"), F.lit(-1).alias("bucket"), F.count("*").alias("rows"))
        counts = written.groupBy("gram", "bucket").agg(F.sum(F.size(ROW)).alias("rows"))
        counts.unionByName(total).write.mode("overwrite").parquet(f"{path}/counts/{column}")


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows of an indexed collection, with their places."""
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")


def candidates(spark: SparkSession, path: str, column: str, pattern: str) -> DataFrame | None:
    """The places (`PART`, `ROW`) of the rows that may match a pattern; None if only a scan can tell.

    What reaches the driver is a row for each trigram of the pattern.
    """
    alternatives = required_trigrams(pattern)
    if alternatives is None:
        return None
    wanted = ["", *sorted(frozenset.union(*alternatives))]
    counts = {r["gram"]: r for r in spark.read.parquet(f"{path}/counts/{column}").where(F.col("gram").isin(wanted)).collect()}
    most = SCAN_SHARE * counts[""]["rows"]
    postings = spark.read.parquet(f"{path}/grams/{column}") if len(counts) > 1 else None
    found = []
    for grams in alternatives:
        if not grams <= counts.keys():
            continue  # no row has them all
        rarest = sorted((counts[g] for g in grams), key=lambda r: (r["rows"], r["gram"]))[:PROBES]
        if rarest[0]["rows"] > most:
            return None
        rarest = [r for r in rarest if r["rows"] <= most]
        hit = postings.where(F.col("bucket").isin([r["bucket"] for r in rarest]) & F.col("gram").isin([r["gram"] for r in rarest]))
        hit = hit.select(PART, F.explode(ROW).alias(ROW))
        found.append(hit.groupBy(PART, ROW).agg(F.count("*").alias("n")).where(F.col("n") == len(rarest)).drop("n"))
    if not found:
        return stored_rows(spark, path).select(PART, ROW).where(F.lit(False))
    return reduce(DataFrame.union, found).distinct() if len(found) > 1 else found[0]


def search_text(spark: SparkSession, path: str, patterns: Mapping[str, str], also: Column | None = None) -> DataFrame:
    """The rows of an indexed collection that match a pattern in each of some columns, and a further predicate.

    Patterns are those of ``regex_any_case``. The rows are the same as those of a scan with these predicates; the folders
    read are those that hold candidates. The list of these folders passes through the driver.
    """
    rows = stored_rows(spark, path)
    named = [c for column, p in patterns.items() if (c := candidates(spark, path, column, p)) is not None]
    if named:
        both = materialize(reduce(lambda a, b: a.join(b, [PART, ROW]), named), "candidates")
        parts = [r[0] for r in both.select(PART).distinct().collect()]
        rows = rows.where(F.col(PART).isin(parts)).join(both, [PART, ROW], "left_semi")
    matches = [regex_any_case(F.col(column), p) for column, p in patterns.items()]
    found = reduce(DataFrame.where, [*matches, *([also] if also is not None else [])], rows)
    return found.drop(PART, ROW)
