"""Document fingerprints as invertible Bloom lookup sketches, in built-in functions only.

A paragraph (a line) is a digest of 64 bits, added to one cell of each of four tables; a cell holds a count, the
exclusive or of its digests and that of their checks. Two sketches of one size are subtracted cell by cell: what both
texts hold cancels. Cells that are left with one digest give it up, and taking it out of its other cells frees more
(peeling). Where a sketch is too small to be emptied so, the texts are sketched again in more cells: segments by
digest, each a sketch of its own, four times as many with each retry. The likeness of two texts is the share of the
paragraphs of both that neither misses.

All of this is done within a row. Texts meet their successors by windows over groups of 256 ids; the last row of a group
gets the head of the next group, found in the same way among the heads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetstats.llm.simhash import keys
from fleetstats.storage import materialize

TABLES = 4
WIDTH, RETRY_WIDTH = 6, 12  # cells of a table in a fingerprint, and in a segment of a retry
RETRIES = 9  # sizes that are tried; with segments by fours the last takes some millions of paragraphs
FIRST_SEGMENTS, GROWTH_BITS = 2, 2
ROUNDS = 20
GROUP_BITS = 8


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression that uses a value several times and computes it once."""
    return F.get(F.transform(F.array(value), use), 0)


def digests(text: Column) -> Column:
    """The digests of the distinct paragraphs of a text; an empty text has none."""
    lines = F.when(F.length(text) > 0, F.split(text, "\n")).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))


def check(digest: Column) -> Column:
    return F.xxhash64(F.lit(1), digest).bitwiseAND(F.lit(0xFFFFFFFF))


def places(digest: Column, level: Column, width: Column) -> Column:
    """One bit for each of the cells of a digest."""
    def bits(h):
        cells = [
            F.call_function("shiftleft", F.lit(1).cast("long"), (
                F.shiftrightunsigned(h, 15 * t).bitwiseAND(F.lit(0x7FFF)) % width + width * t).cast("int"))
            for t in range(TABLES)
        ]
        return cells[0] + cells[1] + cells[2] + cells[3]
    return let(F.xxhash64(level, digest), bits)


def has(bits: Column, cell: Column) -> Column:
    return F.call_function("shiftright", bits, cell).bitwiseAND(F.lit(1).cast("long")) == 1


def cell(n: Column, d: Column, c: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), d.cast("long").alias("d"), c.cast("long").alias("c"))


def sketch(found: Column, level: Column, width: Column) -> Column:
    """The cells of some digests."""
    items = F.transform(found, lambda d: F.struct(
        d.alias("d"), check(d).alias("c"), places(d, level, width).alias("p")))
    return let(items, lambda listed: F.transform(F.sequence(F.lit(0), width * TABLES - 1), lambda i: F.aggregate(
        F.filter(listed, lambda x: has(x["p"], i)), cell(F.lit(0), F.lit(0), F.lit(0)),
        lambda s, x: cell(s["n"] + 1, s["d"].bitwiseXOR(x["d"]), s["c"].bitwiseXOR(x["c"])),
    )))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: cell(
        x["n"] - y["n"], x["d"].bitwiseXOR(y["d"]), x["c"].bitwiseXOR(y["c"])))


def peel(cells: Column, level: Column, width: Column) -> Column:
    """Of a difference: how many digests only the first and only the second has; null if it can't be emptied."""
    def state(left, a, b, done):
        return F.struct(left.alias("cells"), a.alias("a"), b.alias("b"), done.alias("done"))

    def pure(left):
        single = F.filter(left, lambda x: x["n"].isin(1, -1) & (x["c"] == check(x["d"])))
        return F.array_distinct(F.transform(single, lambda x: F.struct(
            x["n"].alias("n"), x["d"].alias("d"), x["c"].alias("c"), places(x["d"], level, width).alias("p"))))

    def without(left, found):
        return F.transform(left, lambda x, i: F.aggregate(
            F.filter(found, lambda y: has(y["p"], i)), x,
            lambda s, y: cell(s["n"] - y["n"], s["d"].bitwiseXOR(y["d"]), s["c"].bitwiseXOR(y["c"]))))

    def count(found, n):
        return F.size(F.filter(found, lambda y: y["n"] == n))

    def step(s, _):
        return F.when(s["done"], s).otherwise(let(pure(s["cells"]), lambda found: F.when(
            F.size(found) == 0, state(s["cells"], s["a"], s["b"], F.lit(True))
        ).otherwise(state(
            without(s["cells"], found), s["a"] + count(found, 1), s["b"] + count(found, -1), F.lit(False)))))

    def emptied(s):
        rest = F.exists(s["cells"], lambda x: (x["n"] != 0) | (x["d"] != 0) | (x["c"] != 0))
        return F.when(~rest, F.struct(s["a"].alias("a"), s["b"].alias("b")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), state(cells, F.lit(0), F.lit(0), F.lit(False)), step, emptied)


def attempt(a: Column, b: Column, cells_a: Column, cells_b: Column, level: Column) -> Column:
    """The differences of two texts by sketches of one size; null if it is too small.

    Level 0 is that of the fingerprints; each further one has four times as many segments, each a sketch of the
    digests that fall into it. A level takes a time in proportion to the digests, but for putting them in order.
    """
    width = F.when(level == 0, WIDTH).otherwise(RETRY_WIDTH)
    segments = F.when(level == 0, 1).otherwise(
        F.call_function("shiftleft", F.lit(FIRST_SEGMENTS), (level - 1) * GROWTH_BITS))

    def segment(d):
        return F.pmod(F.xxhash64(-level, d), segments)

    def difference(items):
        """The cells of tagged digests, those of the second text taken away."""
        placed = F.transform(items, lambda x: F.struct(
            x["n"].alias("n"), x["d"].alias("d"), check(x["d"]).alias("c"), places(x["d"], level, width).alias("p")))
        return let(placed, lambda listed: F.transform(F.sequence(F.lit(0), width * TABLES - 1), lambda i: F.aggregate(
            F.filter(listed, lambda x: has(x["p"], i)), cell(F.lit(0), F.lit(0), F.lit(0)),
            lambda s, x: cell(s["n"] + x["n"], s["d"].bitwiseXOR(x["d"]), s["c"].bitwiseXOR(x["c"])))))

    def tagged(found, n):
        return F.transform(found, lambda d: F.struct(segment(d).alias("s"), F.lit(n).alias("n"), d.alias("d")))

    def first_segment():
        kept = [F.filter(tagged(found, n), lambda x: x["s"] == 0) for found, n in ((a, 1), (b, -1))]
        return peel(difference(F.concat(*kept)), level, width)

    def by_segment(listed):
        """The digests in the order of their segments, cut where the next one begins."""
        n = F.size(listed)
        begins = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(listed, i)["s"] != F.get(listed, i - 1)["s"]))
        return let(begins, lambda starts: F.transform(starts, lambda at, k: F.slice(
            listed, at + 1, F.coalesce(F.get(starts, k + 1), n) - at)))

    def every_segment():
        groups = let(F.array_sort(F.concat(tagged(a, 1), tagged(b, -1))), by_segment)
        return F.transform(groups, lambda items: peel(difference(items), level, width))

    def total(peeled):
        none = F.exists(peeled, lambda x: x.isNull())

        def sums(name):
            return F.aggregate(peeled, F.lit(0), lambda s, x: s + x[name]).alias(name)
        return F.when(~none, F.struct(sums("a"), sums("b")))

    # one segment that can't be emptied is enough to fail, so the first is tried before the digests are put in order
    nothing = F.array(F.lit(None).cast("struct<a: int, b: int>"))
    peeled = F.when(level == 0, F.array(peel(subtract(cells_a, cells_b), level, width))).when(
        first_segment().isNull(), nothing).otherwise(every_segment())
    return let(peeled, total)


def differences(a: Column, b: Column, cells_a: Column, cells_b: Column) -> Column:
    """How many paragraphs only one of two texts has: from their fingerprints, or from larger sketches on failure.

    What no size gives is counted from the digests themselves.
    """
    none = F.lit(None).cast("struct<a: int, b: int>")
    tried = F.aggregate(F.sequence(F.lit(0), F.lit(RETRIES)), none, lambda found, level: F.when(
        found.isNull(), attempt(a, b, cells_a, cells_b, level)).otherwise(found))
    exact = F.struct(F.size(F.array_except(a, b)).alias("a"), F.size(F.array_except(b, a)).alias("b"))
    return F.coalesce(tried, exact)


def likeness(a: Column, found: Column) -> Column:
    """Paragraphs of both texts among those of either; 1 for two texts without any."""
    either = F.size(a) + found["b"]
    return F.when(either == 0, 1.0).otherwise((F.size(a) - found["a"]) / either)


def written(found: Column, cells: Column) -> Column:
    """A fingerprint as text: the number of paragraphs, then count, digests and checks of each cell in hex."""
    def digits(x, n):
        return F.lpad(F.hex(x.cast("long")), n, "0")
    return F.lower(F.concat(digits(F.size(found), 8), F.array_join(F.transform(
        cells, lambda x: F.concat(digits(x["n"], 4), digits(x["d"], 16), digits(x["c"], 8))), "")))


def with_next(rows: DataFrame, order: list[str], least: int, most: int) -> DataFrame:
    """Rows of (`order`..., text) with `next`, the text of the row after; the first row's after the last one.

    The first column of the order is a whole number; rows are grouped by it without its last bits.
    """
    top = most - least < 1 << GROUP_BITS
    group = F.lit(0).cast("long") if top else F.shiftright(F.col(order[0]), GROUP_BITS)
    window = Window.partitionBy("_group").orderBy(*order)
    grouped = rows.withColumn("_group", group)
    beside = grouped.withColumns({
        "next": F.lead("text").over(window), "_head": F.row_number().over(window) == 1,
    })
    if top:
        whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        first = F.first("text").over(whole)
        return beside.withColumn("next", F.coalesce("next", first)).drop("_group", "_head")
    heads = beside.where("_head").select(F.col("_group").alias("g"), "text")
    after = with_next(heads, ["g"], least >> GROUP_BITS, most >> GROUP_BITS)
    after = after.select(F.col("g").alias("_group"), F.col("next").alias("_after"))
    joined = beside.join(after, "_group")
    return joined.withColumn("next", F.coalesce("next", "_after")).drop("_group", "_head", "_after")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: `id_col`, n_chars, edited_text's digest and fingerprints, and their likeness.

    `edited_sha256` is of the text whose last half (rounded down, in code points) is replaced by as many code points from
    the start of the next text, by ascending id; after the last one comes the first. `fingerprint` and
    `edited_fingerprint` are the sketches of both, `near_edited` and `near_next` the likeness of the text to the edited
    and to the next one. A null text is an empty one. Null ids come before all others; rows that share an id follow
    each other by the key of the row, equal rows in any order. A single row is its own successor, an empty table gives
    an empty result.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    bounds = docs.agg(F.min(id_col).alias("a"), F.max(id_col).alias("b")).first()
    least, most = (bounds["a"] or 0) - 1, bounds["b"] or 0
    high, low = keys(docs.select(id_col, text))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("o"), high.alias("k1"), low.alias("k2"),
        F.col(id_col).alias("id"), F.coalesce(text, F.lit("")).alias("text"),
    )
    paired = with_next(rows, ["o", "k1", "k2"], least, most)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next", F.lit(1), half))
    versions = paired.select("id", n.cast("long").alias("n_chars"), "text", "next", edited.alias("edited"))
    listed = materialize(versions.select(
        "id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("e"), digests(F.col("next")).alias("x"),
    ), "paragraphs")
    sketched = listed.withColumns({f"s{c}": sketch(F.col(c), F.lit(0), F.lit(WIDTH)) for c in "aex"})
    a = F.col("a")
    others = F.array(*[F.struct(F.col(c).alias("d"), F.col("s" + c).alias("s")) for c in "ex"])
    near = F.transform(others, lambda o: let(differences(a, o["d"], F.col("sa"), o["s"]), lambda f: likeness(a, f)))
    return sketched.withColumn("near", near).select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256",
        written(a, F.col("sa")).alias("fingerprint"), written(F.col("e"), F.col("se")).alias("edited_fingerprint"),
        F.get("near", 0).alias("near_edited"), F.get("near", 1).alias("near_next"),
    )
