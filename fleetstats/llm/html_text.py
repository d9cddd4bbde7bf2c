"""Main text of web pages by differencing with the page of the nearest address.

Pages of a host are ordered by the path and then the query of their address, and each is paired with the neighbour
whose address shares the longer beginning. What the markup itself names as no part of an article (menus, forms, adverts, comments and so on)
goes. The other lines of the two pages, inside marked articles and outside, are aligned by a longest common
subsequence; lines that both pages hold are the site's and go. Where a page marks its article, so do the lines around
it. Articles that share most of their lines are copies and stay whole, and paragraphs and titles of an `article`
element are its own text even where the neighbour has them too. Inside an article a class or id is believed of a block
that holds others; of a single paragraph, list item or word only if the neighbour has the same line.

The order within hosts is made by a range partitioning, so that a host of a third of all pages is spread over many
tasks; the rows at the borders of the ranges, two to a task, are matched afterwards.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetstats.llm.common import add_columns, fresh, row_key
from fleetstats.storage import materialize

# The markup that begins a block, that is never shown, and that stands around articles.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = ("script", "style", "template", "svg", "iframe", "noembed")
ARTICLES = frozenset(("article", "main"))
RUNNING = frozenset(("p", "h1"))  # blocks that inside an `article` hold its own text
AROUND = frozenset("aside button dialog footer form head header menu nav noscript select textarea".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu navigation search".split())
NAMES = frozenset(
    "ad ads advert advertisement advertising adverts alert alerts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr header masthead menu menus modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promoted related responses share sharing sidebar signup social sponsor sponsored submenu "
    "subscribe toolbar widget".split()
)
# Words that stand in articles too: there they are a hint that the neighbour must confirm.
DOUBTFUL = frozenset("alert alerts banner masthead menu menus modal notice notices popup related responses toolbar widget".split())
# In an article, other names alone tell what these hold; of other elements they are a hint as well.
CONTAINERS = frozenset("aside blockquote center details dialog dir div dl fieldset figure ol section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What ends an open element whose end tag may be left out, and the elements around it that bound this.
CELLS = frozenset("td th tr tbody tfoot thead".split())
ENDED_BY = {
    "p": BLOCKS - {"br", "button", "legend", "optgroup", "option", "select", "title"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": CELLS, "th": CELLS, "tr": CELLS - {"td", "th"},
    "option": {"option", "optgroup"},
}
LISTS = frozenset("dir menu ol ul".split())
BOUNDS = {
    "p": {"button"}, "li": LISTS, "dt": {"dl"}, "dd": {"dl"}, "td": {"table"}, "th": {"table"}, "tr": {"table"},
    "option": {"select"},
}

# What stands in a tag behind its name; a quote opens a value only behind an equals sign.
INSIDE = r"(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(" + "|".join(HIDDEN) + r")\b" + INSIDE + r">.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)(" + INSIDE + r")(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)

# Host, path and query of an address; what ends the steps of a place in the order of a host.
ADDRESS = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#@]*?)(?::[0-9]*)?\s*(?=[/?#]|$)([^?#]*)\??([^#]*)"
STEP, ENDS = "[/\u0001]", "\u0001"
VERSION = 0.1  # of an unmarked page's characters, not shared with another page of its path


@dataclass
class Line:
    """A block of shown text: whether an article is open around it, and markup that is no part of one.

    `running` is a paragraph or title inside an `article` element. What is `hinted` goes if the neighbour has it too.
    `joint` stands before the text if the line before is kept: no line feed within a block.
    """

    text: str
    in_article: bool
    aside: bool
    running: bool = False
    hinted: bool = False
    joint: str = "\n"


def is_aside(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is no part of an article by its tag, role, class or id, and whether it is only hinted to be.

    An article may have a header. The id of a heading is made from its words and tells nothing.
    """
    if tag in ARTICLES or tag in ("html", "body"):
        return False, False
    if tag in AROUND and not (tag == "header" and in_article):
        return True, False
    hinted = False
    for name, *values in ATTRIBUTE.findall(attributes):
        parted = re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(values)).lower()
        words = set(re.split(r"[^a-z0-9]+", parted)) - ({"header"} if in_article else set())
        if name.lower() == "role":
            if words & ROLES:
                return True, False
        elif words & NAMES and not (name.lower() == "id" and tag in HEADINGS):
            if not in_article or tag in CONTAINERS and words & NAMES - DOUBTFUL:
                return True, False
            hinted = True
    return False, hinted


def lines_of(page: str | None) -> list[Line]:
    """The blocks of text of a page in order; white space inside one is a single space."""
    out, held = [], []
    open_tags: list[tuple[str, bool, bool, bool]] = []  # (tag, article, aside, hinted)
    articles = asides = hints = unended = at = 0  # unended: open elements whose end tag may be left out
    opened: dict[str, int] = defaultdict(int)  # open elements by tag
    block, joint = "", "\n"  # the tag that the text at hand stands in, and what joins it to the line before

    def close_block(next_joint="\n"):
        nonlocal joint
        if held:
            raw = html.unescape("".join(held))
            held.clear()
            if text := " ".join(raw.split()):
                running = block in RUNNING and opened["article"] > 0
                before = " " if not joint and raw[0].isspace() else joint
                out.append(Line(text, articles > 0, asides > 0, running, hints > 0, before))
                joint = ""
            if not joint and raw[-1:].isspace():
                joint = " "
        joint = next_joint if next_joint else joint

    def close_tags(depth):
        nonlocal articles, asides, hints, unended
        inline = all(tag not in BLOCKS and not aside for tag, _, aside, _ in open_tags[depth:])
        if not inline or any(o[3] for o in open_tags[depth:]):
            close_block("" if inline else "\n")
        for tag, article, aside, hinted in open_tags[depth:]:
            opened[tag] -= 1
            unended -= tag in ENDED_BY
            articles -= article
            asides -= aside
            hints -= hinted
        del open_tags[depth:]

    def depth_of(tag):
        """Where an open element of this tag is that may be ended here."""
        if not opened[tag]:
            return None
        for i in range(len(open_tags) - 1, -1, -1):
            if open_tags[i][0] == tag:
                return i
            if open_tags[i][0] in BOUNDS.get(tag, ()):
                return None
        return None

    page = page or ""
    for token in TOKEN.finditer(page):
        if token.start() > at:
            held.append(page[at:token.start()])
        at = token.end()
        tag = (token[3] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            close_block()
            if not token[2] and unended:
                for ended, by in ENDED_BY.items():
                    if tag in by and (depth := depth_of(ended)) is not None:
                        close_tags(depth)
            if tag not in VOID:
                block = "" if token[2] else tag
        if token[2]:
            if (depth := depth_of(tag)) is not None:
                close_tags(depth)
            continue
        if tag == "body":  # a head that was not closed ends here
            close_tags(0)
        if tag in VOID or token[4].rstrip().endswith("/"):
            continue
        article, (aside, hinted) = tag in ARTICLES, is_aside(tag, token[4], articles > 0)
        if article or aside or hinted or open_tags or tag in ("html", "body"):
            if article or aside or hinted:
                close_block("" if hinted and tag not in BLOCKS else "\n")
            if tag not in ENDED_BY or article or aside or hinted:
                open_tags.append((tag, article, aside, hinted))
                opened[tag] += 1
                unended += tag in ENDED_BY
                articles += article
                asides += aside
                hints += hinted
    held.append(page[at:])
    close_block()
    return out


# Places of a line that are put together anew each time; the bits of more are kept.
FEW_PLACES = 64


def line_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def shared(own: list[int], other: list[int]) -> list[bool]:
    """Which of one page's lines are in a longest common subsequence with the other's.

    Bit i of a row is 0 where line i of the other page adds to the length of the subsequence with the lines so far. Of the
    rows, one for each line, as many are kept as their number's root; those between are made again on the way back.
    """
    at: dict[int, list[int]] = defaultdict(list)
    for i, h in enumerate(other):
        at[h].append(i)
    often = {h: mask(places) for h, places in at.items() if len(places) > FEW_PLACES}
    every = (1 << len(other)) - 1

    def places_of(h: int) -> int:
        return often[h] if h in often else mask(at.get(h, ()))

    def next_row(v: int, h: int) -> int:
        u = v & places_of(h) if h in at else 0
        return ((v + u) | (v - u)) & every if u else v

    step = max(1, math.isqrt(len(own)))
    marks = [every]
    row = every
    for i, h in enumerate(own, 1):
        row = next_row(row, h)
        if i % step == 0:
            marks.append(row)
    out, j = [False] * len(own), len(other)
    for block in range((len(own) - 1) // step, -1, -1):
        first = block * step
        rows = [marks[block]]
        for h in own[first:first + step]:
            rows.append(next_row(rows[-1], h))
        for i in range(len(rows) - 1, 0, -1):
            if rows[i] == rows[i - 1]:
                continue
            here = ~rows[i] & ((1 << j) - 1)  # places before j where the length grows with i lines
            before = ~rows[i - 1] & ((1 << j) - 1)
            if here.bit_count() > before.bit_count():
                # line i is needed: it takes the last of its places at which the length is reached
                own_places = places_of(own[first + i - 1]) & ((1 << j) - 1)
                while own_places:
                    place = own_places.bit_length() - 1
                    if (~rows[i - 1] & ((1 << place) - 1)).bit_count() + 1 == here.bit_count():
                        out[first + i - 1], j = True, place
                        break
                    own_places ^= 1 << place
    return out


def mask(places) -> int:
    out = 0
    for p in places:
        out |= 1 << p
    return out


def compared(lines: list[Line]) -> list[int]:
    """What a neighbour is told of a page's lines: their hashes, the lowest bit set inside an article, less asides."""
    return [line_hash(line.text) & ~1 | line.in_article for line in lines if not line.aside]


def main_text(lines: list[Line], neighbour: list[int] | None, same_path: bool = False) -> str:
    """The article: lines that neither markup nor the neighbouring page (see `compared`) tell to be the site's.

    Of pages of one path without a marked article, that differ in little, each is a version of the other and loses nothing.
    Where most lines of both pages' articles are shared, one is a copy of the other and no line of it is the site's;
    nor is a paragraph or title of an `article` element, unless a name hints at it.
    """
    own = [line for line in lines if not line.aside]
    marked = any(line.in_article for line in own)
    found = [False] * len(own)
    if neighbour:
        found = shared([h & ~1 for h in compared(own)], [h & ~1 for h in neighbour])
        inside = [s for line, s in zip(own, found) if line.in_article]
        if 2 * sum(inside) > max(len(inside), sum(h & 1 for h in neighbour)):
            found = [s and not line.in_article for line, s in zip(own, found)]
        found = [s and (line.hinted or not line.running) for line, s in zip(own, found)]
    offered = [line.in_article or not marked for line in own]
    kept = {id(line) for line, is_shared, o in zip(own, found, offered) if o and not is_shared}
    chars = {True: 0, False: 0}
    for line, is_shared in zip(own, found):
        chars[is_shared] += len(line.text)
    version = same_path and not marked and chars[False] < VERSION * sum(chars.values())
    if not kept or version:  # nothing but shared lines: two addresses of one page
        kept = {id(line) for line, o in zip(own, offered) if o}
    out, gap = [], ""
    for line in lines:
        gap += line.joint
        if id(line) in kept:
            out += ["\n" if "\n" in gap else gap[:1], line.text] if out else [line.text]
            gap = ""
    return "".join(out)


def address(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query of an address; a null host where it has none.

    What the strict reading refuses, such as a host with an underscore or an address with blanks, is cut by a pattern.
    """
    def part(name: str, group: int) -> Column:
        return F.coalesce(F.try_parse_url(url, F.lit(name)), F.regexp_extract(url, ADDRESS, group))

    path = F.regexp_replace(part("PATH", 2), r"/+$", "")
    return F.nullif(F.lower(part("HOST", 1)), F.lit("")), F.coalesce(F.nullif(path, F.lit("")), F.lit("/")), part("QUERY", 3)


def alike(place: Column, other: Column) -> Column:
    """The number of leading steps that two places share: those of the path, then the query."""
    a, b = F.split(place, STEP), F.split(other, STEP)
    same = F.transform(F.sequence(F.lit(0), F.least(F.size(a), F.size(b)) - 1), lambda i: F.get(a, i) == F.get(b, i))
    return F.coalesce(F.array_position(same, F.lit(False)), F.size(same))


NEIGHBOURS = T.StructType([
    T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("before", T.StringType()), T.StructField("behind", T.StringType()),
    T.StructField("edge", T.BooleanType(), False),
])


def neighbours(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host and path, each with the paths beside it; the first and the last do not know one of them."""
    first, last = True, None  # the last row is held back until the one behind it is seen
    arrow = pa.schema([("host", pa.string()), ("path", pa.string()), ("before", pa.string()), ("behind", pa.string()),
                       ("edge", pa.bool_())])
    for batch in batches:
        rows = []
        for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
            if last:
                behind = path if host == last[0] else None
                rows.append((*last[:3], behind, last[3]))
            before = last[1] if last and last[0] == host else None
            last, first = (host, path, before, first), False
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
    if last:
        rows = [(*last[:3], None, True)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


def nearest(paths: DataFrame) -> DataFrame:
    """(host, path, near): for distinct paths the neighbour in the order of their host that is most alike."""
    dealt = paths.repartitionByRange("host", "path").sortWithinPartitions("host", "path")
    # written, since both its uses must see the same ranges
    beside = materialize(dealt.mapInArrow(neighbours, NEIGHBOURS), "beside")
    inner = beside.where(~F.col("edge"))
    order = Window.orderBy("host", "path")  # two rows to a task

    def next_edge(path, other):
        return F.when(F.col("host") == F.col(other + "_host"), F.col(other + "_path")).otherwise(F.lit(None))

    edges = beside.where("edge").withColumns({
        "b_host": F.lag("host").over(order), "b_path": F.lag("path").over(order),
        "n_host": F.lead("host").over(order), "n_path": F.lead("path").over(order),
    }).select(
        "host", "path", F.coalesce("before", next_edge("path", "b")).alias("before"),
        F.coalesce("behind", next_edge("path", "n")).alias("behind"),
    )
    every = inner.drop("edge").unionByName(edges)
    closer = alike(F.col("path"), F.col("behind")) > alike(F.col("path"), F.col("before"))
    near = F.when(F.col("before").isNull() | (F.col("behind").isNotNull() & closer), F.col("behind")).otherwise(F.col("before"))
    return every.select("host", "path", near.alias("near")).where(F.col("near").isNotNull())


def extract_text(pages: DataFrame, url: str = "url", page: str = "html", out: str = "text") -> DataFrame:
    """The rows with the main text of their page, its blocks joined by line feeds.

    A null or empty page has the empty text. Pages without a usable address, and those whose host has no other page,
    have no neighbour and lose only what their markup names. Pages of a path are in the order of their queries; those
    that also have the same lines are one page. A page all of whose lines are its neighbour's keeps them, as does an
    unmarked page of which another page of its path has nine tenths. Repeated rows give repeated results, an empty
    table an empty one.
    """
    names = {n: fresh([*pages.columns, out], f"_{n}") for n in ("a", "b", "theirs", "same", "both")}
    held = T.StructType([T.StructField("lines", T.ArrayType(T.LongType()))])

    def hashes(htmls):
        return [[compared(lines_of(h)) for h in htmls]]

    key = row_key(f"`{url}`", f"`{page}`")
    host, path, query = address(F.col(f"`{url}`"))
    keyed = pages.select(
        host.alias("host"), path.alias("path"), query.alias("query"), key[0].alias("a"), key[1].alias("b"),
        F.col(f"`{page}`").alias("page"))
    hashed = add_columns(keyed.where(F.col("host").isNotNull()), "page", held, hashes).drop("page")
    content = [F.xxhash64(*salt, F.col("host"), F.col("path"), F.col("lines")) for salt in ((), (F.lit(7),))]
    hashed = materialize(hashed.where(F.size("lines") > 0).withColumns(dict(zip(("k1", "k2"), content))), "lines")
    places = hashed.groupBy("host", "path", "k1", "k2").agg(F.min("query").alias("query"))
    place = F.concat_ws(ENDS, "path", F.translate("query", ENDS, ""), F.concat(*[
        F.lpad(F.hex(k), 16, "0") for k in ("k1", "k2")]))
    pairs = nearest(places.select("host", place.alias("path")))

    def keys_of(place: Column) -> list[Column]:
        return [F.conv(F.substr(place, F.lit(at), F.lit(16)), 16, -10).cast("long") for at in (-32, -16)]

    own, other = keys_of(F.col("path")), keys_of(F.col("near"))
    same = F.substring_index("path", ENDS, 1) == F.substring_index("near", ENDS, 1)
    pairs = pairs.select(own[0].alias("k1"), own[1].alias("k2"), other[0].alias("n1"), other[1].alias("n2"), same.alias("same"))
    rows = hashed.select("a", "b", "k1", "k2").distinct().join(pairs, ["k1", "k2"]).drop("k1", "k2")
    contents = hashed.groupBy(F.col("k1").alias("n1"), F.col("k2").alias("n2")).agg(F.any_value("lines").alias("theirs"))
    told = rows.join(contents, ["n1", "n2"]).select(
        *[F.col(c).alias(names[c]) for c in ("a", "b", "theirs", "same")])
    joined = pages.withColumns({names["a"]: key[0], names["b"]: key[1]}).join(told, [names["a"], names["b"]], "left")
    both = joined.withColumn(names["both"], F.struct(F.col(f"`{page}`"), F.col(names["theirs"]), F.col(names["same"])))
    both = both.drop(names["a"], names["b"], names["theirs"], names["same"])
    added = T.StructType([T.StructField(out, T.StringType(), False)])

    def texts(rows):
        return [[main_text(lines_of(r[page]), r[names["theirs"]], bool(r[names["same"]])) for r in rows]]

    return add_columns(both, names["both"], added, texts).drop(names["both"])
