"""Search over result tables: typed criteria, sorting, pages, drill-down, links."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from fleetstats.functions.sizes import parse_size
from fleetstats.functions.text import regex_any_case
from fleetstats.functions.times import epoch_seconds

# Fixed value: the largest page.
PAGE_CAP = 10_000

# Criterion types whose condition is itself the wanted value.
ENUM_TYPES = ("wf_type", "job_type", "prod_accounts")


class CriterionError(ValueError):
    """A criterion that has no meaning for its type."""


@dataclass(frozen=True)
class Criterion:
    """One condition: a column, its kind in the search form, the condition and its values."""

    column: str
    type: str
    condition: str
    value: Sequence[str] = field(default_factory=tuple)


def _bounds(col: Column, condition: str, values: Sequence, below: str, above: str) -> Column:
    if condition == below:
        return col <= values[0]
    if condition == above:
        return col >= values[0]
    if condition == "between":
        return col.between(values[0], values[1])
    raise CriterionError(f"unknown condition {condition!r}")


def _any_match(col: Column, pattern: str) -> Column:
    return F.exists(col, lambda item: regex_any_case(item, pattern))


def criterion_predicate(c: Criterion, schema: StructType | None = None) -> Column:
    """The predicate of one criterion; raises where it is malformed.

    Dates are compared as epoch seconds, or, where the schema says that the column holds times, as times.
    """
    col = F.col(c.column)
    kind = schema[c.column].dataType if schema is not None and c.column in schema.names else None
    if c.condition in ("null", "!null") and c.type in ("date", "num", "array"):
        return col.isNull() if c.condition == "null" else col.isNotNull()
    try:
        match c.type:
            case "string" if c.condition == "contains":
                return regex_any_case(col, c.value[0])
            case "html":
                size = parse_size(c.value[0])
                if size == 0:
                    raise CriterionError("size is zero")
                return _bounds(col, c.condition, [size], below="ends", above="starts")
            case "date":
                times = [epoch_seconds(v) for v in c.value]
                if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
                    times = [F.timestamp_seconds(F.lit(t)).cast(kind) for t in times]
                return _bounds(col, c.condition, times, below="<", above=">")
            case "num":
                numbers = [int(v.replace(" ", "")) for v in c.value]
                return _bounds(col, c.condition, numbers, below="<=", above=">=")
            case "array" if c.condition == "=":
                return _any_match(col, c.value[0])
            case "array" if c.condition == "!=":
                # rows without the array have no matching element either
                return ~F.coalesce(_any_match(col, c.value[0]), F.lit(False))
            case "boolean" if c.condition in ("true", "false"):
                return col == F.lit(c.condition == "true")
            case kind if kind in ENUM_TYPES:
                return col == F.lit(c.condition)
    except (ValueError, IndexError) as error:
        raise CriterionError(f"{c}: {error}") from error
    raise CriterionError(f"{c}: no such type and condition")


def compile_criteria(
    criteria: Sequence[Criterion],
    logic: str | None = "AND",
    bars: Mapping[str, str] | None = None,
    lenient: bool = False,
    schema: StructType | None = None,
) -> Column:
    """One predicate from the criteria and the texts typed in the search bars.

    The bars are criteria like the others, so under OR they are alternatives. With ``lenient``
    a malformed criterion matches every row instead of raising.
    """
    parts = [regex_any_case(F.col(column), text) for column, text in (bars or {}).items() if text]
    for criterion in criteria:
        try:
            parts.append(criterion_predicate(criterion, schema))
        except CriterionError:
            if not lenient:
                raise
            parts.append(F.lit(True))
    if not parts:
        return F.lit(True)
    return reduce(Column.__or__ if logic == "OR" else Column.__and__, parts)


def order_columns(order: Sequence[tuple[str, str]], unique: Sequence[str]) -> list[Column]:
    """The chosen columns, then the unique key; other directions than asc and desc are ignored."""
    chosen = [
        F.asc_nulls_first(name) if way == "asc" else F.desc_nulls_last(name)
        for name, way in order
        if way in ("asc", "desc")
    ]
    return chosen + [F.asc_nulls_first(name) for name in unique]


def search_page(
    table: DataFrame,
    predicate: Column,
    order: Sequence[tuple[str, str]],
    unique: Sequence[str],
    start: int = 0,
    length: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """A page of the matching rows, and their total number as a one-row table.

    The page is a bounded top-k, so no global sort of the matches takes place. A length of zero or less means the
    largest page; a larger one raises. For pages deep in a result see ``search_page_after``.
    """
    if length > PAGE_CAP:
        raise ValueError(f"a page holds at most {PAGE_CAP} rows, not {length}")
    found = table.where(predicate)
    size = length if length > 0 else PAGE_CAP
    page = found.orderBy(*order_columns(order, unique)).offset(max(start, 0)).limit(size)
    return page, found.agg(F.count("*").alias("recordsFiltered"))


def search_page_after(
    table: DataFrame, predicate: Column, order: Sequence[tuple[str, str]], unique: Sequence[str],
    last: Mapping | None = None, length: int = PAGE_CAP,
) -> DataFrame:
    """The page behind a row: the first rows that come after ``last`` in the order.

    ``last`` has the order and key columns of the last row of the page before. Rows before it are filtered out, so a
    deep page costs no more than the first one.
    """
    if not 0 < length <= PAGE_CAP:
        raise ValueError(f"a page holds 1 to {PAGE_CAP} rows, not {length}")
    found = table.where(predicate)
    ways = [(name, way) for name, way in order if way in ("asc", "desc")] + [(name, "asc") for name in unique]
    if last is not None:
        behind, same = F.lit(False), F.lit(True)
        for name, way in ways:
            col, at = F.col(name), F.lit(last[name])
            # nulls come first in ascending and last in descending order
            if way == "asc":
                step = col.isNotNull() if last[name] is None else col > at
            else:
                step = F.lit(False) if last[name] is None else (col < at) | col.isNull()
            behind, same = behind | (same & step), same & col.eqNullSafe(at)
        found = found.where(behind)
    return found.orderBy(*order_columns(order, unique)).limit(length)


def drilldown(table: DataFrame, **keys) -> DataFrame:
    """Rows equal in every key that was given; keys that are None or empty are left open."""
    given = [F.col(k) == F.lit(v) for k, v in keys.items() if v is not None and v != ""]
    return table.where(reduce(Column.__and__, given)) if given else table


def key_value_query(records: DataFrame, text: str, order: Sequence[str], root: str = "data.payload", start: int = 0,
                    size: int = 10) -> DataFrame:
    """``key:val,key:val``: rows equal in all keys below ``root``; a page of ``size`` rows.

    A page needs an order, which should end with a unique column.
    """
    if not order:
        raise ValueError("a page needs an order")
    found = records
    for pair in text.split(","):
        key, value = (part.strip() for part in pair.split(":", 1))
        path = key if key.startswith(root) else f"{root}.{key}"
        found = found.where(F.col(path).cast("string") == value)
    return found.orderBy(*order).offset(start).limit(size)


def add_links(table: DataFrame, template: str, fields: Mapping[str, Column], name: str = "Links") -> DataFrame:
    """A text column made from a template whose placeholders are replaced by row values."""
    link = F.lit(template)
    for placeholder, value in fields.items():
        link = F.replace(link, F.lit(placeholder), F.coalesce(value.cast("string"), F.lit("")))
    return table.withColumn(name, link)


def readable_request(criteria: Sequence[Criterion], logic: str = "AND", bar: str = "") -> str:
    """A request as the readable end of its id: logic, search bar, ``column.condition:values++``."""
    parts = [f"{c.column}.{c.condition.lower()}:{','.join(c.value)}++" for c in criteria]
    return (logic.lower() + "+" + (bar + "+" if bar else "") + "".join(parts)).replace("/", "_").replace(" ", "")


def saved_query_id(request: Column, page: Column, readable: Column) -> Column:
    """Id of a saved request: start of its hash, the page, the readable text."""
    return F.concat_ws("+", F.substring(F.md5(request), 1, 8), page, readable)


def display(col: Column) -> Column:
    """An array as one line of text."""
    return F.array_join(col, ", ")
