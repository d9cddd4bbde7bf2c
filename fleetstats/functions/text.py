"""Text rules shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def regex_any_case(col: Column, pattern: str) -> Column:
    """Case-insensitive search in which ``^`` and ``$`` match at every line."""
    return col.rlike("(?im)" + pattern)


def index_group(name: Column, prefix: str, marker: str = "_raw_") -> Column:
    """Index family: drop the first ``prefix``, keep what stands before ``marker``."""
    at = F.instr(name, prefix)
    bare = F.when(
        at > 0,
        F.concat(F.substring(name, F.lit(1), at - 1), F.substring(name, at + len(prefix), F.length(name))),
    ).otherwise(name)
    return F.substring_index(bare, marker, 1)


def plain_dn(dn: Column) -> Column:
    """Certificate subject without its serial-number parts."""
    return F.regexp_replace(dn, r"/CN=\d+", "")


def one_line(text: Column) -> Column:
    """Text without line breaks and double quotes."""
    return F.translate(text, '\n"', "")


def task_prefix(task: Column) -> Column:
    """First element of a slash path."""
    return F.get(F.split(task, "/", -1), F.lit(1))


def split_by_pattern(line: Column, pattern: str, groups: int) -> Column:
    """What stands before the match and then all its groups, as an array of ``groups + 1``.

    A line that does not match gives an array of one. The line is matched once, however many
    groups are read from the result. The control character that parts the groups is taken out of the line first.
    """
    sep = "\u0001"
    joined = F.regexp_replace(F.translate(line, sep, ""), pattern, sep + sep.join(f"${i}" for i in range(1, groups + 1)))
    return F.split(joined, sep, -1)
