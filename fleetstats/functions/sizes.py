"""Sizes written for people, as numbers of bytes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unit letters in order; each step multiplies by 1024 (or 1000).
UNITS = "KMGTPEZY"


def bytes_from_text(col: Column, base: int = 1024) -> Column:
    """``'1.5 T'`` -> bytes as double; no unit means bytes; anything else is null."""
    number = F.regexp_extract(col, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*[A-Za-z]*\s*$", 1)
    unit = F.upper(F.regexp_extract(col, r"^\s*[0-9.]+\s*([A-Za-z]?)", 1))
    power = F.when(unit == "", F.lit(0)).otherwise(F.instr(F.lit(UNITS), unit))
    known = (unit == "") | (power > 0)
    return F.when(known, number.try_cast("double") * F.pow(F.lit(float(base)), power))


def parse_size(text: str) -> int:
    """A size a user typed (``'10 TB'``), in steps of 1000; raises if it is not one."""
    match = re.fullmatch(r"([0-9]*\.?[0-9]+)([KMGTPE]B)?", text.replace(" ", "").upper())
    if not match:
        raise ValueError(f"not a size: {text!r}")
    number, unit = match.groups()
    steps = "KMGTPE".index(unit[0]) + 1 if unit else 0
    return int(float(number) * 1000**steps)
