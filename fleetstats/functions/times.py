"""Times, periods and durations."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC = timezone.utc


def utc(day: str | date | datetime) -> datetime:
    """Midnight UTC of a day, or the time itself made UTC-aware."""
    if isinstance(day, str):
        day = datetime.fromisoformat(day)
    if not isinstance(day, datetime):
        day = datetime.combine(day, time.min)
    return day if day.tzinfo else day.replace(tzinfo=UTC)


def epoch_seconds(day: str | date | datetime) -> int:
    return int(utc(day).timestamp())


def epoch_millis(day: str | date | datetime) -> int:
    return epoch_seconds(day) * 1000


def reporting_window(start=None, end=None, last_n_days: int = 30, today: date | None = None):
    """Resolve a reporting period: either bound, both, or none (then the days up to yesterday)."""
    yesterday = utc((today or datetime.now(UTC).date()) - timedelta(days=1))
    span = timedelta(days=last_n_days)
    first, last = (utc(d) if d else None for d in (start, end))
    if last is None:
        last = yesterday if first is None else min(first + span, yesterday)
    if first is None:
        first = last - span
    if first > last:
        raise ValueError(f"start {first:%Y-%m-%d} is after end {last:%Y-%m-%d}")
    return first, last


_OFFSET_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400}


def time_range(text: str, now: datetime, future: bool = False) -> list[int]:
    """``'now-2h'``, ``'7d'``, ten-digit epochs, or two ISO times joined by ``--``; epoch ms.

    Offsets point to the past when listing, to the future when planning.
    """
    if "--" in text:
        return [epoch_millis(t.strip()) for t in text.split("--")]
    base = int(now.timestamp())
    out = []
    for part in (p.strip() for p in text.split("-")):
        offset = re.fullmatch(r"(\d+)\s*(s|secs?|m|mins?|h|hrs?|d|days?)", part)
        if part == "now":
            seconds = base
        elif re.fullmatch(r"\d{10}", part):
            seconds = int(part)
        elif offset:
            step = int(offset[1]) * _OFFSET_SECONDS[offset[2][0]]
            seconds = base + step if future else base - step
        else:
            raise ValueError(f"not a time: {part!r}")
        out.append(seconds * 1000)
    return out


def flexible_epoch(col: Column) -> Column:
    """``YYYYMMDD`` or ten-digit epoch seconds, as epoch seconds; zero stays zero."""
    text = col.cast("string")
    return (
        F.when(text == "0", F.lit(0).cast("long"))
        .when(F.length(text) == 10, text.try_cast("long"))
        .otherwise(F.unix_seconds(F.try_to_timestamp(text, F.lit("yyyyMMdd"))))
    )


def seconds_text(seconds: Column) -> Column:
    """1000 -> ``0h 16m 40s``."""
    s = seconds.cast("long")
    return F.concat(
        F.floor(s / 3600).cast("string"), F.lit("h "),
        F.floor(s % 3600 / 60).cast("string"), F.lit("m "),
        (s % 60).cast("string"), F.lit("s"),
    )


def _unborrowed(early: Column, late: Column) -> dict[str, Column]:
    """Differences field by field, days perhaps negative, and the length of the month to borrow."""
    early_s, late_s = F.unix_seconds(early), F.unix_seconds(late)
    earlier_clock = (F.pmod(late_s, F.lit(86400)) < F.pmod(early_s, F.lit(86400))).cast("int")
    return {
        "months": (F.year(late) - F.year(early)) * 12 + F.month(late) - F.month(early),
        "days": F.day(late) - F.day(early) - earlier_clock,
        "lent": F.day(F.last_day(early)),
        "clock": (late_s - early_s) % 86400,
    }


def _borrowed(raw) -> list[tuple[str, Column]]:
    clock, short = raw["clock"], (raw["days"] < 0).cast("int")
    months = raw["months"] - short
    return [
        ("Y", F.floor(months / 12).cast("int")),
        ("M", months % 12),
        ("D", raw["days"] + short * raw["lent"]),
        ("h", F.floor(clock / 3600).cast("int")),
        ("m", F.floor(clock % 3600 / 60).cast("int")),
        ("s", (clock % 60).cast("int")),
    ]


def calendar_difference(a: Column, b: Column) -> list[tuple[str, Column]]:
    """Years, months, days, hours, minutes and seconds between two times, in either order.

    Differences are taken field by field with a borrow; a borrowed month is as long as the
    month of the earlier time. Fractions of a second do not count. The session zone is UTC, so
    every day has the same length.
    """
    return _borrowed(_unborrowed(F.least(a, b), F.greatest(a, b)))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression of a value that is worked out once per row, however often the expression names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _fields(columns) -> Column:
    return F.struct(*[col.alias(name) for name, col in columns])


def duration_text(a: Column, b: Column) -> Column:
    """``1M 2D 3h``: the parts that are not zero."""
    labels = ("Y", "M", "D", "h", "m", "s")
    ends = F.struct(F.least(a, b).alias("early"), F.greatest(a, b).alias("late"))
    return once(ends, lambda t: once(
        _fields(_unborrowed(t["early"], t["late"]).items()), lambda raw: once(
            _fields((f"n{i}", value) for i, (label, value) in enumerate(_borrowed(raw))), lambda n: F.concat_ws(" ", *[
                F.when(n[f"n{i}"] > 0, F.concat(n[f"n{i}"].cast("string"), F.lit(label)))
                for i, label in enumerate(labels)
            ]))))


def relative_text(now: Column, moment: Column, text: Column | None = None) -> Column:
    """``2h 5m AGO`` for the past, ``IN 3h`` otherwise; ``text`` is their duration if it is known already."""
    text = duration_text(now, moment) if text is None else text
    return F.trim(
        F.when(now > moment, F.concat(text, F.lit(" AGO"))).otherwise(F.concat(F.lit("IN "), text))
    )


def period_chunks(start: Column, end: Column, days: int = 30) -> Column:
    """Half-open ranges of at most ``days`` days that cover ``[start, end)`` without holes."""
    step = F.expr(f"INTERVAL {days} DAYS")
    starts = F.filter(F.sequence(start, end, step), lambda s: s < end)
    return F.transform(
        starts, lambda s: F.struct(s.alias("chunk_start"), F.least(s + step, end).alias("chunk_end"))
    )
