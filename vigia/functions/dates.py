"""Dates: tolerant parsing, calendar parts, durations, labels."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigia.model import DATE_FORMATS

_TOKEN = re.compile(r"'(?P<quoted>[^']*)'|(?P<letter>[A-Za-z])(?P=letter)*|(?P<other>[^A-Za-z']+)")


def _shape(pattern: str) -> str:
    """Regular expression of the strings a date pattern could read."""
    parts = []
    for token in _TOKEN.finditer(pattern):
        if token["letter"]:
            digits = len(token[0])
            parts.append(r"\d{1,2}" if digits == 1 else rf"\d{{{digits}}}")
        else:
            parts.append(re.escape(token["quoted"] if token["quoted"] is not None else token["other"]))
    return "^" + "".join(parts) + "$"


#: Digits of the parts that have fixed places.
_DIGITS = {"yyyy": "[0-9]{4}", "MM": "[0-9]{2}", "dd": "[0-9]{2}", "HH": "(?:[01][0-9]|2[0-3])", "mm": "[0-5][0-9]", "ss": "[0-5][0-9]", "SSS": "[0-9]{3}"}


def _places(pattern: str) -> dict[str, int] | None:
    """Where each part of a pattern begins (from 1) if it is always in the same place, else ``None``."""
    found, at = {}, 1
    for token in _TOKEN.finditer(pattern):
        if token["letter"]:
            if token[0] not in _DIGITS or token[0] in found:
                return None
            found[token[0]] = at
            at += len(token[0])
        else:
            at += len(token["quoted"] if token["quoted"] is not None else token["other"])
    return found if {"yyyy", "MM", "dd"} <= set(found) else None


def _tokens(pattern: str) -> list[tuple[bool, str]]:
    """The parts of a pattern (True) and what stands between them (False)."""
    return [(bool(t["letter"]), t[0] if t["letter"] else t["quoted"] if t["quoted"] is not None else t["other"]) for t in _TOKEN.finditer(pattern)]


def _cells(pattern: str) -> list[str | None]:
    """What stands in each place of the texts of a pattern, ``None`` for a digit."""
    return [None if letter else c for letter, part in _tokens(pattern) for c in part]


def _exclusive(patterns: Sequence[str]) -> bool:
    """Whether no text fits two of these patterns of fixed places: their lengths differ, or a place has a mark in one and not in the other."""
    cells = [_cells(p) for p in patterns]
    return all(len(a) != len(b) or any(x != y and not ((x or "0").isdigit() and (y or "0").isdigit()) for x, y in zip(a, b, strict=True))
               for k, a in enumerate(cells) for b in cells[:k])


def _day(text: Column, pattern: str, places: dict[str, int]) -> Column:
    """The day, as ``yyyy-MM-dd``, of a text in which every part has its place, else NULL.

    A text of the right length is held against one expression, and its parts are cut out, which is a fraction of
    what a parser costs that goes by a pattern.
    """
    tokens = _tokens(pattern)
    exact = r"\A" + "".join(_DIGITS[part] if letter else re.escape(part) for letter, part in tokens) + r"\z"
    size = sum(len(part) for _, part in tokens)
    if pattern[places["yyyy"] - 1:].startswith("yyyy-MM-dd"):
        day = text if size == 10 else F.substring(text, places["yyyy"], 10)
    else:
        day = F.concat_ws("-", *(F.substring(text, places[name], len(name)) for name in ("yyyy", "MM", "dd")))
    return F.when((F.length(text) == size) & text.rlike(exact), day)


def parse_date(value: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date by the first pattern that reads the value, else NULL.

    Patterns whose parts have fixed places are read by these places, without an exception for a text that is none.  Others go through Spark's parser, and only for values of their shape.
    Where no text fits two patterns in a row, the day is cut out by the one that it fits and cast once: the expression of a row of many
    dates has to stay short enough for the JVM to compile.
    """
    text = value.cast("string")
    found: list[Column] = []
    rest = list(formats)
    while rest:
        fixed = []
        while rest and _places(rest[0]) and _exclusive([*fixed, rest[0]]):
            fixed.append(rest.pop(0))
        if fixed:
            found.append(F.coalesce(*[_day(text, f, _places(f)) for f in fixed]).try_cast("date"))
        else:
            other = rest.pop(0)
            found.append(F.when(text.rlike(_shape(other)), F.try_to_timestamp(text, F.lit(other))).cast("date"))
    return F.coalesce(*found)


def calendar_parts(date: Column, prefix: str = "", suffix: str = "") -> dict[str, Column]:
    """Calendar year and month with the ISO week (so 2021-01-01 is week 53 of 2021)."""
    return {
        f"{prefix}anio{suffix}": F.year(date),
        f"{prefix}mes{suffix}": F.month(date),
        f"{prefix}semana{suffix}": F.weekofyear(date),
    }


def week_start(date: Column) -> Column:
    """Monday of the week: a key without the year/week mismatch of :func:`calendar_parts`."""
    return F.date_trunc("week", date).cast("date")


def days_between(end: Column, start: Column) -> Column:
    """Signed whole days; negative durations are kept."""
    return F.datediff(end, start)


def period_label(year: Column, month: Column) -> Column:
    """``YYYY-MM``."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
