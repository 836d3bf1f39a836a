"""Names, codes and headers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accented vowels and what they fold to.
_ACCENTED, _PLAIN = "áéíóú", "aeiou"
_HEADER_TABLE = str.maketrans(" " + _ACCENTED, "_" + _PLAIN)


def normalise_header(name: str) -> str:
    """``' Código DIVIPOLA departamento '`` -> ``'codigo_divipola_departamento'``."""
    return name.strip().lower().translate(_HEADER_TABLE)


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename every column by :func:`normalise_header`; only the schema is touched."""
    return df.toDF(*map(normalise_header, df.columns))


def fold_text(value: Column) -> Column:
    """The header rule for row values, blanks inside kept."""
    return F.translate(F.lower(F.trim(value)), _ACCENTED, _PLAIN)


def pad_code(value: Column, width: int) -> Column:
    """Zero-padded code of exactly ``width`` characters; longer codes keep their first ones."""
    return F.lpad(value.cast("string"), width, "0")


def canonical_name(
    value: Column,
    aliases: Mapping[str, str],
    substrings: Mapping[str, str] | None = None,
) -> Column:
    """Trimmed upper-case name with known spellings replaced.

    ``aliases`` maps whole names, ``substrings`` maps any name that contains the given text.  Both
    are short fixed lists, so they become literals of the expression and need no join.
    """
    name = F.upper(F.trim(value))
    result = name
    for part, target in (substrings or {}).items():
        result = F.when(name.contains(part), F.lit(target)).otherwise(result)
    if aliases:
        table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
        result = F.coalesce(F.try_element_at(table, name), result)
    return result


def label_or(value: Column, default: str) -> Column:
    """``default`` where the label is NULL or empty."""
    return F.when(value.isNull() | (value == ""), F.lit(default)).otherwise(value)


def is_label(value: Column) -> Column:
    """True for a usable label: not NULL, not empty, not the text ``null``."""
    return value.isNotNull() & (value != "") & (value != "null")
