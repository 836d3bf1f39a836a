"""Ages, flags, buckets, rates and indexes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigia.model import AGE_CUTS, AGE_LABELS, AGE_UNITS


def age_in_years(age: Column, unit: Column, units: Mapping[str, int] = AGE_UNITS) -> Column:
    """Age in years from a number and its unit code; unknown unit or bad number gives NULL."""
    number = age.try_cast("double")
    code = unit.cast("string")
    result = F.lit(None).cast("double")
    for value, per_year in units.items():
        years = number if per_year == 1 else number / F.lit(float(per_year))
        result = F.when(code == value, years).otherwise(result)
    return result


def bucket_label(
    value: Column,
    cuts: Sequence[float] = AGE_CUTS,
    labels: Sequence[str] = AGE_LABELS,
    null_label: str | None = "",
) -> Column:
    """Label of the half-open range a value falls in; ``len(labels) == len(cuts) + 1``.

    With the default ``null_label`` a NULL takes the last label, as an ``otherwise`` branch does.
    Pass a label, or ``None`` for NULL, to keep such rows apart.
    """
    result = F.lit(labels[-1])
    for cut, label in reversed(list(zip(cuts, labels))):
        result = F.when(value < cut, F.lit(label)).otherwise(result)
    if null_label == "":
        return result
    return F.when(value.isNull(), F.lit(null_label).cast("string")).otherwise(result)


def indicator(value: Column, members: Sequence[str]) -> Column:
    """1 where the value is one of ``members`` (case-sensitive), else 0, NULL included."""
    return F.when(value.isin(*members), F.lit(1)).otherwise(F.lit(0))


def level(value: Column, steps: Sequence[tuple[float, str]], lowest: str) -> Column:
    """Label of the first step the value exceeds; ``steps`` run from high to low."""
    result = F.lit(lowest)
    for bound, label in reversed(list(steps)):
        result = F.when(value > bound, F.lit(label)).otherwise(result)
    return result


def weighted_index(parts: Mapping[Column, float] | Sequence[tuple[Column, float]]) -> Column:
    """Weighted sum of columns."""
    pairs = list(parts.items()) if isinstance(parts, Mapping) else list(parts)
    total = pairs[0][0] * F.lit(pairs[0][1])
    for column, weight in pairs[1:]:
        total = total + column * F.lit(weight)
    return total


def rate(part: Column, whole: Column, scale: float = 100.0) -> Column:
    """``part / whole * scale``; NULL for a zero or NULL ``whole``."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(scale)


def zero_if_missing(value: Column, kind: str) -> Column:
    """0 for NULL, NaN and the infinities, typed as ``kind`` ("double" or "bigint")."""
    number = value.cast("double")
    usable = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    return F.when(usable, value.cast(kind)).otherwise(F.lit(0).cast(kind))
