"""What is different between two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of change.
NEW, CHANGED, GONE = "nuevo", "cambiado", "retirado"


def row_hash(columns: Sequence[str]) -> Column:
    """A 64-bit number of the values; a NULL counts as one and in its place."""
    return F.xxhash64(*[part for c in columns for part in (F.col(c), F.col(c).isNull())])


def snapshot_changes(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    carried: Sequence[str] = (),
    kind: str = "cambio",
) -> DataFrame:
    """``keys`` and ``kind`` of every key whose rows differ between two snapshots with the same columns.

    Rows are compared by a hash of all columns but the keys.  A key may have several rows: it is unchanged if both snapshots
    have as many, of the same sum of hashes.  NULL keys are keys.  Each task first folds its rows of a key into
    two counts and two sums, so that there is one shuffle, no join, and no hot key; unchanged keys end there.
    ``carried`` columns come out as ``<name>_antes`` and ``<name>_ahora``: the least of the key's values, before and after.
    """
    values = [c for c in new.columns if c not in keys]
    missing = set(new.columns) ^ set(old.columns)
    if missing:
        raise ValueError(f"snapshots differ in columns: {', '.join(sorted(missing))}")

    def tagged(df: DataFrame, is_new: bool) -> DataFrame:
        return df.select(*keys, row_hash(values).cast("decimal(20,0)").alias("__hash"), *carried, F.lit(is_new).alias("__new"))

    rows = tagged(old, False).unionByName(tagged(new, True))
    now, before = F.col("__new"), ~F.col("__new")
    states = [
        F.count(F.when(before, 1)).alias("__rows_before"), F.count(F.when(now, 1)).alias("__rows_now"),
        F.sum(F.when(before, F.col("__hash"))).alias("__sum_before"), F.sum(F.when(now, F.col("__hash"))).alias("__sum_now"),
        *[F.min(F.when(before, F.col(c))).alias(f"{c}_antes") for c in carried],
        *[F.min(F.when(now, F.col(c))).alias(f"{c}_ahora") for c in carried],
    ]
    found = rows.groupBy(*keys).agg(*states)
    what = (
        F.when(F.col("__rows_before") == 0, NEW)
        .when(F.col("__rows_now") == 0, GONE)
        .when((F.col("__rows_before") != F.col("__rows_now")) | (F.col("__sum_before") != F.col("__sum_now")), CHANGED)
    )
    named = found.withColumn(kind, what).filter(F.col(kind).isNotNull())
    return named.select(*keys, kind, *[f"{c}_{when}" for c in carried for when in ("antes", "ahora")])
