"""Key checks for dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or are NULL, with their row count."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("filas"))
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return counted.filter((F.col("filas") > 1) | missing)


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent row, with their row count; NULL keys are no orphans.

    The child is counted per key first, so the anti join sees one row per key.
    """
    counted = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("clave"))
        .agg(F.count(F.lit(1)).alias("filas"))
    )
    parents = parent.select(F.col(parent_key).alias("clave"))
    return counted.join(parents, "clave", "left_anti")


def key_report(
    tables: dict[str, DataFrame],
    primary: dict[str, str],
    foreign: Sequence[tuple[str, str, str, str]],
) -> DataFrame:
    """One row per constraint: (restriccion, claves_malas, filas_malas)."""
    parts = []
    for table, key in primary.items():
        bad = duplicate_keys(tables[table], [key])
        parts.append((f"pk {table}.{key}", bad))
    for child, child_key, parent, parent_key in foreign:
        bad = orphan_keys(tables[child], child_key, tables[parent], parent_key)
        parts.append((f"fk {child}.{child_key}", bad))
    rows = [
        bad.agg(
            F.count(F.lit(1)).alias("claves_malas"),
            F.coalesce(F.sum("filas"), F.lit(0)).cast("bigint").alias("filas_malas"),
        ).select(F.lit(label).alias("restriccion"), "claves_malas", "filas_malas")
        for label, bad in parts
    ]
    result = rows[0]
    for row in rows[1:]:
        result = result.unionByName(row)
    return result
