"""Lookups of a large table in dimensions.

No join here is forced to broadcast.  Dimensions may grow with the data, so the choice is left to
Spark, which broadcasts a side only below ``spark.sql.autoBroadcastJoinThreshold`` (at planning by
file size, at run time by measured size) and otherwise shuffles both and splits hot keys by
adaptive skew join.  All joins are equi-joins, so no plan falls back to nested loops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dimension: DataFrame, key: Column, dimension_key: str) -> DataFrame:
    """LEFT equi-join on ``key = dimension.dimension_key``; the dimension's key is dropped."""
    right = dimension.withColumnRenamed(dimension_key, "__key")
    return df.join(right, key == right["__key"], "left").drop("__key")


def join_any(
    df: DataFrame,
    dimension: DataFrame,
    code: Column,
    name: Column,
    dimension_code: str,
    dimension_name: str,
) -> DataFrame:
    """LEFT join on ``code = dimension_code OR name = dimension_name``.

    A row that meets several dimension rows comes out once for each of them; a row that meets none
    comes out once with NULLs.  The dimension is folded to one row for each code and one for each name, with the rows that have it, so that
    two equi-joins by unique keys bring all matches of a row side by side, and one explode sets them apart.  A name
    match that is also a code match is left out, because the code has brought it already.
    """
    payload = [c for c in dimension.columns if c not in (dimension_code, dimension_name)]
    entry = F.struct(
        F.col(dimension_code).cast("string").alias("__dim_code"),
        F.col(dimension_name).alias("__dim_name"),
        *payload,
    )
    entries = dimension.select(entry.alias("entry"))

    def folded(key: str, name: str) -> DataFrame:
        known = entries.filter(F.col(f"entry.{key}").isNotNull())
        return known.groupBy(F.col(f"entry.{key}").alias(f"{name}_key")).agg(F.collect_list("entry").alias(name))

    by_code, by_name = folded("__dim_code", "__by_code"), folded("__dim_name", "__by_name")
    rows = df.withColumns({"__code": code.cast("string"), "__name": name})
    rows = rows.join(by_code, F.col("__code") == F.col("__by_code_key"), "left")
    rows = rows.join(by_name, F.col("__name") == F.col("__by_name_key"), "left")
    other = F.filter("__by_name", lambda e: ~F.coalesce(e["__dim_code"] == F.col("__code"), F.lit(False)))
    none = F.array().cast(by_code.schema["__by_code"].dataType)
    found = rows.withColumn("__entry", F.explode_outer(F.concat(F.coalesce("__by_code", none), F.coalesce(other, none))))
    return found.select(*df.columns, *[F.col(f"__entry.{c}").alias(c) for c in payload])


def join_first_match(
    df: DataFrame,
    dimension: DataFrame,
    code: Column,
    name: Column,
    dimension_code: str,
    dimension_name: str,
) -> DataFrame:
    """LEFT lookup by code, by name where the code is unknown; never adds rows.

    The dimension must be unique in each of the two keys (see ``integrity.duplicate_keys``).
    """
    payload = [c for c in dimension.columns if c not in (dimension_code, dimension_name)]
    by_code = dimension.select(
        F.col(dimension_code).cast("string").alias("__code_key"),
        F.struct(*payload).alias("__by_code"),
    )
    by_name = dimension.select(
        F.col(dimension_name).alias("__name_key"),
        F.struct(*payload).alias("__by_name"),
    )
    rows = df.join(by_code, code.cast("string") == F.col("__code_key"), "left")
    rows = rows.join(by_name, name == F.col("__name_key"), "left")
    found = F.coalesce(F.col("__by_code"), F.col("__by_name"))
    return rows.withColumn("__found", found).select(
        *df.columns, *[F.col(f"__found.{c}").alias(c) for c in payload]
    )


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total rows and, for each column, rows where the lookup found a value; one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("registros"),
        *[F.count(c).alias(f"con_{c}") for c in columns],
    )
