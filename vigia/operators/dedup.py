"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """Keep the first row of each key in the given order (default: all other columns), NULLs last.

    The result does not depend on partitioning as long as ``order`` leaves no ties between rows
    that differ.  ``row_number() = 1`` is a group limit to Catalyst: each map task first cuts its
    rows to one per key, so a key that holds a large share of the table sends one row per task
    through the shuffle and not its whole group.  NULL keys form one group.
    """
    order = list(order) if order else [c for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*[(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order])
    position = "__position"
    return df.withColumn(position, F.row_number().over(window)).filter(F.col(position) == 1).drop(position)
