"""Running totals and ranks over a whole table without a window over all of it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigia.sources.scratch import scratch_path

RANGE = "__range"


def running_totals(df: DataFrame, order: Sequence[str], totals: Mapping[str, str]) -> DataFrame:
    """``df`` with, for each new column of ``totals``, the sum of a column over all rows up to this one in ``order``.

    Two levels: rows are dealt out by ranges of the order (Spark samples the bounds) and written with the number of their range; a range
    is summed up by itself, and what lies before it is the sum of the ranges before, one row for each, which are added up on the driver.  No task has
    more than a range, whatever the number of rows.  ``order`` has to tell all rows apart (NULLs come first); a NULL adds nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    dealt = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).withColumn(RANGE, F.spark_partition_id())
    dealt.write.parquet(path)
    rows = spark.read.schema(dealt.schema).parquet(path)
    return _added(rows, order, totals, _offsets(rows, totals))


def _offsets(rows: DataFrame, totals: Mapping[str, str]) -> DataFrame:
    """(range, sum before it for each new column): as many rows as the ranges, a number that the session sets."""
    sums = [F.sum(column).alias(name) for name, column in totals.items()]
    schema = rows.groupBy(RANGE).agg(*sums).schema
    before = dict.fromkeys(totals, 0)
    found = []
    for row in sorted(rows.groupBy(RANGE).agg(*sums).collect(), key=lambda r: r[RANGE]):
        found.append((row[RANGE], *before.values()))
        before = {name: so_far + (row[name] or 0) for name, so_far in before.items()}
    return rows.sparkSession.createDataFrame(found, schema).select(RANGE, *[F.col(n).alias(f"__before_{n}") for n in totals])


def _added(rows: DataFrame, order: Sequence[str], totals: Mapping[str, str], offsets: DataFrame) -> DataFrame:
    window = Window.partitionBy(RANGE).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    own: dict[str, Column] = {name: F.coalesce(F.sum(column).over(window), F.lit(0)) for name, column in totals.items()}
    inside = rows.withColumns(own).join(offsets, RANGE)
    return inside.withColumns({n: F.col(n) + F.col(f"__before_{n}") for n in totals}).drop(RANGE, *[f"__before_{n}" for n in totals])


def mid_ranks(df: DataFrame, value: str, counts: Mapping[str, Column] | None = None) -> DataFrame:
    """(value, rows, below, rank, ...): each distinct value with its rows, the rows of smaller values, and the mean rank of its rows.

    ``counts`` names conditions whose rows are counted as well, with those of smaller values as ``<name>_below``.  Equal values are one
    row before anything is ordered, so that a value that most rows have is no hot spot.  NULL is no value.
    """
    counts = {"rows": F.lit(True), **(counts or {})}
    groups = df.where(F.col(value).isNotNull()).groupBy(value).agg(*[F.count(F.when(c, 1)).alias(n) for n, c in counts.items()])
    summed = running_totals(groups, [value], {f"{n}_below": n for n in counts})
    below = summed.withColumns({f"{n}_below": F.col(f"{n}_below") - F.col(n) for n in counts})
    # The rows of a value have the ranks from ``below + 1`` to ``below + rows``.
    return below.withColumn("rank", F.col("rows_below") + (F.col("rows") + 1) / 2)


def area_under_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row (positives, negatives, auc): the area under the curve of ``score`` for the label 1 against 0, from rank sums.

    It is the share of pairs of a positive and a negative in which the positive scores higher, equal scores counted half: exact, with
    ties.  Rows without label or score don't count; without positives or negatives the area is NULL.
    """
    rows = df.where(F.col(label).isin(0, 1) & F.col(score).isNotNull())
    ranks = mid_ranks(rows, score, {"positives": F.col(label) == 1})
    # Twice the rank sum of the positives is an integer, so no digit is lost: 2 * rank = 2 * below + rows + 1.
    twice = F.col("positives").cast("decimal(19,0)") * (2 * F.col("rows_below") + F.col("rows") + 1).cast("decimal(19,0)")
    sums = ranks.agg(F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"),
                     F.coalesce(F.sum(F.col("rows") - F.col("positives")), F.lit(0)).alias("negatives"), F.sum(twice).alias("__twice"))
    own = F.col("positives").cast("decimal(19,0)")
    return sums.select("positives", "negatives", F.try_divide(
        (F.col("__twice") - own * (own + 1)).cast("double"), 2.0 * F.col("positives") * F.col("negatives")).alias("auc"))
