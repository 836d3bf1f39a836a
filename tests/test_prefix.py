"""Running totals by ranges, mean ranks and the area under the curve."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from vigia.operators.prefix import area_under_curve, mid_ranks, running_totals


def test_running_totals_over_many_ranges(spark):
    rng = random.Random(1)
    rows = [(i // 3, i % 3, rng.randint(-5, 50) if i % 11 else None) for i in range(2000)] + [(None, 0, 7), (None, 1, 8)]
    df = spark.createDataFrame(rows, "a int, b int, x int").repartition(5)
    previous = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running_totals(df, ["a", "b"], {"total": "x", "other": "b"}).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", previous)
    want, total, other = {}, 0, 0
    for a, b, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        total, other = total + (x or 0), other + b
        want[a, b] = (x, total, other)
    assert {(r.a, r.b): (r.x, r.total, r.other) for r in got} == want
    assert got[0].asDict().keys() == {"a", "b", "x", "total", "other"}


def test_running_totals_of_nothing_and_of_one_row(spark):
    df = spark.createDataFrame([(1, 2)], "a int, x bigint")
    assert running_totals(df.limit(0), ["a"], {"total": "x"}).collect() == []
    assert [tuple(r) for r in running_totals(df, ["a"], {"total": "x"}).collect()] == [(1, 2, 2)]


def test_mid_ranks(spark):
    values = [3.0, 1.0, 3.0, None, 2.0, 3.0, 1.0]
    got = mid_ranks(spark.createDataFrame([(v,) for v in values], "v double"), "v").orderBy("v").collect()
    assert [(r.v, r.rows, r.rows_below, r["rank"]) for r in got] == [(1.0, 2, 0, 1.5), (2.0, 1, 2, 3.0), (3.0, 3, 3, 5.0)]


def plain_area(rows):
    ups, downs = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    return sum((a > b) + (a == b) / 2 for a in ups for b in downs) / (len(ups) * len(downs))


@pytest.mark.parametrize("scores", [1, 4, 1000])
def test_area_equals_the_share_of_pairs(spark, scores):
    rng = random.Random(scores)
    rows = [(float(rng.random() < 0.3), rng.randint(1, scores) / 8) for _ in range(400)]
    df = spark.createDataFrame([*rows, (None, 1.0), (1.0, None), (2.0, 0.5)], "label double, score double")
    found = area_under_curve(df, "label", "score").first()
    assert found["positives"] + found["negatives"] == 400
    assert found["auc"] == pytest.approx(plain_area(rows), abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert found["auc"] == pytest.approx(evaluator.evaluate(spark.createDataFrame(rows, "label double, score double")), abs=1e-9)


def test_no_area_without_both_labels(spark):
    df = spark.createDataFrame([(1.0, 0.5), (1.0, 0.7)], "label double, score double")
    assert tuple(area_under_curve(df, "label", "score").first()) == (2, 0, None)
    assert area_under_curve(df.limit(0), "label", "score").first()["auc"] is None


def test_a_score_that_most_rows_have(spark):
    """Equal scores are folded before anything is ordered."""
    df = spark.range(30_000).select((F.col("id") % 2).cast("double").alias("label"), F.when(F.col("id") % 3 > 0, 0.5).otherwise(F.col("id") / 90_000).alias("score"))
    groups = mid_ranks(df, "score")
    assert groups.agg(F.max("rows")).first()[0] == 20_000 and groups.count() == 10_001
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
