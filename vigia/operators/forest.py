"""A random forest over many rows of few different values.

A pass of Spark's forest visits every row once for each tree.  Rows that are equal in features and label go the same way in every tree
and add the same to every count, so they are merged into one row with their number.  A bootstrap draws each of ``n`` equal rows a
Poisson(1) number of times, together a Poisson(n) number of times: that is drawn at once, for each tree and merged row, and each tree is
grown by Spark's own classifier with the draws as weights.  No row, tree or level is left out, and the trees are votes of one model as usual.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Trees that are grown at the same time.
AT_ONCE = 4


def merged(rows: DataFrame, columns: Sequence[str], count: str = "n") -> DataFrame:
    """The different rows of ``columns`` with how often each occurs, in their order."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(count)).orderBy(*columns)


def drawn(groups: DataFrame, columns: Sequence[str], trees: int, seed: int, count: str = "n") -> DataFrame:
    """``groups`` with ``draw0``, ``draw1``, ...: how often each tree draws from the ``count`` rows of a group.

    The draws follow from the seed and the values of ``columns``, not from where a group lies.
    """
    names = [f"draw{k}" for k in range(trees)]
    # The hash of values passes over NULLs: which ones are NULL is hashed as well.
    keyed = groups.withColumn("__key", F.xxhash64(*columns, *[F.col(c).isNull() for c in columns], F.lit(seed)))
    same = [f for f in keyed.schema if f.name != "__key"]
    schema = T.StructType(same + [T.StructField(n, T.LongType()) for n in names])
    at, many = keyed.columns.index("__key"), keyed.columns.index(count)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = batch.column(at).to_numpy(zero_copy_only=False).view(np.uint64), batch.column(many).to_numpy(zero_copy_only=False)
            draws = np.empty((len(keys), trees), dtype=np.int64)
            for k, (key, rows) in enumerate(zip(keys.tolist(), n.tolist(), strict=True)):
                draws[k] = np.random.Generator(np.random.PCG64(key)).poisson(rows, trees)
            kept = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c) for c in draws.T.copy())], names=[f.name for f in same] + names)

    return keyed.mapInArrow(draw, schema)


def grow(forest: RandomForestClassifier, rows: DataFrame, classes: int) -> RandomForestClassificationModel:
    """The model of ``forest`` over ``rows`` with its label, its features and ``draw0``, ``draw1``, ... of its trees."""
    label, features, trees = forest.getLabelCol(), forest.getFeaturesCol(), forest.getNumTrees()
    # A tree that draws no row of the last class still has to know it.
    known = {"ml_attr": {"type": "nominal", "name": label, "vals": [str(k) for k in range(classes)]}}
    rows = rows.select(F.col(label).alias(label, metadata=known), features, *[f"draw{k}" for k in range(trees)])
    subset = forest.getFeatureSubsetStrategy()
    # Of several trees each split looks at so many features, of a single one by default at all.
    subset = "sqrt" if subset == "auto" and trees > 1 else subset

    def one(k: int):
        tree = forest.copy({forest.numTrees: 1, forest.seed: forest.getSeed() + k, forest.bootstrap: False,
                            forest.featureSubsetStrategy: subset, forest.weightCol: "drawn"})
        return tree.fit(rows.select(label, features, F.col(f"draw{k}").cast("double").alias("drawn")).where("drawn > 0"))

    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # The rows are computed once before the trees ask for them.
        rows.count()
        with ThreadPool(min(AT_ONCE, trees)) as pool:
            grown = pool.map(inheritable_thread_target(rows.sparkSession)(one), range(trees), chunksize=1)
    finally:
        rows.unpersist()
    context = rows.sparkSession.sparkContext
    kind = context._jvm.org.apache.spark.ml.classification
    votes = context._gateway.new_array(kind.DecisionTreeClassificationModel, trees)
    for k, model in enumerate(grown):
        votes[k] = model._java_obj.trees()[0]
    made = kind.RandomForestClassificationModel(forest.uid, votes, grown[0].numFeatures, classes)
    return forest._copyValues(forest._create_model(made))
