"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order.  The rows of the index lie in blocks of bounded size; each
block keeps an inverted file from pivot to (row, place of the pivot) and answers a query by adding up, over the
query's own nearest pivots, how far their places differ (the footrule distance; a pivot missing from a row's list counts as
placed right behind it).  The rows of a block that rank best are reranked by the exact cosine, and the best of all blocks
are the answer.

Queries and rows meet block by block; a task holds one block of rows and one block of queries.  Equal vectors are reduced to the
few smallest ids first, since no more of them can be in an answer: a vector that a third of all rows share is no
heavier than any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigia.llm.common import stored

#: Pivots, and how many of them represent a vector.
PIVOTS = 128
NEAREST = 64
#: Rows that the pivots are drawn from, at most.
PIVOT_ROWS = 2_000
#: Rows and queries of a block.
BLOCK_ROWS = 8_192
BLOCK_QUERIES = 4_096
#: Share of a block's rows that are reranked, the same for blocks of any size; a table of a few dozen rows is reranked whole.
RERANKED = 0.2
WHOLE = 40


def usable(vector: Column) -> Column:
    """Whether a vector is not NULL, not empty or zero, and all its components are finite."""
    double = F.transform(vector, lambda x: x.cast("double"))
    whole = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & whole & F.exists(double, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that nothing over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def pivots(rows: DataFrame) -> np.ndarray:
    """Pivot directions of each dimension's vectors, from at most ``PIVOT_ROWS`` rows chosen by hash, far from each other."""
    sample = rows.select("vec").orderBy(F.xxhash64("id", F.lit(17)), "id").limit(PIVOT_ROWS).collect()
    if not sample:
        return np.zeros((0, 1))
    size = len(sample[0]["vec"])
    vectors = _unit(np.array([r["vec"] for r in sample if len(r["vec"]) == size], dtype=np.float64))
    chosen = [0]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(PIVOTS, len(vectors)):
        nxt = int(nearest.argmin())
        if nearest[nxt] > 1 - 1e-9:
            break
        chosen.append(nxt)
        nearest = np.maximum(nearest, vectors @ vectors[nxt])
    return vectors[chosen]


class Block:
    """The inverted file of one block of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, marks: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.marks = ids[order], vectors[order], marks
        self.scaled = self.vectors / np.abs(self.vectors).max(axis=1, keepdims=True)
        self.sizes = np.sqrt((self.scaled * self.scaled).sum(axis=1))
        self.nearest = min(NEAREST, len(marks))
        places = self.places(self.vectors)
        rows = np.repeat(np.arange(len(ids)), self.nearest)
        by_pivot = np.argsort(places.ravel(), kind="stable")
        self.rows = rows[by_pivot]
        self.place = np.tile(np.arange(self.nearest), len(ids))[by_pivot].astype(np.int32)
        self.first = np.searchsorted(places.ravel()[by_pivot], np.arange(len(marks) + 1))

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Each vector's nearest pivots in order."""
        near = _unit(vectors) @ self.marks.T
        return np.argsort(-near, axis=1, kind="stable")[:, :self.nearest]

    def cosines(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Cosine of a vector with some rows, in double precision and the same for equal rows wherever they stand."""
        query = query / np.abs(query).max()
        return (self.scaled[rows] * query).sum(axis=1) / (self.sizes[rows] * np.sqrt((query * query).sum()))

    def best(self, query: np.ndarray, own: int | None, count: int, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the ``count`` nearest rows found, without the query's own."""
        gain = np.zeros(len(self.ids), dtype=np.int32)
        for place, pivot in enumerate(self.places(query[None])[0]):
            at = slice(self.first[pivot], self.first[pivot + 1])
            # Both lists miss a pivot at cost ``nearest - place`` each; meeting saves what exceeds the difference of places.
            gain[self.rows[at]] += 2 * (self.nearest - np.maximum(self.place[at], place))
        wanted = min(len(gain), max(count + 1, WHOLE, int(np.ceil(share * len(gain)))))
        if wanted < len(gain):
            # Ties go to smaller ids, which stand first.
            order = np.lexsort((np.arange(len(gain)), -gain))[:wanted]
        else:
            order = np.arange(len(gain))
        if own is not None:
            order = order[self.ids[order] != own]
        score = self.cosines(query, order)
        top = np.lexsort((self.ids[order], -score))[:count]
        return self.ids[order][top], score[top]


def search(df: DataFrame, queries: DataFrame, *, id: str = "vec_id", vector: str = "embedding", count: int = 5,
           share: float = RERANKED) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the ``count`` rows of ``df`` with the largest cosine that the index finds.

    Both tables have the columns ``id`` and ``vector``; a row never answers the query of its own id.  Nearest first, ties to the
    smaller id; fewer rows if there are fewer candidates.  Rows whose id is NULL, or whose vector is NULL, empty, zero or holds a NULL,
    NaN or infinite component, take no part; rows whose vector has another length than the query's are no candidates of it.  Rows that
    repeat an id are one candidate each (with equal vectors, one together).  An empty table gives no rows.
    """
    def shaped(table: DataFrame) -> DataFrame:
        rows = table.select(F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
        return rows.where(F.col("id").isNotNull() & usable(F.col("vec")))

    # Equal vectors: the smallest ids are enough (one more than asked for, as the query's own may be among them).  The rank
    # limit works within each task before rows of equal vectors meet.
    rows = shaped(df).distinct().withColumn("key", F.xxhash64("vec"))
    few = rows.withColumn("n", F.row_number().over(Window.partitionBy("key", "vec").orderBy("id"))).where(F.col("n") <= count + 1)
    rows = stored(few.select("id", "vec"), "neighbours-rows")
    asked = stored(shaped(queries).distinct(), "neighbours-queries")
    spark, total, many = df.sparkSession, rows.count(), asked.count()
    marks = spark.sparkContext.broadcast(pivots(rows))
    parts, groups = max(1, -(-total // BLOCK_ROWS)), max(1, -(-many // BLOCK_QUERIES))
    # Block numbers by hash; each pair of a block of rows and a block of queries is one group.
    placed = rows.select("id", "vec", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(parts)).cast("int").alias("part"),
                         F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(False).alias("asks"))
    posed = asked.select("id", "vec", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                         F.pmod(F.xxhash64("id", F.lit(4)), F.lit(groups)).cast("int").alias("group"), F.lit(True).alias("asks"))

    def answer(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids = table.column("id").to_numpy()
        values = table.column("vec").combine_chunks()
        flat, ends = values.flatten().to_numpy(zero_copy_only=False), values.offsets.to_numpy()
        sizes = np.diff(ends)
        starts = ends[:-1] - ends[0]
        found: list[tuple[np.ndarray, ...]] = []
        for size in np.unique(sizes[asks]):
            mine = np.flatnonzero(~asks & (sizes == size))
            if not len(mine):
                continue
            take = starts[mine][:, None] + np.arange(size)
            known = marks.value if marks.value.shape[1] == size else np.eye(size)[:PIVOTS]
            block = Block(ids[mine], flat[take], known)
            for q in np.flatnonzero(asks & (sizes == size)):
                near, score = block.best(flat[starts[q]:starts[q] + size], ids[q], count, share)
                found.append((np.full(len(near), ids[q]), near, score))
        query, near, score = (np.concatenate([f[k] for f in found]) if found else np.zeros(0) for k in range(3))
        return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(near, pa.int64()), "score": pa.array(score, pa.float64())})

    met = placed.unionByName(posed).repartition("part", "group")
    hits = met.groupBy("part", "group").applyInArrow(answer, "query_id bigint, vec_id bigint, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
