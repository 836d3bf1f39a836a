"""Near-duplicate texts by SimHash and the generalised pigeonhole principle.

Fingerprints link if they differ in few bits.  Equal fingerprints are one class from the start.  The 64 bits are dealt
into partitions, correlated bits together, and partition ``i`` gets a threshold ``t_i`` of its own (-1: not
looked at) with ``sum(t_i + 1) = distance + 1``: of two fingerprints within the distance, at least one partition
differs in at most its ``t_i`` bits.  Number of partitions and thresholds are those of the least estimated work, found by
dynamic programming over collision counts of all fingerprints.  Fingerprints that agree in a partition up to its
threshold meet in a bucket; small buckets are compared pair by pair in a join, large ones block by block, each block giving
only the links of a spanning forest.  Linked classes are then merged by rounds of hooking to the smallest neighbour.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigia.llm.common import annotate, free_name, gathered, remove, stored

BITS = 64
SHINGLE = 3
SEED = 42
DISTANCE = 3
#: Shingles hashed at a time.
PIECE = 100_000
#: Buckets of up to so many fingerprints are joined; larger ones are compared in blocks of ``BLOCK``.
JOINED = 32
BLOCK = 2048


def _votes(words: list[bytes], size: int) -> tuple[np.ndarray, int]:
    """How many shingles of the words set each bit, lowest bit first, and how many shingles there are."""
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        # A shingle is a slice of the words joined by single blanks.
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        starts = np.concatenate([[0], ends[:-size]])
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), (ends[size - 1:] - 1).tolist(), strict=True)]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64), len(hashes)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The unsigned SimHash of a whole text: A-Z lower-cased, words between ASCII white space, ``size``-word shingles.

    Fewer words than that are one shingle; no words give 0.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    votes, total = np.zeros(BITS, dtype=np.int64), 0
    for start in range(0, max(1, len(words) - size + 1), PIECE):
        some, count = _votes(words[start:start + PIECE + size - 1], size)
        votes, total = votes + some, total + count
    return int.from_bytes(np.packbits(2 * votes > total, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, text: str = "text", name: str = "fingerprint", size: int = SHINGLE) -> DataFrame:
    """``df`` with the fingerprint of ``text`` as a (signed) long."""
    def make():
        def work(texts):
            return {name: np.array([fingerprint(t, size) for t in texts], dtype=np.uint64).view(np.int64)}
        return work

    return annotate(df, text, make, {name: "bigint"})


# --- The plan: which bits form a partition, and how much each partition may differ -----------------------------------


@dataclass(frozen=True)
class Plan:
    #: Bits of each partition and its threshold (0 or more; partitions that are not looked at are left out).
    parts: tuple[tuple[tuple[int, ...], int], ...]


def bit_moments(prints: DataFrame) -> np.ndarray:
    """For each two bits the number of fingerprints that have both; summed in tasks first."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for start in range(0, len(values), 65536):
                bits = np.unpackbits(values[start:start + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "n"])

    rows = prints.select("fp").mapInArrow(sums, "at bigint, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BITS * BITS)
    for row in rows:
        out[row["at"]] = row["n"]
    return out.reshape(BITS, BITS)


def grouped_bits(moments: np.ndarray, total: int, count: int) -> list[tuple[int, ...]]:
    """``count`` partitions of near-equal size; each grows from a bit by the bits most correlated with it."""
    share = moments.diagonal() / max(total, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    link = np.abs(moments / max(total, 1) - np.outer(share, share)) / np.outer(spread, spread)
    free, parts = set(range(BITS)), []
    for k in range(count):
        size = (len(free) + count - k - 1) // (count - k)
        seed = max(free, key=lambda b: (link[b, sorted(free)].sum(), -b))
        part = [seed]
        free.discard(seed)
        while len(part) < size:
            best = max(free, key=lambda b: (link[b, part].sum(), -b))
            part.append(best)
            free.discard(best)
        parts.append(tuple(sorted(part)))
    return parts


def _mask(bits: tuple[int, ...]) -> int:
    return int(np.array(sum(1 << b for b in bits), dtype=np.uint64).astype(np.int64))


def _exploded(prints: DataFrame, keys: list[tuple[int, Column, Column]]) -> DataFrame:
    """A row (part, key, home, fp) for each given key of each fingerprint."""
    entries = F.array(*(F.struct(F.lit(part).alias("part"), key.alias("key"), home.alias("home")) for part, key, home in keys))
    return prints.select("fp", F.explode(entries).alias("e")).select("e.part", "e.key", "e.home", "fp")


def allocate(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost with ``sum(t + 1) = distance + 1``; ``costs[i][t + 1]`` is that of ``t`` in partition ``i``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for spent, more in enumerate(options):
                if used + spent <= distance + 1:
                    found = (cost + more, [*chosen, spent - 1])
                    if used + spent not in after or found < after[used + spent]:
                        after[used + spent] = found
        best = after
    return best[distance + 1]


def plan(prints: DataFrame, distance: int = DISTANCE) -> Plan:
    """Partitions and thresholds for the distinct fingerprints ``prints`` (column ``fp``)."""
    moments, total = bit_moments(prints), prints.count()
    layouts = {count: grouped_bits(moments, total, count) for count in range(2, distance + 3)}
    flat = [(count, i, bits) for count, parts in layouts.items() for i, bits in enumerate(parts)]
    counted = _exploded(prints, [(n, F.col("fp").bitwiseAND(F.lit(_mask(bits))), F.lit(True)) for n, (*_, bits) in enumerate(flat)])
    pairs = {r["part"]: r["pairs"] for r in counted.groupBy("part", "key").count().groupBy("part").agg(
        F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs")).collect()}
    # Two fingerprints that agree elsewhere differ in a bit as two independent ones do.
    share = moments.diagonal() / max(total, 1)
    differ = np.clip(2 * share * (1 - share), 1e-6, 0.5)
    odds = differ / (1 - differ)
    found = []
    for count, parts in layouts.items():
        costs = []
        for i, bits in enumerate(parts):
            same = pairs.get(flat.index((count, i, bits)), 0.0)
            one = odds[list(bits)].sum()
            # A row that is sent to a bucket costs about as much as ten comparisons.
            costs.append([0.0, 10.0 * total + same, 10.0 * total * (1 + len(bits) / 2) + same * (1 + one)])
        if (count * 2) >= distance + 1:
            cost, thresholds = allocate(costs, distance)
            found.append((cost, count, tuple((bits, t) for bits, t in zip(parts, thresholds, strict=True) if t >= 0)))
    return Plan(min(found)[2])


def buckets(prints: DataFrame, layout: Plan) -> DataFrame:
    """(part, key, home, fp): fingerprints under their own key, and under those of neighbours their partition may differ from.

    Of two keys that differ in one bit, the one without it visits the other.
    """
    keys: list[tuple[int, Column, Column]] = []
    for n, (bits, threshold) in enumerate(layout.parts):
        own = F.col("fp").bitwiseAND(F.lit(_mask(bits)))
        keys.append((n, own, F.lit(True)))
        if threshold == 1:
            for b in bits:
                one = F.lit(_mask((b,)))
                keys.append((n, F.when(own.bitwiseAND(one) == 0, own.bitwiseOR(one)), F.lit(False)))
    return _exploded(prints, keys).where(F.col("key").isNotNull())


# --- Links within buckets ---------------------------------------------------------------------------------------------


def forest(left: np.ndarray, right: np.ndarray | None, distance: int) -> list[tuple[int, int]]:
    """Links that connect what is connected at ``distance`` among ``left`` (``right`` None), or between ``left`` and ``right``."""
    both = left if right is None else np.concatenate([left, right])
    # Bits of a negative number would be counted in its absolute value.
    bits = both.astype(np.int64).view(np.uint64)
    side = np.zeros(len(both), dtype=bool)
    side[len(left):] = True
    free, links = np.ones(len(both), dtype=bool), []
    for root in range(len(both)):
        if not free[root]:
            continue
        free[root] = False
        front = [root]
        while front:
            at = front.pop()
            near = free & (np.bitwise_count(bits ^ bits[at]) <= distance)
            if right is not None:
                near &= side != side[at]
            for k in np.flatnonzero(near).tolist():
                links.append((int(both[at]), int(both[k])))
                front.append(k)
            free &= ~near
    return links


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links between distinct fingerprints, enough to connect all that are within ``distance`` of each other."""
    if not 0 <= distance <= 7:
        raise ValueError("distances from 0 to 7 are planned for")
    rows = stored(buckets(prints, plan(prints, distance)), "simhash-buckets")
    sizes = rows.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    large = stored(sizes.where(F.col("n") > JOINED), "simhash-large")
    # Large buckets are few: the others are left over by an anti join, which a hot bucket cannot skew.
    small = rows.join(large, ["part", "key"], "left_anti")
    left, right = small.alias("l"), small.alias("r")
    close = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= distance
    met = F.col("l.home") & (~F.col("r.home") | (F.col("l.fp") < F.col("r.fp")))
    pairs = left.join(right, (F.col("l.part") == F.col("r.part")) & (F.col("l.key") == F.col("r.key")) & met & close)
    pairs = pairs.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))

    # Rows of a large bucket fall into blocks by hash; each two blocks (and each block by itself) are one group, so that a
    # group has two blocks of rows however large the bucket is.
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    hot = rows.join(large, ["part", "key"]).withColumn("of", blocks).withColumn(
        "block", F.pmod(F.xxhash64("fp", F.lit(5)), F.col("of")).cast("int"))
    met = hot.select("part", "key", "fp", "home", "block", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("other"))
    met = met.select("part", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "home", "fp")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = frame["i"].iloc[0], frame["j"].iloc[0]
        values, at, home = frame["fp"].to_numpy(), frame["block"].to_numpy(), frame["home"].to_numpy()
        found = forest(values, None, distance) if i == j else forest(values[at == i], values[at == j], distance)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    dense = met.groupBy("part", "key", "i", "j").applyInPandas(compare, "a bigint, b bigint")
    return pairs.unionByName(dense).where("a != b").distinct()


def components(edges: DataFrame, label: str = "simhash", keep: Callable[[DataFrame, str, list[str]], DataFrame] = stored) -> DataFrame:
    """(node, root) for the nodes of the undirected ``edges`` (a, b): the smallest node each can reach.

    Alternates two steps until nothing changes: larger neighbours of a node are hung on its smallest one, then smaller ones.  A
    node's neighbours are never gathered, only their minimum is, so a hub is aggregated in tasks first.  ``keep`` writes what a step has made.
    """
    spark, used = edges.sparkSession, []
    edges = keep(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}-edges", used)
    while True:
        read, used = used, []
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        star = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = keep(star.where("a != b").distinct(), f"{label}-star", read)
        lower = star.groupBy("a").agg(F.min("b").alias("m"))
        hung = star.join(lower, "a")
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").unionByName(lower.select("a", F.col("m").alias("b")))
        after = keep(small.distinct(), f"{label}-edges", used)
        remove(spark, read)
        # Done when every node hangs on a root: no root of one edge hangs on another node.
        if after.join(after.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            multiple = after.groupBy("a").count().where("count > 1")
            if multiple.isEmpty():
                return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = after


def _classed(df: DataFrame, text: str, id: str, distance: int, size: int) -> tuple[DataFrame, DataFrame]:
    """Written rows (id, fp), and for each fingerprint its class ``root`` and the smallest id ``component`` of that."""
    keyed = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    rows = stored(fingerprints(keyed, "text", "fp", size).select("id", "fp"), "simhash-prints")
    # One row for each distinct fingerprint, however many copies it has.
    prints = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    roots = components(links(prints, distance))
    joined = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component"))
    return rows, joined.join(smallest, "root").select("fp", "root", "component")


def near_duplicates(df: DataFrame, text: str = "text", id: str = "doc_id", distance: int = DISTANCE, size: int = SHINGLE) -> DataFrame:
    """(id, fp, component): fingerprint and smallest id of its component for every row of ``df``.

    NULL, empty and blank texts have the fingerprint 0 and link like any other.  A repeated row is in the component of its
    copies; a row with a NULL id gets a component too, that of its smallest id that is not NULL (NULL if none).  An empty
    table gives no rows.  Other columns are not looked at.
    """
    rows, classes = _classed(df, text, id, distance, size)
    named = stored(classes.select("fp", "component"), "simhash-named")
    return rows.join(named, "fp").select("id", "fp", "component")


def keep_one(df: DataFrame, text: str = "text", id: str = "doc_id", distance: int = DISTANCE, size: int = SHINGLE) -> DataFrame:
    """The rows of ``df``, unchanged, with the smallest id of each component.

    Rows that share an id are told apart by their texts.  Rows with a NULL id all stay.
    """
    named = df.where(F.col(id).isNotNull())
    rows, classes = _classed(named, text, id, distance, size)
    found = rows.join(stored(classes, "simhash-named"), "fp").select("id", F.col("fp").alias("class"), "root", "component")

    def mark(some: DataFrame, name: str) -> DataFrame:
        return fingerprints(some, text, name, size)

    kept = keep_smallest(named, found, shared_ids(rows), mark, text, id)
    return kept.unionByName(df.where(F.col(id).isNull()))


def shared_ids(rows: DataFrame) -> DataFrame | None:
    """The ids of ``rows`` (id, ...) that do not name one row: those of several rows, and NULL; None if there are none."""
    counts = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    found = counts.where((F.col("n") > 1) | F.col("id").isNull()).select("id")
    return None if found.isEmpty() else gathered(found, "simhash-shared")


def keep_smallest(df: DataFrame, found: DataFrame, shared: DataFrame | None, mark: Callable[[DataFrame, str], DataFrame], text: str, id: str) -> DataFrame:
    """One row of ``df`` for each component of ``found`` (id, class, root, component), which has all rows: that with the smallest id.

    Components are told apart by their ``root``, since rows that share an id may be in several, each of them with that id as its smallest.  A
    component without an id keeps a row too.  ``shared`` are the ids that do not name one row, if any; rows with these get their class by ``mark`` and are kept by id and class.
    Of rows that share both, the first in the order of the text and the other columns stays.
    """
    flag, own = free_name(df, "component"), free_name(df, "class")
    won = found.where(F.col("id").eqNullSafe(F.col("component"))).groupBy("root").agg(F.min("id").alias("id"), F.min("class").alias("class"))
    won = gathered(won.select("id", "class"), "simhash-kept")
    # Nearly all ids are kept, so their table grows with the input: the rows are dealt out by id at every size.
    ids = won.select(F.col("id").alias(flag)).hint("shuffle_hash")
    kept = df.join(ids, F.col(id) == F.col(flag), "left_semi")
    if shared is None:
        return kept
    several = shared.select(F.col("id").alias(flag))
    kept = kept.join(several, F.col(id) == F.col(flag), "left_anti").where(F.col(id).isNotNull())
    marked = mark(df.join(several, F.col(id).eqNullSafe(F.col(flag)), "left_semi"), own)
    # Maps have no order.
    order = [F.col(text), *(F.col(f"`{c}`") for c, kind in df.dtypes if c not in (id, text) and "map<" not in kind and "variant" not in kind)]
    place, wanted = free_name(marked, "place"), free_name(marked, "wanted")
    # A copy is left out in its task already, so that the copies of one row do not meet in one.
    first = marked.withColumn(place, F.row_number().over(Window.partitionBy(id, own).orderBy(*order))).where(F.col(place) == 1).drop(place)
    picked = won.select(F.col("id").alias(flag), F.col("class").alias(wanted))
    rest = first.join(picked, F.col(id).eqNullSafe(F.col(flag)) & (F.col(own) == F.col(wanted)), "left_semi")
    return kept.unionByName(rest.drop(own))


def as_hex(value: Column) -> Column:
    """16 lower-case hexadecimal digits of a long."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
