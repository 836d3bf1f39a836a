"""Merkle manifest of a dataset, as a log of nodes in postorder.

Rows are the leaves of one tree for each key, in the order of their ids; the roots of these trees, in the order of the keys, are the leaves
of one more.  Every ``FAN`` consecutive nodes of a level (the last run may be shorter) become the digest of their digests, while more than one is left.

*Aligned builders* each take ``FAN ** SPAN`` consecutive leaves, whose subtrees hold no leaf of another builder, and write
their nodes in the order of completion, a node right after its last child.  The place of a node in the log of the whole tree is known
without looking: before leaf ``j`` there are ``j`` leaves and ``j // FAN ** k`` completed nodes of each level ``k`` (the sizes of the subtrees
before it), and a node follows its last leaf by as many places as it has levels.  What the builders leave, a node each, are the
leaves of the next round of builders.  A proof reads the siblings of a leaf at the places which the same formula gives: those within a builder's stretch
of the log from that stretch, all others once for the whole stretch.  No task holds more than the nodes of one builder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigia.llm.common import stored

FAN = 8
#: Levels that a builder completes over its leaves; unless said otherwise.
SPAN = 3

_LOG = "tree string, level int, index bigint, position bigint, digest string, total bigint, block bigint, ref bigint, changed string"
_ARROW_LOG = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("index", pa.int64()), ("position", pa.int64()), ("digest", pa.string()),
                        ("total", pa.int64()), ("block", pa.int64()), ("ref", pa.int64()), ("changed", pa.string())])


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(total: int) -> int:
    """Levels above the leaves of a tree of ``total`` leaves."""
    levels = 0
    while FAN**levels < total:
        levels += 1
    return levels


def position(level: int, index: int, total: int) -> int:
    """Place of a node in the postorder log of a tree of ``total`` leaves; ``index`` counts the nodes of its level."""
    last = min((index + 1) * FAN**level, total) - 1
    place, done = last + level, last // FAN
    while done:
        place, done = place + done, done // FAN
    return place


def field(value: Column) -> Column:
    """A column as it enters a leaf: ``-`` for NULL, else its length in UTF-8 bytes, a colon, and its text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


# --- Numbers of leaves -------------------------------------------------------------------------------------------------


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with ``index``, the place of a row within its ``tree`` by ``order``, and ``total``, the rows of the tree.

    Rows are dealt out by ranges of the whole order, so that a large tree takes many tasks; a task counts its own rows, and
    the counts of the tasks before it, a row for each task and tree, are added.
    """
    spread = leaves.withColumn("tie", F.monotonically_increasing_id())  # equal rows need not stay together
    ordered = spread.repartitionByRange("tree", *order, "tie").sortWithinPartitions("tree", *order, "tie").drop("tie")
    at = ordered.columns.index("tree")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, tree, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            trees = batch.column(at).to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(np.concatenate([[True], trees[1:] != trees[:-1]])) if len(trees) else np.zeros(0, dtype=np.int64)
            rank = np.arange(len(trees))
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(trees)], strict=True):
                if trees[a] != tree:
                    tree, seen = trees[a], 0
                rank[a:b] += seen - a
                seen += b - a
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(trees), task)), pa.array(rank)],
                                             names=[*batch.schema.names, "task", "rank"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema) + ", task bigint, rank bigint"
    counted = stored(ordered.mapInArrow(count, schema), "merkle-leaves")
    parts = counted.groupBy("tree", "task").agg(F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("tree", "task", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"), F.sum("rows").over(tree).alias("total"))
    return counted.join(parts, ["tree", "task"]).withColumn("index", F.col("before") + F.col("rank")).drop("task", "rank", "before")


# --- The log -----------------------------------------------------------------------------------------------------------


def _builder(base: int, span: int) -> Callable[[pa.Table], pa.Table]:
    """Completes the levels above ``base`` for the nodes of one block; gives all nodes in the order of completion."""
    def build(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("index")
        total, block, tree = nodes["total"][0].as_py(), nodes["block"][0].as_py(), nodes["tree"][0].as_py()
        first, digests = nodes["index"][0].as_py(), nodes["digest"].to_pylist()
        refs = list(zip(nodes["ref"].to_pylist(), nodes["changed"].to_pylist(), strict=True))
        most = min(span, height(total) - base)
        count = -(-total // FAN**base)  # nodes of the base level in the whole tree
        log: list[tuple] = []
        waiting: list[list[str]] = [[] for _ in range(most + 1)]
        for k, (own, ref) in enumerate(zip(digests, refs, strict=True), first):
            log.append((base, k, own, ref))
            waiting[0].append(own)
            for level in range(1, most + 1):
                size = FAN**level
                if (k + 1) % size and k + 1 < count:
                    break
                made = digest("".join(waiting[level - 1]))
                waiting[level - 1].clear()
                waiting[level].append(made)
                log.append((base + level, k // size, made, (None, None)))
        level, index, digests, refs = zip(*log, strict=True)
        n = len(log)
        places = [position(a, b, total) for a, b in zip(level, index, strict=True)]
        return pa.table([[tree] * n, level, index, places, digests, [total] * n, [block] * n, *zip(*refs, strict=True)], schema=_ARROW_LOG)

    return build


def _build(leaves: DataFrame, label: str, span: int = SPAN) -> tuple[list[DataFrame], int]:
    """The logs of the rounds of builders, the lowest first, and the height of the tallest tree.

    ``leaves``: tree, index, total, digest, ref and changed (a number and a digest that leaf rows carry).  Each round is written once and read by its proofs.
    """
    top = leaves.agg(F.max("total").alias("most")).first()["most"]
    tallest = height(top) if top else 0
    logs, nodes, base = [], leaves, 0
    while not logs or base < tallest:
        dealt = nodes.withColumn("block", F.floor(F.col("index") / F.lit(FAN**span)).cast("bigint")).select(
            "tree", F.lit(base).cast("int").alias("level"), "index", F.lit(None).cast("bigint").alias("position"), "digest", "total", "block", "ref", "changed")
        logs.append(stored(dealt.groupBy("tree", "block").applyInArrow(_builder(base, span), _LOG), f"merkle-{label}"))
        base += span
        nodes = logs[-1].where((F.col("level") == base) & (F.col("total") > FAN**base))
    return logs, tallest


def _roots(logs: list[DataFrame], tallest: int, span: int) -> DataFrame:
    """(tree, total, digest) of the root of each tree: the node whose level is the height of its tree."""
    high = F.lit(0)
    for level in range(tallest):
        high = high + F.when(F.col("total") > FAN**level, 1).otherwise(0)
    found = [log.where((F.col("level") == high) & ((F.col("level") > k * span) | (F.lit(k) == 0))) for k, log in enumerate(logs)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.where("index = 0").select("tree", "total", "digest")


# --- Proofs ------------------------------------------------------------------------------------------------------------

_PATH = "tree string, block bigint, before array<string>, after array<string>, subroot string, root string"
_ARROW_PATH = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string())),
                         ("subroot", pa.string()), ("root", pa.string())])


def siblings(log: pa.Table, base: int, span: int) -> Iterator[tuple[int, str, list[str], list[str]]]:
    """(row of ``log``, digest, siblings before, siblings behind) of the base nodes of one builder's stretch of the log, by level from below."""
    total = log["total"][0].as_py()
    places, digests = log["position"].to_numpy(), log["digest"].to_pylist()
    order = np.argsort(places)
    ordered = places[order]
    most = min(span, height(total) - base)
    runs: dict[tuple[int, int], list[str]] = {}

    def run(level: int, number: int) -> list[str]:
        """Digests of a run of siblings, read at the places that the formula gives."""
        if (level, number) not in runs:
            count = -(-total // FAN**level)
            wanted = [position(level, i, total) for i in range(number * FAN, min((number + 1) * FAN, count))]
            runs[level, number] = [digests[order[k]] for k in np.searchsorted(ordered, wanted).tolist()]
        return runs[level, number]

    levels, indexes = log["level"].to_pylist(), log["index"].to_pylist()
    for k, (level, index) in enumerate(zip(levels, indexes, strict=True)):
        if level != base:
            continue
        before, after = [], []
        for up in range(base, base + most):
            own = run(up, index // FAN)
            before.append("".join(own[:index % FAN]))
            after.append("".join(own[index % FAN + 1:]))
            index //= FAN
        yield k, digests[k], before, after


def _lower_paths(base: int, span: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The paths of the base nodes of a block, each the root of a block below, from the path of the block's own root."""
    def walk(log: pa.Table, above: pa.Table) -> pa.Table:
        if not (log.num_rows and above.num_rows):
            return _ARROW_PATH.empty_table()
        up = above.slice(0, 1).to_pylist()[0]
        index = log["index"].to_pylist()
        rows = [(up["tree"], index[k], [*before, *up["before"]], [*after, *up["after"]], up["subroot"], up["root"])
                for k, _, before, after in siblings(log, base, span)]
        return pa.table(list(zip(*rows, strict=True)), schema=_ARROW_PATH)

    return walk


def fold(own: str, before: list[str], after: list[str]) -> str:
    """The root that follows from a leaf and the siblings of its path."""
    for left, right in zip(before, after, strict=True):
        own = digest(left + own + right)
    return own


_PROOF = ("tree", "index", "ref", "leaf", "subroot", "root", "proof_sha256", "folded_root")


def _prover(span: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Proof and folded root of the leaves of a block."""
    schema = pa.schema([(name, pa.int64() if name in ("index", "ref") else pa.string()) for name in _PROOF])

    def prove(log: pa.Table, above: pa.Table) -> pa.Table:
        if not (log.num_rows and above.num_rows):
            return schema.empty_table()
        up = above.slice(0, 1).to_pylist()[0]
        tree, index, ref, changed = (log[c].to_pylist() for c in ("tree", "index", "ref", "changed"))
        upper = "".join(a + b for a, b in zip(up["before"], up["after"], strict=True))
        rows = []
        for k, own, before, after in siblings(log, 0, span):
            proof = digest("".join(a + b for a, b in zip(before, after, strict=True)) + upper)
            folded = fold(fold(changed[k] or own, before, after), up["before"], up["after"])
            rows.append((tree[k], index[k], ref[k], own, up["subroot"], up["root"], proof, folded))
        return pa.table(list(zip(*rows, strict=True)), schema=schema)

    return prove


def _start(k: int, paths: DataFrame, span: int) -> DataFrame:
    """The paths (of whole trees) of those trees whose root a builder of round ``k`` makes."""
    ends = F.col("total") <= FAN**(span * (k + 1))
    begins = F.col("total") > FAN**(span * k) if k else F.lit(True)
    return paths.where(begins & ends).select("tree", F.lit(0).cast("bigint").alias("block"), "before", "after", "subroot", "root")


def _paths(logs: list[DataFrame], whole: DataFrame, label: str, span: int) -> DataFrame:
    """(tree, block, before, after, subroot, root) of the blocks of the lowest builders, from the paths of whole trees."""
    paths = _start(len(logs) - 1, whole, span)
    for k in range(len(logs) - 1, 0, -1):
        below = logs[k].groupBy("tree", "block").cogroup(paths.groupBy("tree", "block")).applyInArrow(_lower_paths(k * span, span), _PATH)
        paths = stored(below, f"merkle-{label}").unionByName(_start(k - 1, whole, span))
    return paths


def manifest(df: DataFrame, leaf: Column, changed: Column, key: str = "lang", id: str = "doc_id", span: int = SPAN) -> DataFrame:
    """Proofs of all rows of ``df``: id, leaf, subroot, root, proof_sha256, folded_root and verified.

    ``leaf`` is the digest (hex) of a row, ``changed`` that of a row which has been tampered with, or NULL.  Trees are by ``key`` (NULL is
    a key of its own, the first), leaves in the order of ``id`` (NULL first) and, among equal ids, of their digests; equal rows are leaves of
    their own.  ``proof_sha256`` digests the siblings on the way to the root, ``folded_root`` follows from the changed leaf, else from the leaf,
    and these siblings.  Long texts and NULLs are the matter of ``leaf``; an empty table gives no rows.  Other columns of ``df`` are not read.
    """
    rows = df.select(F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("tree"), F.col(id).cast("bigint").alias("ref"),
                     leaf.alias("digest"), changed.alias("changed"))
    leaves = stored(_numbered(stored(rows, "merkle-rows"), ["ref", "digest"]), "merkle-numbered")
    logs, tallest = _build(leaves, "log", span)
    roots = _roots(logs, tallest, span)
    # The roots are the leaves of one more tree.
    over = stored(_numbered(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", F.col("total").alias("ref"),
                                          F.lit(None).cast("string").alias("changed")), ["name"]), "merkle-over")
    top, top_height = _build(over, "top", span)
    root = _roots(top, top_height, span).select(F.lit("").alias("tree"), "total", F.array().cast("array<string>").alias("before"),
                                          F.array().cast("array<string>").alias("after"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    above = _paths(top, root, "top-paths", span)
    named = top[0].groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(_lower_paths(0, span), _PATH)
    whole = over.select("index", "name", F.col("ref").alias("total"), F.col("digest").alias("own")).join(
        named.select(F.col("block").alias("index"), "before", "after", "root"), "index").select(
        F.col("name").alias("tree"), "total", "before", "after", F.col("own").alias("subroot"), "root")
    paths = _paths(logs, stored(whole, "merkle-whole"), "paths", span)
    schema = ", ".join(f"{name} {'bigint' if name in ('index', 'ref') else 'string'}" for name in _PROOF)
    proofs = logs[0].groupBy("tree", "block").cogroup(paths.groupBy("tree", "block")).applyInArrow(_prover(span), schema)
    return proofs.select(F.col("ref").alias(id), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
