"""The Merkle manifest against a plain tree."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from vigia.llm import merkle
from vigia.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves):
    """The levels of a tree of digests."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def plain_walk(levels, i, own):
    """(texts of the siblings in order, folded root) of leaf ``i``."""
    proof = ""
    for level in levels[:-1]:
        run = level[i // 8 * 8:i // 8 * 8 + 8]
        before, after = "".join(run[:i % 8]), "".join(run[i % 8 + 1:])
        proof, own, i = proof + before + after, h(before + own + after), i // 8
    return proof, own


def plain_manifest(rows):
    one = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    trees = {}
    for r in rows:
        start = "".join(one(r[c]) for c in ("doc_id", "source", "lang", "n_chars"))
        own = h(start + one(r["text"]))
        tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None
        changed = h(start + one(r["text"].translate(lower))) if tampered else own
        trees.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, own, changed))
    names = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    built = {k: plain_tree([x[2] for x in sorted(trees[k])]) for k in names}
    top = plain_tree([built[k][-1][0] for k in names])
    out = []
    for n, k in enumerate(names):
        for i, (known, id, own, changed) in enumerate(sorted(trees[k])):
            low, sub = plain_walk(built[k], i, changed)
            high, folded = plain_walk(top, n, sub)
            out.append((id if known else None, own, built[k][-1][0], top[-1][0], h(low + high), folded, folded == top[-1][0]))
    return out


def manifest_rows(df, span=merkle.SPAN):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf(*fields[:-1], lower))
    return [tuple(r) for r in merkle.manifest(df, merkle.leaf(*fields), tampered, span=span).collect()]


def key(row):
    return tuple((v is not None, v) for v in row)


def test_places_are_those_of_a_postorder_walk():
    for total in (1, 2, 7, 8, 9, 63, 64, 65, 511, 513, 700):
        counts = [total]
        while counts[-1] > 1:
            counts.append(-(-counts[-1] // 8))
        walked = []

        def visit(level, i, counts=counts, walked=walked):
            if level:
                for child in range(i * 8, min(i * 8 + 8, counts[level - 1])):
                    visit(level - 1, child)
            walked.append((level, i))

        visit(len(counts) - 1, 0)
        assert merkle.height(total) == len(counts) - 1
        assert [merkle.position(level, i, total) for level, i in walked] == list(range(len(walked)))


@pytest.mark.parametrize("span", [1, 2, 3])
def test_manifest_equals_a_plain_tree(spark, span):
    rows = [(i * 3 % 1000, f"Text Number {i}" if i % 5 else None, "a" if i < 600 else f"x{i % 11}", None if i % 7 else "S", i) for i in range(800)]
    rows += [(None, "NULL id", "a", "s", None), (3, "Again", "a", "s", 1), (3, "Again", "a", "s", 1), (4, "", None, None, None), (2001, "é漢🙂 ABC", "é", "", 9),
             (2002, "Long Word " * 50_000, "z", "s", 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(manifest_rows(df, span), key=key) == sorted(plain_manifest([r.asDict() for r in df.collect()]), key=key)


@pytest.mark.parametrize("count", [0, 1, 2, 9])
def test_small_tables(spark, count):
    df = spark.createDataFrame([(i, "Same", "l", "s", 4) for i in range(count)], SCHEMA).withColumn("leaf", F.lit("clash")).withColumn("tree", F.lit("clash"))
    assert sorted(manifest_rows(df), key=key) == sorted(plain_manifest([r.asDict() for r in df.collect()]), key=key)


def test_query_equals_its_sql_and_a_plain_tree(spark, small):
    got = sorted(tuple(r) for r in QUERIES["op12_merkle"](spark, small).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    assert got == sorted(con.sql(ORACLE["op12_merkle"]).fetchall())
    rows = [r.asDict() for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert got == sorted(plain_manifest(rows))
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_no_task_holds_more_than_a_block(spark):
    """A key with nearly all rows is dealt out over many blocks."""
    df = spark.range(3000).selectExpr("id AS doc_id", "'t' AS text", "'one' AS lang", "'s' AS source", "1L AS n_chars")
    rows = df.select(F.lit("=one").alias("tree"), F.col("doc_id").alias("ref"), merkle.leaf(F.col("doc_id")).alias("digest"), F.lit(None).cast("string").alias("changed"))
    logs, tallest = merkle._build(merkle._numbered(rows, ["ref", "digest"]), "test")
    assert tallest == 4 and len(logs) == 2
    assert logs[0].groupBy("block").count().agg(F.max("count")).first()[0] == 512 + 64 + 8 + 1
    every = logs[0].unionByName(logs[1].where("level > 3")).orderBy("position").select("position", "level").collect()
    assert [r["position"] for r in every] == list(range(len(every)))
