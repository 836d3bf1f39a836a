"""Near-duplicates by Jaccard similarity against brute force."""

import itertools
import random

import pytest

import corpus_pipeline
from vigia.llm import simhash, similar
from vigia.sources.scratch import scratch_root


def plain_shingles(text, size=5):
    words = (text or "").lower().split()
    return {tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def smallest_ids(texts, least=0.8):
    sets, root = {i: plain_shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        if min(len(sets[a]), len(sets[b])) < least * max(len(sets[a]), len(sets[b])):
            continue
        both = len(sets[a] & sets[b])
        if both >= least * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in texts}


def test_the_stage_drops_edited_copies(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    want = set(smallest_ids(texts).values())
    # Documents that differ in text and share five words of six or more.
    assert not {255, 467, 770, 875, 944} <= want
    kept = corpus_pipeline.near_duplicates(spark, rows, "")
    assert kept.columns == rows.columns and {r["doc_id"] for r in kept.collect()} == want


@pytest.mark.parametrize("large,block,sent", [(32, 1024, 500_000), (3, 8, 0)])
def test_components_of_similar_texts(spark, monkeypatch, large, block, sent):
    monkeypatch.setattr(similar, "SENT", sent)
    monkeypatch.setattr(similar, "LARGE", large)
    monkeypatch.setattr(similar, "BLOCK", block)
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    texts = {}
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(5, 150))
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[len(texts)] = " ".join(["the same line stands before every text", *copy])
    chain = rng.choices(words, k=200)
    for k in range(20):
        texts[len(texts)] = " ".join(chain[5 * k:5 * k + 100])
    texts |= {900: None, 901: "", 902: " \n", 903: "one two", 904: "One  TWO"}
    table = spark.createDataFrame([*texts.items()], "doc_id bigint, text string").repartition(3)
    assert {r["id"]: r["component"] for r in similar.near_duplicates(table).collect()} == smallest_ids(texts)


def test_odd_rows(spark):
    rows = [(5, "a b c d", 1), (2, "a b c d", 1), (2, "a b c d", 1), (9, None, 1), (8, "", 1), (None, "a b c d", 1), (7, "q w e r t y u i o p", 1)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, component int")
    kept = similar.keep_one(table)
    assert kept.columns == table.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 7, 8, None]
    assert similar.near_duplicates(table.limit(0)).count() == 0


LINES = {name: " ".join(f"{name}{k}" for k in range(40)) for name in "abcdn"}


@pytest.mark.parametrize("sent", [500_000, 0])
def test_rows_that_share_an_id_are_told_apart(spark, monkeypatch, sent):
    monkeypatch.setattr(similar, "SENT", sent)
    # Two texts of id 3, both the smallest of their component; id 5 has a text of its own and a near copy of one of id 3; an id twice, once of them a copy of less.
    rows = [(3, LINES["a"], 1), (3, LINES["b"], 2), (3, LINES["b"], 1), (3, LINES["b"] + " x", 4), (4, LINES["a"] + " y", 1), (5, LINES["c"], 1),
            (5, LINES["a"] + " z", 1), (6, LINES["d"], 1), (7, LINES["b"] + " y", 3)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, class int").repartition(4)
    kept = similar.keep_one(table)
    found = sorted(tuple(r) for r in kept.collect())
    assert kept.columns == table.columns and len(found) == 4 and found[0] == rows[0] and found[2:] == [rows[5], rows[7]]
    assert found[1] in (rows[2], rows[3])
    texts = [r.text for r in simhash.keep_one(table, distance=0).collect()]
    assert len(texts) == len(set(texts)) == len({t for _, t, _ in rows})


@pytest.mark.parametrize("sent", [500_000, 0])
def test_the_stage_compares_documents_without_an_id(spark, monkeypatch, sent):
    monkeypatch.setattr(similar, "SENT", sent)
    rows = [(1, LINES["a"]), (None, LINES["a"]), (None, LINES["a"] + " x"), (None, LINES["n"] + " x"), (None, LINES["n"] + " y"), (None, LINES["n"] + " y"),
            (None, LINES["c"]), (2, LINES["d"]), (None, None), (None, "")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, table, "").collect()]
    named, unnamed = sorted(r for r in found if r[0]), [t for i, t in found if i is None]
    assert named == [rows[0], rows[7]]
    assert sorted((t or "")[:3] for t in unnamed) == ["", "c0 ", "n0 "]


def test_sets_of_shingles():
    texts = [None, "", "one two", "ONE  two", "a b c d e f a b c d e", "x a b c d e", "É é"]
    sets = [set(s.tolist()) for s in similar.shingle_sets(texts)]
    plain = [plain_shingles(t) for t in texts]
    for a in range(len(texts)):
        assert len(sets[a]) == len(plain[a]) or a == 6
        assert [len(sets[a] & s) for s in sets[:6]] == [len(plain[a] & s) for s in plain[:6]] or a == 6
    assert all(sorted(s) == s.tolist() for s in similar.shingle_sets(texts))


def test_repeated_shingles_go_on_and_no_others(spark, monkeypatch):
    """Packed blocks, and shingles that are taken for repeated since their slot is hot."""
    words = [f"w{k}" for k in range(300)]
    rng = random.Random(6)
    same = rng.choices(words, k=30)
    texts = [" ".join([*rng.choices(words, k=20), *same, *rng.choices(words, k=rng.randint(0, 20))]) for _ in range(60)]
    table = spark.createDataFrame([(t,) for t in texts + texts[:9]], "text string").repartition(5)
    counts = similar._slot_counts(table, 5)
    assert counts.sum() == sum(map(len, similar.shingle_sets(texts + texts[:9])))
    sets = similar.shingle_sets(texts)
    firsts = {}
    for s in sets:
        rank = sorted(s.tolist(), key=lambda x: (counts[x % similar.SLOTS], x))[:similar.prefix_size(len(s), 0.8)]
        for place, x in enumerate(rank):
            firsts.setdefault(x, set()).add((similar.class_of(s), len(s), place))
    want = {(x - (1 << 64) if x >> 63 else x, *row) for x, found in firsts.items() if len(found) > 1 for row in found}
    for size in (100_000, 50):
        monkeypatch.setattr(similar, "BLOCK_TOKENS", size)
        got = [tuple(r) for r in similar._prefixes(table, counts, 5, 0.8).collect()]
        assert set(got) == want and len(got) == len(want)
    monkeypatch.setattr(similar, "HOT_SHARE", 0)
    monkeypatch.setattr(similar, "HOT_COUNT", 20)
    hot = {tuple(r) for r in similar._prefixes(table, counts, 5, 0.8).collect()}
    assert want <= hot and all(r in want or counts[r[0] % similar.SLOTS] > 20 for r in hot)


def test_scratch_is_removed(spark, tmp_path):
    import os

    root = scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    table = spark.createDataFrame([(k, f"a b c d e f g {k % 3}") for k in range(9)], "doc_id bigint, text string")
    similar.near_duplicates(table).collect()
    left = {name.rpartition("-")[0] for name in set(os.listdir(root)) - before}
    assert not left & {"similar-prefixes", "similar-sets", "similar-pairs", "similar-first", "similar-met", "similar-buckets", "similar-star-star"}


def test_a_large_group_is_not_held_against_all_others(spark, monkeypatch):
    """Near copies and a few texts that have rare shingles in common with them: exact, and far fewer pairs than the product."""
    rng = random.Random(13)
    words = [f"w{k}" for k in range(5000)]
    base = rng.choices(words, k=120)
    texts = {}
    for k in range(240):
        copy = list(base)
        copy[rng.randrange(120)] = f"edit{k}"
        texts[k] = " ".join(copy)
    for k in range(40):
        start = rng.randrange(60)
        texts[500 + k] = " ".join([*rng.choices(words, k=60), *base[start:start + 50], *rng.choices(words, k=20)])
    table = spark.createDataFrame([*texts.items()], "doc_id bigint, text string").repartition(3)
    counted = []
    measured = similar._measured

    def counting(pairs, *rest):
        counted.append(pairs.count())
        return measured(pairs, *rest)

    monkeypatch.setattr(similar, "_measured", counting)
    assert {r["id"]: r["component"] for r in similar.near_duplicates(table).collect()} == smallest_ids(texts)
    assert sum(counted) < 240 * 40 / 2


def test_parities_never_tell_more_than_the_sets_differ():
    rng = random.Random(8)
    words = [f"w{k}" for k in range(900)]
    base = rng.choices(words, k=200)
    texts = [None, "one", " ".join(base), " ".join(base[:150]), " ".join(base[:100] + ["x"] + base[100:]), " ".join(rng.choices(words, k=2000))]
    sets = [set(s.tolist()) for s in similar.shingle_sets(texts)]
    odd = [similar.parities(s) for s in similar.shingle_sets(texts)]
    differ = [[sum(int(x).bit_count() for x in (a ^ b).view("uint64")) for b in odd] for a in odd]
    for a, b in itertools.product(range(len(texts)), repeat=2):
        assert differ[a][b] <= len(sets[a] ^ sets[b])
    assert not any(differ[k][k] for k in range(len(texts))) and differ[0][1] == 1 and differ[2][4] >= 8


def test_near_copies_that_fall_short_are_not_compared(spark, monkeypatch):
    """Copies with two edits each, 0.76 alike, and in half of the families some with one: exact, and few of the pairs compared."""
    rng = random.Random(21)
    words = [f"w{k}" for k in range(5000)]
    texts = {}
    for family in range(4):
        base = rng.choices(words, k=150)
        for k in range(28):
            copy = list(base)
            for place in rng.sample(range(8, 142), 1 if family % 2 and k % 9 == 0 else 2):
                copy[place] = f"edit{family}-{k}-{place}"
            texts[len(texts)] = " ".join(copy)
    table = spark.createDataFrame([*texts.items()], "doc_id bigint, text string").repartition(3)
    counted = []
    measured = similar._measured

    def counting(pairs, *rest):
        counted.append(pairs.count())
        return measured(pairs, *rest)

    monkeypatch.setattr(similar, "_measured", counting)
    assert {r["id"]: r["component"] for r in similar.near_duplicates(table).collect()} == smallest_ids(texts)
    assert len(set(smallest_ids(texts).values())) > 4
    assert sum(counted) < 4 * 28 * 27 / 2 / 2


def test_scratch_tables_have_no_file_for_each_partition_of_a_shuffle(spark, monkeypatch):
    """Each file starts processes at its writer: tables of a few rows are one file, and nothing stays cached."""
    import os

    rng = random.Random(4)
    words = [f"w{k}" for k in range(900)]
    texts = {}
    for k in range(60):
        base = rng.choices(words, k=60)
        for e in range(1 + k % 3):
            texts[len(texts)] = " ".join(base[:-1] + [f"edit{e}"])
    root = scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    monkeypatch.setattr(similar, "remove", lambda *_: None)
    cached = spark.sparkContext._jsc.sc().getPersistentRDDs().size
    held = cached()
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        table = spark.createDataFrame([*texts.items()], "doc_id bigint, text string").coalesce(3)
        found = similar.near_duplicates(table)
        assert cached() == held
        assert {r["id"]: r["component"] for r in found.collect()} == smallest_ids(texts)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    files = {}
    for folder in set(os.listdir(root)) - before:
        files[folder.rpartition("-")[0]] = sum(f.startswith("part-") for f in os.listdir(os.path.join(root, folder)))
    narrow = {"similar-buckets", "similar-pairs", "similar-first", "similar-links", "similar-met", "similar-dealt", "similar-edges", "similar-named"}
    assert narrow <= set(files) and all(files[label] == 1 for label in narrow), files
