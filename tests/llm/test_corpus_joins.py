"""Near-duplicates, decontamination and nearest neighbours against brute force."""

import itertools
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from vigia.llm import decontaminate, neighbours, simhash
from vigia.llm.queries import QUERIES


def plain_fingerprint(text, size=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    texts = [None, "", " \t\n", "one", "One two", "A b C d", "été\x0bÀ x\xa0y z", "w " * 40, "a b c d e f g h i j k l m n"]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "PIECE", 4)
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_thresholds_of_least_cost():
    rng = random.Random(1)
    for _ in range(50):
        costs = [[0.0, rng.random(), rng.random() + 1] for _ in range(rng.randint(2, 5))]
        found, thresholds = simhash.allocate(costs, 3)
        every = [sum(c[s] for c, s in zip(costs, spent, strict=True)) for spent in itertools.product(range(3), repeat=len(costs)) if sum(spent) == 4]
        assert found == pytest.approx(min(every)) and sum(t + 1 for t in thresholds) == 4


def roots_of(values, distance):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(values)), 2):
        if bin(values[i] ^ values[j]).count("1") <= distance:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return [find(i) for i in range(len(values))]


def prints_with_groups(seed=4):
    """Random fingerprints, chains of close ones, and a large group that shares most bits."""
    rng = random.Random(seed)
    values = [rng.getrandbits(64) for _ in range(300)]
    for v in values[:40]:
        for _ in range(4):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                v ^= 1 << b
            values.append(v)
    hub = rng.getrandbits(64)
    values += [hub ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 9))) for _ in range(250)]
    return sorted(set(values))


@pytest.mark.parametrize("joined,block,distance", [(32, 2048, 3), (2, 16, 3), (8, 64, 2), (4, 32, 5)])
def test_components_of_close_fingerprints(spark, monkeypatch, joined, block, distance):
    monkeypatch.setattr(simhash, "JOINED", joined)
    monkeypatch.setattr(simhash, "BLOCK", block)
    values = prints_with_groups()
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), distance))
    root = {r["node"]: r["root"] for r in found.collect()}
    want, got = roots_of(values, distance), [root.get(v, v) for v in signed]
    assert len({*zip(want, got, strict=True)}) == len(set(want)) == len(set(got))


def test_components_of_graphs(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    rows = spark.createDataFrame(chain + star + [(5, 5), (7000, 6000)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in simhash.components(rows).collect()}
    assert all(found[i] == 0 for i in range(1, 61)) and all(found[1000 + i] == 1000 for i in range(1, 200)) and found[7000] == 6000
    assert simhash.components(rows.limit(0)).count() == 0


def test_near_duplicates_of_documents(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op7_simhash"](spark, small).collect()
    ids = sorted(texts)
    values = [plain_fingerprint(texts[i]) for i in ids]
    roots = roots_of(values, 3)
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{v:016x}" for i, v in zip(ids, values, strict=True)}
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: ids[r] for i, r in zip(ids, roots, strict=True)}


def test_near_duplicates_of_odd_rows(spark):
    rows = [(5, "a b c d", 1), (2, "a b c d", 1), (2, "a b c d", 1), (9, None, 1), (8, "", 1), (None, "a b c d", 1), (7, "q w e r t y u i o p", 1)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, fp int")
    found = sorted(((r["id"] is None, r["id"], r["component"]) for r in simhash.near_duplicates(table).collect()), key=str)
    assert found == sorted([(False, 5, 2), (False, 2, 2), (False, 2, 2), (False, 9, 8), (False, 8, 8), (True, None, 2), (False, 7, 7)], key=str)
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 7, 8, None]
    assert simhash.near_duplicates(table.limit(0)).count() == 0


# --- Decontamination -----------------------------------------------------------------------------------------------------


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence():
    rng = random.Random(7)
    for _ in range(200):
        a, b = (rng.choices("abcdef", k=rng.randint(1, 40)) for _ in range(2))
        assert decontaminate.common_subsequence(a, b) == longest(a, b)


def test_slots_follow_words():
    texts = ["One two, THREE_4 - é漢字 x2", "", "  ", "a", "'s ½² \n z", "́abc İstanbul", "<b>q</b>"] * 3
    slots, counts = decontaminate.hashed_words(texts)
    assert counts.tolist() == [len(decontaminate.words_of(t)) for t in texts]
    words = [w for t in texts for w in decontaminate.words_of(t)]
    for w in set(words):
        assert len({int(s) for s, x in zip(slots, words, strict=True) if x == w}) == 1


def benchmark_and_documents(rng):
    vocabulary = ["".join(rng.choices("bcdfgklmnprst", k=2)) + "".join(rng.choices("aeiou", k=1)) + "".join(rng.choices("lmnrst", k=2)) for _ in range(3000)]
    vocabulary += ["the", "of", "and", "to"] * 300
    prose = lambda n: rng.choices(vocabulary, k=n)
    items = [prose(n) for n in (6, 9, 14, 20, 33, 47, 60, 130)]
    documents = []
    for k, item in enumerate(items):
        documents.append((k, [*prose(300), *item, *prose(200)]))
        documents.append((100 + k, item))
        # A paraphrase: a tenth of the words replaced, a few put in.
        if len(item) >= 14:
            changed = [w if i % 10 != 5 else prose(1)[0] for i, w in enumerate(item)]
            changed[7:7] = prose(2)
            documents.append((200 + k, [*prose(80), *changed, *prose(80)]))
    documents += [(1000 + k, prose(rng.randint(1, 400))) for k in range(150)]
    return items, documents


def test_leaks_are_found_and_clean_texts_are_left_alone(spark):
    items, documents = benchmark_and_documents(random.Random(11))
    docs = spark.createDataFrame([(i, " ".join(w).capitalize() + ".", "kept") for i, w in documents], "doc_id bigint, text string, leaked_items string").repartition(3)
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(50, None), (51, ""), (None, "x y z"), (0, " ".join(items[0]))],
                                  "item_id bigint, text string")
    found = {r["doc_id"]: r["leaked_items"] for r in decontaminate.find_leaks(docs, bench).collect()}
    assert len(found) == len(documents)
    assert {i: v for i, v in found.items() if v} == {i: [str(i % 100)] for i in found if i < 1000}
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == 150


def changed_items(rng, items, words):
    """(item, text): items with 20 to 45 % of their words replaced, at random places, at the head, in the middle or at the tail."""
    for number, item in items:
        for share, kind in itertools.product((0.2, 0.3, 0.4, 0.45), ("random", "head", "middle", "tail")):
            k, n = int(len(item) * share), len(item)
            at = {"random": rng.sample(range(n), k), "head": range(k), "middle": range((n - k) // 2, (n + k) // 2), "tail": range(n - k, n)}[kind]
            copy = [rng.choice(words) if i in set(at) else w for i, w in enumerate(item)]
            start = rng.randrange(len(words) - 200)
            yield number, " ".join([*words[start:start + 70], *copy, *words[start + 100:start + 150]])


def test_changed_items_reach_the_check():
    folder = "/root/testdata/sf0.01"
    texts = pq.read_table(f"{folder}/documents.parquet")["text"].to_pylist()
    bench = [(str(r["item_id"]), r["text"], None) for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist()]
    sums = decontaminate._Sums()
    sums.add(texts)
    index = decontaminate.Index(decontaminate._space(sums.moment, sums.frequency, sums.passages), bench)
    words = [w for t in texts for w in decontaminate.words_of(t or "")]
    cases = list(changed_items(random.Random(23), [(i, decontaminate.words_of(t)) for i, t, _ in bench], words))
    answers = {i: (decontaminate.words_of(t), decontaminate.answer_of(t)) for i, t, _ in bench}
    accepted = hits = 0
    for (i, text), found in zip(cases, index.search([t for _, t in cases]), strict=True):
        item, answer = answers[i]
        share, said = longest(item, text.split()) / len(item), f" {' '.join(answer)} " in f" {text} "
        if share >= 0.7 or share >= 0.5 and said:
            accepted, hits = accepted + 1, hits + any(m[0] == i for m in found)
    assert accepted > 300 and hits / accepted >= 0.98, (hits, accepted)


def test_leaks_of_odd_rows(spark, monkeypatch):
    item = "what is the tallest mountain on the third moon of the seventh planet"
    rows = [(1, None), (1, None), (2, ""), (None, f"so, {item.upper()}!"), (3, "..."), (4, "word " * 60_000 + item)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, item), (8, "an entirely different question about rivers and their many bridges")], "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "PASS_CHARS", 60)
    found = decontaminate.find_leaks(docs, bench).collect()
    assert sorted((str(r["doc_id"]), r["leaked_items"]) for r in found) == [("1", []), ("1", []), ("2", []), ("3", []), ("4", ["7"]), ("None", ["7"])]
    assert decontaminate.find_leaks(docs, bench.limit(0)).where("size(leaked_items) = 0").count() == 6
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0


def test_leaks_of_documents(spark):
    folder = "/root/testdata/sf0.01"
    spell = lambda t: f" {' '.join(re.findall(r'\w+', t.lower()))} "
    items = {r["item_id"]: spell(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    want = {(r["doc_id"], k) for r in spark.read.parquet(f"{folder}/documents.parquet").collect() for t in [spell(r["text"])] for k, v in items.items() if v in t}
    assert {(r["doc_id"], r["item_id"]) for r in QUERIES["op3_decontaminate"](spark, folder).collect()} == want and want


# --- Nearest neighbours --------------------------------------------------------------------------------------------------


def test_recall_of_neighbours(spark, small):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").orderBy("vec_id").collect()]
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], dtype=np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    found = {}
    for r in QUERIES["op8_neighbours"](spark, small).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[q]
        score[q] = -2
        best = [int(ids[k]) for k in np.lexsort((ids, -score))[:5]]
        got = sorted(found[ids[q]])
        assert [r for r, *_ in got] == [1, 2, 3, 4, 5]
        assert all(abs(score[np.flatnonzero(ids == v)[0]] - s) < 1e-12 for _, v, s in got)
        hits, total = hits + len(set(best) & {v for _, v, _ in got}), total + 5
    assert hits / total >= 0.9


def test_recall_over_several_blocks(spark, small, monkeypatch):
    """Rows and queries in many blocks, each of which reranks the same share."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    ids, unit = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    found = {}
    for r in neighbours.search(table, table.where("vec_id % 20 = 0")).collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = unit @ unit[q]
        score[q] = -2
        hits += len(set(ids[np.argsort(-score)[:5]].tolist()) & set(found[ids[q]]))
    assert all(len(v) == 5 for v in found.values()) and hits / (5 * len(found)) >= 0.9


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    same = [(i, [1.0, 2.0, 3.0]) for i in range(10, 60)]
    rows = [(0, [1.0, 2.0, 3.0]), (1, [2.0, 4.0, 6.1]), (1, [2.0, 4.0, 6.1]), (2, None), (3, []), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 2.0]), (6, [nan, 1.0, 1.0]),
            (7, [inf, 1.0, 1.0]), (None, [1.0, 2.0, 3.0]), (8, [1.0, 2.0]), (9, [-1.0, -2.0, -3.0]), (100, [1e300, 2e300, 3e300]), *same]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, score string")
    found = neighbours.search(table, table.where("vec_id IN (0, 2, 4, 6, 7, 8, 20)")).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {0: [10, 11, 12, 13, 14], 20: [0, 10, 11, 12, 13]}
    few = neighbours.search(table.where("vec_id IN (0, 1, 9)"), table.where("vec_id = 0")).orderBy("rank").collect()
    assert [r["vec_id"] for r in few] == [1, 9] and few[1]["score"] == pytest.approx(-1.0)
    assert neighbours.search(table.limit(0), table.limit(0)).count() == 0
