"""Toxicity: features, FTRL-proximal and what it learns."""

import math
import random

import numpy as np
import pytest

from vigia.llm import toxicity
from vigia.llm.queries import QUERIES


def sets_of(texts):
    out = [set() for _ in texts]
    for slots, text in toxicity.features(texts):
        for s, t in zip(slots.tolist(), text.tolist(), strict=True):
            out[t].add(s)
    return out


def plain_features(text):
    """Names of the features of a text."""
    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    out = {("word", w) for w in words} | {("begin", n, w[:n]) for w in words for n in toxicity.BEGINNINGS if len(w) > n}
    return out | {("pair", d, a, b) for d in toxicity.DISTANCES for a, b in zip(words, words[d:], strict=False)}


TEXTS = ["You clown!", "you, CLOWN", "", None, "a b c d e f", "f e d c b a", "longerword longerworld", "a  b\nc", "été très 12"]


def test_features_are_those_of_the_words():
    sets = sets_of(TEXTS)
    names = [plain_features(t) for t in TEXTS]
    for i in range(len(TEXTS)):
        assert len(sets[i]) == len(names[i])
        for j in range(len(TEXTS)):
            assert len(sets[i] & sets[j]) == len(names[i] & names[j])
    assert [s for t in TEXTS for s in sets_of([t])] == sets  # neighbours in a slice don't matter


def plain_ftrl(documents, labels):
    """The published per-coordinate update, a feature at a time; feature -1 is the bias."""
    seen = {}
    for d in documents:
        for f in d:
            seen[f] = seen.get(f, 0) + 1
    z, n, w = {}, {}, {}

    def weight(f):
        own, l1 = z.get(f, 0.0), 0.0 if f == -1 else toxicity.L1
        if abs(own) <= l1:
            return 0.0
        return -math.copysign(abs(own) - l1, own) / ((toxicity.BETA + math.sqrt(n.get(f, 0.0))) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for d, y in zip(documents, labels, strict=True):
            own = [f for f in d if seen[f] >= toxicity.LEAST_DOCUMENTS] + [-1]
            w = {f: weight(f) for f in own}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - y
            for f in own:
                sigma = (math.sqrt(n.get(f, 0.0) + g * g) - math.sqrt(n.get(f, 0.0))) / toxicity.ALPHA
                z[f], n[f] = z.get(f, 0.0) + g - sigma * w[f], n.get(f, 0.0) + g * g
    return {f: weight(f) for f in z if weight(f)}


def test_training_equals_the_plain_update():
    rng = random.Random(4)
    documents = [sorted(rng.sample(range(1, 60), rng.randint(0, 20))) for _ in range(120)]
    labels = np.array([int(7 in d or 9 in d) for d in documents])
    got = toxicity.train([np.array(d, dtype=np.uint32) for d in documents], labels)
    want = plain_ftrl(documents, labels.tolist())
    assert got.bias == pytest.approx(want.pop(-1, 0.0))
    assert dict(zip(got.slots.tolist(), got.weights.tolist(), strict=True)) == pytest.approx(want)
    assert 0 < len(want) < 59  # the L1 penalty leaves out most


def test_score_is_the_logistic_of_the_weights():
    sets = sets_of(TEXTS)
    slots = np.array(sorted(set().union(*sets)), dtype=np.uint32)
    weights = np.linspace(-1, 1, len(slots))
    known = dict(zip(slots.tolist(), weights.tolist(), strict=True))
    want = [1 / (1 + math.exp(-(0.25 + sum(known[s] for s in own)))) for own in sets]
    assert toxicity.Weights(slots, weights, 0.25).score(TEXTS).tolist() == pytest.approx(want)


def test_learns_from_held_in_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op11_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    toxic, clean = [r["score"] for r in out if r["toxic"] == 1], [r["score"] for r in out if r["toxic"] == 0]
    better = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert better > 0.85
    assert sum(r["predicted"] for r in out if r["toxic"] == 0) <= 0.03 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


ODD = [None, "", " ", "%%% !!", "a", "clown " * 30_000, "é漢字🙂\x00\x1c", "same text", "same text"]


def test_odd_rows(spark):
    rows = spark.createDataFrame([(i if i != 4 else None, t, 3, "kept") for i, t in enumerate(ODD)], "doc_id bigint, text string, score int, other string")
    marks = spark.createDataFrame([(0, 1), (0, 0), (5, 1), (7, 0), (7, 0), (8, None), (None, 1), (99, 1), (1, 3)], "doc_id bigint, toxic int")
    weights = toxicity.fit(rows, marks)
    got = toxicity.score_toxicity(rows, weights).collect()
    assert len(got) == len(ODD) and {r["other"] for r in got} == {"kept"} and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if not r["text"] or r["text"] in (" ", "%%% !!")}) == 1
    assert toxicity.score_toxicity(rows.limit(0), weights).count() == 0
    assert toxicity.fit(rows, marks.limit(0)) is None
    assert {r["score"] for r in toxicity.score_toxicity(rows, None).collect()} == {0.5}


def test_fit_does_not_depend_on_partitions(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs.repartition(7), labels.repartition(3))
    assert a.slots.tolist() == b.slots.tolist() and a.weights.tolist() == b.weights.tolist() and a.bias == b.bias
