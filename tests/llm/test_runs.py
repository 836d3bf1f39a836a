"""Periodic runs against a look at every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from vigia.llm import runs
from vigia.llm.queries import QUERIES


def plain_runs(words):
    """(start, length, period) by trying every period at every place."""
    n, out = len(words), []
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            own = words[i:j + p]
            if len(own) >= max(6, 4 * p) and not any(own[r:] == own[:-r] for r in range(1, p)):
                out.append((i, len(own), p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(words):
    found = plain_runs(words)
    gone = {k for a, n, p in found for k in range(a + p, a + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (len(found), *(best or (None,) * 3), best and best[1] * 1000 // best[2], digest("".join(f"{a},{n},{p}\n" for a, n, p in found)),
            digest(" ".join(w for k, w in enumerate(words) if k not in gone)))


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def some_texts(rng):
    docs = []
    for _ in range(rng.randint(1, 6)):
        words = []
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.4:
                words += [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 30))]
            else:
                unit = [rng.randint(0, rng.choice([1, 2, 9])) for _ in range(rng.randint(1, rng.choice([3, 12, 25])))]
                if rng.random() < 0.3:
                    unit = unit * rng.randint(1, 5) + [rng.randint(0, 2)]
                words += (unit * rng.randint(2, 9))[:rng.randint(1, 200)]
        if rng.random() < 0.3 and docs:
            words = docs[-1][rng.randint(0, 5):] + words
        docs.append(words)
    return docs


def found(docs):
    flat, starts = np.array([w for d in docs for w in d], dtype=np.int64), np.cumsum([0, *map(len, docs)])
    rows = list(zip(*(c.tolist() for c in runs.find_runs(flat, starts)), strict=True))
    return [[r[1:] for r in rows if r[0] == k] for k in range(len(docs))]


def test_runs_equal_those_of_every_period():
    rng, seen = random.Random(7), 0
    for _ in range(300):
        docs = some_texts(rng)
        want = [plain_runs(d) for d in docs]
        seen += sum(map(len, want))
        assert found(docs) == want
    assert seen > 1000


def test_hashes_that_always_agree_change_nothing(monkeypatch):
    """Every stretch is compared word by word in the end."""
    rng = random.Random(9)
    docs = [some_texts(rng) for _ in range(40)]
    honest = runs._Reach.equal

    def careless(self, a, b, size):
        return honest(self, a, b, size) | (size % 5 == 4)

    monkeypatch.setattr(runs._Reach, "equal", careless)
    for some in docs:
        for got, want in zip(found(some), map(plain_runs, some), strict=True):
            assert set(got) <= set(want)  # what is given is true


def test_grammar_derives_the_text():
    rng = random.Random(3)
    docs = some_texts(rng) + [[1] * 50, [], [1, 2] * 40]
    flat, starts = np.array([w for d in docs for w in d], dtype=np.int64), np.cumsum([0, *map(len, docs)])
    nodes = runs.grammar(flat, starts)
    by_symbol = {}
    for low, cut, high, symbol in zip(*(c.tolist() for c in nodes), strict=True):
        assert low < cut < high
        if symbol >= 0:
            by_symbol.setdefault(symbol, set()).add((cut - low, tuple(flat[low:high].tolist())))
    assert all(len(s) == 1 for s in by_symbol.values())
    # Each place between two words of a text is the boundary of one node.
    inner = [p for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True) for p in range(a + 1, b)]
    assert sorted(nodes.cut.tolist()) == inner
    # No pair of symbols is left twice: a long repetition needs few seams.
    assert sum((nodes.symbol < 0) & (nodes.high - nodes.low == 50)) < 12


def test_long_texts_of_few_words():
    assert found([[0] * 30_000]) == [[(0, 30_000, 1)]]
    unit = list(range(1000))
    assert found([unit * 5 + [7]]) == [[(0, 5000, 1000)]]


ODD = [None, "", " \t\n", "a", "a a a a a a", "a a a a a", "x\x1cy x\x1cy x\x1cy x\x1cy", "b a b a b a b a ", "w " * 40_000, "same same", "same same"]


def test_odd_rows(spark):
    rows = spark.createDataFrame([(i if i != 4 else None, t, 5, "kept") for i, t in enumerate(ODD)], "doc_id bigint, text string, n_runs int, other string")
    got = runs.annotate_runs(rows).collect()
    assert len(got) == len(ODD) and {r["other"] for r in got} == {"kept"}
    for r in got:
        assert tuple(r[c] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")) == plain_row(words_of(r["text"]))
    assert runs.annotate_runs(rows.limit(0)).count() == 0


def test_query_equals_brute_force(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op13_runs"](spark, small).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts) and sum(r["n_runs"] > 0 for r in got) > 10
    for row in got:
        words = words_of(texts[row["doc_id"]])
        number, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        if number % 10 == 0 and n:
            g = number // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000 and number % 10:
            continue  # the plain way takes the square of a text; its runs are tested above
        assert tuple(row[1:]) == plain_row(words), row["doc_id"]


@pytest.mark.parametrize("text", ["a b c", "a\x0bb\x0cc\rd", "  x  "])
def test_words(text):
    import pyarrow as pa

    from vigia.llm.words import split_words

    split = split_words(pa.array([None, text, ""]))
    assert [split.known[k].as_py() for k in split.number.tolist()] == words_of(text)
    assert split.starts.tolist() == [0, 0, len(words_of(text)), len(words_of(text))]
