"""Language identification, quality, tokens and licences."""

import hashlib
import itertools
import math
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vigia.llm import langid, licenses, quality
from vigia.llm.bpe import Codec, encode_documents
from vigia.llm.common import held_out, may_learn, slices
from vigia.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n", "1234 %%% !!", "a", "word " * 30_000, "é漢字🙂\x00\x1c", "same text", "same text"]


def odd_table(spark, **extra):
    rows = spark.createDataFrame([(i if i != 4 else None, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    return rows.selectExpr("*", *(f"'{v}' AS {k}" for k, v in extra.items()))


def test_slices_cover_all_texts():
    texts = ["x" * 3_000_000, None, "y" * 3_000_000, "", "z" * 9_000_000, "a"]
    parts = list(slices(texts))
    assert [k for p in parts for k in range(p.start, p.stop)] == list(range(6)) and len(parts) == 4


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as file:
        return Codec(file.read())


def test_codec_equals_the_library(codec):
    theirs = Tokenizer.from_file(PATH)
    rng = random.Random(5)
    alphabet = "abc ABC  \n\t\r\x0b\x0c\x1c\x85\xa0　'sdlvert0123½²٣éñ漢字🙂​́!?.-_"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["<|endoftext|>", "a<|endoftext|> b", "x" * 5000, "ab" * 3000, " " * 300, "the thing's\n\n\n end", "aaaaaaa" * 9]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        want = theirs.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == want, text
        assert codec.decode(ids) == theirs.decode(want, skip_special_tokens=False)


def test_cache_limit_changes_nothing(codec, monkeypatch):
    texts = ["one two three", "two  three four", "five"]
    want = codec.encode(texts)
    monkeypatch.setattr("vigia.llm.bpe.WORD_BYTES", 0)
    monkeypatch.setattr("vigia.llm.bpe.PAIR_BYTES", 0)
    assert [codec.encode([t])[0] for t in texts] == want


def test_cache_is_bounded_in_bytes_and_goes_with_the_task(codec, monkeypatch):
    monkeypatch.setattr("vigia.llm.bpe.WORD_BYTES", 50_000)
    rng = random.Random(2)
    codec.forget()
    for _ in range(60):
        codec.encode([" ".join("".join(rng.choices("abcdefgh", k=rng.randint(3, 90))) for _ in range(40))])
        held = sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in codec.known.items())
        assert held <= codec.known_bytes < 50_000 + 40 * 2 * 300
    codec.forget()
    assert not codec.known and not codec.apart and not codec.known_bytes


def test_encoding_odd_rows(spark):
    rows = encode_documents(odd_table(spark, ids="clash", other="kept"), PATH).collect()
    assert len(rows) == len(ODD) and {r["other"] for r in rows} == {"kept"}
    assert all(r["decoded"] == (r["text"] or "") for r in rows)
    assert encode_documents(odd_table(spark).limit(0), PATH).count() == 0


def test_token_digests(spark, small):
    theirs = Tokenizer.from_file(PATH)
    rows = QUERIES["op10_bpe"](spark, small).join(spark.read.parquet(f"{small}/documents.parquet"), "doc_id").collect()
    for row in rows:
        ids = theirs.encode(row["text"], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def grams_of(text):
    padded = [ord(c) for c in f" {' '.join(''.join(c.lower() if c.isalpha() else ' ' for c in text).split())} "]
    return {(n, tuple(padded[i:i + n])) for n in (2, 3, 4) for i in range(len(padded) - n + 1)}


def test_marks_are_the_ngrams_of_the_text(monkeypatch):
    texts = ["The cat, the CAT!", "été d'un 3 chat", "a", "x" * 50, "ab cd " * 40]
    rows = []
    for text in texts:
        row = np.zeros(langid.WIDTH, dtype=np.uint8)
        assert langid.mark(text, row)
        rows.append(row)
        assert 0 < row.sum() <= len(grams_of(text))
    monkeypatch.setattr(langid, "PIECE", 7)
    for text, whole in zip(texts, rows, strict=True):
        pieces = np.zeros(langid.WIDTH, dtype=np.uint8)
        langid.mark(text, pieces)
        assert (pieces == whole).all(), text
    assert not langid.mark("123 %%", np.zeros(langid.WIDTH, dtype=np.uint8))
    assert not langid.mark(None, np.zeros(langid.WIDTH, dtype=np.uint8))


def test_language_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op2_language"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 100
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(spark, small):
    model = langid.fit(spark.read.parquet(f"{small}/documents.parquet"))
    rows = {i: r for i, r in enumerate(langid.identify(odd_table(spark, score="clash"), model).collect())}
    assert [rows[i]["lang_pred"] for i in range(5)] == ["und"] * 5 and all(rows[i]["score"] == 0 for i in range(5))
    assert rows[8]["lang_pred"] == rows[9]["lang_pred"] != "und"
    assert langid.keep_identified(odd_table(spark, lang_pred="x"), model).count() == 5
    assert langid.fit(odd_table(spark, lang="en").limit(0)) is None
    assert {r["lang_pred"] for r in langid.identify(odd_table(spark), None).collect()} == {"und"}


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    pair, first = rng.normal(size=(2, 2)), 0.4
    lengths = np.array([1, 4, 2, 6])
    unary = rng.normal(size=lengths.sum())
    good, expected = quality.all_marginals(unary, lengths, pair, first)
    start = 0
    for k, n in enumerate(lengths):
        total, on, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            weight = np.exp(sum(unary[start + i] * y for i, y in enumerate(labels)) + first * labels[0]
                            + sum(pair[a, b] for a, b in zip(labels, labels[1:])))
            total += weight
            on += weight * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                pairs[a, b] += weight
        assert np.allclose(good[start:start + n], on / total) and np.allclose(expected[k], pairs / total)
        start += n


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op4_quality"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r["quality"] == r["predicted"] for r in rows) / len(rows) > 0.95


def test_quality_of_odd_rows(spark, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    field = quality.fit(spark.read.parquet(f"{small}/documents.parquet"), labels)
    rows = quality.score_quality(odd_table(spark, score="clash"), field).collect()
    assert [r["score"] for r in rows[:4]] == [0.0] * 4 and rows[8]["score"] == rows[9]["score"]
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert quality.fit(odd_table(spark), labels.limit(0)) is None
    assert {r["score"] for r in quality.score_quality(odd_table(spark), None).collect()} == {0.5}


def test_held_out_is_a_crc_of_the_id(spark):
    import zlib

    rows = spark.range(200).select("id", held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)


def test_licenses_against_all_templates():
    tool = licenses.templates(0.8)
    rng = random.Random(2)
    parts = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "All rights reserved.",
             "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: MIT"]
    some = "the of license under licensed mit work is this to and version public".split()
    parts += [" ".join(rng.choices(some, k=rng.randint(1, 12))) for _ in range(300)]
    for part in parts:
        grams = licenses.bigrams(licenses.normalised(part))
        words = set(licenses.normalised(part))
        every = [(licenses.dice(grams, g), name) for _, name, needed, g in tool.templates if needed <= words]
        best = max((s for s, _ in every), default=0.0)
        want = min(n for s, n in every if s == best) if best >= 0.8 else None
        found = tool.scan(part)
        assert (found[0][0] if found else None) == want, part
        assert not found or found[0][1] == pytest.approx(best)
    for part in ("This work is licensed under the", "SPDX-License-Identifier:", "Licensed under the", "a software of this work"):
        assert tool.scan(part) == []
    assert {f[0] for f in tool.scan("Some prose. " + "\n\n".join(parts[:6]))} == {"Apache-2.0", "MIT", "All-Rights-Reserved", "GPL-3.0", "CC-BY-NC-4.0"}


BSD = """Copyright (c) 1999, Someone. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_wordings_across_line_breaks():
    tool = licenses.templates(0.8)
    prose = "Some words stand before it. They tell nothing.\n\n"
    names = lambda text: {f[0] for f in tool.scan(text)} - {"All-Rights-Reserved"}
    assert names(BSD % "") == names(prose + BSD % "" + prose) == {"BSD-2-Clause"}
    assert names(BSD % THIRD) == names(prose + BSD % THIRD + prose) == {"BSD-3-Clause"}
    assert names(f"{prose}This file. Licensed under the Apache\nLicense, Version 2.0. More prose.") == {"Apache-2.0"}
    for name, wordings in licenses.WORDINGS.items():
        for wording in wordings:
            words = wording.split()
            wrapped = "\n".join(" # " + " ".join(words[k:k + 9]) for k in range(0, len(words), 9))
            assert name in {f[0] for f in tool.scan(f"{prose}{wrapped}\n\n{prose}")}, wording
    assert tool.scan("All rights reserved.\n" * 20_000)[0][0] == "All-Rights-Reserved"


def test_license_of_odd_rows(spark):
    rows = licenses.scan_licenses(odd_table(spark, licenses="clash")).collect()
    assert len(rows) == len(ODD) and all(r["licenses"] == [] for r in rows)


def test_license_lines_are_found(spark):
    folder = "/root/testdata/sf0.01"
    lines = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "All rights reserved.": "All-Rights-Reserved",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    want = {(r["doc_id"], name) for r in spark.read.parquet(f"{folder}/documents.parquet").collect() for line, name in lines.items() if line in r["text"].split("\n")}
    assert {(r["doc_id"], r["license"]) for r in QUERIES["op5_licenses"](spark, folder).collect()} == want


def test_every_language_is_learned(spark):
    """More languages than texts of each that fit, and one with most of the rows."""
    rng = random.Random(1)
    rows = []
    for k in range(70):
        letters = "".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 6))
        for n in range(6 if k else 200):
            rows.append((len(rows), " ".join("".join(rng.choices(letters, k=rng.randint(3, 8))) for _ in range(60)), f"l{k:02d}"))
    rows += [(0, rows[0][1], "l69"), (len(rows), None, "l00"), (None, "x", "l00")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    model = langid.fit(table)
    assert len(model.languages) == 70
    found = langid.identify(table.where("doc_id > 0 AND text IS NOT NULL"), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) > 0.9 * len(found)


def test_the_stage_drops_texts_in_no_learned_language(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = langid.fit(docs.where(may_learn("doc_id")))
    rng = random.Random(12)
    other = [" ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(150)) for letters in ("абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω")]
    other.append("1234 !!")
    more = spark.createDataFrame([(10_000 + k, t, None, None, None) for k, t in enumerate(other)], docs.schema)
    kept = {r["doc_id"] for r in langid.keep_identified(docs.unionByName(more), model).collect()}
    letters = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert not kept & {10_000, 10_001, 10_002} and kept == letters


def plain_kernel(a, b):
    return len(a & b) / math.sqrt(max(len(a), 1) * max(len(b), 1))


def test_scores_equal_a_plain_kernel_ridge_regression(spark, small):
    """Nyström features, centred and weighted by language, ridge by normal equations; from sets of hash slots."""
    texts = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{small}/documents.parquet").where("lang IS NOT NULL AND text IS NOT NULL").limit(60).collect()]
    table = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    model = langid.fit(table)

    def slots(text):
        row = np.zeros(langid.WIDTH, dtype=np.uint8)
        return set(np.flatnonzero(row).tolist()) if not langid.mark(text, row) else set(np.flatnonzero(row).tolist())

    rows = langid._samples(table, "text", "lang", "doc_id")
    sets = [set(np.flatnonzero(np.unpackbits(np.frombuffer(b, dtype=np.uint8))).tolist()) for b in rows["bits"]]
    labels, names = rows["label"].tolist(), sorted(set(rows["label"]))
    marks = [s for k, s in enumerate(sets) if labels[:k].count(labels[k]) < 32]
    kernel = np.array([[plain_kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(kernel)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    feats = np.array([[plain_kernel(a, b) for b in marks] for a in sets]) @ root
    weight = np.array([len(sets) / len(names) / labels.count(x) for x in labels])
    for k, name in enumerate(names):
        target = np.array([1.0 if x == name else -1.0 for x in labels])
        centre, level = np.average(feats, axis=0, weights=weight), np.average(target, weights=weight)
        f = feats - centre
        solved = np.linalg.solve(f.T @ np.diag(weight) @ f + langid.RIDGE * np.eye(f.shape[1]), f.T @ (weight * (target - level)))
        for text in [texts[0][1], texts[7][1], "ein Haus und the dog"]:
            row = np.array([plain_kernel(slots(text), m) for m in marks]) @ root
            own = np.zeros(langid.WIDTH, dtype=np.uint8)
            langid.mark(text, own)
            got = (own.astype(np.float32) @ model.weights[:, k]) / math.sqrt(own.sum()) + model.offsets[k]
            assert got == pytest.approx(level + (row - centre) @ solved, abs=2e-3)


def test_lines_of_the_fit_are_neighbours(spark, monkeypatch):
    text = "\n".join(f"line {'x' * k}" for k in range(400))
    table = spark.createDataFrame([(1, text), (2, "a\nb")], "doc_id bigint, text string")
    marks = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    sizes = [s for _, s, label in quality._samples(table, marks, "text", "quality", "doc_id") if label == 1][0]
    assert len(sizes) == quality.FIT_LINES and set(np.diff(sizes).tolist()) == {1.0}


def test_a_licence_behind_a_wording_on_one_line():
    tool, line = licenses.templates(licenses.LEAST), " ".join(licenses._MIT.split())
    assert [name for name, *_ in tool.scan(line)] == ["MIT"]
    for text in (f"{line} Released under GPLv3.", f"{line}\nReleased under GPLv3.", f"Released under GPLv3. {line}"):
        found = {name for name, *_ in tool.scan(text)}
        assert "MIT" in found and any(name.startswith("GPL-3") for name in found) and len(found) == 2


def test_language_fit_unpacks_few_rows_at_a_time(monkeypatch):
    """The driver holds the packed presence of all learned texts, never all of it as numbers."""
    import tracemalloc

    import pandas as pd

    rng = np.random.default_rng(3)
    rows = [("en" if k % 2 else "es", k, np.packbits(rng.random(langid.WIDTH) < (0.02 if k % 2 else 0.04)).tobytes()) for k in range(1200)]
    table = pd.DataFrame(rows, columns=["label", "place", "bits"]).sort_values(["label", "place"], ignore_index=True)
    monkeypatch.setattr(langid, "_samples", lambda *_: table)
    tracemalloc.start()
    try:
        model = langid.fit(None)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.languages == ("en", "es") and np.isfinite(model.weights).all()
    assert peak < langid.WIDTH * 1200 * 4
