"""The corpus pipeline stage by stage."""

import corpus_pipeline
from tests.llm.test_similar import smallest_ids
from vigia.llm.queries import QUERIES


def test_stages_keep_what_their_operators_decide(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = set(rows)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "quality", "near_duplicates", "benchmark_leaks", "tokens"]

    def step(name):
        nonlocal docs
        docs = stages[name](spark, docs, small)
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        return {r["doc_id"] for r in docs.select("doc_id").collect()}

    languages = {r["doc_id"]: r["lang_pred"] for r in QUERIES["op2_language"](spark, small).collect()}
    kept &= {i for i, v in languages.items() if v != "und"}
    assert step("language") == kept and docs.columns == columns
    good = {r["doc_id"] for r in QUERIES["op4_quality"](spark, small).where("predicted = 1").collect()}
    kept &= good
    assert step("quality") == kept and docs.columns == columns
    kept = set(smallest_ids({i: rows[i] for i in kept}).values())
    assert step("near_duplicates") == kept and docs.columns == columns
    kept -= {r["doc_id"] for r in QUERIES["op3_decontaminate"](spark, small).collect()}
    assert step("benchmark_leaks") == kept and docs.columns == columns
    assert step("tokens") == kept
    found = {tuple(r) for r in docs.collect()}
    tokens = {tuple(r) for r in QUERIES["op10_bpe"](spark, small).collect() if r["doc_id"] in kept}
    assert found == tokens == {tuple(r) for r in corpus_pipeline.run(spark, small).collect()}
