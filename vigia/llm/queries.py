"""The registered queries of the operators, over whole tables and with production parameters."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigia.llm import decontaminate, htmltext, langid, licenses, merkle, neighbours, quality, runs, simhash, toxicity, warc
from vigia.llm.bpe import encode_documents
from vigia.llm.common import held_out, may_learn, table
from vigia.llm.oracle import ORACLE as ORACLE
from vigia.llm.urlfilter import Rule, judge

VOCABULARY = "byte_bpe_50k.json"


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as it is read back from its archive."""
    records = warc.round_trip(table(spark, folder, "pages"))
    number = lambda urn: F.regexp_extract(urn, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")
    revisit = F.col("type") == "revisit"
    return records.select(
        number("id").alias("page_id"), F.when(revisit, F.col("said_bytes")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.substring_index("said_digest", ":", -1)).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(revisit, number("refers")).alias("refers_to"))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    """The predicted language of every document; learned from two thirds of them."""
    documents = table(spark, folder, "documents")
    model = langid.fit(documents.where(may_learn("doc_id")))
    return langid.identify(documents.select("doc_id", "text", held_out("doc_id").alias("held_out")), model).drop("text")


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Each document and benchmark item that it holds, and the share of the item's words found in order."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(documents, table(spark, folder, "benchmark"))
    pairs = found.select("doc_id", F.explode(F.arrays_zip("leaked_items", "leaked_shares")).alias("leak"))
    return pairs.select("doc_id", F.col("leak.leaked_items").cast("bigint").alias("item_id"), F.col("leak.leaked_shares").alias("share"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality of every document; learned from two thirds of the labels."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.score_quality(documents.withColumn("held_out", held_out("doc_id")), learned_quality(spark, folder)).drop("text")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def learned_quality(spark: SparkSession, folder: str) -> quality.Field | None:
    labels = table(spark, folder, "labels").where(may_learn("doc_id") & F.col("quality").isNotNull())
    # A document that is labelled twice with different marks counts as bad.
    labels = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return quality.fit(table(spark, folder, "documents").select("doc_id", "text"), labels)


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Each document and licence that it holds, with the closest part."""
    found = licenses.scan_licenses(table(spark, folder, "documents").select("doc_id", "text"))
    hit = F.explode(F.arrays_zip("licenses", "license_scores", "license_parts")).alias("hit")
    return found.where(F.size("licenses") > 0).select("doc_id", hit).select(
        "doc_id", F.col("hit.licenses").alias("license"), F.col("hit.license_scores").alias("dice"), F.col("hit.license_parts").alias("part"))


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return htmltext.extract(table(spark, folder, "pages").select("page_id", "url", "html"), keep_html=False)


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.as_hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    vectors = table(spark, folder, "embeddings")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 50 == 0))


#: The rules that URLs are judged by.
URL_RULES = [Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow")]


def op9_urls(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's URL."""
    return judge(table(spark, folder, "pages").select("page_id", "url"), URL_RULES)


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return encode_documents(documents, public_tokenizers.path(VOCABULARY), digests=True).drop("text")


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document; learned from three quarters of the labels."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    remains = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    labels = table(spark, folder, "labels").where(F.col("doc_id").isNotNull() & ~remains & F.col("toxic").isNotNull())
    scored = toxicity.score_toxicity(documents.withColumn("held_out", remains), toxicity.fit(documents, labels)).drop("text")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, proof and verification of every document; every third one is tampered with."""
    documents = table(spark, folder, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf(*fields[:-1], lower))
    return merkle.manifest(documents, merkle.leaf(*fields), tampered)


def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The periodic runs of every document; the tail of every tenth one is made periodic first."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    number = F.crc32(F.col("doc_id").cast("string"))
    # Words of those texts only whose tail changes.
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = documents.withColumn("number", number).withColumn("words", F.when(F.col("number") % 10 == 0, words))
    g, n = F.floor(F.col("number") / 10), F.size("words")
    cut = cut.withColumn("a", F.when(n > 0, g % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    tail = F.transform(F.sequence(F.lit(0), n - F.col("a") - 1), lambda i: F.get("words", (F.col("a") + i % F.col("p")).cast("int")))
    planted = F.concat_ws(" ", F.slice("words", F.lit(1), F.col("a").cast("int")), tail)
    texts = cut.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))
    return runs.annotate_runs(texts).drop("text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_language": op2_language,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality": op4_quality,
    "op5_licenses": op5_licenses,
    "op6_main_text": op6_main_text,
    "op7_simhash": op7_simhash,
    "op8_neighbours": op8_neighbours,
    "op9_urls": op9_urls,
    "op10_bpe": op10_bpe,
    "op11_toxicity": op11_toxicity,
    "op12_merkle": op12_merkle,
    "op13_runs": op13_runs,
}
