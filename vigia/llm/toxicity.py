"""Toxicity by logistic regression, trained with FTRL-proximal over hashed word n-grams and skip-grams.

A text is the set of its hashed features: words, beginnings of longer words (inflected forms share one), pairs of neighbouring words, and pairs with one or
two words left out between them.  Training looks at one document at a time: each feature has its own learning rate, which falls
with the squared gradients the feature has seen, and its weight stays exactly zero until its summed gradients leave the L1
threshold.  What is left are a few thousand weights, which are broadcast; scoring is a look-up of the features of each text where the
text is, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import annotate, slices
from vigia.llm.words import split_words

#: Longer words are features by their first letters, too.
BEGINNINGS = (4, 6)
#: Places between the two words of a pair: neighbours, and skip-grams.
DISTANCES = (1, 2, 3)
#: The model learns from so many documents of each label (0, 1) at most, of so many characters at most.
FIT_CLEAN, FIT_TOXIC, FIT_CHARS = 3_000, 1_500, 30_000
#: Features of fewer documents of the fit are not learned.
LEAST_DOCUMENTS = 2
#: Passes over the documents of the fit, and the constants of FTRL-proximal: learning rate, its smoothing, L1 and L2 penalties.
EPOCHS = 8
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.1
#: High bits of a slot that the first look-up goes by.
SIEVE = 20
_KINDS = np.random.default_rng(2_013).integers(1, 1 << 63, size=1 + len(BEGINNINGS) + max(DISTANCES), dtype=np.uint64) | np.uint64(1)


def features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, number of the text) of all features of the texts, a kind at a time; a feature that is met twice is given twice."""
    plain = pc.replace_substring_regex(pc.utf8_lower(pa.array(texts, pa.large_string())), r"[^\pL\pN]+", " ")
    words = split_words(plain)
    text = np.repeat(np.arange(len(texts)), np.diff(words.starts))
    known = words.known.to_pylist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w) for w in known), dtype=np.uint64, count=len(known))
    own = hashes[words.number]
    yield _slots(own * _KINDS[0]), text
    for k, size in enumerate(BEGINNINGS, 1):
        begin = np.fromiter((digest(w[:size]) if len(w) > size else 0 for w in known), dtype=np.uint64, count=len(known))[words.number]
        longer = begin != 0
        yield _slots(begin[longer] * _KINDS[k]), text[longer]
    for d in DISTANCES:
        same = text[d:] == text[:-d]
        yield _slots((own[:-d][same] * _KINDS[0]) ^ (own[d:][same] * _KINDS[len(BEGINNINGS) + d])), text[d:][same]


def _slots(mixed: np.ndarray) -> np.ndarray:
    mixed = mixed * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)


@dataclass(frozen=True)
class Weights:
    """Slots in order with their weights, all others weigh nothing; and the weight that every text has."""

    slots: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of label 1 for each text."""
        margin = np.full(len(texts), self.bias)
        if len(self.slots):
            sieve = np.zeros(1 << SIEVE, dtype=bool)
            sieve[self.slots >> (32 - SIEVE)] = True
            found = [np.zeros(0, dtype=np.uint64)]
            for slots, text in features(texts):
                at = np.flatnonzero(sieve[slots >> (32 - SIEVE)])
                place = np.minimum(np.searchsorted(self.slots, slots[at]), len(self.slots) - 1)
                hit = self.slots[place] == slots[at]
                found.append(text[at[hit]].astype(np.uint64) << np.uint64(32) | place[hit].astype(np.uint64))
            # A feature counts once for a text.
            pairs = np.unique(np.concatenate(found))
            margin += np.bincount((pairs >> np.uint64(32)).astype(np.int64), self.weights[(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)],
                                  minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


def train(documents: list[np.ndarray], labels: np.ndarray) -> Weights:
    """FTRL-proximal over documents (sets of slots) in the given order; the bias has no L1 penalty."""
    if not len(documents):
        return Weights()
    every = np.concatenate([np.zeros(0, dtype=np.uint32), *documents])
    slots, counts = np.unique(every, return_counts=True)
    slots = slots[counts >= LEAST_DOCUMENTS]
    # The last place is that of the bias.
    rows = []
    for own in documents:
        at = np.minimum(np.searchsorted(slots, own), max(len(slots) - 1, 0))
        rows.append(np.append(at[slots[at] == own] if len(slots) else np.zeros(0, dtype=np.int64), len(slots)))
    sums, squares = np.zeros(len(slots) + 1), np.zeros(len(slots) + 1)
    threshold = np.append(np.full(len(slots), L1), 0.0)

    def weights(at):
        z = sums[at]
        return -np.sign(z) * np.maximum(np.abs(z) - threshold[at], 0.0) / ((BETA + np.sqrt(squares[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for at, label in zip(rows, labels, strict=True):
            now = weights(at)
            gradient = 1.0 / (1.0 + np.exp(-np.clip(now.sum(), -35.0, 35.0))) - label
            grown = squares[at] + gradient * gradient
            sums[at] += gradient - (np.sqrt(grown) - np.sqrt(squares[at])) / ALPHA * now
            squares[at] = grown
    final = weights(slice(None))
    held = np.flatnonzero(final[:-1])
    return Weights(slots[held], final[held], float(final[-1]))


def fit(df: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", id: str = "doc_id") -> Weights | None:
    """Weights learned from the texts of ``df`` that ``labels`` marks 0 or 1 under the same ``id``; None without any.

    A bounded number of documents is learned from, chosen by a hash of their ids: ``FIT_CLEAN`` and ``FIT_TOXIC`` at most, none
    longer than ``FIT_CHARS``.  An id that is marked both ways counts as 1; of rows that share an id one is learned from.  Only the weights reach the driver.
    """
    marks = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(
        F.max(label).cast("int").alias("label"))
    marks = marks.withColumn("place", F.xxhash64(F.col("id").cast("string"), F.lit(11)))
    learned = df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).where(F.length("text") <= FIT_CHARS)
    chosen = [marks.where(F.col("label") == k).orderBy("place", "id").limit(n) for k, n in ((0, FIT_CLEAN), (1, FIT_TOXIC))]
    # At most FIT_CLEAN + FIT_TOXIC rows.
    picked = learned.join(F.broadcast(chosen[0].unionByName(chosen[1])), "id").select("label", "place", "id", "text")

    def as_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            for part in slices(texts):
                pairs = np.unique(np.concatenate([t.astype(np.uint64) << np.uint64(32) | s.astype(np.uint64) for s, t in features(texts[part])]))
                ends = np.searchsorted(pairs >> np.uint64(32), np.arange(len(texts[part])), side="right")
                own = np.split((pairs & np.uint64(0xFFFFFFFF)).astype("<u4"), ends[:-1])
                yield frame.iloc[part][["label", "place", "id"]].assign(slots=[o.tobytes() for o in own])

    schema = f"label int, place bigint, id {learned.schema['id'].dataType.simpleString()}, slots binary"
    sets = picked.mapInPandas(as_sets, schema).groupBy("id").agg(F.min("label").alias("label"), F.min("place").alias("place"), F.min("slots").alias("slots"))

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["place", "id"])
        made = train([np.frombuffer(s, dtype="<u4") for s in frame["slots"]], frame["label"].to_numpy())
        return pd.DataFrame({"slot": [*made.slots.tolist(), -1], "weight": [*made.weights.tolist(), made.bias]})

    # One group of bounded size: FTRL goes through its documents in order.
    rows = sets.withColumn("group", F.lit(0)).groupBy("group").applyInPandas(learn, "slot bigint, weight double").orderBy("slot").toPandas()
    if not len(rows):
        return None
    return Weights(rows["slot"].to_numpy()[1:].astype(np.uint32), rows["weight"].to_numpy()[1:], float(rows["weight"].iloc[0]))


def score_toxicity(df: DataFrame, weights: Weights | None, text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with the probability from 0 to 1 that the whole text of a row is toxic.

    NULL counts as empty; texts without a word get the score of the bias alone, and if nothing was learned all texts score 0.5.  Very long
    texts are features of one text all the same, mapped in a slice of their own.  Repeated rows get equal scores, and an empty table gives no rows.
    A column named like the new one is replaced, all others kept.
    """
    held = df.sparkSession.sparkContext.broadcast(weights)

    def make():
        known = held.value
        return lambda texts: {score: known.score(texts) if known else np.full(len(texts), 0.5)}

    return annotate(df, text, make, {score: "double"})
