"""Language identification by string kernels.

A text is the set of its character n-grams of all sizes from ``MIN_GRAM`` to ``MAX_GRAM`` (a blended
spectrum; presence and not counts).  The kernel of two texts is the number of n-grams they share over the
geometric mean of their own numbers.  A bounded number of landmark texts spans the Nyström space; a kernel
ridge regression against each language is fitted there.  The kernel against the landmarks is linear in the
presence vector, so that the fitted model is one matrix from n-gram slots to languages, and a batch of texts
is scored by one matrix product.

N-grams are addressed by hash slots; the slots of a text are marked piece by piece, so that memory does not
grow with the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigia.llm.common import annotate, codes, free_name

MIN_GRAM, MAX_GRAM = 2, 4
#: Hash slots of each n-gram size (powers of two).
SLOTS = {2: 1 << 11, 3: 1 << 13, 4: 1 << 14}
#: Labelled texts of each language that the model is fitted on, at most, and in all languages together (one of each at least); and how
#: many of these are landmarks.
FIT_PER_LANGUAGE = 600
FIT_IN_ALL = 3000
LANDMARKS_PER_LANGUAGE = 32
LANDMARKS_IN_ALL = 2048
#: Presence rows of learned texts unpacked at a time.
FIT_ROWS = 480
RIDGE = 0.1
#: Characters marked at a time.
PIECE = 1 << 20
#: Presence rows multiplied at a time.
ROWS = 64
UNDETERMINED = "und"
#: Texts of fewer n-grams (slots) are too short for their margin to tell that their language was never learned; that of others has to be
#: so much above the margin of a text of which nothing is known.
EVIDENCE = 300
LIFT = 0.15

WIDTH = sum(SLOTS.values())
FIRST = {size: sum(SLOTS[k] for k in range(MIN_GRAM, size)) for size in SLOTS}


def letter_classes() -> np.ndarray:
    """For each code point its lower-case code point if it is a letter, a blank if not."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            low = letter.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


_TABLE: list[np.ndarray] = []


def folded(text: str) -> np.ndarray:
    """Lower-case letters with single blanks between words."""
    if not _TABLE:
        _TABLE.append(letter_classes())
    points = _TABLE[0][codes(text)]
    blank = points == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[:1] = True
    return points[keep]


def mark(text: str | None, row: np.ndarray) -> bool:
    """Marks the n-grams of the whole text in ``row``; False if it has no letter."""
    found = False
    carry = np.array([32], dtype=np.uint32)
    for start in range(0, len(text or ""), PIECE):
        fresh = folded(text[start:start + PIECE])
        if len(fresh) and fresh[0] == 32 and carry[-1] == 32:
            fresh = fresh[1:]
        points = np.concatenate([carry, fresh])
        if start + PIECE >= len(text) and points[-1] != 32:
            points = np.append(points, np.uint32(32))
        found = found or bool((points != 32).any())
        for size in range(MIN_GRAM, MAX_GRAM + 1):
            count = len(points) - size + 1
            if count < 1:
                continue
            slot = points[:count] * np.uint32(0x9E3779B1)
            for k in range(1, size):
                slot = (slot ^ points[k:count + k]) * np.uint32(0x85EBCA6B)
                slot ^= slot >> np.uint32(15)
            row[(slot & np.uint32(SLOTS[size] - 1)) + np.uint32(FIRST[size])] = 1
        carry = points[-(MAX_GRAM - 1):]
    return found


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: n-gram slots x languages.
    weights: np.ndarray
    offsets: np.ndarray

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, its share (softmax of the regressions) and its margin (the regression itself, 1 for its own and -1 for others; infinite for
        texts too short to tell) for each text."""
        names, shares, margins = [], [], []
        for start in range(0, len(texts), ROWS):
            part = texts[start:start + ROWS]
            rows = np.zeros((len(part), WIDTH), dtype=np.uint8)
            letters = np.array([mark(t, rows[i]) for i, t in enumerate(part)])
            present = rows.astype(np.float32)
            own = np.sqrt(np.maximum(present.sum(axis=1), 1.0))
            values = (present @ self.weights) / own[:, None] + self.offsets
            odds = np.exp(4.0 * (values - values.max(axis=1, keepdims=True)))
            odds /= odds.sum(axis=1, keepdims=True)
            best = values.argmax(axis=1)
            for i, k in enumerate(best):
                names.append(self.languages[k] if letters[i] else UNDETERMINED)
                shares.append(float(odds[i, k]) if letters[i] else 0.0)
                margins.append(float(values[i, k]) if own[i]**2 >= EVIDENCE else np.inf)
        return names, shares, margins


def _samples(df: DataFrame, text: str, label: str, order: str) -> pd.DataFrame:
    """For a bounded number of labelled texts the packed presence rows; chosen by a hash of ``order``."""
    labelled = df.where(F.col(label).isNotNull() & F.col(text).isNotNull() & F.col(order).isNotNull())
    languages = labelled.select(label).distinct().count()
    if not languages:
        return pd.DataFrame({"label": [], "bits": []})
    each = max(1, min(FIT_PER_LANGUAGE, FIT_IN_ALL // languages))
    # An id with several languages is one of the first of them.
    some = labelled.groupBy(F.col(order).alias("id")).agg(F.min(label).alias("label")).withColumn("place", F.xxhash64(F.col("id").cast("string"), F.lit(7)))
    # The rank limit works within each task first, so that a language with most rows is cut before its rows meet.
    best = Window.partitionBy("label").orderBy("place", "id")
    chosen = some.withColumn("n", F.row_number().over(best)).where(F.col("n") <= each).drop("n")
    # So many ids for each language: a bounded table, whose texts are picked up where they are.
    picked = df.join(F.broadcast(chosen.select(F.col("id").alias(order), F.col("label").alias("picked_label"), "place")), order).select(
        F.col("picked_label").alias("label"), "place", F.col(text).alias("text"))

    def presence(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bits, letters = [], []
            for text in frame["text"]:
                row = np.zeros(WIDTH, dtype=np.uint8)
                letters.append(mark(text, row))
                bits.append(np.packbits(row).tobytes())
            yield pd.DataFrame({"label": frame["label"], "place": frame["place"], "bits": bits})[np.array(letters, dtype=bool)]

    # One row for each chosen id, even if a table repeats it.
    rows = picked.mapInPandas(presence, "label string, place bigint, bits binary").groupBy("label", "place").agg(
        F.min("bits").alias("bits")).toPandas()
    return rows.sort_values(["label", "place", "bits"], ignore_index=True)


def _unpacked(packed: np.ndarray) -> np.ndarray:
    """Presence rows of length one."""
    present = np.unpackbits(packed, axis=1)[:, :WIDTH].astype(np.float32)
    present /= np.sqrt(np.maximum(present.sum(axis=1), 1.0))[:, None]
    return present


def fit(df: DataFrame, text: str = "text", label: str = "lang", order: str = "doc_id") -> Model | None:
    """The model of the labelled rows of ``df``; None without any.

    Every language is learned, from at most ``FIT_PER_LANGUAGE`` texts each (fewer if that were more than ``FIT_IN_ALL`` together), of which
    ``LANDMARKS_PER_LANGUAGE`` (``LANDMARKS_IN_ALL``) are landmarks.  The driver gets their presence bits and never a text.
    """
    rows = _samples(df, text, label, order)
    if rows.empty:
        return None
    languages = tuple(sorted(rows["label"].unique()))
    packed = np.stack([np.frombuffer(b, dtype=np.uint8) for b in rows["bits"]])
    place = rows.groupby("label").cumcount().to_numpy()
    marks = _unpacked(packed[place < max(1, min(LANDMARKS_PER_LANGUAGE, LANDMARKS_IN_ALL // len(languages)))])
    # Nyström: the landmark kernel's inverse square root maps kernel rows to features.
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    # Only so many rows are unpacked at a time: whole, they are the largest table of the driver.
    kernel = np.concatenate([_unpacked(packed[k:k + FIT_ROWS]) @ marks.T for k in range(0, len(packed), FIT_ROWS)])
    features = kernel.astype(np.float64) @ root
    targets = np.stack([np.where(rows["label"].to_numpy() == lang, 1.0, -1.0) for lang in languages], axis=1)
    # Each language weighs the same, however many texts it has.
    counts = rows["label"].value_counts()
    weight = rows["label"].map(1.0 / counts).to_numpy()[:, None] * len(rows) / len(languages)
    centre, level = (features * weight).sum(0) / weight.sum(), (targets * weight).sum(0) / weight.sum()
    f, t = features - centre, targets - level
    solved = np.linalg.solve(f.T @ (weight * f) + RIDGE * np.eye(f.shape[1]), f.T @ (weight * t))
    weights = marks.T.astype(np.float64) @ (root @ solved)
    return Model(languages, weights.astype(np.float32), (level - centre @ solved).astype(np.float32))


def identify(df: DataFrame, model: Model | None, text: str = "text", language: str = "lang_pred", score: str = "score",
             margin: str | None = None) -> DataFrame:
    """``df`` with the predicted language of every whole text and a score from 0 to 1 (and the margin, if a name for it is given).

    A NULL or empty text, or one without a letter, gets ``und`` with score 0, and so does every text if nothing was
    learned; its margin is NULL then.  Of equally likely languages the first by name is told.  A very long text is marked piece by piece to its end.
    Repeated rows get the same answer; an empty table gives no rows.  Columns named like the two new ones are
    replaced, all others kept.  The model is sent to the tasks: its size is slots times learned languages.
    """
    held = df.sparkSession.sparkContext.broadcast(model)

    def make():
        known = held.value

        def work(texts):
            if known is None:
                return {language: [UNDETERMINED] * len(texts), score: [0.0] * len(texts), margin: [None] * len(texts)}
            names, shares, margins = known.score(texts)
            return {language: names, score: shares, margin: [m if n != UNDETERMINED else None for m, n in zip(margins, names, strict=True)]}

        return work

    return annotate(df, text, make, {language: "string", score: "double"} | ({margin: "double"} if margin else {}))


def keep_identified(df: DataFrame, model: Model | None, text: str = "text", lift: float = LIFT) -> DataFrame:
    """The rows of ``df``, unchanged, whose language could be told: texts that have letters, and whose margin is more by ``lift`` than that
    of a text which has no n-gram in common with any learned language.  Texts of fewer than ``EVIDENCE`` n-grams are given the benefit of the doubt."""
    language, score, margin = (free_name(df, name) for name in ("lang_pred", "lang_score", "lang_margin"))
    told = identify(df, model, text, language, score, margin)
    least = float(model.offsets.max()) + lift if model else float("-inf")
    return told.where((F.col(language) != UNDETERMINED) & (F.col(margin) >= F.lit(least))).select(*df.columns)
