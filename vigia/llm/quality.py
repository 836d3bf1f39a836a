"""Document quality by a linear-chain conditional random field over lines.

Each line of a text is good or bad.  A line's features are shape counts (letters, capitals, digits, symbols, word
repetition and the like), those of the line before and after it, and differences to them; the chain adds weights for
each pair of neighbouring labels and for the first label.  Forward-backward gives the marginal of each line, and a
document's score is their mean weighted by line length, put on the scale of labels by a logistic curve.

The field is fitted by maximum likelihood on the lines of a bounded number of labelled documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import annotate, codes, free_name

#: Labelled documents of each label that the field is fitted on.
FIT_PER_LABEL = 1500
#: A document with more lines enters the fit with this many of them, spread evenly; scores always use every line.
FIT_LINES = 200
ROUNDS = 80
RATE = 0.08
PENALTY = 1e-3
#: Lines whose chains are run at the same time.
BLOCK_LINES = 50_000

SHAPES = 16

#: Character classes.
_SPACE, _LOWER, _UPPER, _DIGIT, _STOP, _BAR, _MARK, _OTHER = range(8)
_CLASS: list[np.ndarray] = []


def _classes() -> np.ndarray:
    if not _CLASS:
        table = np.full(0x110000, _OTHER, dtype=np.uint8)
        for point in range(0x110000):
            letter = chr(point)
            if letter.isspace():
                table[point] = _SPACE
            elif letter.isalpha():
                table[point] = _UPPER if letter.isupper() else _LOWER
            elif letter.isnumeric():
                table[point] = _DIGIT
            elif letter in ".,;:'\"?()-":
                table[point] = _STOP
            elif letter in "|<>{}[]/\\=_":
                table[point] = _BAR
            elif letter in "!#$%&*+@^~`":
                table[point] = _MARK
        _CLASS.append(table)
    return _CLASS[0]


def shapes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Shape features of each line (lines x ``SHAPES``) and the lines' lengths; blank lines are left out."""
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    if not lines:
        return np.zeros((0, SHAPES), dtype=np.float32), np.zeros(0)
    size = np.array([len(line) for line in lines])
    kind = _classes()[codes("".join(lines))]
    starts = np.cumsum(size) - size
    one_hot = np.stack([np.add.reduceat(kind == c, starts, dtype=np.int64) for c in range(8)], axis=1).astype(np.float32)
    space, lower, upper, digit, stop, bar, mark, other = one_hot.T
    letters = lower + upper
    ink = np.maximum(size - space, 1.0)
    words = [line.split() for line in lines]
    count = np.array([len(w) for w in words], dtype=np.float32)
    distinct = np.array([len(set(w)) for w in words], dtype=np.float32)
    repeats = np.array([sum(map(str.__eq__, w, w[1:])) for w in words], dtype=np.float32)
    ends = np.array([line.rstrip()[-1] in ".!?\"'" for line in lines], dtype=np.float32)
    seen: set[str] = set()
    again = np.zeros(len(lines), dtype=np.float32)
    for i, line in enumerate(lines):
        again[i] = line in seen
        seen.add(line)
    many = np.maximum(count, 1.0)
    found = np.stack([
        upper / np.maximum(letters, 1.0), digit / ink, stop / ink, np.minimum(bar / ink * 4, 1.0), np.minimum(mark / ink * 4, 1.0),
        other / ink, letters / ink, space / size, repeats / many, 1.0 - distinct / many, np.minimum(np.log1p(count) / 5, 2.0),
        np.minimum(ink / many / 10, 2.0), ends, again, (mark / many > 0.5).astype(np.float32), (bar / many > 0.4).astype(np.float32),
    ], axis=1)
    return found.astype(np.float32), size.astype(np.float64)


def with_neighbours(found: np.ndarray) -> np.ndarray:
    """Own shapes, those of the line before and the line after (a line's own at the ends), a constant."""
    before = np.concatenate([found[:1], found[:-1]])
    after = np.concatenate([found[1:], found[-1:]])
    return np.concatenate([found, before, after, np.ones((len(found), 1), dtype=np.float32)], axis=1)


WIDTH = 3 * SHAPES + 1


def _chains(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lays chains out as (longest, chains): positions of the lines, and a mask."""
    starts = np.cumsum(lengths) - lengths
    step = np.arange(lengths.max())[:, None]
    mask = step < lengths
    return np.where(mask, starts + np.minimum(step, lengths - 1), 0), mask


def marginals(unary: np.ndarray, lengths: np.ndarray, pair: np.ndarray, first: float) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each line is good, and for each chain the expected number of each pair of neighbouring labels.

    ``unary`` is each line's score for good against bad; ``lengths`` the lines of each chain, none empty.
    ``pair[a, b]`` weighs label ``a`` followed by ``b`` (0 bad, 1 good).
    """
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    index, mask = _chains(lengths)
    index, mask = index[:, order], mask[:, order]
    steps = len(index)
    alive = [int(n) for n in mask.sum(axis=1)]
    score = unary[index]
    forward = np.zeros((steps, len(sizes), 2))
    forward[0, :, 1] = score[0] + first
    for t in range(1, steps):
        n = alive[t]
        past = forward[t - 1, :n]
        forward[t, :n] = np.logaddexp(past[:, :1] + pair[0], past[:, 1:] + pair[1])
        forward[t, :n, 1] += score[t, :n]
    backward = np.zeros_like(forward)
    for t in range(steps - 2, -1, -1):
        n = alive[t + 1]
        ahead = backward[t + 1, :n].copy()
        ahead[:, 1] += score[t + 1, :n]
        backward[t, :n] = np.logaddexp(ahead[:, :1] + pair[:, 0], ahead[:, 1:] + pair[:, 1])
    both = forward + backward
    good = 1.0 / (1.0 + np.exp(np.clip(both[..., 0] - both[..., 1], -500, 500)))
    out = np.zeros(len(unary))
    out[index[mask]] = good[mask]
    expected = np.zeros((len(sizes), 2, 2))
    if steps > 1:
        total = np.logaddexp(both[0, :, 0], both[0, :, 1])
        for a in (0, 1):
            for b in (0, 1):
                log = forward[:-1, :, a] + pair[a, b] + (score[1:] if b else 0.0) + backward[1:, :, b] - total
                expected[order, a, b] = np.exp(np.where(mask[1:], log, -np.inf)).sum(axis=0)
    return out, expected


def _blocks(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of chains, few enough for ``BLOCK_LINES`` cells of the longest; a longer chain is a run of its own."""
    start, longest = 0, 0
    for i, n in enumerate(lengths):
        longest = max(longest, n)
        if i > start and longest * (i - start + 1) > BLOCK_LINES:
            yield start, i
            start, longest = i, n
    if start < len(lengths):
        yield start, len(lengths)


def all_marginals(unary: np.ndarray, lengths: np.ndarray, pair: np.ndarray, first: float) -> tuple[np.ndarray, np.ndarray]:
    """``marginals`` block by block, in order of length so that blocks waste little."""
    order = np.argsort(lengths, kind="stable")
    starts = np.cumsum(lengths) - lengths
    out, expected = np.zeros(len(unary)), np.zeros((len(lengths), 2, 2))
    for a, b in _blocks(lengths[order]):
        some = order[a:b]
        lines = np.concatenate([np.arange(starts[k], starts[k] + lengths[k]) for k in some])
        out[lines], expected[some] = marginals(unary[lines], lengths[some], pair, first)
    return out, expected


@dataclass(frozen=True)
class Field:
    weights: np.ndarray
    pair: np.ndarray
    first: float
    #: Logistic curve from the length-weighted share of good lines to the label.
    slope: float = 1.0
    offset: float = 0.0
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    #: Score of a text without a line.
    empty: float = 0.0

    def shares(self, features: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Length-weighted share of good lines of each document."""
        good, _ = all_marginals(((features - self.mean) / self.scale) @ self.weights, lengths, self.pair, self.first)
        starts = np.cumsum(lengths) - lengths
        return np.add.reduceat(good * sizes, starts) / np.add.reduceat(sizes, starts)

    def score(self, texts: list[str | None]) -> np.ndarray:
        found = [shapes(t or "") for t in texts]
        lengths = np.array([len(size) for _, size in found])
        scores = np.full(len(texts), self.empty)
        full = lengths > 0
        if full.any():
            share = self.shares(np.concatenate([with_neighbours(f) for f, s in found if len(s)]),
                                np.concatenate([s for _, s in found if len(s)]), lengths[full])
            scores[full] = 1.0 / (1.0 + np.exp(-np.clip(self.slope * share + self.offset, -500, 500)))
        return scores


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a one-variable logistic regression, lightly penalised; Newton's method."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.array([4.0, -2.0])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 1e-2 * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        move = np.linalg.solve(curve, gradient)
        beta = beta + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def fit_field(documents: list[tuple[np.ndarray, np.ndarray, int]]) -> Field | None:
    """The field of (shapes, line lengths, label) of documents with lines; None unless both labels occur.

    Lines take the label of their document.  Both labels weigh the same; each document weighs one, so that long
    documents don't drown short ones.
    """
    labels = np.array([label for *_, label in documents])
    if len(set(labels.tolist())) < 2:
        return None
    lengths = np.array([len(size) for _, size, _ in documents])
    features = np.concatenate([with_neighbours(f) for f, *_ in documents]).astype(np.float64)
    mean, scale = features.mean(0), features.std(0) + 1e-3
    mean[-1], scale[-1] = 0.0, 1.0
    x = (features - mean) / scale
    share = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    weight = share / np.sqrt(lengths)
    per_line, heads = np.repeat(weight, lengths), np.cumsum(lengths) - lengths
    target = np.repeat(labels, lengths)
    seen = np.zeros((len(labels), 2, 2))
    seen[np.arange(len(labels)), labels, labels] = lengths - 1
    weights, pair, first = np.zeros(WIDTH), np.zeros((2, 2)), 0.0
    moments = [np.zeros(WIDTH + 5), np.zeros(WIDTH + 5)]
    for step in range(1, ROUNDS + 1):
        good, expected = all_marginals(x @ weights, lengths, pair, first)
        gradient = -PENALTY * np.concatenate([weights, pair.ravel(), [first]])
        gradient[:WIDTH] += x.T @ (per_line * (target - good))
        gradient[WIDTH:-1] += ((seen - expected) * weight[:, None, None]).sum(axis=0).ravel()
        gradient[-1] += (weight * (labels - good[heads])).sum()
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
        move = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights, pair, first = weights + move[:WIDTH], pair + move[WIDTH:-1].reshape(2, 2), first + move[-1]
    field = Field(weights, pair, float(first), mean=mean, scale=scale)
    sizes = np.concatenate([s for _, s, _ in documents])
    slope, offset = _logistic(field.shares(features, sizes, lengths), labels.astype(float), share * len(labels))
    return Field(weights, pair, float(first), slope, offset, mean, scale)


def _samples(df: DataFrame, labels: DataFrame, text: str, label: str, order: str) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Line shapes of a bounded number of labelled documents, chosen by a hash of their id; no text reaches the driver."""
    ids = labels.where(F.col(label).isin(0, 1) & F.col(order).isNotNull()).select(
        F.col(order).alias("id"), F.col(label).cast("int").alias("label"), F.xxhash64(F.col(order).cast("string"), F.lit(11)).alias("place"))
    chosen = [ids.where(F.col("label") == k).orderBy("place", "id").limit(FIT_PER_LABEL) for k in (0, 1)]
    both = chosen[0].unionByName(chosen[1]).groupBy("id").agg(F.min("label").alias("picked_label"), F.min("place").alias("place"))
    # At most 2 * FIT_PER_LABEL ids.
    picked = df.select(F.col(order).alias("id"), F.col(text).alias("text")).join(F.broadcast(both), "id").drop("id")

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text in frame["text"]:
                found, size = shapes(text or "")
                if len(size) > FIT_LINES:
                    # Lines that follow each other, so that neighbours are neighbours; where they begin depends on the text only.
                    first = zlib.crc32((text or "").encode("utf-8", "replace")) % (len(size) - FIT_LINES + 1)
                    found, size = found[first:first + FIT_LINES], size[first:first + FIT_LINES]
                out.append(np.concatenate([found, size[:, None].astype(np.float32)], axis=1).astype("<f4").tobytes())
            yield pd.DataFrame({"label": frame["picked_label"], "place": frame["place"], "cells": out})

    # One row for each chosen id, even if a table repeats it.
    rows = picked.mapInPandas(lines, "label int, place bigint, cells binary").groupBy("place", "label").agg(
        F.min("cells").alias("cells")).orderBy("place", "label").collect()
    out = []
    for row in rows:
        cells = np.frombuffer(row["cells"], dtype="<f4").reshape(-1, SHAPES + 1)
        if len(cells):
            out.append((cells[:, :-1], cells[:, -1].astype(np.float64), row["label"]))
    return out


def fit(df: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", order: str = "doc_id") -> Field | None:
    """The field of the texts of ``df`` that ``labels`` marks 0 or 1 under the same ``order``; None unless both occur.

    Fitted on at most ``FIT_PER_LABEL`` documents of each label.
    """
    return fit_field(_samples(df, labels, text, label, order))


def score_quality(df: DataFrame, field: Field | None, text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with the quality of every whole text from 0 to 1, 1 for good.

    A NULL text counts as empty.  Empty texts and texts of blank lines score 0; if nothing was learned, all texts score
    0.5.  Repeated rows get the same score; an empty table gives no rows.  A column named like the new one is
    replaced, all others kept.
    """
    held = df.sparkSession.sparkContext.broadcast(field)

    def make():
        known = held.value
        return lambda texts: {score: known.score(texts) if known else np.full(len(texts), 0.5)}

    return annotate(df, text, make, {score: "double"})


def keep_good(df: DataFrame, field: Field | None, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``df``, unchanged, whose text scores ``least`` or more."""
    score = free_name(df, "quality_score")
    return score_quality(df, field, text, score).where(F.col(score) >= least).drop(score)
