"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages; a passage is its TF-IDF vector over hashed words.  One pass over the corpus sums, in
each task, the document frequencies and the passages' second moment applied to random vectors; from these sums follows the
randomised SVD, without a second look at the corpus.  A second pass maps windows of the texts and benchmark
items to the whitened latent space and takes window and item for a candidate if their cosine is high.  A candidate counts if the
longest common subsequence of the item's words and those around the window is long enough, or somewhat
shorter with the item's answer found word by word, as in a paraphrase.

Which windows and items can be near each other at all is told by an inverted file from pairs of an item's words that stand close
together to the item: where the words that such pairs find weigh less than a candidate's must, no window is mapped.  So the work
follows what the texts have in common with the benchmark and not its size.

Windows come in several lengths; an item is looked for by overlapping pieces from its first word to its last, as long as the longest
window that it fills and as the next shorter one, so that what is left of a changed item fills a window.  Sums over passages are additive, windows are scored where their text is: nothing but the sums is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import annotate, codes, free_name, slices

#: Hash slots of words, latent dimensions kept, and random vectors beyond these.
SLOTS = 1 << 13
RANK = 88
EXTRA = 8
#: Words of a passage of the SVD.
PASSAGE = 32
#: Window lengths in words; the step is a third of the length.
WINDOWS = (3, 6, 12, 24, 48)
#: Blank words after each text, so that no window holds two texts, and what the places of texts are multiples of.
GAP, ALIGN = 32, 16
COSINE = 0.5
#: Share of an item's inverse document frequencies that a candidate's words must have.
WEIGHT = 0.3
#: Share of an item's words in the common subsequence: enough alone, and enough with the answer found.
COPY, PARAPHRASE = 0.7, 0.5
#: Shorter items must be found whole.
SHORT = 8
#: Characters of the benchmark items of one pass, about; a larger benchmark takes several.
PASS_CHARS = 1_000_000
#: Pairs of words of an item at most so far apart make up the inverted file, if their inverse document frequencies sum up to so much;
#: and for each word the heaviest of its pairs, whatever it weighs.
REACH = 3
PAIR_WEIGHT = 8.0
#: Words that a changed item may be shifted by in a text, half its length and so many at least.
LEAST_BIN = 12
#: High bits of a pair that the first look-up goes by.
SIEVE = 22
#: Words mapped at a time, and characters of texts whose words are hashed together.
PIECE = 16_384
CHARS = 100_000
#: Slots summed by matrix product.
FREQUENT = 128
#: Slots whose sums travel as one row.
ROW = 128

WIDTH = RANK + EXTRA
_WORD = re.compile(r"\w+")
_FOLD: list[np.ndarray] = []


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


#: Words are hashed as polynomials in ``_BASE`` modulo 2^32, taken from running sums over the text.
_BASE = 0x5BD1E995
_POWERS: list[np.ndarray] = []


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE`` to the power of 0, 1, ... and to 0, -1, ..., modulo 2^32."""
    if not _POWERS or len(_POWERS[0]) < count:
        size = 1 << max(18, int(count - 1).bit_length())
        _POWERS[:] = [np.concatenate([[np.uint32(1)], np.cumprod(np.full(size - 1, base, dtype=np.uint32), dtype=np.uint32)])
                      for base in (_BASE, pow(_BASE, -1, 1 << 32))]
    return _POWERS[0], _POWERS[1]


def word_values(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the words of all texts one after the other, and how many words each text has."""
    if not _FOLD:
        table = np.zeros(0x110000, dtype=np.uint32)
        for point in range(0x110000):
            letter = chr(point)
            if letter.isalnum() or letter == "_":
                low = letter.lower()
                table[point] = ord(low) if len(low) == 1 else point
        _FOLD.append(table)
    points = np.zeros(sum(map(len, texts)) + len(texts) + 1, dtype=np.uint32)
    points[1:] = _FOLD[0][codes("\n".join([*texts, ""]))]
    up, down = _powers(len(points))
    inside = points != 0
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    first, last = edge[::2], edge[1::2]
    points *= up[:len(points)]
    total = np.cumsum(points, dtype=np.uint32)
    value = (total[last] - total[first]) * down[first] * np.uint32(0x9E3779B1)
    value ^= value >> np.uint32(15)
    ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
    counts = np.diff(np.searchsorted(first, ends), prepend=0)
    return value, counts


def slot_of(values: np.ndarray) -> np.ndarray:
    return (values & np.uint32(SLOTS - 1)).astype(np.uint16)


def hashed_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the words of all texts one after the other, and how many words each text has."""
    values, counts = word_values(texts)
    return slot_of(values), counts


def value_runs(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, hashes of words, words of each text) for runs of texts of about ``CHARS`` characters."""
    start, waiting, size = 0, [], 0
    for text in texts:
        if waiting and size + len(text or "") > CHARS:
            yield start, *word_values(waiting)
            start, waiting, size = start + len(waiting), [], 0
        waiting.append(text or "")
        size += len(text or "")
    if waiting:
        yield start, *word_values(waiting)


def slot_runs(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The same with slots."""
    for start, values, counts in value_runs(texts):
        yield start, slot_of(values), counts


def slots_of(text: str) -> np.ndarray:
    """Slot of each word of ``words_of(text)``, for the whole text."""
    return hashed_words([text])[0]


def _probe() -> np.ndarray:
    return np.random.default_rng(20_240_229).standard_normal((SLOTS, WIDTH)).astype(np.float32)


# --- Sums over the corpus, and the latent space ------------------------------------------------------------------------


class _Sums:
    """Numbers of passages with each slot and ``A'A G`` of the passages ``A`` seen so far, ``G`` random."""

    def __init__(self):
        self.random = np.concatenate([_probe(), np.zeros((1, WIDTH), dtype=np.float32)])
        self.moment = np.zeros((SLOTS, WIDTH))
        self.frequency = np.zeros(SLOTS, dtype=np.int64)
        self.passages = 0
        self.seen = 0
        self.often = np.zeros(0, dtype=np.int64)
        self.place = np.full(SLOTS + 1, FREQUENT, dtype=np.int64)

    def add(self, texts: list[str | None]) -> None:
        for _, slots, counts in slot_runs(texts):
            counts = counts[counts > 0]
            if not len(counts):
                continue
            # Texts are filled up to whole passages by a slot whose random vector is zero.
            each = -(-counts // PASSAGE)
            room = np.full(each.sum() * PASSAGE, SLOTS, dtype=np.uint16)
            shift = (np.cumsum(each) - each) * PASSAGE - (np.cumsum(counts) - counts)
            room[np.arange(len(slots)) + np.repeat(shift, counts)] = slots
            for k in range(0, len(room), PIECE):
                self._passages(room[k:k + PIECE])

    def _passages(self, room: np.ndarray) -> None:
        image = self.random[room].reshape(-1, PASSAGE, WIDTH).sum(axis=1)
        self.passages += len(image)
        # Slots that have been frequent so far are summed by a matrix product, all others in runs of equal slots.
        place = self.place[room]
        often = np.flatnonzero(place < FREQUENT)
        counts = np.bincount(often // PASSAGE * FREQUENT + place[often], minlength=len(image) * FREQUENT).reshape(-1, FREQUENT)
        known = len(self.often)
        self.moment[self.often] += (counts.T.astype(np.float32) @ image)[:known]
        self.frequency[self.often] += (counts > 0).sum(axis=0)[:known]
        rare = np.flatnonzero((place == FREQUENT) & (room < SLOTS))
        slots = room[rare]
        order = np.argsort(slots, kind="stable")
        ordered, passage = slots[order], rare[order] // PASSAGE
        heads = np.flatnonzero(np.diff(ordered.astype(np.int32), prepend=-1))
        if len(heads):
            self.moment[ordered[heads]] += np.add.reduceat(image[passage], heads, axis=0)
            new = (np.diff(ordered.astype(np.int32), prepend=-1) != 0) | (np.diff(passage, prepend=-1) != 0)
            self.frequency += np.bincount(ordered[new], minlength=SLOTS)
        self.seen += 1
        if self.seen & (self.seen - 1) == 0:
            self.often = np.argsort(-self.frequency, kind="stable")[:FREQUENT]
            self.place = np.full(SLOTS + 1, FREQUENT, dtype=np.int64)
            self.place[self.often] = np.arange(len(self.often))


@dataclass(frozen=True)
class Space:
    """Maps words to latent coordinates: a row for each slot, IDF and whitening included; and the slots' IDF."""

    rows: np.ndarray
    weight: np.ndarray


def _space(moment: np.ndarray, frequency: np.ndarray, passages: int) -> Space:
    weight = np.log((1.0 + passages) / (1.0 + frequency)) + 1e-6
    # Weighted moments follow from plain ones: the random vectors count as divided by the weights.
    core = _probe().astype(np.float64).T @ moment
    core = (core + core.T) / 2
    values, vectors = np.linalg.eigh(core)
    good = values > 1e-9 * max(values.max(), 1e-300)
    half = (weight[:, None] * moment) @ (vectors[:, good] / np.sqrt(values[good]))
    if not half.size:
        return Space(np.zeros((SLOTS, 1), dtype=np.float32), weight.astype(np.float32))
    right, sizes, _ = np.linalg.svd(half, full_matrices=False)
    keep = min(RANK, int((sizes > 1e-9 * sizes[0]).sum()))
    # Singular values of A are the square roots of those of A'A, which ``half`` is a root of.
    return Space((weight[:, None] * right[:, :keep] / sizes[:keep]).astype(np.float32), weight.astype(np.float32))


def latent_space(df: DataFrame, text: str = "text") -> Space:
    """The latent space of all passages of ``df``.

    Each task gives its sums in ``SLOTS / ROW`` rows; rows of the same slots are added up as they arrive, so that neither a
    task nor the driver holds more than the sums of one task.
    """
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Sums()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in slices(texts):
                total.add(texts[part])
        if total.passages:
            starts = range(0, SLOTS, ROW)
            yield pa.RecordBatch.from_arrays([
                pa.array([s // ROW for s in starts], pa.int32()),
                pa.array([total.moment[s:s + ROW].astype("<f4").tobytes() for s in starts], pa.binary()),
                pa.array([total.frequency[s:s + ROW].astype("<i8").tobytes() for s in starts], pa.binary()),
                pa.array([total.passages] * len(starts), pa.int64()),
            ], names=["row", "moment", "frequency", "passages"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for row, moment, frequency, passages in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = held.setdefault(row, [np.zeros((ROW, WIDTH)), np.zeros(ROW, dtype=np.int64), 0])
                own[0] += np.frombuffer(moment, dtype="<f4").reshape(ROW, WIDTH)
                own[1] += np.frombuffer(frequency, dtype="<i8")
                own[2] += passages
        for row, (moment, frequency, passages) in held.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([row], pa.int32()), pa.array([moment.astype("<f4").tobytes()], pa.binary()),
                pa.array([frequency.astype("<i8").tobytes()], pa.binary()), pa.array([passages], pa.int64()),
            ], names=["row", "moment", "frequency", "passages"])

    schema = "row int, moment binary, frequency binary, passages bigint"
    parts = df.select(F.col(text).cast("string").alias("text")).mapInArrow(sums, schema)
    moment, frequency, passages = np.zeros((SLOTS, WIDTH)), np.zeros(SLOTS, dtype=np.int64), 0
    for row in parts.repartition("row").mapInArrow(add_up, schema).collect():
        at = slice(row["row"] * ROW, (row["row"] + 1) * ROW)
        moment[at] = np.frombuffer(row["moment"], dtype="<f4").reshape(ROW, WIDTH)
        frequency[at] = np.frombuffer(row["frequency"], dtype="<i8")
        passages = row["passages"]
    return _space(moment, frequency, passages)


# --- Candidates and their check -----------------------------------------------------------------------------------------


def common_subsequence(item: list[str], words: list[str]) -> int:
    """Length of the longest common subsequence; one addition of ``len(item)``-bit numbers for each word."""
    places: dict[str, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    open_ = full
    for word in words:
        hit = open_ & places.get(word, 0)
        if hit:
            open_ = (open_ + hit | open_ - hit) & full
    return len(item) - open_.bit_count()


def contains(words: list[str], some: list[str]) -> bool:
    return bool(some) and any(words[i] == some[0] and words[i:i + len(some)] == some for i in range(len(words) - len(some) + 1))


def answer_of(text: str) -> list[str]:
    """The words of the last sentence: the answer of an item that names none."""
    sentences = [w for w in map(words_of, re.split(r"[.!?\n]+", text)) if w]
    return sentences[-1] if sentences else []


def pieces_of(words: int) -> list[tuple[int, int]]:
    """(length, first word) of the pieces that an item of so many words is looked for by.

    Pieces of the longest window that it fills, and of the next shorter one, each half over the one before, from the first word to
    the last.  Items that must be found whole need one.
    """
    lengths = [w for w in WINDOWS if w <= words] or [WINDOWS[0]]
    out = []
    for length in lengths[-1:] if words < SHORT else lengths[-2:]:
        last = max(0, words - length)
        out += [(length, start) for start in ([*range(0, last, length // 2), last] if words >= SHORT else [last // 2])]
    return out


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """32-bit hashes of ordered pairs of words."""
    mixed = (first * np.uint32(0x85EBCA6B)) ^ (second * np.uint32(0xC2B2AE35) + np.uint32(0x27D4EB2F))
    mixed ^= mixed >> np.uint32(15)
    return mixed * np.uint32(0x2C1B3C6D)


class Index:
    """Benchmark items in the latent space, and the inverted file that leads to them."""

    def __init__(self, space: Space, items: list[tuple[str, str, str | None]]):
        self.space = space
        self.items = [(id, words_of(text), words_of(answer) if answer else answer_of(text)) for id, text, answer in items]
        self.lengths = np.array([len(words) for _, words, _ in self.items], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        values, _ = word_values([text for _, text, _ in items])
        slots = slot_of(values)
        self.weights = space.weight[slots].astype(np.float64)
        self.need = np.zeros(len(items))
        #: For each item and window length: vectors of its pieces, their slots, and the weight that a candidate must share with each.
        self.pieces: list[list[tuple[int, np.ndarray, list[frozenset[int]], np.ndarray]]] = []
        found = [(np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
        for n, (start, length) in enumerate(zip(self.starts.tolist(), self.lengths.tolist(), strict=True)):
            own, value, weight = slots[start:start + length], values[start:start + length], self.weights[start:start + length]
            by_length: dict[int, list[np.ndarray]] = {}
            for size, first in pieces_of(length):
                by_length.setdefault(size, []).append(own[first:first + size])
            made = []
            for size, pieces in sorted(by_length.items()):
                vectors = np.stack([space.rows[piece].sum(axis=0) for piece in pieces])
                vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
                made.append((size, vectors.astype(np.float32), [frozenset(piece.tolist()) for piece in pieces],
                             WEIGHT * np.array([space.weight[piece].sum() for piece in pieces], dtype=np.float64)))
            self.pieces.append(made)
            self.need[n] = min(need.min() for *_, need in made)
            found.append(self._postings(start, value, weight))
        keys, first, second = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.argsort(keys, kind="stable")
        self.first, self.second = first[order], second[order]
        self.keys, self.at, self.count = np.unique(keys[order], return_index=True, return_counts=True)
        self.sieve = np.zeros(1 << SIEVE, dtype=bool)
        self.sieve[self.keys >> np.uint32(32 - SIEVE)] = True
        self.rows = np.concatenate([space.rows, np.zeros((1, space.rows.shape[1]), dtype=np.float32)])
        self.weight = np.append(space.weight, np.float32(0))

    @staticmethod
    def _postings(start: int, value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, place of its first word, place of its second word) of an item, places counted over all items; a lone word is a pair with itself."""
        if len(value) == 1:
            return _pair(value, value), np.array([start]), np.array([start])
        pairs = np.array([(i, i + d) for d in range(1, REACH + 1) for i in range(len(value) - d)])
        i, j = pairs[:, 0], pairs[:, 1]
        both = weight[i] + weight[j]
        best = np.full(len(value), -np.inf)
        np.maximum.at(best, i, both)
        np.maximum.at(best, j, both)
        kept = (both >= PAIR_WEIGHT) | (both >= best[i]) | (both >= best[j])
        return _pair(value[i], value[j])[kept], start + i[kept], start + j[kept]

    def regions(self, values: np.ndarray, room: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first word, last word + 1) of stretches of ``room`` whose words found by pairs weigh enough for a candidate."""
        found = []
        for d in range(REACH + 1):
            # Without distance: items of a single word.
            if d == 0 and not (self.lengths == 1).any():
                continue
            left, right = (values[:-d], values[d:]) if d else (values, values)
            keys = _pair(left, right)
            at = np.flatnonzero(self.sieve[keys >> np.uint32(32 - SIEVE)])
            at = at[(room[at] < SLOTS) & (room[at + d] < SLOTS)]
            place = np.minimum(np.searchsorted(self.keys, keys[at]), max(len(self.keys) - 1, 0))
            hit = self.keys[place] == keys[at] if len(self.keys) else np.zeros(0, dtype=bool)
            at, place = at[hit], place[hit]
            many = self.count[place]
            posting = np.repeat(self.at[place], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            found.append((np.repeat(at, many), np.full(many.sum(), d), posting))
        word, apart, posting = (np.concatenate(c) for c in zip(*found, strict=True))
        if not len(word):
            return
        first, second = self.first[posting], self.second[posting]
        item = np.searchsorted(self.starts, first, side="right") - 1
        # Where the item would begin in the room; two ways to deal these places out, half a bin apart, so that one has what is close together.
        begin = word - (first - self.starts[item]) + len(self.weights)
        bins = np.maximum(LEAST_BIN, self.lengths[item] // 2)
        item, word, apart, first, second = (np.concatenate([c, c]) for c in (item, word, apart, first, second))
        place = np.concatenate([begin // bins * 2, (begin + bins // 2) // bins * 2 + 1])
        order = np.lexsort((word, place, item))
        word, apart, first, second, item, place = (c[order] for c in (word, apart, first, second, item, place))
        new = np.concatenate([[True], (item[1:] != item[:-1]) | (place[1:] != place[:-1])])
        group = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        # Each word of the item counts once for a stretch.
        width = np.int64(len(self.weights) + 1)
        seen = np.unique(np.concatenate([group * width + first, group * width + second]))
        mass = np.bincount(seen // width, self.weights[seen % width], minlength=len(heads))
        last = np.maximum.reduceat(word + apart, heads) + 1
        enough = np.flatnonzero(mass >= self.need[item[heads]] - 1e-6)
        yield from sorted(set(zip(item[heads[enough]].tolist(), word[heads[enough]].tolist(), last[enough].tolist(), strict=True)))

    def candidates(self, item: int, room: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
        """(first word, last word + 1) of windows of ``room`` between ``low`` and ``high`` that are close to a piece of the item."""
        out = []
        for length, vectors, slots, need in self.pieces[item]:
            step = length // 3
            begin = low // step * step
            count = max(1, -(-(high - begin) // step))
            own = np.full((count + 2) * step, SLOTS, dtype=room.dtype)
            some = room[begin:min(begin + len(own), len(room))]
            own[:len(some)] = some
            steps = self.rows[own].reshape(count + 2, step, -1).sum(axis=1)
            window = steps[:-2] + steps[1:-1] + steps[2:]
            size = np.sqrt(np.einsum("ij,ij->i", window, window))
            close = (window @ vectors.T >= COSINE * size[:, None]) & (size > 1e-9)[:, None]
            for w, q in zip(*(x.tolist() for x in np.nonzero(close)), strict=True):
                shared = [x for x in own[w * step:w * step + length].tolist() if x in slots[q]]
                if self.weight[shared].sum() >= need[q]:
                    out.append((begin + w * step, begin + w * step + length))
        return out

    def matches(self, text: str, near: dict[int, list[tuple[int, int]]]) -> list[tuple[str, float, bool]]:
        """Items that hold against the text's words: id, share of the common subsequence, answer found."""
        words, out = words_of(text), []
        for number, spans in sorted(near.items()):
            id, item, answer = self.items[number]
            best = (0.0, False)
            for first, last in joined(spans, len(item)):
                # The window is about a piece of the item, which may be its first or last.
                around = words[max(0, first - len(item)):last + len(item)]
                if len(item) < SHORT:
                    found = (1.0, True) if contains(around, item) else (0.0, False)
                else:
                    share = common_subsequence(item, around) / len(item)
                    found = share, share >= PARAPHRASE and contains(around, answer)
                best = max(best, found)
            if best[0] >= COPY or best[0] >= PARAPHRASE and best[1]:
                out.append((id, best[0], best[1]))
        return out

    def search(self, texts: list[str | None]) -> list[list[tuple[str, float, bool]]]:
        """Matches of each whole text."""
        near: list[dict[int, list[tuple[int, int]]]] = [{} for _ in texts]
        for first_text, values, counts in value_runs(texts):
            # Texts stand apart by blanks, each at a place that all steps divide: its windows don't depend on other texts.
            each = -(-(counts + GAP) // ALIGN) * ALIGN
            places, starts = np.cumsum(each) - each, np.cumsum(counts) - counts
            at = np.arange(len(values)) + np.repeat(places - starts, counts)
            room, hashed = np.full(each.sum(), SLOTS, dtype=np.uint16), np.zeros(each.sum(), dtype=np.uint32)
            room[at], hashed[at] = slot_of(values), values
            for number, first, last in self.regions(hashed, room):
                own = int(np.searchsorted(places, first, side="right")) - 1
                base, end = int(places[own]), int(places[own] + counts[own])
                size = len(self.items[number][1])
                spans = self.candidates(number, room, max(base, first - size), min(end, last + size))
                if spans:
                    near[first_text + own].setdefault(number, []).extend((a - base, b - base) for a, b in spans)
        return [self.matches(t, found) if found else [] for t, found in zip(texts, near, strict=True)]


def joined(spans: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Spans that overlap as one, as long as that is no longer than three times ``length`` (and the longest window)."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(set(spans)):
        if out and first <= out[-1][1] and max(last, out[-1][1]) - out[-1][0] <= 3 * length + WINDOWS[-1]:
            out[-1] = out[-1][0], max(last, out[-1][1])
        else:
            out.append((first, last))
    return out


def _passes(benchmark: DataFrame, id: str, text: str, answer: str | None) -> Iterator[list[tuple[str, str, str | None]]]:
    """Benchmark items, of about ``PASS_CHARS`` characters at a time; NULL ids, NULL texts and texts without a word are no items."""
    items = benchmark.select(F.col(id).cast("string").alias("id"), F.col(text).cast("string").alias("text"),
                             (F.col(answer).cast("string") if answer else F.lit(None).cast("string")).alias("answer"))
    items = items.where("id IS NOT NULL AND text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.length("text") + F.coalesce(F.length("answer"), F.lit(0)))).first()[0] or 0
    buckets = -(-size // (PASS_CHARS // 2))
    for k in range(buckets):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(buckets)) == k).orderBy("id", "text", "answer").collect()
        some = [tuple(r) for r in part if words_of(r["text"])]
        if some:
            yield some


def find_leaks(df: DataFrame, benchmark: DataFrame, *, text: str = "text", id: str = "item_id", item: str = "text",
               answer: str | None = None, space: Space | None = None, items: str = "leaked_items", shares: str = "leaked_shares") -> DataFrame:
    """``df`` with two new array columns: ids (as strings) of the benchmark items in the whole column ``text``, and the shares
    of their words in the longest common subsequence.

    NULL and empty texts have no leaks.  Repeated rows get the same ones; repeated items count once; an empty benchmark leaves
    nothing to find.  Columns of ``df`` named like a new one are replaced, all others kept.  Items are sent to the tasks
    ``PASS_CHARS`` characters at a time; a larger benchmark takes a further pass over ``df`` for each.
    """
    space = space or latent_space(df, text)
    out = df.drop(items, shares)
    found = []
    for k, some in enumerate(_passes(benchmark, id, item, answer)):
        held = df.sparkSession.sparkContext.broadcast(Index(space, some))

        def make(held=held):
            index = held.value

            def work(texts):
                matched = index.search(texts)
                return {names[0]: [[m[0] for m in ms] for ms in matched], names[1]: [[m[1] for m in ms] for ms in matched]}

            return work

        names = free_name(out, f"items_{k}"), free_name(out, f"shares_{k}")
        out = annotate(out, text, make, {names[0]: "array<string>", names[1]: "array<double>"})
        found.append(names)
    if not found:
        return out.select("*", F.array().cast("array<string>").alias(items), F.array().cast("array<double>").alias(shares))
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in (items.lower(), shares.lower())]
    return out.select(*kept, F.concat(*(F.col(a) for a, _ in found)).alias(items), F.concat(*(F.col(b) for _, b in found)).alias(shares))


def keep_clean(df: DataFrame, benchmark: DataFrame, text: str = "text", **columns: str) -> DataFrame:
    """The rows of ``df``, unchanged, whose text holds no benchmark item."""
    items, shares = free_name(df, "leaked_items"), free_name(df, "leaked_shares")
    return find_leaks(df, benchmark, text=text, items=items, shares=shares, **columns).where(F.size(items) == 0).drop(items, shares)
