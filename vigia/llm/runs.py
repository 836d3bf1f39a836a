"""Periodic runs of words, found through a grammar.

A run is a stretch of consecutive words with smallest period ``q`` and a length of at least ``max(LEAST_WORDS, LEAST_TIMES * q)`` that
no neighbouring word extends.  The words of a slice of texts become numbers and are compressed by Re-Pair: again and again, the pairs
of neighbouring symbols that occur more often than those they overlap become new symbols, until no pair occurs twice.  Each new symbol
stands for one stretch of words, however often it is met; it is a *node* with a boundary between its two parts, and so is
each seam between two symbols that are left of a text.  A run lies within some smallest node and crosses its boundary: the
stretches that cross the boundary of a symbol are looked for once, in one place where the symbol stands, and copied to all others; stretches that
lie within another one of their period are parts of it.

A stretch of at least four periods has two of them on one side of the boundary, so that the words around the boundary stand there once more,
a period away.  Short periods are tried one by one, longer ones at the earlier places of the ``GRAM`` words that end
(or begin) at the boundary.  How far a period reaches is found by hashes of stretches, and every stretch is compared word by word in the end.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from vigia.llm.common import annotate
from vigia.llm.words import split_words

LEAST_WORDS = 6
LEAST_TIMES = 4
#: Periods below it are tried at every boundary.
GRAM = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x5851F42D4C957F2D)


class Nodes(NamedTuple):
    """Places in the slice: where a node begins, its boundary (the first word of its right part), its end; and which symbol it is."""

    low: np.ndarray
    cut: np.ndarray
    high: np.ndarray
    symbol: np.ndarray


# --- Re-Pair -----------------------------------------------------------------------------------------------------------


def grammar(words: np.ndarray, starts: np.ndarray) -> Nodes:
    """The nodes of a grammar for the texts that begin at ``starts`` (and end where the next one begins).

    ``symbol`` is the same for equal stretches that one rule made, and -1 for the seams left in the end, whose stretch is the text.
    """
    symbols = words.astype(np.int64)
    at = np.arange(len(words))
    fresh = int(symbols.max(initial=-1)) + 1
    end = np.zeros(len(words) + 1, dtype=bool)  # whether a text ends before a place
    end[starts] = True
    made = []
    rules: dict[tuple[int, int], int] = {}
    total = len(words)
    # A pair that stands in one place only never stands in two later on; it counts again when a new symbol takes part.
    single = np.append(end[1:-1], True)
    while True:
        open_ = np.flatnonzero(~single)
        pair = symbols[open_] * np.int64(fresh) + symbols[open_ + 1]
        order = np.argsort(pair)
        ordered = pair[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(pair)]
        heads = np.flatnonzero(new)
        counts = np.diff(np.append(heads, len(pair)))
        # The more frequent pair goes first; of equally frequent ones that with the smaller number.
        rank = np.where(counts > 1, counts * np.int64(len(heads)) + (len(heads) - 1 - np.arange(len(heads))), -1)
        own = np.full(len(symbols), -1)
        own[open_[order]] = np.repeat(rank, counts)
        single[open_] = own[open_] < 0
        chosen = own >= 0
        chosen[1:] &= own[1:] >= own[:-1]
        chosen[:-1] &= own[:-1] >= own[1:]
        # Equal neighbours are a symbol repeated: every second pair, from where the repetition begins.
        same = np.flatnonzero(chosen[1:] & chosen[:-1]) + 1
        if len(same):
            heads = np.concatenate([[True], np.diff(same) > 1])
            chosen[same[(same - np.repeat(same[heads], np.diff(np.append(np.flatnonzero(heads), len(same))))) % 2 == 0]] = False
        took = np.flatnonzero(chosen)
        if not len(took):
            break
        # A symbol repeated may have been taken in one place only; a rule for it does no harm.
        pair = symbols[took] * np.int64(fresh) + symbols[took + 1]
        kinds, kind = np.unique(pair, return_inverse=True)
        numbers = np.fromiter((rules.setdefault(rule, -1) for rule in zip(*(x.tolist() for x in np.divmod(kinds, fresh)), strict=True)), np.int64, len(kinds))
        unknown = numbers < 0
        numbers[unknown] = fresh + np.arange(unknown.sum())
        rules.update(zip(zip(*(x[unknown].tolist() for x in np.divmod(kinds, fresh)), strict=True), numbers[unknown].tolist(), strict=True))
        until = np.append(at, [total, total])
        made.append((at[took], at[took + 1], until[took + 2], numbers[kind]))
        symbols[took] = numbers[kind]
        fresh += int(unknown.sum())
        keep = np.ones(len(symbols), dtype=bool)
        keep[took + 1] = False
        symbols, at = symbols[keep], at[keep]
        single[took] = single[took - 1] = False
        single = single[keep]
        single[:-1] |= end[at[1:]]
        single[-1] = True
    seams = at[~end[at]] if len(at) else at
    text = np.searchsorted(starts, seams, side="right") - 1
    made.append((starts[:-1][text], seams, starts[1:][text], np.full(len(seams), -1)))
    return Nodes(*(np.concatenate(c).astype(np.int64) for c in zip(*made, strict=True)))


# --- Stretches across boundaries ---------------------------------------------------------------------------------------


class _Reach:
    """How far a period reaches around a place, by hashes of stretches of words."""

    def __init__(self, words: np.ndarray):
        self.words = words
        n = len(words)
        values = (words.astype(np.uint64) + np.uint64(1)) * _MIX
        values ^= values >> np.uint64(32)
        self.power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE, dtype=np.uint64), dtype=np.uint64)])
        self.total = np.concatenate([[np.uint64(0)], np.cumsum(values * self.power[:n], dtype=np.uint64)])

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ``size`` words from ``a`` on are those from ``b`` on (``a <= b``)."""
        return (self.total[a + size] - self.total[a]) * self.power[b - a] == self.total[b + size] - self.total[b]

    def forward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``a`` and ``b`` on are equal, ``most`` at most."""
        return self._longest(most, lambda some, size: self.equal(a[some], b[some], size))

    def backward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and ``b`` are equal, ``most`` at most."""
        return self._longest(most, lambda some, size: self.equal(a[some] - size, b[some] - size, size))

    @staticmethod
    def _longest(most, good):
        low, step = np.zeros(len(most), dtype=np.int64), np.ones(len(most), dtype=np.int64)
        some = np.flatnonzero(most > 0)
        # Steps double as long as they fit, then halve.
        growing = some
        while len(growing):
            wanted = low[growing] + step[growing]
            fits = wanted <= most[growing]
            growing = growing[fits]
            held = good(growing, wanted[fits])
            growing = growing[held]
            low[growing] += step[growing]
            step[growing] *= 2
        while len(some):
            wanted = low[some] + step[some]
            fits = np.flatnonzero(wanted <= most[some])
            held = fits[good(some[fits], wanted[fits])]
            low[some[held]] += step[some[held]]
            step[some] //= 2
            some = some[step[some] > 0]
        return low


BEFORE, BEHIND = 0, 1


def _stretches(reach: _Reach, low: np.ndarray, cut: np.ndarray, high: np.ndarray, period: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretch with ``period`` that holds the words on both sides of ``cut``, within ``low`` to ``high``.

    It is the one in which these two words stand once more a period before (or behind); without these it is empty.
    """
    begin, end = cut.copy(), cut.copy()
    at = np.flatnonzero(cut - period >= low if side == BEFORE else cut + period <= high)
    p = period[at]
    first = cut[at] - p if side == BEFORE else cut[at]
    on = reach.forward(first, first + p, high[at] - first - p)
    back = reach.backward(first, first + p, first - low[at])
    good = (on > 0) & (back > 0)
    begin[at[good]], end[at[good]] = (first - back)[good], (first + p + on)[good]
    return begin, end


def _plain(words: np.ndarray, low: int, cut: int, high: int, p: int, side: int) -> tuple[int, int]:
    """The same, word by word: for the rare case that hashes of different stretches are equal."""
    first = cut - p if side == BEFORE else cut
    equal = words[low:high - p] == words[low + p:high]
    on = equal[first - low:]
    back = equal[:first - low][::-1]
    counts = [len(x) if x.all() else int(np.argmin(x)) for x in (on, back)]
    return (first - counts[1], first + p + counts[0]) if all(counts) else (cut, cut)


def _grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place the number of the ``GRAM`` words from there on; and the places by these numbers, with keys to search in."""
    n = len(words) - GRAM + 1
    value = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(GRAM if n > 0 else 0):
        value = (value ^ words[k:k + n].astype(np.uint64)) * _MIX
        value ^= value >> np.uint64(29)
    order = np.argsort(value)
    ordered = value[order]
    number = np.empty(len(value), dtype=np.int64)
    number[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])) if len(value) else 0
    keys = np.sort(number * np.int64(len(words) + 1) + np.arange(len(value)))
    return number, keys % np.int64(len(words) + 1), keys


def crossing(words: np.ndarray, nodes: Nodes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(node, begin, end, period) of the stretches of at least the asked length that cross the boundary of each node."""
    reach = _Reach(words)
    found = [(np.zeros(0, dtype=np.int64),) * 4]

    def look(node, period, side, known):
        low, cut, high = nodes.low[node], nodes.cut[node], nodes.high[node]
        least = np.maximum(LEAST_WORDS, LEAST_TIMES * period)
        begin, end = _stretches(reach, low, cut, high, period, side)
        for k in np.flatnonzero(end - begin >= least).tolist():
            a, b, p = int(begin[k]), int(end[k]), int(period[k])
            if not np.array_equal(words[a:b - p], words[a + p:b]):
                begin[k], end[k] = _plain(words, int(low[k]), int(cut[k]), int(high[k]), p, side)
        good = end - begin >= least
        found.append((node[good], begin[good], end[good], period[good]))
        # Two stretches share fewer words than the sum of their periods, so that a longer period must reach beyond this one.
        np.maximum.at(known[BEFORE], node[good], (cut - begin - period)[good])
        np.maximum.at(known[BEHIND], node[good], (end - cut - period)[good])

    short = np.zeros((2, len(nodes.cut)), dtype=np.int64)
    room = nodes.high - nodes.low
    for p in range(1, GRAM):
        some = np.flatnonzero(room >= max(LEAST_WORDS, LEAST_TIMES * p))
        low, cut, high = nodes.low[some], nodes.cut[some], nodes.high[some]
        last = len(words) - 1
        # Two words around the boundary, once more a period before or behind.
        before = (cut - 1 - p >= low) & (words[cut] == words[np.maximum(cut - p, 0)]) & (words[cut - 1] == words[np.maximum(cut - 1 - p, 0)])
        behind = (cut + p < high) & (words[cut] == words[np.minimum(cut + p, last)]) & (words[cut - 1] == words[np.minimum(cut - 1 + p, last)])
        for side, there in ((BEFORE, before), (BEHIND, behind)):
            if there.any():
                look(some[there], np.full(int(there.sum()), p), side, short)

    number, order, keys = _grams(words)
    if len(number):
        width = np.int64(len(words) + 1)
        counts = np.bincount(number)
        for side in (BEFORE, BEHIND):
            # Words that end with the first one behind the boundary; words that begin with the last one before it.
            place = nodes.cut - GRAM + 1 if side == BEFORE else nodes.cut - 1
            some = np.flatnonzero((room >= LEAST_TIMES * GRAM) & (place >= nodes.low) & (place + GRAM <= nodes.high))
            some = some[counts[number[place[some]]] > 1]
            known = short.copy()
            least = np.maximum(GRAM, known[side][some])
            while len(some):
                own = place[some]
                if side == BEFORE:
                    k = np.searchsorted(keys, number[own] * width + np.maximum(own - least, -1), side="right") - 1
                    other = order[np.maximum(k, 0)]
                    good = (k >= 0) & (number[other] == number[own]) & (own - other >= least) & (nodes.cut[some] - 2 * (own - other) >= nodes.low[some])
                else:
                    k = np.searchsorted(keys, number[own] * width + np.minimum(own + least, width - 1))
                    other = order[np.minimum(k, len(order) - 1)]
                    good = (k < len(order)) & (number[other] == number[own]) & (other - own >= least) & (nodes.cut[some] + 2 * (other - own) <= nodes.high[some])
                some, period = some[good], np.abs(own - other)[good]
                if len(some):
                    look(some, period, side, known)
                    least = np.maximum(period + 1, known[side][some])
    node, begin, end, period = (np.concatenate(c) for c in zip(*found, strict=True))
    # A multiple of a period covers what the period covers; the smallest one counts.
    order = np.lexsort((period, end, begin, node))
    node, begin, end, period = node[order], begin[order], end[order], period[order]
    first = np.ones(len(node), dtype=bool)
    first[1:] = (node[1:] != node[:-1]) | (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    return node[first], begin[first], end[first], period[first]


# --- Runs of texts -----------------------------------------------------------------------------------------------------


def find_runs(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of the texts that begin at ``starts`` in ``words``, by text, start and period."""
    nodes = grammar(words, starts)
    # One place for each symbol; seams stand for themselves.
    order = np.lexsort((nodes.low, nodes.symbol))
    symbol = nodes.symbol[order]
    head = np.concatenate([[True], symbol[1:] != symbol[:-1]]) | (symbol < 0) if len(symbol) else np.zeros(0, dtype=bool)
    heads = np.flatnonzero(head)
    one = Nodes(*(c[order[heads]] for c in nodes))
    node, begin, end, period = crossing(words, one)
    # To all places of the symbol.
    copies = np.diff(np.append(heads, len(order)))[node]
    first = heads[node]
    shift = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
    moved = nodes.low[order[np.repeat(first, copies) + shift]] - np.repeat(one.low[node], copies)
    begin, end, period = np.repeat(begin, copies) + moved, np.repeat(end, copies) + moved, np.repeat(period, copies)
    text = np.searchsorted(starts, begin, side="right") - 1
    # Stretches within a stretch of the same period are parts of a run.
    order = np.lexsort((-end, begin, period, text))
    text, begin, end, period = text[order], begin[order], end[order], period[order]
    if len(text):
        group = np.cumsum(np.concatenate([[0], (text[1:] != text[:-1]) | (period[1:] != period[:-1])]))
        reached = np.maximum.accumulate(end + group * np.int64(len(words) + 1)) - group * np.int64(len(words) + 1)
        whole = np.concatenate([[True], (group[1:] != group[:-1]) | (end[1:] > reached[:-1])])
        text, begin, end, period = text[whole], begin[whole], end[whole], period[whole]
    order = np.lexsort((period, begin, text))
    text, begin, end, period = text[order], begin[order], end[order], period[order]
    return text, begin - starts[text], end - begin, period


_FIELDS = {"n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string",
           "collapsed_sha256": "string"}


def annotate_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the periodic runs of the words of the whole column ``text``: how many (``n_runs``), start, length, period and a thousandth of the
    exponent of the longest one, digests of all runs and of the text without what runs repeat.

    Words stand between ASCII white space.  Of equally long runs the first counts, then that of the smaller period.  NULL, empty and blank texts have no
    words and no runs: four NULLs, digests of nothing.  A word goes if a run holds it behind the run's first period.  A very long text is a grammar
    of its own and held in one task; its memory is in proportion to its words.  Repeated rows get equal results, an empty table gives no rows;
    columns named like a new one are replaced, all others kept.
    """
    return annotate(df, text, lambda: runs_of, _FIELDS)


def runs_of(texts: list[str | None]) -> dict[str, list]:
    """The new columns of ``annotate_runs`` for a slice of texts."""
    split = split_words(pa.array(texts, pa.large_string()))
    words, starts = split.number.astype(np.int64), split.starts.astype(np.int64)
    owner, start, length, period = find_runs(words, starts)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    kept = np.ones(len(words), dtype=bool)
    for a, size, q in zip((starts[owner] + start).tolist(), length.tolist(), period.tolist(), strict=True):
        kept[a + q:a + size] = False
    left = np.concatenate([[0], np.cumsum(kept)])[starts]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), split.known.take(pa.array(words[kept]))), pa.scalar(" ", pa.large_string())).to_pylist()
    out: dict[str, list] = {name: [] for name in _FIELDS}
    for k in range(len(texts)):
        s, n, p = (c[first[k]:first[k + 1]] for c in (start, length, period))
        best = int(np.lexsort((p, s, -n))[0]) if len(s) else -1
        listed = "".join(f"{a},{size},{q}\n" for a, size, q in zip(s.tolist(), n.tolist(), p.tolist(), strict=True))
        out["n_runs"].append(len(s))
        for name, values in (("start", s), ("length", n), ("period", p)):
            out[name].append(int(values[best]) if best >= 0 else None)
        out["exponent_milli"].append(int(n[best]) * 1000 // int(p[best]) if best >= 0 else None)
        out["runs_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
        out["collapsed_sha256"].append(hashlib.sha256(collapsed[k].encode()).hexdigest())
    return out
