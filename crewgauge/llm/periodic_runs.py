"""Periodic runs of words, found on a grammar of each text.

A run is a stretch of consecutive words with smallest period ``q``, at least ``max(min_length, 3 * q)`` words long, that no
neighbouring word extends. The words of a text become numbers, and Re-Pair turns them into a grammar: repeated
neighbouring pairs are replaced by new symbols, most frequent first, until no pair repeats; what is left is paired up
evenly, so that one symbol derives the whole text. A run lies within the text of some symbol and crosses the boundary
between the two symbols it is made of, so each symbol is searched once, at that boundary. What is found there is carried
to all places the symbol derives, and intervals of one period that overlap by a period are merged to maximal ones.

A period ``q`` at a boundary means that words next to the boundary are repeated ``q`` words away on one of its sides, at
least as many words as ``q`` (or a third of ``min_length``). Stretches of 8, 16, 32, ... words are named by doubling (equal names, equal words),
so candidates are looked up among the equal names nearby, and how far both sides agree is read off the names, exactly.

A task works on some megabytes of whole texts at a time as one array, with numbers that are local to each text; there
is no shuffle. A text is never cut: the longest one has to fit in a task, as it does in a row.

Defined results: a null, empty or blank text has no words and no runs, and its collapsed text is empty. Repeated rows are
treated each on their own. Columns of any name are handed through under ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MIN_LENGTH = 24
#: Bytes of text that a task treats as one array.
CHUNK = 1 << 22
_BASE = np.int64(1) << 32


@dataclass(frozen=True)
class Nodes:
    """Symbols of the derivation trees: the words they derive, the boundary inside, and equal labels for equal symbols."""

    label: np.ndarray
    start: np.ndarray
    middle: np.ndarray
    end: np.ndarray

    def at(self, which: np.ndarray) -> Nodes:
        return Nodes(self.label[which], self.start[which], self.middle[which], self.end[which])


def local_ids(codes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for the words of each text that no other text shares, and how often each word is in its text."""
    _, ids, counts = np.unique(doc * (codes.max(initial=0) + 1) + codes, return_inverse=True, return_counts=True)
    return ids, counts[ids]


def _local_maxima(at: np.ndarray, rank: np.ndarray, size: int) -> np.ndarray:
    """Which of the pairs that start ``at`` are replaced: those no neighbouring pair outranks, every other one of ``aaaa``."""
    around = np.full(size + 2, -1, np.int64)
    around[at + 1] = rank
    begins = np.ones(len(at), bool)
    begins[1:] = (at[1:] != at[:-1] + 1) | (rank[1:] != rank[:-1])
    place = np.arange(len(at))
    offset = place - np.maximum.accumulate(np.where(begins, place, 0))
    return (offset % 2 == 0) & (rank >= around[at]) & (rank >= around[at + 2])


def grammar(ids: np.ndarray, often: np.ndarray, doc: np.ndarray) -> Nodes:
    """All symbols of the Re-Pair grammars of the texts, one row for each place a symbol derives."""
    symbols, d = ids.copy(), doc
    start, end = np.arange(len(ids)), np.arange(1, len(ids) + 1)
    label = int(ids.max(initial=0)) + 1
    found: list[tuple[np.ndarray, ...]] = []
    live = np.zeros(len(ids), bool)  # the pair that begins here may repeat
    live[:-1] = (d[1:] == d[:-1]) & (often[1:] > 1) & (often[:-1] > 1)

    def replace(first: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Put new symbols for the pairs that begin at ``first``; returns where those symbols are afterwards."""
        nonlocal symbols, start, end, d
        found.append((labels, start[first], start[first + 1], end[first + 1]))
        symbols[first], end[first] = labels, end[first + 1]
        stays = np.ones(len(symbols), bool)
        stays[first + 1] = False
        symbols, start, end, d = symbols[stays], start[stays], end[stays], d[stays]
        return first - np.arange(len(first))

    while len(at := np.flatnonzero(live)):
        pairs, which, counts = np.unique(symbols[at] * _BASE + symbols[at + 1], return_inverse=True, return_counts=True)
        repeats = counts[which] > 1
        live[at[~repeats]] = False
        at, which = at[repeats], which[repeats]
        if not len(at):
            break
        rank = np.empty(len(pairs), np.int64)
        rank[np.argsort(counts, kind="stable")] = np.arange(len(pairs))
        chosen = _local_maxima(at, rank[which], len(symbols))
        gone = at[chosen] + 1
        new = replace(at[chosen], label + which[chosen])
        label += len(pairs)
        live = np.delete(live, gone)
        live[new[:-1] if len(new) and new[-1] + 1 == len(symbols) else new] = True
        live[new[new > 0] - 1] = True
        live[:-1] &= d[1:] == d[:-1]
        live[-1] = False

    while True:  # the rest of each text, paired up evenly
        first = np.flatnonzero(np.append(True, d[1:] != d[:-1])) if len(d) else np.empty(0, np.int64)
        offset = np.arange(len(d)) - np.repeat(first, np.diff(np.append(first, len(d))))
        left = np.flatnonzero((offset[:-1] % 2 == 0) & (d[1:] == d[:-1]))
        if not len(left):
            break
        replace(left, label + np.arange(len(left)))
        label += len(left)
    return Nodes(*(np.concatenate(c) for c in zip(*found, strict=True))) if found else Nodes(*[np.empty(0, np.int64)] * 4)


@dataclass(frozen=True)
class Names:
    """``levels[k][i]``: the name of the ``2**k`` words from ``i`` on; -1 where they are nowhere else in that text."""

    levels: list[np.ndarray]

    @staticmethod
    def of(ids: np.ndarray, often: np.ndarray, doc: np.ndarray) -> Names:
        n = len(ids)
        levels = [np.where(often > 1, ids, -1)]
        while True:
            last, width = levels[-1], 1 << (len(levels) - 1)
            at = np.flatnonzero(last[: max(n - width, 0)] >= 0)
            at = at[(last[at + width] >= 0) & (doc[at + width] == doc[at])]
            _, which, counts = np.unique(last[at] * _BASE + last[at + width], return_inverse=True, return_counts=True)
            again = counts[which] > 1
            if not again.any():
                return Names(levels)
            named = np.full(n, -1, np.int64)
            named[at[again]] = which[again]
            levels.append(named)

    def _same(self, k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        names = self.levels[k]
        inside = (a >= 0) & (b >= 0) & (a < len(names)) & (b < len(names))
        a, b = np.where(inside, a, 0), np.where(inside, b, 0)
        return inside & (names[a] >= 0) & (names[a] == names[b])

    def _agree(self, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        total = np.zeros(len(a), np.int64)
        for k in [*[len(self.levels) - 1] * 2, *range(len(self.levels) - 2, -1, -1)]:
            # The highest level may fit more than once; each lower one fits once at most after that.
            step = 1 << k
            while True:
                same = self._same(k, a - total - step, b - total - step) if back else self._same(k, a + total, b + total)
                total += step * same
                if k < len(self.levels) - 1 or not same.any():
                    break
        return total

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on and from ``b`` on are equal."""
        return self._agree(a, b, back=False)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` and before ``b`` are equal."""
        return self._agree(a, b, back=True)


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges ``[low, high)``, and the range of each."""
    size = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(low)), size)
    return np.repeat(low - (np.cumsum(size) - size), size) + np.arange(len(which)), which


def crossing_runs(nodes: Nodes, names: Names, min_length: int) -> tuple[np.ndarray, ...]:
    """Runs within each node's words that cross its boundary: node, start, end (in the words), period."""
    found = []
    base = max(0, (-(-min_length // 3)).bit_length() - 1)
    for k in range(base, len(names.levels)):
        width, named = 1 << k, names.levels[k]
        least = 1 if k == base else width
        at = np.flatnonzero(named >= 0)
        keys = np.sort(named[at] * _BASE + at)
        most = np.minimum(2 * width - 1, (nodes.end - nodes.start) // 3)
        able = np.flatnonzero(most >= least)
        for shift in (0, width):  # the words after the boundary, those before it
            probe = nodes.middle[able] - shift
            inside = (probe >= nodes.start[able]) & (probe + width <= nodes.end[able])
            node, probe = able[inside], probe[inside]
            node, probe = node[named[probe] >= 0], probe[named[probe] >= 0]
            name = named[probe] * _BASE
            for side in (-1, 1):
                # nothing is before the first word: with less room than that, a probe there would meet itself
                room = np.minimum(nodes.middle[node] - nodes.start[node], probe) if side < 0 else (nodes.end[node] - nodes.middle[node])
                far = np.minimum(most[node], room)
                near_end, far_end = probe + side * least, np.clip(probe + side * far, 0, len(named))
                low = np.searchsorted(keys, name + np.minimum(near_end, far_end), "left")
                high = np.searchsorted(keys, name + np.maximum(near_end, far_end), "right")
                place, which = _ranges(low, np.where(far >= least, high, low))
                period = np.abs(keys[place] % _BASE - probe[which])
                found.append((node[which], period, np.full(len(which), side)))
    if not found:
        return (np.empty(0, np.int64),) * 4
    node, period, side = (np.concatenate(c) for c in zip(*found, strict=True))
    low, middle, high = nodes.start[node], nodes.middle[node], nodes.end[node]
    a = np.where(side < 0, middle - period, middle)
    before = np.minimum(names.backward(a, a + period), a - low)
    after = np.minimum(names.forward(a, a + period), high - a - period)
    start, end = a - before, a + period + after
    run = (start < middle) & (end > middle) & (end - start >= np.maximum(min_length, 3 * period))
    return _smallest_period(node[run], start[run], end[run], period[run])


def _smallest_period(group: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """One row of each interval, that with the smallest period: the others are its multiples."""
    order = np.lexsort((period, end, start, group))
    group, start, end, period = group[order], start[order], end[order], period[order]
    first = np.ones(len(group), bool)
    first[1:] = (group[1:] != group[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return group[first], start[first], end[first], period[first]


def _everywhere(nodes: Nodes, one: np.ndarray, found: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Runs of the nodes ``one`` (one of each label) at all places their labels derive: start, end, period."""
    which, start, end, period = found
    order = np.argsort(nodes.label, kind="stable")
    labels = nodes.label[order]
    own = nodes.label[one[which]]
    place, run = _ranges(np.searchsorted(labels, own, "left"), np.searchsorted(labels, own, "right"))
    moved = nodes.start[order[place]] - nodes.start[one[which[run]]]
    return start[run] + moved, end[run] + moved, period[run]


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Intervals of one period that overlap by a period or more, as one."""
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    shift = np.cumsum(np.append(0, period[1:] != period[:-1])) * (2 * size + 2) if len(period) else 0
    reach = np.maximum.accumulate(end + shift)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] + (shift[1:] if len(period) else 0) > reach[:-1] - period[1:]
    first = np.flatnonzero(new)
    ends = np.maximum.reduceat(end, first) if len(first) else end
    return start[first], ends, period[first]


def runs(codes: np.ndarray, doc: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs, in order. ``codes`` are the words of all texts one after the other, ``doc`` the
    rising number of each word's text; starts and ends count through all texts."""
    if not len(codes):
        return (np.empty(0, np.int64),) * 3
    ids, often = local_ids(codes, doc)
    nodes = grammar(ids, often, doc)
    nodes = nodes.at(np.flatnonzero(nodes.end - nodes.start >= min_length))
    one = np.unique(nodes.label, return_index=True)[1]
    found = crossing_runs(nodes.at(one), Names.of(ids, often, doc), min_length)
    start, end, period = _merged(*_everywhere(nodes, one, found), len(codes))
    _, start, end, period = _smallest_period(np.zeros(len(start), np.int64), start, end, period)
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _dropped(start: np.ndarray, end: np.ndarray, period: np.ndarray, size: int) -> np.ndarray:
    """The words behind the first period of any run."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _searched(texts: list[str | None], min_length: int) -> tuple[pa.Array, list[str]]:
    """The runs of each text, and the texts without the words behind the first period of a run."""
    words = [(t or "").encode().split() for t in texts]  # bytes.split() cuts at the six ASCII white-space characters
    sizes = np.array([len(w) for w in words], np.int64)
    begins = np.cumsum(sizes) - sizes
    flat = [w for ws in words for w in ws]
    codes = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    start, end, period = runs(codes, np.repeat(np.arange(len(texts)), sizes), min_length)
    gone = _dropped(start, end, period, len(flat))
    own = np.searchsorted(start, np.append(begins, len(flat)), "left")
    kept = []
    for n, ws in enumerate(words):
        if own[n] < own[n + 1]:
            ws = [w for w, g in zip(ws, gone[begins[n] : begins[n] + len(ws)].tolist(), strict=True) if not g]
        kept.append(b" ".join(ws).decode())
    doc = np.searchsorted(begins, start, "right") - 1  # the last text that begins here or before; empty ones end before it
    values = pa.StructArray.from_arrays([pa.array(start - begins[doc]), pa.array(end - start), pa.array(period)], fields=list(_RUNS.value_type))
    return pa.ListArray.from_arrays(pa.array(own, pa.int32()), values).cast(_RUNS), kept


def _chunks(texts: list[str | None], size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with up to ``size`` characters, or a single longer row."""
    first, total = 0, 0
    for n, text in enumerate(texts):
        total += len(text or "")
        if total > size and n > first:
            yield first, n
            first, total = n, len(text or "")
    if first < len(texts):
        yield first, len(texts)


def detect(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per row of ``docs``: ``row`` (its columns but the text), ``runs`` (start, length, period in words, by start and period)
    and ``collapsed`` (the words outside runs and the first period of each run, joined by one space)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _chunks(texts, CHUNK):
                found, kept = _searched(texts[a:b], min_length)
                yield pa.RecordBatch.from_arrays([batch.column("row")[a:b], found, pa.array(kept, pa.string())], ["row", "runs", "collapsed"])

    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col))
    rows = docs.select(own.alias("row"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(search, f"row {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
