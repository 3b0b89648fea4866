"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit per component, set where the component is above zero. Codes are cut into segments, and
every segment of every distinct code is one posting. Queries probe all segment values at distance exactly ``r`` from
their own, for ``r`` = 0, 1, ...; a code within Hamming distance ``m * (r + 1) - 1`` of a query is within ``r`` in one
of the ``m`` segments, so after round ``r`` everything up to that distance has been verified. A query leaves when its
k-th verified distance is covered.

Postings lie in leaves: those of one segment whose values begin alike, cut into parts where they are many. A query goes
once to every leaf that some of its probes lead to, and its probes are made there; so what is shuffled is queries and
postings, never probes, which are thousands of times as many. Where a leaf has fewer postings than a query has probes,
their values are compared one by one. No side of the join is broadcast, and many queries are dealt out over several
copies of a leaf.

Candidates are verified inside the join, against the query's k-th distance so far (first: that among the codes which
begin alike), and accepted only in the round and segment that meet them first, so each pair comes out once. Equal codes
are one posting with their ``k`` smallest ids, which are all that a top-k list can need: a vector that makes up a third
of all rows is one posting. The nearest ids are those of the ``k`` nearest codes, of codes equally far those with the
least ids. Segments are 16 bits wide, or wider if there are more codes than such segments have values, and evened out.

Defined results: neighbours are ordered by distance, then id; the query's own row is among them. Rows without a vector
are neither queries nor neighbours; null or NaN components give a zero bit; vectors shorter than the longest one are
filled up with zero bits. Repeated rows are repeated neighbours. With fewer rows than ``k`` all are returned.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from crewgauge.llm.scratch import written

WIDTH = 16
WORD = 64
#: Postings of a leaf and queries of one of its copies, about; prefixes have ``DEPTHS`` bits.
POSTINGS, ASKED, DEPTHS = 1 << 16, 1 << 18, (4, 16)
#: Candidates that are verified at once.
SLICE = 1 << 18
#: Cells of a leaf's table; wider ones are compared one by one.
TABLE_BITS = 20

Segment = tuple[int, int, int]
Words = list[np.ndarray]


def _words(vector: Column, bits: int) -> list[Column]:
    """The code as numbers of 64 bits, the first component in the highest bit."""
    one = lambda x: F.when(F.coalesce((x > 0) & ~F.isnan(x), F.lit(False)), F.lit(1)).otherwise(F.lit(0)).cast("long")
    number = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda n, x: F.shiftleft(n, 1).bitwiseOR(one(x)))
    filled = lambda part, size: F.concat(part, F.array_repeat(F.lit(0).cast("float"), F.lit(size) - F.size(part)))
    return [number(filled(F.slice(vector, at + 1, min(WORD, bits - at)), min(WORD, bits - at))) for at in range(0, bits, WORD)]


def _segments(bits: int, width: int) -> list[Segment]:
    """(word, bits to the right, width) of every segment; none lies across two words."""
    out = []
    for word, at in enumerate(range(0, bits, WORD)):
        right = size = min(WORD, bits - at)
        number = math.ceil(size / width)
        for n in range(number):
            wide = size // number + (n < size % number)
            right -= wide
            out.append((word, right, wide))
    return out


def _value(words: Words, segment: Segment) -> np.ndarray:
    word, right, width = segment
    return (words[word] >> np.uint64(right)) & np.uint64((1 << width) - 1)


@lru_cache(256)
def _flips(bits: int, radius: int) -> np.ndarray:
    """All numbers of ``bits`` bits of which ``radius`` are set."""
    places = np.array(list(combinations(range(bits), radius)), np.uint64).reshape(math.comb(bits, radius), radius)
    return (np.uint64(1) << places).sum(1, dtype=np.uint64)


def _apart(a: Words, b: Words) -> np.ndarray:
    counts = [np.bitwise_count(x ^ y) for x, y in zip(a, b, strict=True)]
    return counts[0] if len(counts) == 1 else sum(c.astype(np.int32) for c in counts)


@dataclass(frozen=True)
class _Leaves:
    """A slot is a segment and a prefix of its values.

    ``parts`` has the number of leaves of each slot, ``first`` the first of them, ``slots`` the slot of each leaf.
    """

    segments: list[Segment]
    depth: int
    parts: np.ndarray
    first: np.ndarray
    slots: np.ndarray

    def low(self, n: int) -> int:
        """The bits of a segment behind the prefix."""
        return self.segments[n][2] - min(self.segments[n][2], self.depth)


def _slots(words: Words, segments: list[Segment], depth: int) -> Iterator[np.ndarray]:
    for n, segment in enumerate(segments):
        yield (n << depth) + (_value(words, segment) >> np.uint64(segment[2] - min(segment[2], depth))).astype(np.int64)


def _leaves(codes: DataFrame, names: list[str], segments: list[Segment]) -> _Leaves:
    depth = max(DEPTHS[0], min(DEPTHS[1], math.ceil(math.log2(max(1, codes.count() / POSTINGS)))))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slots in _slots(_read(batch, names), segments, depth):
                slot, n = np.unique(slots, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n)], ["slot", "n"])

    # at most 2**depth rows a segment
    counts = codes.select(*names).mapInArrow(counted, "slot long, n long").groupBy("slot").agg(F.sum("n")).collect()
    parts = np.zeros(len(segments) << depth, np.int64)
    for slot, n in counts:
        parts[slot] = math.ceil(n / (2 * POSTINGS))
    return _Leaves(segments, depth, parts, np.cumsum(parts) - parts, np.repeat(np.arange(len(parts)), parts))


def _read(rows: pa.RecordBatch | pa.Table, names: list[str]) -> Words:
    return [rows.column(name).to_numpy().view(np.uint64) for name in names]


def _postings(leaves: _Leaves, names: list[str], segments: range, copies: int) -> Callable:
    """The postings of some segments: (key, words, least, size), a key being a copy of a leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _read(batch, names)
            mixed = np.zeros(batch.num_rows, np.uint64)
            for word in words:
                mixed = (mixed ^ word) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(32)
            for n, slots in enumerate(_slots(words, leaves.segments, leaves.depth)):
                if n in segments:
                    leaf = leaves.first[slots] + (mixed % leaves.parts[slots].astype(np.uint64)).astype(np.int64)
                    for copy in range(copies):
                        yield pa.RecordBatch.from_arrays([pa.array(leaf * copies + copy), *batch.columns], ["key", *batch.schema.names])

    return run


def _asked(leaves: _Leaves, names: list[str], segments: range, radius: int, copies: int) -> Callable:
    """The queries, once for every leaf with values at distance ``radius`` from theirs: (key, query, within, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, copy = list(_slots(_read(batch, names), leaves.segments, leaves.depth)), batch.column("query").to_numpy() % copies
            for n in segments:
                low = leaves.low(n)
                for near in range(max(0, radius - low), min(radius, leaves.segments[n][2] - low) + 1):
                    flips = _flips(leaves.segments[n][2] - low, near).astype(np.int64)
                    step = max(1, SLICE // len(flips))
                    for at in range(0, batch.num_rows, step):
                        slots = (own[n][at : at + step, None] ^ flips).ravel()
                        parts = leaves.parts[slots]
                        for part in range(parts.max(initial=0)):
                            there = np.flatnonzero(parts > part)
                            row = at + there // len(flips)
                            key = (leaves.first[slots[there]] + part) * copies + copy[row]
                            yield pa.RecordBatch.from_arrays([pa.array(key), *batch.take(pa.array(row)).columns], ["key", *batch.schema.names])

    return run


def _probed(own: np.ndarray, flips: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(asker, posting): those of the cells that the flips lead to."""
    step = max(1, SLICE // len(flips))
    for at in range(0, len(own), step):
        cell = (own[at : at + step, None] ^ flips).ravel().astype(np.int64)
        first = starts[cell]
        number = starts[cell + 1] - first
        hit = np.flatnonzero(number)
        first, number, asker = first[hit], number[hit], at + hit // len(flips)
        for a, b in pairwise([0, *(np.flatnonzero(np.diff(np.cumsum(number) // SLICE)) + 1), len(hit)]):
            ends = np.cumsum(number[a:b])
            if len(ends):
                yield np.repeat(asker[a:b], number[a:b]), np.repeat(first[a:b] - ends + number[a:b], number[a:b]) + np.arange(ends[-1])


def _compared(own: np.ndarray, cells: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same, found by a look at every posting."""
    step = max(1, SLICE // len(cells))
    for at in range(0, len(own), step):
        asker, row = np.nonzero(np.bitwise_count(own[at : at + step, None] ^ cells) == radius)
        yield at + asker, row


def _nearest(found: list[np.ndarray], least: np.ndarray, gone: np.ndarray, k: int) -> list[np.ndarray]:
    """Of (asker, posting, distance) the ``k`` nearest of each asker, ties by least id."""
    asker, row, distance = found
    order = np.lexsort((least[row], gone[row], distance, asker))
    asker = asker[order]
    new = np.append(True, asker[1:] != asker[:-1])
    at = np.arange(len(asker))
    order = order[at - np.maximum.accumulate(np.where(new, at, 0)) < k]
    return [x[order] for x in found]


def _meet(leaves: _Leaves, names: list[str], radius: int, k: int, copies: int) -> Callable:
    """The pairs that some segment meets first at ``radius`` in a leaf, the ``k`` nearest of each query.

    (query, distance, words, least, size).
    """

    def run(asked: pa.Table, postings: pa.Table) -> pa.Table:
        picked = []
        if asked.num_rows and postings.num_rows:
            slot = int(leaves.slots[postings.column("key")[0].as_py() // copies])
            n, prefix = slot >> leaves.depth, np.uint64(slot & (1 << leaves.depth) - 1)
            low, segment = leaves.low(n), leaves.segments[n]
            postings = postings.take(pa.array(np.argsort(_value(_read(postings, names), segment), kind="stable")))
            words, wanted, within = _read(postings, names), _read(asked, names), asked.column("within").to_numpy()
            gone, least = postings.column("least").is_null().to_numpy(), postings.column("least").fill_null(0).to_numpy()
            mask = np.uint64((1 << low) - 1)
            cells, own = _value(words, segment) & mask, _value(wanted, segment)
            starts = np.append(0, np.cumsum(np.bincount(cells.astype(np.int64), minlength=1 << low))) if low <= TABLE_BITS else None
            away = np.bitwise_count((own >> np.uint64(low)) ^ prefix)
            for near in range(max(0, radius - low), min(radius, segment[2] - low) + 1):
                who, rest = np.flatnonzero(away == near), radius - near
                few = starts is not None and math.comb(low, rest) <= len(cells)
                pairs = _probed(own[who] & mask, _flips(low, rest), starts) if few else _compared(own[who] & mask, cells, rest)
                for asker, row in pairs:
                    asker = who[asker]
                    distance = _apart([w[row] for w in words], [w[asker] for w in wanted])
                    ok = distance <= within[asker]
                    asker, row, distance = asker[ok], row[ok], distance[ok]
                    ours, theirs = [w[row] for w in words], [w[asker] for w in wanted]
                    ok = np.ones(len(row), bool)
                    for other, part in enumerate(leaves.segments):
                        if other != n:
                            apart = np.bitwise_count(_value(ours, part) ^ _value(theirs, part))
                            ok &= apart > radius if other < n else apart >= radius
                    if ok.any():
                        picked.append(_nearest([asker[ok], row[ok], distance[ok]], least, gone, k))
        asker, row, distance = [np.concatenate(x) for x in zip(*picked, strict=True)] if picked else [np.zeros(0, np.int64)] * 3
        if len(picked) > 1:
            asker, row, distance = _nearest([asker, row, distance], least, gone, k)
        found = postings.select([*names, "least", "size"]).take(pa.array(row))
        return pa.table([asked.column("query").take(pa.array(asker)), pa.array(distance.astype(np.int32)), *found.columns], names=["query", "distance", *found.column_names])

    return run


def _bound(names: list[str], bits: int, k: int) -> Callable:
    """A distance within which every query of a leaf has ``k`` neighbours there: (query, within)."""

    def run(asked: pa.Table, postings: pa.Table) -> pa.Table:
        within = np.full(asked.num_rows, bits, np.int32)
        words, wanted = _read(postings, names), _read(asked, names)
        step = max(1, SLICE // max(1, postings.num_rows))
        for at in range(0, asked.num_rows if postings.num_rows else 0, step):
            apart = _apart(words, [w[at : at + step, None] for w in wanted])
            rows = len(apart)
            weights = np.tile(postings.column("size").to_numpy(), rows)
            counts = np.bincount((apart + np.arange(rows)[:, None] * (bits + 1)).ravel(), weights, rows * (bits + 1)).reshape(rows, -1)
            enough = counts.cumsum(1) >= k
            within[at : at + step] = np.where(enough.any(1), enough.argmax(1), bits)
        return pa.table([asked.column("query"), pa.array(within)], names=["query", "within"])

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", width: int | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, distance): the ``k`` rows of ``vectors`` nearest to every row of ``queries``."""
    pick = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v")).where("v is not null")
    rows, asked = pick(vectors), pick(queries)
    total, longest = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    bits = max(longest or 1, asked.agg(F.max(F.size("v"))).first()[0] or 1)
    width = min(bits, WORD, width or max(WIDTH, math.ceil(math.log2(total + 1))))
    segments, needed = _segments(bits, width), min(k, total)
    names = [f"w{n}" for n in range(math.ceil(bits / WORD))]

    def coded(df: DataFrame) -> DataFrame:
        return df.select("id", *(w.alias(n) for w, n in zip(_words(F.col("v"), bits), names, strict=True)))

    nth = F.row_number().over(Window.partitionBy(*names).orderBy(F.asc_nulls_last("id")))
    alike = coded(rows).withColumn("nth", nth).where(F.col("nth") <= k).groupBy(*names)
    ids = F.collect_list(F.struct("id")).alias("ids")
    codes = written(alike.agg(ids, F.min("id").alias("least"), F.count("*").cast("int").alias("size")), "codes")
    queries = written(coded(asked), "queries")
    numbered = written(queries.select(*names).distinct().withColumn("query", F.monotonically_increasing_id()), "askers")
    leaves = _leaves(codes, names, segments)

    types = ", ".join(f"{n} long" for n in names)

    def met(active: DataFrame, of: range, radius: int, copies: int, run: Callable, schema: str) -> DataFrame:
        deal, ask = _postings(leaves, names, of, copies), _asked(leaves, names, of, radius, copies)
        there = codes.select(*names, "least", "size").mapInArrow(deal, f"key long, {types}, least long, size int")
        here = active.select("query", "within", *names).mapInArrow(ask, f"key long, query long, within int, {types}")
        return here.groupBy("key").cogroup(there.groupBy("key")).applyInArrow(run, schema)

    copies = math.ceil(numbered.count() / ASKED)
    start = numbered.select("query", *names, F.lit(bits).alias("within"))
    bounds = met(start, range(1), 0, copies, _bound(names, bits, k), "query long, within int").groupBy("query").agg(F.min("within").alias("bound"))
    bounded = start.join(bounds, "query", "left").withColumn("within", F.coalesce("bound", "within")).drop("bound")
    active = written(bounded, "active")
    best: DataFrame | None = None
    by_query = Window.partitionBy("query").orderBy("distance", F.asc_nulls_last("least"))
    for radius in range(max(w for _, _, w in segments) + 1):
        meet = _meet(leaves, names, radius, k, copies)
        found = met(active, range(len(segments)), radius, copies, meet, f"query long, distance int, {types}, least long, size int")
        merged = found if best is None else found.unionByName(best)
        best = written(merged.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).drop("rank"), "nearest")
        reached = best.withColumn("n", F.sum("size").over(by_query.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        state = reached.where(F.col("n") >= needed).groupBy("query").agg(F.min("distance").alias("farthest"))
        covered = len(segments) * (radius + 1) - 1
        rest = active.join(state, "query", "left").where((F.col("farthest").isNull() & F.lit(needed > 0)) | (F.col("farthest") > covered))
        active = written(rest.withColumn("within", F.least("within", "farthest")).drop("farthest"), "active")
        copies = math.ceil(active.count() / ASKED)
        if not copies:
            break
    near = best.select("query", "distance", *names).join(codes.select(*names, "ids"), names).select("query", "distance", F.inline("ids"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", F.asc_nulls_last("id")))
    ranked = near.withColumn("rank", rank).where(F.col("rank") <= k).join(numbered, "query").drop("query").withColumnRenamed("id", "near")
    # Queries with one code have one answer: each row of theirs takes it.
    out = queries.join(ranked, names)
    return out.select(F.col("id").alias("query_id"), F.col("rank").cast("long"), F.col("near").alias(id_col), F.col("distance").cast("long"))
