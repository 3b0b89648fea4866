"""Exact Jaccard self-join of word n-gram sets as a metric-space join, with the connected components of its links.

Jaccard distance is a metric. Almost all documents of a corpus are at distance 1 from each other, so a few document
pivots would put every document into every window. The join therefore goes down in three steps:

1. *Points.* Texts with equal sets are one point, named by a 128-bit digest of the set.
2. *Regions of projections.* The n-grams are dealt into classes by hash. Two linked sets differ in ``D`` elements at
   most (a bound on their sizes), so with more than ``D`` classes their projections coincide in some class: there their
   distance is 0. Every shared projection is a cell whose smallest point is its pivot; cells with the same pivot are
   one Voronoi region. Sizes are cut into bands, and a set near a band's upper end is replicated into the next. Sets
   with many empty classes, where a coincidence may say nothing, also enter cells of single n-grams (the prefix
   principle). Cells with one point, nearly all, are found from 16 bytes a cell and never touched again.
   There are more classes than ``D + 1``, so a linked set shares several cells; sets that share fewer, such as texts
   with a common passage, leave here.
3. *Recursion.* A region beyond ``LEAF`` points takes some of its points as pivots; each point goes to the nearest, its
   home, and by the triangle inequality also to every pivot within ``2 * eps`` more than that. A link is counted where its
   smaller point is at home. Regions that no longer shrink are cut into blocks, and each two blocks meet in a tile.
   Leaves count common n-grams through an index and compare whole numbers, so the join is exact.

No pairs are shuffled: a leaf returns edges that span its links and, per point, the number of its links. One task holds
at most ``LEAF`` points with ``LEAF_NGRAMS`` n-grams, or a tile of that size. The broadcast is a bit array that grows with the shared cells up to a
fixed size; a full one only leaves more candidates.

``classes`` does without the number of links. There, a region beyond ``BLOCK`` points is first compared block by block; then only the points
outside its largest class meet the others. A dense group of near copies is one class after the first step, so it costs rows in
proportion to its size.

Defined results: null texts and texts without words have the empty set and no links, their component is their own id.
Shorter texts than an n-gram are one n-gram. Repeated rows have equal results; the component of rows with null ids
is the smallest id that is not null, or null. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from crewgauge.llm.components import components
from crewgauge.llm.scratch import written

LEAF = 512
LEAF_NGRAMS = 2_000_000
#: Points of a leaf of which only the classes are wanted.
BLOCK = 4096
#: Pivots that a too large region takes, and how often it is split before it is cut into blocks.
PIVOTS, ROUNDS = 8, 4
#: Most bits of the arrays that tell possibly shared cells: 32 MiB.
BITS = 1 << 28
#: Bytes of text whose cells one part owns: a part's keys, of up to twice that, meet in one task. And keys that a task sorts at once.
PART_BYTES = 1 << 22
#: Least files of an intermediate table, and bytes of text for each further one.
FILES, FILE_BYTES = 8, 1 << 24
HELD_KEYS = 1 << 19
_POINT_BITS = np.uint64((1 << 24) - 1)
_HASHES = 4
_SEEN = 100_000


@dataclass(frozen=True)
class Bound:
    """Two sets are linked if ``den * intersection >= num * union``; sets have ``words`` consecutive words an element."""

    words: int = 4
    num: int = 85
    den: int = 100

    @property
    def eps(self) -> float:
        return 1 - self.num / self.den

    def differ(self, size: int) -> int:
        """How many elements two linked sets of up to ``size`` elements differ in at most."""
        return 2 * (self.den - self.num) * size // (self.den + self.num)

    def band(self, size: int) -> tuple[int, int]:
        """First size of the band that ``size`` is in, and of the next one. Linked sizes are in the same or in adjacent bands."""
        low, width = 1, max(1.6, 1.1 * self.den / self.num)
        while (high := max(low + 1, int(low * width))) <= size:
            low = high
        return low, high


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(text: bytes, words: int) -> np.ndarray:
    """The distinct hashed word n-grams of a text, sorted; A-Z lower-cased, words parted by ASCII white space."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    wide = min(words, len(parts))
    factors = _mixed(np.arange(1, wide + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    total = np.full(len(parts) - wide + 1, wide, np.uint64)
    for n in range(wide):
        total += hashed[n : len(parts) - wide + 1 + n] * factors[n]
    return np.unique(_mixed(total))


def cells(grams: np.ndarray, bound: Bound) -> list[tuple[np.ndarray, int]]:
    """The cells that a set enters, as 64-bit keys, by band, and how many of them every set linked there must share.

    Of ``classes`` projections at most ``differ`` are unequal, so ``spare + 1`` or more are equal; those that are not
    empty are shared cells.
    """
    size, found = len(grams), []
    low, high = bound.band(size)
    bands = [(low, high)]
    if size * bound.den // bound.num >= high:
        bands.append(bound.band(high))
    for low, high in bands:
        if not (differ := bound.differ(high - 1)):
            continue  # such sets are linked only if they are equal
        spare = 4 + differ // 6
        classes = differ + 1 + spare
        own = (grams >> np.uint64(17)) % np.uint64(classes)
        order = np.argsort(own, kind="stable")
        first = np.flatnonzero(np.diff(own[order], prepend=np.uint64(classes)))
        summed = np.add.reduceat(_mixed(grams[order] + np.uint64(low)), first)
        keys = _mixed(summed ^ _mixed(own[order][first] + np.uint64(classes << 32)))
        empty = classes - len(first)
        if empty > spare:
            prefix = size - (bound.num * size + bound.den - 1) // bound.den + 1
            single = _mixed(grams[:prefix] ^ np.uint64(high * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            keys = np.concatenate([keys, single])
        found.append((keys, max(1, spare + 1 - empty)))
    return found


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Id and text of a row in 25 bytes, in the order of the ids, null last."""
    number = F.col(id_col).cast("long")
    ordered = F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    text = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    return F.unhex(F.concat(F.when(number.isNull(), F.lit("01" + "0" * 16)).otherwise(F.concat(F.lit("00"), ordered)), text))


def _texts(docs: DataFrame, id_col: str, text_col: str, id_type: str) -> DataFrame:
    return docs.select(F.col(id_col).cast(id_type).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def _packed(keys: np.ndarray, digest: bytes) -> np.ndarray:
    """Cell and point in 8 bytes: 40 bits of the cell, 24 of the point. What falls together by chance is one more candidate."""
    return (keys & ~_POINT_BITS) | (np.frombuffer(digest[:8], "<u8")[0] & _POINT_BITS)


def _cell_keys(texts: DataFrame, bound: Bound, parts: int) -> DataFrame:
    """(part, keys): every set in every cell that it enters, some megabytes of sorted keys at a time, by the part that owns the cell."""

    def rows(held: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.unique(np.concatenate([np.empty(0, np.uint64), *held]))
        owner = _owner(keys, parts)
        order = np.argsort(owner, kind="stable")
        own, first = np.unique(owner[order], return_index=True)
        blobs = [k.astype("<u8").tobytes() for k in np.split(keys[order], first[1:])] if len(own) else []
        return pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(blobs, pa.binary())], ["part", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total, seen = 0, set()
        for batch in batches:
            for text in batch.column(1):
                grams = ngrams(text.as_py(), bound.words)
                if not len(grams) or (digest := _digest(grams)) in seen:
                    continue
                seen = seen if len(seen) < _SEEN else set()
                seen.add(digest)
                for keys, _ in cells(grams, bound):
                    held.append(_packed(keys, digest))
                    total += len(keys)
                if total > HELD_KEYS:
                    yield rows(held)
                    held, total = [], 0
        yield rows(held)

    return texts.mapInArrow(run, "part long, keys binary")


def _owner(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)


def _bit_positions(cells: np.ndarray, bits: np.ndarray | int) -> np.ndarray:
    """``_HASHES`` positions of every cell, one row each."""
    salts = np.arange(1, _HASHES + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    return _mixed(cells[None, :] + salts) % np.asarray(bits, np.uint64)


def _shared_of(most: int):
    """Of a part's keys: a bit array with the cells (40 bits) that two points or more are in, ``most`` bits at the most."""

    def run(table: pa.Table) -> pa.Table:
        keys = np.unique(np.concatenate([np.frombuffer(k, "<u8") for k in table["keys"].to_pylist()]))
        cell = keys >> np.uint64(24)
        shared = np.unique(cell[1:][cell[1:] == cell[:-1]])
        bits = min(most, 64 << (len(shared) // 4).bit_length())
        array = np.zeros(bits // 64, np.uint64)
        at = np.unique(_bit_positions(shared, bits))
        np.bitwise_or.at(array, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        return pa.Table.from_arrays([table["part"].slice(0, 1), pa.array([array.astype("<u8").tobytes()], pa.binary())], ["part", "bits"])

    return run


class _Cells:
    """Bit arrays of all parts one after the other: which cells may have two points or more."""

    def __init__(self, parts: int, arrays: pa.Table) -> None:
        self.parts = parts
        own = [b""] * parts
        for part, bits in zip(arrays["part"].to_pylist(), arrays["bits"].to_pylist(), strict=True):
            own[part] = bits
        self.size = np.array([max(8 * len(b), 64) for b in own], np.uint64)
        self.first = np.cumsum(self.size) - self.size
        self.words = np.frombuffer(b"".join(b or bytes(8) for b in own), "<u8")

    def shared(self, keys: np.ndarray, need: int) -> np.ndarray:
        """Those keys that may be shared, if there are enough of them for a link."""
        part = _owner(keys, self.parts)
        at = _bit_positions(keys >> np.uint64(24), self.size[part]) + self.first[part]
        kept = keys[((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)]
        return kept if len(kept) >= need else keys[:0]


def _shared_cells(texts: DataFrame, bound: Bound, bits: int):
    """A broadcast of ``_Cells``, and how many files tables of points are written as. Every part has 16 to 32 bits a shared cell, which lets one in 1,000 others or fewer pass, as long as all
    together stay within ``bits``."""
    size = texts.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    keys = _cell_keys(texts, bound, parts)
    arrays = keys.groupBy("part").applyInArrow(_shared_of(max(64, bits // parts // 64 * 64)), "part long, bits binary").toArrow()
    return texts.sparkSession.sparkContext.broadcast(_Cells(parts, arrays)), max(FILES, -(-size // FILE_BYTES))


_POINT_SCHEMA = "point binary, n_shingles long, cells array<long>, grams array<long>"


def _points(texts: DataFrame, bound: Bound, shared) -> DataFrame:
    """One row per document. A set that enters a shared cell also has its cells and n-grams, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entered, seen = shared.value, set()
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for doc_id, text in zip(ids, batch.column(1), strict=True):
                grams = ngrams(text.as_py(), bound.words)
                point, own = _digest(grams) if len(grams) else None, grams[:0]
                if point is not None and point not in seen:
                    own = np.concatenate([own, *(entered.shared(keys, need) for keys, need in cells(grams, bound))])
                if len(own):
                    seen = seen if len(seen) < _SEEN else set()
                    seen.add(point)
                    out.append((doc_id, point, len(grams), own.view(np.int64), grams.view(np.int64)))
                else:
                    out.append((doc_id, point, len(grams), None, None))
                if len(out) >= 512:
                    yield _point_batch(out, batch.schema.field(0).type)
                    out = []
            if out:
                yield _point_batch(out, batch.schema.field(0).type)

    return texts.mapInArrow(run, f"doc_id {dict(texts.dtypes)['doc_id']}, {_POINT_SCHEMA}")


def _point_batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = (id_type, pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    names = ("doc_id", "point", "n_shingles", "cells", "grams")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _regions(points: DataFrame) -> DataFrame:
    """(region, point): the cells with two points or more, those with the same pivot merged."""
    entered = points.where("cells is not null").select("point", F.explode("cells").alias("cell")).distinct()
    pivots = entered.groupBy("cell").agg(F.min("point").alias("pivot"), F.max("point").alias("last")).where("pivot != last")
    return entered.join(pivots, "cell").select(F.xxhash64("pivot").alias("region"), "point").distinct()


def _sized(members: DataFrame) -> DataFrame:
    """(leaf, members, total): how many points and n-grams each leaf has; leaves without a pair to compare are left out."""
    sizes = members.groupBy("leaf").agg(F.count("*").alias("members"), F.sum("n").alias("total"), F.max("core").alias("any_core"))
    return sizes.where("members > 1 and any_core").drop("any_core")


class _Pivots:
    """The pivots of one leaf, and their distances from other points."""

    def __init__(self, grams: list[np.ndarray]) -> None:
        self.size = np.array([len(g) for g in grams])
        self.known, column = np.unique(np.concatenate(grams), return_inverse=True)
        self.has = np.zeros((len(self.known), len(grams)), bool)
        self.has[column, np.repeat(np.arange(len(grams)), self.size)] = True

    def far(self, grams: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, grams), len(self.known) - 1)
        shared = self.has[at[self.known[at] == grams]].sum(axis=0)
        return 1 - shared / (len(grams) + self.size - shared)


def _moved(bound: Bound):
    """Of rows by leaf and slice, the pivots first: every other point once for each pivot that it goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, pivots = None, [], None
        for batch in batches:
            leaf, part, nth, core = (batch.column(c).to_pylist() for c in ("leaf", "slice", "nth", "core"))
            row, to, home = [], [], []
            for n, grams in enumerate(batch.column("grams")):
                if (leaf[n], part[n]) != at:
                    at, own, pivots = (leaf[n], part[n]), [], None
                if nth[n] is not None:
                    own.append(grams.values.to_numpy())
                    continue
                pivots = pivots or _Pivots(own)
                far = pivots.far(grams.values.to_numpy())
                near = np.flatnonzero(far <= far.min() + 2 * bound.eps + 1e-9).tolist()
                row.extend([n] * len(near))
                to.extend(near)
                home.extend(core[n] and m == far.argmin() for m in near)
            kept = batch.select(["region", "leaf", "point", "n"]).take(pa.array(row, pa.int64()))
            columns = [*kept.columns, pa.array(to, pa.int32()), pa.array(home, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["region", "old", "point", "n", "pivot", "core"])

    return run


def _split(members: DataFrame, large: DataFrame, sets: DataFrame, bound: Bound, turn: int) -> DataFrame:
    """Voronoi split of every leaf around some of its points, windows of ``2 * eps`` included.

    The points of a leaf are dealt into slices of about ``LEAF``, and each slice gets the pivots once, not every row.
    """
    nth = F.row_number().over(Window.partitionBy("leaf").orderBy(F.xxhash64("point", F.lit(turn)), "point"))
    slices = large.select("leaf", F.ceil(F.col("members") / LEAF).cast("int").alias("slices"))
    chosen = members.withColumn("nth", nth).where(F.col("nth") <= PIVOTS).join(slices, "leaf")
    chosen = chosen.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    every = members.join(slices, "leaf").withColumn("nth", F.lit(None).cast("int"))
    every = every.withColumn("slice", F.pmod(F.xxhash64("point", "leaf"), "slices").cast("int"))
    names = ("leaf", "slice", "nth", "region", "point", "n", "core")
    rows = chosen.select(*names).unionByName(every.select(*names)).join(sets.select("point", "grams"), "point")
    rows = rows.repartition("leaf", "slice").sortWithinPartitions("leaf", "slice", F.asc_nulls_last("nth"))
    moved = rows.select(*names, "grams").mapInArrow(_moved(bound), "region long, old long, point binary, n long, pivot int, core boolean")
    return moved.select("region", F.xxhash64("old", "pivot", F.lit(turn)).alias("new"), "old", "point", "n", "core")


def _tiles(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Leaves cut into blocks; each two blocks meet in one tile, and a block meets itself."""
    blocks = F.greatest(F.ceil(2 * F.col("members") / LEAF), F.ceil(2 * F.col("total") / LEAF_NGRAMS)).cast("int")
    rows = members.join(sizes.select("leaf", blocks.alias("blocks")), "leaf")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("point", "leaf"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = F.xxhash64("leaf", F.least("block", "other"), F.greatest("block", "other"), F.lit("tile"))
    side = F.when(F.col("block") == F.col("other"), -1).when(F.col("block") < F.col("other"), 0).otherwise(1)
    return rows.select("region", tile.alias("leaf"), "point", "n", "core", side.alias("side"))


def _leaves(regions: DataFrame, sets: DataFrame, bound: Bound, files: int) -> DataFrame:
    """(region, leaf, point, core, side): where every possible link is looked at once."""
    members = regions.join(sets.select("point", F.size("grams").cast("long").alias("n")), "point")
    members = written(members.select("region", F.col("region").alias("leaf"), "point", "n", F.lit(True).alias("core")).coalesce(files), "members")
    whole = F.lit(-1).alias("side")
    done: list[DataFrame] = []
    too_large = F.expr(f"members > {LEAF} or total > {LEAF_NGRAMS}")

    def finish(leaves: DataFrame) -> None:
        """Written at once, so that no later plan holds those of all turns."""
        done.append(written(leaves.select("region", "leaf", "point", "core", "side").coalesce(files), "leaves"))

    for turn in range(ROUNDS + 1):
        sizes = written(_sized(members).coalesce(files), "sizes")
        finish(members.join(sizes.where(~too_large).select("leaf"), "leaf").withColumn("side", whole))
        large = sizes.where(too_large)
        if large.isEmpty():
            break
        rest = members.join(large.select("leaf"), "leaf")
        if turn == ROUNDS:
            finish(_tiles(rest, large))
            break
        parts = written(_split(rest, large, sets, bound, turn).coalesce(files), "parts")
        # a leaf whose largest part has kept nearly all of it doesn't get smaller this way
        kept = parts.groupBy("old", "new").agg(F.count("*").alias("size")).groupBy("old").agg(F.max("size").alias("size"))
        stuck = large.join(kept, F.col("leaf") == F.col("old")).where("size > 0.7 * members").select("leaf", "members", "total")
        stuck = written(stuck.coalesce(files), "stuck")
        finish(_tiles(rest.join(stuck.select("leaf"), "leaf"), stuck))
        members = parts.join(stuck.select(F.col("leaf").alias("old")), "old", "left_anti").select("region", F.col("new").alias("leaf"), "point", "n", "core")
    return reduce(DataFrame.unionByName, done)


class _Leaf:
    """The points of one leaf, compared with each other."""

    def __init__(self, rows: list[tuple], bound: Bound) -> None:
        rows.sort(key=lambda r: r[0])
        self.points, self.copies, grams, self.regions, core, side = zip(*rows, strict=True)
        self.bound, self.region = bound, None
        self.size = np.array([len(g) for g in grams])
        self.core, self.side = np.array(core), np.array(side)
        self.first = np.array([r[0] for r in self.regions])
        row = np.repeat(np.arange(len(rows)), self.size)
        _, self.column = np.unique(np.concatenate(grams), return_inverse=True)
        order = np.argsort(self.column, kind="stable")
        self.listed = row[order]
        self.count = np.bincount(self.column)
        self.start = np.cumsum(self.count) - self.count
        self.ends = np.cumsum(self.size)

    def common(self, n: int) -> np.ndarray:
        """How many n-grams point ``n`` has in common with each point."""
        own = self.column[self.ends[n] - self.size[n] : self.ends[n]]
        own = own[self.count[own] > 1]
        many = self.count[own]
        at = np.repeat(self.start[own] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return np.bincount(self.listed[at], minlength=len(self.points))

    def links(self, region: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each point with the larger points that it is linked with, as far as this region counts them."""
        for n in np.flatnonzero(self.core):
            common = self.common(n)
            union = self.size[n] + self.size - common
            fits = self.bound.den * common >= self.bound.num * union
            fits[: n + 1] = False
            if self.side[n] >= 0:
                fits &= self.side != self.side[n]
            to = np.flatnonzero(fits)
            if not len(to):
                continue
            # a link belongs to the smallest region that both points are in
            plain = self.first[to] == self.first[n]
            mine = [m for m in to[~plain] if np.intersect1d(self.regions[n], self.regions[m], assume_unique=True)[0] == region]
            to = np.concatenate([to[plain] if self.first[n] == region else to[:0], np.array(mine, int)])
            if len(to):
                yield n, to

    def result(self, region: int) -> Iterator[tuple[bytes, bytes | None, int]]:
        """Edges that span the links, and how many links every point has, copies of texts counted."""
        links, root = np.zeros(len(self.points), np.int64), list(range(len(self.points)))
        copies = np.array(self.copies)

        def top(n: int) -> int:
            while root[n] != n:
                root[n] = root[root[n]]
                n = root[n]
            return n

        for n, to in self.links(region):
            links[n] += copies[to].sum()
            links[to] += copies[n]
            for m in to.tolist():
                if (a := top(n)) != (b := top(m)):
                    root[b] = a
                    yield self.points[n], self.points[m], 0
        for n in np.flatnonzero(links):
            yield self.points[n], None, int(links[n])


def _compared(leaves: DataFrame, sets: DataFrame, bound: Bound) -> DataFrame:
    """(a, b, links): spanning edges, and with null ``b`` the links of each point in its leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            out: list[tuple] = []
            leaf, region, point, copies, core, side = (batch.column(c).to_pylist() for c in (0, 1, 2, 3, 6, 7))
            grams, regions = batch.column(4), batch.column(5)
            for n in range(batch.num_rows):
                if (leaf[n], region[n]) != at:
                    if len(rows) > 1:
                        out.extend(_Leaf(rows, bound).result(at[1]))
                    at, rows = (leaf[n], region[n]), []
                rows.append((point[n], copies[n], grams[n].values.to_numpy(), regions[n].values.to_numpy(), core[n], side[n]))
            if out:
                yield _edge_batch(out)
        if len(rows) > 1:
            yield _edge_batch(list(_Leaf(rows, bound).result(at[1])))

    rows = leaves.join(sets, "point").repartition("leaf").sortWithinPartitions("leaf", "region")
    return rows.select("leaf", "region", "point", "copies", "grams", "regions", "core", "side").mapInArrow(run, "a binary, b binary, links long")


def _edge_batch(rows: list[tuple]) -> pa.RecordBatch:
    a, b, links = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(links, pa.int64())], ["a", "b", "links"])


class _Block(_Leaf):
    """Points of which only the classes are wanted: those of one class need not be compared with each other."""

    def __init__(self, rows: list[tuple], bound: Bound) -> None:
        super().__init__([(point, 1, grams, np.zeros(1, np.int64), core, side) for point, grams, core, side in rows], bound)

    def edges(self) -> Iterator[tuple[bytes, bytes]]:
        """Edges that join the points of each class.

        A point is compared with all others at once. When every point outside the largest class has had its turn, what is
        left are links within that class. So a block of near copies takes a few turns, not one for each point.
        """
        label = np.arange(len(self.points))
        waiting = self.core.copy()
        largest = 0
        while len(turn := np.flatnonzero(waiting & (label != largest)) if self.core.all() else np.flatnonzero(waiting)):
            n = turn[0]
            waiting[n] = False
            common = self.common(n)
            fits = self.bound.den * common >= self.bound.num * (self.size[n] + self.size - common)
            if self.side[n] >= 0:
                fits &= self.side != self.side[n]
            classes, first = np.unique(label[fits], return_index=True)
            others = np.flatnonzero(fits)[first[classes != label[n]]]
            if len(others):
                for m in others.tolist():
                    yield self.points[n], self.points[m]
                label[np.isin(label, classes)] = label[n]
                largest = np.bincount(label).argmax()


def _edges(leaves: DataFrame, sets: DataFrame, bound: Bound) -> DataFrame:
    """(a, b): edges that join the classes of every leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []

        def found() -> pa.RecordBatch:
            pairs = list(_Block(rows, bound).edges()) if len(rows) > 1 else []
            a, b = zip(*pairs, strict=True) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

        for batch in batches:
            leaf, point, core, side = (batch.column(c).to_pylist() for c in ("leaf", "point", "core", "side"))
            for n, grams in enumerate(batch.column("grams")):
                if leaf[n] != at:
                    if len(rows) > 1:
                        yield found()
                    at, rows = leaf[n], []
                rows.append((point[n], grams.values.to_numpy(), core[n], side[n]))
        yield found()

    rows = leaves.join(sets.select("point", "grams"), "point").repartition("leaf").sortWithinPartitions("leaf")
    return written(rows.select("leaf", "point", "grams", "core", "side").mapInArrow(run, "a binary, b binary"), "edges")


def _blocks(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Regions as leaves; those beyond a block cut into blocks by a hash of the point."""
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("total") / LEAF_NGRAMS))
    rows = members.join(sizes.select("region", blocks.alias("blocks")), "region")
    leaf = F.xxhash64("region", F.pmod(F.xxhash64("point", "region"), "blocks"))
    return rows.select(leaf.alias("leaf"), "point", F.lit(True).alias("core"), F.lit(-1).alias("side"))


def _rest(members: DataFrame, large: DataFrame, edges: DataFrame, files: int) -> DataFrame:
    """Of regions beyond a block: each point, and whether it is outside the region's largest class so far."""
    classes = components(edges)
    named = members.join(large.select("region"), "region").join(classes.withColumnRenamed("node", "point"), "point", "left")
    named = written(named.withColumn("component", F.coalesce("component", "point")).coalesce(files), "classes")
    counts = named.groupBy("region", "component").agg(F.count("*").alias("size"))
    largest = counts.groupBy("region").agg(F.max(F.struct("size", "component")).alias("top")).select("region", "top.component")
    return named.join(largest.withColumnRenamed("component", "largest"), "region").withColumn("core", F.col("component") != F.col("largest"))


def _outside(rest: DataFrame) -> DataFrame:
    """Leaves in which every point outside the largest class meets every point of its region.

    Links within the largest class are known as far as they matter, so a region that is one class is done, and one with few points
    outside costs each point as many rows as these fill blocks.
    """
    half, grams = BLOCK // 2, LEAF_NGRAMS // 2
    sizes = rest.groupBy("region").agg(
        F.count("*").alias("members"), F.sum("n").alias("total"), F.count_if("core").alias("outside"), F.sum(F.when(F.col("core"), F.col("n"))).alias("load")
    ).where("outside > 0")
    cut = lambda count, load: F.greatest(F.ceil(F.col(count) / half), F.ceil(F.col(load) / grams)).cast("int")
    rows = rest.join(sizes.select("region", cut("members", "total").alias("all_blocks"), cut("outside", "load").alias("own_blocks")), "region")
    number = F.xxhash64("point", "region")
    every = rows.withColumn("own", F.explode(F.sequence(F.lit(0), F.col("own_blocks") - 1))).withColumn("all", F.pmod(number, "all_blocks"))
    outer = rows.where("core").withColumn("all", F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1))).withColumn("own", F.pmod(number, "own_blocks"))
    leaf = F.xxhash64("region", F.col("own").cast("long"), F.col("all").cast("long"), F.lit("outside")).alias("leaf")
    sides = (every.select(leaf, "point", F.lit(False).alias("core"), F.lit(1).alias("side")), outer.select(leaf, "point", F.lit(True).alias("core"), F.lit(0).alias("side")))
    return sides[0].unionByName(sides[1])


def _linked(regions: DataFrame, sets: DataFrame, bound: Bound, files: int) -> DataFrame:
    """(node, component) of the points of all regions."""
    members = regions.join(sets.select("point", F.size("grams").cast("long").alias("n")), "point")
    members = written(members.select("region", "point", "n").coalesce(files), "members")
    sizes = written(members.groupBy("region").agg(F.count("*").alias("members"), F.sum("n").alias("total")).coalesce(files), "sizes")
    edges = _edges(_blocks(members, sizes), sets, bound)
    large = sizes.where(f"members > {BLOCK} or total > {LEAF_NGRAMS}")
    if not large.isEmpty():
        edges = edges.unionByName(_edges(_outside(written(_rest(members, large, edges, files).coalesce(files), "rest")), sets, bound))
    return components(edges)


def _found(docs: DataFrame, bound: Bound, id_col: str, text_col: str, bits: int, id_type: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Points by row, points with their copies, the regions of points, and how many files tables of points are written as."""
    texts = _texts(docs, id_col, text_col, id_type)
    shared, files = _shared_cells(texts, bound, bits)
    points = written(_points(texts, bound, shared), "points")
    shared.destroy()
    copies = written(points.where("point is not null").groupBy("point").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")).coalesce(files), "copies")
    return points, copies, written(_regions(points).coalesce(files), "regions"), files


def join(docs: DataFrame, bound: Bound = Bound(), id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, id_type: str = "long") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id and n_links (other rows that it is linked with)."""
    points, copies, regions, files = _found(docs, bound, id_col, text_col, bits, id_type)
    listed = regions.groupBy("point").agg(F.sort_array(F.collect_set("region")).alias("regions"))
    sets = points.where("cells is not null").select("point", "grams").dropDuplicates(["point"])
    sets = written(sets.join(listed, "point").join(copies.select("point", "copies"), "point").coalesce(files), "sets")
    found = written(_compared(_leaves(regions, sets, bound, files), sets, bound).repartition("a").coalesce(files), "links")
    connected = components(found.where("b is not null").select("a", "b"))
    links = found.where("b is null").groupBy(F.col("a").alias("point")).agg(F.sum("links").alias("links"))
    return _report(points, copies, connected, links)


def classes(docs: DataFrame, bound: Bound = Bound(), id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, id_type: str = "long") -> DataFrame:
    """``join`` without the number of links, which spares the comparison of points that are known to be in one class."""
    points, copies, regions, files = _found(docs, bound, id_col, text_col, bits, id_type)
    entered = regions.select("point").distinct()
    sets = written(points.where("cells is not null").select("point", "grams").dropDuplicates(["point"]).join(entered, "point").coalesce(files), "sets")
    connected = _linked(regions, sets, bound, files)
    none = connected.select(F.col("node").alias("point"), F.lit(0).cast("long").alias("links")).limit(0)
    return _report(points, copies, connected, none).drop("n_links")


def _report(points: DataFrame, copies: DataFrame, connected: DataFrame, links: DataFrame) -> DataFrame:
    own: Column = F.coalesce("component", "point")
    named = copies.join(connected.withColumnRenamed("node", "point"), "point", "left").withColumn("component", own)
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = named.join(least, "component").join(links, "point", "left")
    known = known.select("point", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    empty = F.col("point").isNull()
    return points.select("doc_id", "point", "n_shingles").join(known, "point", "left").select(
        "doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
    )
