"""Removal of repeated passages by prefix-free parsing.

Every byte that lies in a string of ``LENGTH`` bytes which also starts somewhere else goes; strings are judged on the
texts as they come in, and none crosses two texts.

A rolling hash over ``TRIGGER`` bytes marks cuts, which depend on the text alone, so equal passages are cut alike. The
stretch from one cut to the next is a phrase. A window of ``LENGTH`` bytes is a suffix of the phrase in which it
starts, of ``a`` bytes up to its first cut, followed by the parse behind that cut. Windows are equal if and only if both parts are. In corpus
order windows are told apart by the class of the phrase suffix and then by that of the parse suffix; since only
neighbours that share all ``LENGTH`` bytes matter, classes are named by digests and are never put in alphabetical order,
which would need the suffix array of all distinct phrases in one place. The classes are refined in three rounds:

1. parse suffixes: 8 + 200 bytes from each cut on. A cut whose suffix is nowhere else has no repeated window with ``a <= 200``.
2. whole phrases: the phrase with all that its windows reach. Equal ones have equal windows, and are repeated.
3. phrase suffixes: single windows, for phrases that agree with others in the parse suffix but not in all they reach, which
   happens at both ends of a repeated passage. One phrase of each class of round 2 speaks for all.

Windows without a cut in their first 200 bytes (long phrases: repeated characters and the like) are compared as they are, in rounds 1 and 3.

A round sends sorted digests, each once for a chunk of texts, to the part that owns them by hash, and an answer of a byte each back; so a
digest that is in a third of all texts is sent once a chunk. Digests of rounds 2 and 3 have 128 bits. Texts without anything repeated leave after round 1.

Defined results: null and empty texts, and texts shorter than ``LENGTH``, keep all their bytes. Repeated rows are
occurrences of their own, so all copies of a text of ``LENGTH`` bytes or more lose everything. Null ids are kept. Columns other than id and
text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from crewgauge.llm.periodic_runs import _chunks, _ranges
from crewgauge.llm.scratch import written

LENGTH = 400
#: Bytes of a trigger, and the mean distance of cuts.
TRIGGER = 8
SPACING = 32
#: Suffixes of phrases up to this length are found by the cut behind them.
REACH = 200
#: Characters of text in a chunk.
CHUNK = 1 << 21

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Digests of any stretch of a text from its running sums, modulo 2**64."""

    def __init__(self, which: int) -> None:
        self.base, self.inverse = _ODD[which], pow(_ODD[which], -1, 1 << 64)
        seeds = (hashlib.blake2b(bytes([which, byte]), digest_size=8).digest() for byte in range(256))
        self.value = np.frombuffer(b"".join(seeds), "<u8")
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, text: np.ndarray) -> np.ndarray:
        if len(self.up) < len(text) + 1:
            self.up, self.down = _powers(self.base, len(text) + 1), _powers(self.inverse, len(text) + 1)
        out = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(self.value[text] * self.up[: len(text)], out=out[1:])
        return out


_hashers: list[Hasher] = []


def _hasher(which: int) -> Hasher:
    if not _hashers:
        _hashers.extend(Hasher(n) for n in range(len(_ODD)))
    return _hashers[which]


def _covered(size: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


@dataclass(frozen=True)
class Parse:
    """The parse of some texts, one after the other in ``data``."""

    data: bytes
    sizes: np.ndarray

    @cached_property
    def text(self) -> np.ndarray:
        return np.frombuffer(self.data, np.uint8)

    @cached_property
    def _first_sums(self) -> np.ndarray:
        return _hasher(0).sums(self.text)

    @cached_property
    def _second_sums(self) -> np.ndarray:
        return _hasher(1).sums(self.text)

    def digest(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._first_sums[end] - self._first_sums[start]) * _hasher(0).down[start]

    def second(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._second_sums[end] - self._second_sums[start]) * _hasher(1).down[start]

    @cached_property
    def ends(self) -> np.ndarray:
        return np.cumsum(self.sizes)

    @cached_property
    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The cuts with windows, and the least and most bytes ``a`` of these before the cut."""
        at = np.arange(max(len(self.text) - TRIGGER + 1, 0))
        trigger = at[(self.digest(at, at + TRIGGER) >> np.uint64(40)) % np.uint64(SPACING) == 0]
        doc = np.searchsorted(self.ends, trigger, "right")
        inside = trigger + TRIGGER <= self.ends[doc] if len(doc) else np.empty(0, bool)
        cut, doc = trigger[inside] + TRIGGER, doc[inside]
        begin, end = self.ends[doc] - self.sizes[doc], self.ends[doc]
        last = np.append(np.int64(-REACH), cut[:-1])
        last = np.where(last > begin, last, begin - REACH)  # no cut before it in this text
        most = np.minimum(np.minimum(cut - last + TRIGGER - 1, REACH), cut - begin)
        least = np.maximum(TRIGGER, cut + LENGTH - end)
        some = least <= most
        return cut[some], least[some], most[some]

    @cached_property
    def alone(self) -> np.ndarray:
        """Where windows start that have no cut within reach."""
        cut, least, most = self.phrases
        covered = _covered(len(self.text) + 1, cut - most, cut - least + 1)
        begins = self.ends - self.sizes
        whole = _covered(len(self.text) + 1, begins, np.maximum(self.ends - LENGTH + 1, begins))
        return np.flatnonzero(whole & ~covered)

    def parse_keys(self) -> np.ndarray:
        """Round 1: one digest for each phrase, then for each window without one."""
        cut, _, _ = self.phrases
        lone = self.digest(self.alone, self.alone + LENGTH) ^ np.uint64(_ODD[1])
        return np.concatenate([self.digest(cut - TRIGGER, cut + LENGTH - REACH), lone])[:, None]

    def phrase_keys(self, which: np.ndarray) -> np.ndarray:
        """Round 2, for some of the phrases: the digest of round 1 and two of all their windows reach."""
        cut, least, most = (c[which] for c in self.phrases)
        start, end = cut - most, cut - least + LENGTH
        shape = (most * LENGTH + least).astype(np.uint64) * np.uint64(_ODD[0])
        return np.stack([self.digest(cut - TRIGGER, cut + LENGTH - REACH), self.digest(start, end) ^ shape, self.second(start, end) + shape], axis=1)

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows of some of the phrases start, and the place of their phrase in ``which``."""
        cut, least, most = (c[which] for c in self.phrases)
        return _ranges(cut - most, cut - least + 1)

    def window_keys(self, start: np.ndarray) -> np.ndarray:
        """Round 3: two digests of each window."""
        return np.stack([self.digest(start, start + LENGTH), self.second(start, start + LENGTH)], axis=1)


def _distinct(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct rows, their weights (2 stands for more) and the distinct row of each row."""
    order = np.lexsort(keys.T[::-1])
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(new) - 1
    total = np.bincount(group, weight, minlength=int(new.sum()))
    return ordered[new], np.minimum(total, 2).astype(np.uint8), group


@dataclass(frozen=True)
class Asked:
    """The distinct digests that a chunk asks for, by the part that owns them."""

    keys: np.ndarray
    weight: np.ndarray
    group: np.ndarray
    owner: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, weight: np.ndarray, parts: int) -> Asked:
        keys, weight, group = _distinct(keys, weight)
        return Asked(keys, weight, group, ((keys[:, 0] >> np.uint64(20)) % np.uint64(parts)).astype(np.int64))

    def rows(self, chunk: int) -> pa.RecordBatch:
        parts = np.unique(self.owner)
        own = [self.owner == p for p in parts]
        keys = [self.keys[o].astype("<u8").tobytes() for o in own]
        weights = [self.weight[o].tobytes() for o in own]
        columns = [pa.array([chunk] * len(parts), pa.int64()), pa.array(parts, pa.int64()), pa.array(keys, pa.binary()), pa.array(weights, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "part", "keys", "weights"])

    def answered(self, answers: dict[int, bytes]) -> np.ndarray:
        """The answer to each key as it was asked, from the answers by part."""
        found = np.zeros(len(self.keys), np.uint8)
        for part, answer in answers.items():
            found[self.owner == part] = np.frombuffer(answer, np.uint8)
        return found[self.group]


_ASKED = "chunk bigint, part bigint, keys binary, weights binary"
_ANSWERS = "round int, chunk bigint, part bigint, answer binary"
#: Bits of an answer: it is repeated; phrases that differ share its parse suffix; this chunk speaks for it.
REPEATED, MIXED, SPEAKS = 1, 2, 4


def _answers(width: int, round_no: int):
    def answer(table: pa.Table) -> pa.Table:
        chunks = table["chunk"].to_numpy()
        raw = [np.frombuffer(k, "<u8").reshape(-1, width) for k in table["keys"].to_pylist()]
        keys = np.concatenate(raw)
        weight = np.frombuffer(b"".join(table["weights"].to_pylist()), np.uint8)
        sizes = np.array([len(r) for r in raw])
        distinct, total, group = _distinct(keys, weight)
        bits = (total > 1) * np.uint8(REPEATED)
        first = distinct[:, 0]
        shared = np.zeros(len(first), bool)
        shared[1:] = first[1:] == first[:-1]
        shared[:-1] |= shared[1:]
        bits = (bits | shared * np.uint8(MIXED))[group]
        source = np.repeat(chunks, sizes)
        order = np.lexsort((source, group))
        speaks = np.ones(len(order), bool)
        speaks[1:] = group[order[1:]] != group[order[:-1]]
        bits[order[speaks]] |= np.uint8(SPEAKS)
        cuts = np.cumsum(sizes)
        data = bits.astype(np.uint8).tobytes()
        answers = [data[e - s : e] for s, e in zip(sizes, cuts, strict=True)]
        columns = [pa.array([round_no] * len(sizes), pa.int32()), table["chunk"], table["part"], pa.array(answers, pa.binary())]
        return pa.Table.from_arrays(columns, ["round", "chunk", "part", "answer"])

    return answer


def _answered(asked: DataFrame, width: int, round_no: int) -> DataFrame:
    """What the owners of the digests say, by chunk and part."""
    return written(asked.groupBy("part").applyInArrow(_answers(width, round_no), _ANSWERS), f"answers{round_no}")


def _by_part(answers: pa.Table, round_no: int) -> dict[int, bytes]:
    rows = zip(answers["round"].to_pylist(), answers["part"].to_pylist(), answers["answer"].to_pylist(), strict=True)
    return {part: answer for number, part, answer in rows if number == round_no}


_CHUNK = "chunk bigint, ids array<bigint>, sizes array<bigint>, data binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor()
    for batch in batches:
        texts = batch.column(1).to_pylist()
        ids = batch.column(0).to_pylist()
        for a, b in _chunks(texts, CHUNK):
            coded = [(t or "").encode() for t in texts[a:b]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[a:b]], pa.list_(pa.int64())), pa.array([[len(c) for c in coded]], pa.list_(pa.int64())),
                 pa.array([packer.compress(b"".join(coded))], pa.binary())], ["ids", "sizes", "data"]
            )


def _parses(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, list, Parse]]:
    opener = zstandard.ZstdDecompressor()
    columns = (batch.column(c).to_pylist() for c in ("chunk", "ids", "sizes", "data"))
    for chunk, ids, sizes, data in zip(*columns, strict=True):
        yield chunk, ids, Parse(opener.decompress(data), np.array(sizes, np.int64))


def _ask_parse(parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, _, parse in _parses(batch):
                keys = parse.parse_keys()
                yield Asked.of(keys, np.ones(len(keys), np.uint8), parts).rows(chunk)

    return ask


_DONE = "array<struct<doc_id:bigint,n_bytes:bigint,spans:array<struct<start:bigint,end:bigint>>,kept:binary,kept_sha256:string>>"
_DONE_TYPE = pa.list_(pa.struct([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("kept", pa.binary()), ("kept_sha256", pa.string()),
]))
#: What goes on after round 1, and the texts that are done with. ``marks``: which phrases and lone windows are repeated.
_OPEN = f"{_CHUNK}, marks binary, done {_DONE}"


def _result(doc_id: int | None, data: bytes, gone: np.ndarray | None, with_text: bool) -> dict:
    spans, kept = [], data
    if gone is not None and gone.any():
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
        spans = [{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()]
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
    return {
        "doc_id": doc_id, "n_bytes": len(data), "spans": spans, "kept": kept if with_text else None,
        "kept_sha256": hashlib.sha256(kept).hexdigest(),
    }


def _sift(parts: int, with_text: bool):
    """Texts without a repeated digest of round 1 are done with; the rest stays, with marks on what is repeated."""

    def sift(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        packer = zstandard.ZstdCompressor()
        out: list[list] = [[] for _ in range(6)]
        for chunk, ids, parse in _parses(chunks):
            keys = parse.parse_keys()
            mark = Asked.of(keys, np.ones(len(keys), np.uint8), parts).answered(_by_part(answers, 1)) & REPEATED > 0
            place = np.concatenate([parse.phrases[0] - TRIGGER, parse.alone])
            doc = np.searchsorted(parse.ends, place, "right")
            stays = np.zeros(len(ids), bool)
            stays[doc[mark]] = True
            texts = np.split(parse.text, parse.ends[:-1])
            done = [_result(i, t.tobytes(), None, with_text) for i, t, s in zip(ids, texts, stays.tolist(), strict=True) if not s]
            row = (
                chunk, [i for i, s in zip(ids, stays.tolist(), strict=True) if s], parse.sizes[stays].tolist(),
                packer.compress(b"".join(t.tobytes() for t, s in zip(texts, stays.tolist(), strict=True) if s)),
                np.packbits(mark[stays[doc]]).tobytes(), done,
            )
            for column, value in zip(out, row, strict=True):
                column.append(value)
        longs = pa.list_(pa.int64())
        types = [pa.int64(), longs, longs, pa.binary(), pa.binary(), _DONE_TYPE]
        names = ["chunk", "ids", "sizes", "data", "marks", "done"]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return sift


def _marked(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, list, Parse, np.ndarray, np.ndarray]]:
    """Each chunk with its repeated phrases (their numbers) and the starts of its repeated lone windows."""
    for (chunk, ids, parse), marks in zip(_parses(batch), batch.column("marks").to_pylist(), strict=True):
        phrases = len(parse.phrases[0])
        mark = np.unpackbits(np.frombuffer(marks, np.uint8), count=phrases + len(parse.alone)) > 0
        yield chunk, ids, parse, np.flatnonzero(mark[:phrases]), parse.alone[mark[phrases:]]


def _ask_phrases(parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, _, parse, which, _ in _marked(batch):
                yield Asked.of(parse.phrase_keys(which), np.ones(len(which), np.uint8), parts).rows(chunk)

    return ask


def _spoken(parse: Parse, which: np.ndarray, lone: np.ndarray, said: Asked, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that this chunk sends in round 3, and their weights."""
    first = np.zeros(len(which), bool)
    first[np.unique(said.group, return_index=True)[1]] = True  # of equal phrases in the chunk, one speaks
    sends = first & (bits & MIXED > 0) & (bits & SPEAKS > 0)
    start, phrase = parse.windows(which[sends])
    weight = 1 + (bits[sends] & REPEATED)[phrase]
    return np.concatenate([start, lone]), np.concatenate([weight, np.ones(len(lone), np.uint8)])


def _phrase_answers(parse: Parse, which: np.ndarray, answers: pa.Table, parts: int) -> tuple[Asked, np.ndarray]:
    said = Asked.of(parse.phrase_keys(which), np.ones(len(which), np.uint8), parts)
    return said, said.answered(_by_part(answers, 2))


def _ask_windows(parts: int):
    def ask(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for chunk, _, parse, which, lone in _marked(chunks):
            start, weight = _spoken(parse, which, lone, *_phrase_answers(parse, which, answers, parts))
            out.append(Asked.of(parse.window_keys(start), weight, parts).rows(chunk))
        return pa.Table.from_batches(out, pa.schema([("chunk", pa.int64()), ("part", pa.int64()), ("keys", pa.binary()), ("weights", pa.binary())]))

    return ask


def _finish(parts: int, with_text: bool):
    def finish(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[dict] = []
        for _, ids, parse, which, lone in _marked(chunks):
            said, bits = _phrase_answers(parse, which, answers, parts)
            start, weight = _spoken(parse, which, lone, said, bits)
            asked = Asked.of(parse.window_keys(start), weight, parts)
            hit = start[asked.answered(_by_part(answers, 3)) & REPEATED > 0]
            sure, _ = parse.windows(which[bits & REPEATED > 0])
            start = np.concatenate([hit, sure])
            gone = _covered(len(parse.text), start, start + LENGTH)
            for doc_id, end, size in zip(ids, parse.ends.tolist(), parse.sizes.tolist(), strict=True):
                out.append(_result(doc_id, parse.data[end - size : end], gone[end - size : end], with_text))
        return pa.Table.from_pylist(out, pa.schema(list(_DONE_TYPE.value_type)))

    return finish


def _parts(total: int) -> int:
    """How many parts own the digests: 32 MB of text each up to 128 GB, then 4,096 up to 1 TB, then 256 MB each."""
    return max(1, -(-total // min(1 << 28, max(1 << 25, total // 4096))))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (the maximal removed runs of bytes, end exclusive), kept (the other bytes
    one after the other, null unless wanted) and kept_sha256."""
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    packed = texts.mapInArrow(_packed, "ids array<bigint>, sizes array<bigint>, data binary")
    chunks = written(packed.withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    total = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda x, y: x + y))).first()[0] or 0
    parts = _parts(total)
    by_chunk = chunks.select("chunk", "ids", "sizes", "data")

    first = _answered(by_chunk.mapInArrow(_ask_parse(parts), _ASKED), 1, 1)
    sifted = by_chunk.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(_sift(parts, with_text), _OPEN)
    sifted = written(sifted, "sifted")
    still = sifted.where(F.size("ids") > 0).drop("done")

    second = _answered(still.mapInArrow(_ask_phrases(parts), _ASKED), 3, 2)
    asked = still.groupBy("chunk").cogroup(second.groupBy("chunk")).applyInArrow(_ask_windows(parts), _ASKED)
    third = _answered(asked, 2, 3)

    answers = second.unionByName(third)
    row = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary, kept_sha256 string"
    last = still.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_finish(parts, with_text), row)
    return sifted.select(F.inline("done")).unionByName(last)
