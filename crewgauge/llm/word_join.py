"""Token ids of texts through a table of distinct words: every distinct word is encoded once, its ids are joined back by position.

1. ``sliced``: every task cuts its texts into words (the tokenizer's own pre-tokens, which it encodes independently) and numbers
   the distinct words of a slice, a bounded stretch of its rows. A text becomes the numbers of its words. This is written once,
   in buckets by slice, so that the texts are not shuffled afterwards.
2. ``word_ids``: the slices' distinct words meet by word in one sorted order, so that a word that occurs in many slices is
   encoded once; its ids go back to each slice under the number it has there.
3. ``encoded``: a slice's texts meet the ids of its words and are put together by position.

Only distinct words of slices are shuffled, never occurrences: a word that makes up a third of all text is one row a slice. A
slice ends after ``words`` distinct words or ``letters`` characters, so a task holds that much and one text at most. Which rows
share a slice does not matter to any result.

Defined results: a null text counts as empty and has no ids. A text with the string of an added token is one word, encoded as
a whole. Repeated rows and null ids are rows of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from crewgauge.llm.scratch import bucketed
from crewgauge.llm.words import WordEncoder, added_tokens

#: A slice ends after so many distinct words or characters.
SLICE_WORDS, SLICE_LETTERS = 500_000, 48_000_000
#: Rows of a block, words of a row of the word list, words that a task encodes before it hands them on.
_BLOCK_ROWS, _BLOCK_WORDS, _LIST_WORDS, _HELD_WORDS = 256, 100_000, 20_000, 400_000
_KEPT_STRETCHES = 100_000
_SLICES = "slice long, base int, ids array<long>, many binary, codes binary, words array<string>"
_ENTRIES = "slice long, places binary, sizes binary, tokens binary"


class _Places(dict):
    """The number of every word in the order of first occurrence."""

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        return place


class _Numbered(dict):
    """The numbers of the words in a stretch of text without white space inside; a table of bounded size that can be emptied."""

    def __init__(self, places: _Places, pre_tokens) -> None:
        self.place, self.pre_tokens = places.__getitem__, pre_tokens

    def __missing__(self, stretch: str) -> tuple[int, ...]:
        if len(self) >= _KEPT_STRETCHES:
            self.clear()
        self[stretch] = numbers = tuple(map(self.place, self.pre_tokens(stretch)))
        return numbers


def _packed(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _codes(at: np.ndarray, base: int) -> np.ndarray:
    """Numbers of words as 0 where a word is met for the first time, else one more; ``base`` words were met before."""
    seen = np.maximum.accumulate(np.append(base - 1, at))[:-1]
    return np.where(at > seen, 0, at + 1)


def _numbers(codes: np.ndarray, base: int) -> np.ndarray:
    new = codes == 0
    return np.where(new, np.cumsum(new) + (base - 1), codes.astype(np.int64) - 1)


def sliced(
    docs: DataFrame, kind: type[WordEncoder], tokenizer_path: str, id_col: str, text_col: str, words: int, letters: int
) -> DataFrame:
    """The written slices: rows with the texts of a block of rows as numbers of words, and rows with lists of words."""
    from tokenizers import Tokenizer

    added, split = added_tokens(Tokenizer.from_file(tokenizer_path)), kind.split
    pre_tokens = kind.pre_tokens
    schema = pa.schema([
        ("slice", pa.int64()), ("base", pa.int32()), ("ids", pa.list_(pa.int64())), ("many", pa.binary()),
        ("codes", pa.binary()), ("words", pa.list_(pa.string())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        places, length = _Places(), 0
        numbered = _Numbered(places, pre_tokens)
        ids, many, at, base = [], [], [], 0

        def row(**values) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"slice": number, **values}], schema)

        def block() -> pa.RecordBatch:
            codes = _codes(np.array(at, np.int64), base)
            return row(base=base, ids=ids, many=_packed(np.array(many, np.int64)), codes=_packed(codes))

        def lists() -> Iterator[pa.RecordBatch]:
            known = list(places)
            for start in range(0, len(known), _LIST_WORDS):
                yield row(base=start, words=known[start : start + _LIST_WORDS])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                before = len(at)
                if any(t in text for t in added):
                    at.append(places[text])
                else:
                    at.extend(chain.from_iterable(map(numbered.__getitem__, split(text))))
                ids.append(doc_id)
                many.append(len(at) - before)
                length += len(text)
                full = len(places) >= words or length >= letters
                if full or len(ids) >= _BLOCK_ROWS or len(at) >= _BLOCK_WORDS:
                    yield block()
                    ids, many, at, base = [], [], [], len(places)
                if full:
                    yield from lists()
                    places, length, base, number = _Places(), 0, 0, number + 1
                    numbered = _Numbered(places, pre_tokens)
        if ids:
            yield block()
        yield from lists()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, _SLICES)
    return bucketed(rows, "slices", "slice")


def word_ids(slices: DataFrame, kind: type[WordEncoder], tokenizer_path: str) -> DataFrame:
    """(slice, places, sizes, tokens): the ids of words under their numbers in each slice, several words a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kind(tokenizer_path)
        last: dict[str, bytes] = {}
        held: list[tuple[np.ndarray, np.ndarray, list[bytes]]] = []

        def packed() -> pa.RecordBatch:
            slice_of, place = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            tokens = [ids for h in held for ids in h[2]]
            order = np.lexsort((place, slice_of))
            slice_of, place = slice_of[order], place[order]
            starts = np.flatnonzero(np.append(True, slice_of[1:] != slice_of[:-1]))
            out = []
            for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True):
                mine = [tokens[k] for k in order[a:b].tolist()]
                sizes = np.fromiter(map(len, mine), np.int64, len(mine)) // 4
                steps = np.diff(place[a:b], prepend=0)
                out.append((int(slice_of[a]), _packed(steps), _packed(sizes), _packed(np.frombuffer(b"".join(mine), "<u4"))))
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["slice", "places", "sizes", "tokens"])

        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column(0).to_pylist()
            found = encoder.encode_units([w for w in dict.fromkeys(words) if w not in last])
            found.update(last)
            held.append((batch.column(1).to_numpy(), batch.column(2).to_numpy(), [found[w] for w in words]))
            last = {words[-1]: found[words[-1]]}
            if sum(len(h[2]) for h in held) >= _HELD_WORDS:
                yield packed()
                held = []
        if held:
            yield packed()

    places = slices.where("words is not null").select("slice", "base", F.posexplode("words").alias("nth", "word"))
    by_word = places.select("word", "slice", (F.col("base") + F.col("nth")).alias("place")).repartition("word").sortWithinPartitions("word")
    return by_word.mapInArrow(run, _ENTRIES)


#: What ``encoded`` makes of a block of rows with ids, and the columns of the result.
Then = tuple[Callable[[pa.RecordBatch], pa.RecordBatch], pa.Schema]
_IDS: Then = (lambda rows: rows, pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())]))


def _joined(blocks: pa.Table, entries: pa.Table, then: Then = _IDS) -> pa.Table:
    """The ids of every row of one slice, a chunk for each of its blocks: the table is handed on chunk by chunk."""
    size, first, flat, so_far = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
    if entries.num_rows:
        columns = [list(map(_unpacked, entries.column(c).to_pylist())) for c in ("places", "sizes", "tokens")]
        many = sum(map(len, columns[0]))
        size, first = np.zeros(many, np.int64), np.zeros(many, np.int64)
        for steps, sizes, tokens in zip(*columns, strict=True):
            place = np.cumsum(steps, dtype=np.int64)
            size[place] = sizes
            first[place] = so_far + np.cumsum(sizes, dtype=np.int64) - sizes
            so_far += len(tokens)
            flat.append(tokens)
    flat = np.concatenate(flat) if flat else np.zeros(0, "<u4")
    out = []
    for block in zip(*(blocks.column(c) for c in ("base", "ids", "many", "codes")), strict=True):
        base, own, many, codes = (v.as_py() for v in block)
        place = _numbers(_unpacked(codes), base)
        sizes = size[place]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        tokens = flat[np.repeat(first[place] - (ends - sizes), sizes) + np.arange(total)].tobytes()
        cuts = 4 * np.append(0, ends)[np.append(0, np.cumsum(_unpacked(many), dtype=np.int64))]
        rows = [tokens[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        out.append(then[0](pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(rows, pa.binary())], ["doc_id", "ids"])))
    return pa.Table.from_batches(out, then[1])


def encoded(
    docs: DataFrame, kind: type[WordEncoder], tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    words: int = SLICE_WORDS, letters: int = SLICE_LETTERS, then: Callable[[], Then] = lambda: _IDS, columns: str = "doc_id long, ids binary",
) -> DataFrame:
    """(doc_id, ids): the ids of every row's whole text, as little-endian unsigned 32-bit bytes.

    ``then`` is called in the tasks; what it returns makes ``columns`` of each block of rows, where the ids are put together.
    """
    slices = sliced(docs, kind, tokenizer_path, id_col, text_col, words, letters)
    blocks = slices.where("words is null").select("slice", "base", "ids", "many", "codes")
    entries = word_ids(slices, kind, tokenizer_path)

    def joined(blocks: pa.Table, entries: pa.Table) -> pa.Table:
        return _joined(blocks, entries, then())

    return blocks.groupBy("slice").cogroup(entries.groupBy("slice")).applyInArrow(joined, columns)
