"""Exact top-k ranking of documents for queries, with range-maximum sparse tables on posting lists.

A term of a query weighs ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and gives a document that holds it ``tf`` times the
impact ``w * (1000000000 * tf // (1000 * tf + 20 * m))``, where ``m = 50 + 50 * n * N // L`` is the document's length against the
average in hundredths. ``N``, ``L`` and ``df`` count all documents. The score of a document is the sum over the query's distinct terms.

Each task indexes its documents a part at a time: posting lists of impacts in document order, and over them a sparse
table that names the largest impact of any range of a list in two look-ups. For a query an interval of documents
is bounded by the sum of these maxima over its terms. The best intervals come first: the document with the largest
single impact in it is scored and splits the interval in two, whose bounds are looked up in turn. An interval is done with when its
bound does not reach the k-th best score that the task has found. The tasks' best rows are ranked in two steps, so that no
task ranks those of all partitions.

Queries are taken in blocks of bounded size, which is what is sent to the tasks. Terms of documents that no query asks for are counted
but not kept.

Defined results: null, empty and wordless documents have no terms and are never returned; a null, empty or wordless query
has no rows. Each row of ``items`` is a query of its own, also where ids repeat or are null; each row of ``docs`` is a document
of its own. Equal scores are ranked by document id, null ids last. Only documents with a score above 0 are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from crewgauge.llm.periodic_runs import _chunks, _ranges
from crewgauge.llm.scratch import written

#: Bytes of query text that one pass answers.
BLOCK_BYTES = 1 << 23
#: Characters of text that a task splits at once, and postings that it indexes at once.
CHUNK = 1 << 22
PART = 1 << 18

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_TO_TERMS = bytes(0x20 if c in _SEPARATORS else c + 0x20 if 0x41 <= c <= 0x5A else c for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, with repeats."""
    return (text or "").encode().translate(_TO_TERMS).split()


@dataclass(frozen=True)
class Queries:
    """A block of queries: ``terms[first[q]:first[q + 1]]`` are the distinct terms of query ``q``, as numbers."""

    vocabulary: dict[bytes, int]
    first: np.ndarray
    terms: np.ndarray

    @staticmethod
    def of(texts: list[str | None]) -> Queries:
        vocabulary: dict[bytes, int] = {}
        own = [[vocabulary.setdefault(t, len(vocabulary)) for t in dict.fromkeys(terms(text))] for text in texts]
        first = np.cumsum([0, *map(len, own)])
        return Queries(vocabulary, first, np.array([t for ts in own for t in ts], np.int64))


def _counted(texts: list[str | None], vocabulary: dict[bytes, int]) -> list[pa.Array]:
    """Of each text: its number of terms, and the vocabulary's terms in it with their counts."""
    split = [terms(t) for t in texts]
    sizes = np.array([len(s) for s in split], np.int64)
    coded = pa.array([t for s in split for t in s], pa.binary()).dictionary_encode()
    number = np.array([vocabulary.get(t, -1) for t in coded.dictionary.to_pylist()], np.int64)
    term = number[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    pair, tf = np.unique((doc * (len(vocabulary) + 1) + term)[term >= 0], return_counts=True)
    doc, term = np.divmod(pair, len(vocabulary) + 1)
    cuts = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)), pa.int32())
    lists = (pa.ListArray.from_arrays(cuts, pa.array(a, pa.int32())) for a in (term, tf))
    return [pa.array(sizes), *lists]


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms with repeats), terms and tfs (those of the vocabulary) of each of ``docs`` (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in _chunks(texts, CHUNK):
                counted = _counted(texts[a:b], sent.value)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *counted], ["doc_id", "n", "terms", "tfs"])

    made = written(docs.mapInArrow(count, "doc_id bigint, n bigint, terms array<int>, tfs array<int>"), "term_counts")
    sent.destroy()
    return made


class Index:
    """Posting lists of some documents, which are numbered in the order of their ids, and a sparse table over all lists."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, size: int) -> None:
        order = np.argsort(term * size + doc)
        self.size = size
        self.doc, self.impact = doc[order], impact[order]
        self.key = (term * size + doc)[order]
        longest = int(np.bincount(term).max(initial=1))
        table = [np.arange(len(doc), dtype=np.int32)]
        while 2 << (len(table) - 1) <= longest:
            last, step = table[-1], 1 << (len(table) - 1)
            left, right = last[:-step], last[step:]
            table.append(np.where(self.impact[left] >= self.impact[right], left, right))
        # One row a level; what is beyond the end of a level is never asked for.
        self.table = np.stack([np.pad(t, (0, len(doc) - len(t))) for t in table])

    def ranges(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the lists of these terms begin and end."""
        return np.searchsorted(self.key, term * self.size), np.searchsorted(self.key, (term + 1) * self.size)

    def largest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The posting with the largest impact in each range, none of which is empty."""
        level = np.frexp((high - low).astype(float))[1] - 1
        left, right = self.table[level, low], self.table[level, high - (1 << level)]
        return np.where(self.impact[left] >= self.impact[right], left, right)

    def place(self, low: np.ndarray, high: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The first posting of each range that is of ``doc`` or a later document."""
        term = self.key[low] // self.size
        return np.clip(np.searchsorted(self.key, term * self.size + doc), low, high)


class Best:
    """The best rows found so far, k of each query at most: query, score, null id, id."""

    def __init__(self, queries: int, k: int) -> None:
        self.queries, self.k = queries, k
        self.rows = tuple(np.empty(0, np.int64) for _ in range(4))
        self.least = np.ones(queries, np.int64)  # the score that a document has to reach
        self.last = (np.ones(queries, np.int64), np.full(queries, np.iinfo(np.int64).max))

    def add(self, query: np.ndarray, score: np.ndarray, null: np.ndarray, doc_id: np.ndarray) -> None:
        rows = [np.concatenate(c) for c in zip(self.rows, (query, score, null, doc_id), strict=True)]
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        rows = [c[order] for c in rows]
        rank = np.arange(len(order)) - np.searchsorted(rows[0], rows[0])
        self.rows = query, score, null, doc_id = tuple(c[rank < self.k] for c in rows)
        full = np.flatnonzero(rank[rank < self.k] == self.k - 1)
        self.least[query[full]] = score[full]
        self.last[0][query[full]], self.last[1][query[full]] = null[full], doc_id[full]

    def reachable(self, query: np.ndarray, bound: np.ndarray, null: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
        """Whether a document from this id on could be among the best with a score up to the bound."""
        least, last_null, last = self.least[query], self.last[0][query], self.last[1][query]
        earlier = (null < last_null) | ((null == last_null) & (doc_id <= last))
        return (bound > least) | ((bound == least) & earlier)


@dataclass(frozen=True)
class Intervals:
    """Intervals of documents, each with the non-empty ranges ``low:high`` of its query's posting lists in it."""

    query: np.ndarray
    count: np.ndarray
    low: np.ndarray
    high: np.ndarray
    bound: np.ndarray
    split: np.ndarray
    begin: np.ndarray

    @staticmethod
    def of(index: Index, query: np.ndarray, begin: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> Intervals:
        some = high > low
        owner, low, high = owner[some], low[some], high[some]
        count = np.bincount(owner, minlength=len(query))
        query, begin, count = query[count > 0], begin[count > 0], count[count > 0]
        posting = index.largest(low, high)
        impact = index.impact[posting]
        cuts = np.cumsum(count) - count
        if not len(count):
            return Intervals(query, count, low, high, impact, posting, begin)
        most = np.maximum.reduceat(impact, cuts)
        owner = np.repeat(np.arange(len(count)), count)
        hit = np.flatnonzero(impact == most[owner])
        hit = hit[np.unique(owner[hit], return_index=True)[1]]
        return Intervals(query, count, low, high, np.add.reduceat(impact, cuts), index.doc[posting[hit]], begin)

    def at(self, which: np.ndarray) -> Intervals:
        first = np.cumsum(self.count) - self.count
        own, _ = _ranges(first[which], first[which] + self.count[which])
        return Intervals(self.query[which], self.count[which], self.low[own], self.high[own], self.bound[which], self.split[which], self.begin[which])

    def plus(self, other: Intervals) -> Intervals:
        return Intervals(*(np.concatenate([getattr(self, f), getattr(other, f)]) for f in self.__dataclass_fields__))


def _split(index: Index, taken: Intervals) -> tuple[np.ndarray, Intervals]:
    """The scores of the split documents, and what is left and right of them."""
    owner = np.repeat(np.arange(len(taken.query)), taken.count)
    doc = taken.split[owner]
    middle = index.place(taken.low, taken.high, doc)
    hit = (middle < taken.high) & (index.doc[np.minimum(middle, len(index.doc) - 1)] == doc)
    score = np.zeros(len(taken.query), np.int64)
    np.add.at(score, owner[hit], index.impact[middle[hit]])
    halves = (
        Intervals.of(index, taken.query, taken.begin, owner, taken.low, middle),
        Intervals.of(index, taken.query, taken.split + 1, owner, middle + hit, taken.high),
    )
    return score, halves[0].plus(halves[1])


def search(index: Index, queries: Queries, null: np.ndarray, doc_id: np.ndarray, best: Best) -> None:
    """Put the best of the index's documents (their ids in order) among the best so far."""
    number = len(queries.first) - 1
    owner = np.repeat(np.arange(number), np.diff(queries.first))
    low, high = index.ranges(queries.terms)
    pool = Intervals.of(index, np.arange(number), np.zeros(number, np.int64), owner, low, high)
    while True:
        begin = np.minimum(pool.begin, len(doc_id) - 1)
        live = np.flatnonzero(best.reachable(pool.query, pool.bound, null[begin], doc_id[begin]))
        if not len(live):
            return
        # The better half of each query's intervals at once.
        live = live[np.lexsort((-pool.bound[live], pool.query[live]))]
        query = pool.query[live]
        rank = np.arange(len(live)) - np.searchsorted(query, query)
        many = np.bincount(query, minlength=number)[query]
        taken = pool.at(live[rank < (many + 1) // 2])
        score, parts = _split(index, taken)
        best.add(taken.query, score, null[taken.split], doc_id[taken.split])
        pool = pool.at(live[rank >= (many + 1) // 2]).plus(parts)


def _part_index(batches: list[pa.RecordBatch], weight: np.ndarray, documents: int, length: int) -> tuple[Index, np.ndarray, np.ndarray] | None:
    table = pa.Table.from_batches(batches)
    ids, n = table["doc_id"].combine_chunks(), table["n"].to_numpy()
    null = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
    doc_id = ids.fill_null(0).to_numpy()
    lists = table["terms"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    term, tf = lists.flatten().to_numpy().astype(np.int64), table["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
    order = np.lexsort((doc_id, null))
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    doc = np.repeat(number, sizes)
    m = np.repeat(50 + 50 * n * documents // length, sizes)
    impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m))
    some = impact > 0
    if not some.any():
        return None
    return Index(doc[some], term[some], impact[some], len(order)), null[order], doc_id[order]


def _searcher(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight, documents, length = sent.value
        best = Best(len(queries.first) - 1, k)
        waiting: list[pa.RecordBatch] = []
        postings = 0

        def flush() -> None:
            if waiting and (made := _part_index(waiting, weight, documents, length)):
                search(made[0], queries, made[1], made[2], best)
            waiting.clear()

        for batch in batches:
            cuts = batch.column(2).offsets.to_numpy()
            first = 0
            while first < batch.num_rows:
                last = int(np.searchsorted(cuts, cuts[first] + PART - postings, "right")) - 1
                last = min(max(last, first + 1), batch.num_rows)
                waiting.append(batch.slice(first, last - first))
                postings += int(cuts[last] - cuts[first])
                first = last
                if postings >= PART or first < batch.num_rows:
                    flush()
                    postings = 0
        flush()
        query, score, null, doc_id = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(score), pa.array(doc_id, mask=null.astype(bool))], ["query", "score", "doc_id"]
        )

    return run


def _weights(counts: DataFrame, vocabulary: int) -> tuple[np.ndarray, int, int]:
    """The weight of each term of the vocabulary, the number of documents with terms, and their terms."""
    totals = counts.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(vocabulary, np.int64)
    for term, n in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = n
    weight = [math.floor(1000 * math.log((2 * totals[0] + 2) / (2 * int(d) + 1))) for d in df]
    return np.array(weight, np.int64), totals[0], totals[1]


def _best_of_all(rows: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, first among some partitions' rows and then among what is left."""
    spread = math.isqrt(rows.rdd.getNumPartitions()) + 1
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    first = F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))
    final = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    some = rows.withColumn("part", F.spark_partition_id() % spread).withColumn("rank", first).where(F.col("rank") <= k)
    return some.withColumn("rank", final).where(F.col("rank") <= k).drop("part")


def _blocks(items: DataFrame, limit: int) -> DataFrame:
    """``items`` with the number of the block that each is in, at most about ``limit`` bytes of text or a single longer item each."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    rows, total = items.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    number = max(1, -(-total // limit))
    while True:
        blocks = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(number)))
        if number == 1 or number >= rows:
            return blocks
        if (blocks.groupBy("block").agg(F.sum(size).alias("s")).agg(F.max("s")).first()[0] or 0) <= 2 * limit:
            return blocks
        number *= 2


def rank(
    docs: DataFrame, items: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents for each of ``items``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    blocks = written(_blocks(asked, block_bytes), "queries")
    kind = blocks.schema["item_id"].dataType.simpleString()
    answers = []
    for (block,) in blocks.select("block").distinct().collect():
        own = blocks.where(F.col("block") == block).select("item_id", "text").collect()
        queries = Queries.of([r["text"] for r in own])
        counts = count_terms(texts, queries.vocabulary)
        sent = spark.sparkContext.broadcast((queries, *_weights(counts, len(queries.vocabulary))))
        asking = counts.where(F.size("terms") > 0)
        best = _best_of_all(asking.mapInArrow(_searcher(sent, k), "query bigint, score bigint, doc_id bigint"), k)
        best = written(best, "ranked")
        sent.destroy()
        names = spark.createDataFrame([(n, r["item_id"]) for n, r in enumerate(own)], f"query bigint, item_id {kind}")
        answers.append(best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    if not answers:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, answers)
