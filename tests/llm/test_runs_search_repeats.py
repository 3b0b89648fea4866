"""Periodic runs, ranked search and repeated passages against plain Python, on awkward rows and on given tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from crewgauge.llm import parsed_repeats, periodic_runs, ranked_search
from tests.llm.cases import LONG, ROWS, SCHEMA, docs, lowered, rows_of

SMALL = registry.SMOKE_DIR


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(words, least=24):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts():
    r = random.Random(5)
    for n in range(150):
        words, kinds = [], r.choice([1, 2, 3, 50])
        while len(words) < r.choice([0, 30, 200, 500]):
            block = [str(r.randrange(kinds)) for _ in range(r.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 40]))]
            words += (block * r.randrange(1, 9))[: r.randrange(1, 120)]
        yield n, " ".join(words)
    yield 150, "a " * 3000
    yield 151, ("a b c " * 100 + "x ") * 5


@pytest.mark.parametrize("least", [24, 12])
def test_runs_are_those_of_brute_force(spark, least):
    texts = dict(periodic_texts())
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    for r in periodic_runs.detect(table, min_length=least).collect():
        words = words_of(texts[r["row"]["doc_id"]])
        runs = [tuple(x) for x in r["runs"]]
        assert runs == plain_runs(words, least)
        assert r["collapsed"] == collapsed(words, runs)


@pytest.mark.parametrize("least", [24, 12])
def test_runs_of_a_text_that_comes_first(least):
    """What a batch begins with has nothing before it, and no run has the period 0."""
    for n, text in periodic_texts():
        runs, kept = periodic_runs._searched([text, "x"], least)
        found = [tuple(x.values()) for x in runs.to_pylist()[0]]
        assert found == plain_runs(words_of(text), least), n
        assert kept == [collapsed(words_of(text), found), "x"]


def test_runs_of_awkward_rows(spark):
    table = docs(spark).withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit("x"))
    got = periodic_runs.detect(table).collect()
    assert len(got) == len(ROWS) and set(got[0]["row"].asDict()) == set(table.columns) - {"text"}
    texts = {r[0]: r[1] for r in ROWS if r[0] is not None}
    for r in got:
        text = texts.get(r["row"]["doc_id"])
        if r["row"]["doc_id"] is not None and text is not None and text.startswith(LONG):
            assert r["runs"][0]["period"] % 397 == 0
        elif r["row"]["doc_id"] is not None:
            assert [tuple(x) for x in r["runs"]] == plain_runs(words_of(text))
    assert periodic_runs.detect(docs(spark, [])).count() == 0


def test_each_symbol_is_searched_once():
    """The grammar derives the text, and equal parts of a text share their symbols."""
    codes = np.array([*range(40)] * 64)
    doc = np.zeros(len(codes), np.int64)
    nodes = periodic_runs.grammar(*periodic_runs.local_ids(codes, doc), doc)
    assert len(np.unique(nodes.label)) < 60 < len(nodes.label)
    for label in np.unique(nodes.label):
        own = nodes.at(np.flatnonzero(nodes.label == label))
        assert len({tuple(codes[a:b]) for a, b in zip(own.start, own.end, strict=True)}) == 1


def test_periodic_query(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in registry.queries()["op11_periodic_runs"](spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    planted = 0
    for doc_id, text in rows:
        words = words_of(text)
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        if n > 4000:
            continue
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        lines = "".join(f"{a},{b},{q}\n" for a, b, q in runs)
        exponent = best[1] and 1000 * best[1] // best[2]
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs)))
        assert got[doc_id] == (len(runs), *best, exponent, *digests), doc_id
    assert len(got) == len(rows) and planted > 5


def search_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))


def plain_ranking(documents, items, k):
    counts = [(i, Counter(search_terms(t))) for i, t in documents]
    sizes = [sum(c.values()) for _, c in counts]
    number, length = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for (doc_id, c), n in zip(counts, sizes, strict=True):
            m = 50 + 50 * n * number // length if length else 0
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(search_terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("k", "part", "block"), [(1, 7, 1), (5, 40, 200), (1000, 1 << 18, 1 << 23)])
def test_ranking_is_that_of_brute_force(spark, monkeypatch, k, part, block):
    monkeypatch.setattr(ranked_search, "PART", part)
    r = random.Random(8)
    words = ["aa", "Bb", "cc-dd", "é9", "x_y", "z", "q", "w1", "w2", "w3"]
    documents = [(n, " ".join(r.choice(words) for _ in range(r.randrange(0, 12)))) for n in range(120)]
    documents += [(7, "aa bb"), (None, "aa Bb cc"), (None, None), (500, ""), (501, "--")]
    items = [(1, "aa bb"), (2, "AA z z q"), (2, "w1 w2"), (None, "dd"), (3, None), (4, "..."), (5, "nowhere"), (6, " ".join(words))]
    table = spark.createDataFrame([(*d, "c", 1) for d in documents], "doc_id long, text string, query string, score int").repartition(3)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    assert rows_of(ranked_search.rank(table, asked, k, block_bytes=block)) == plain_ranking(documents, items, k)


def test_ranking_of_awkward_and_empty_tables(spark):
    items = [(1, "w1 w2 w397"), (2, "Äpfel und")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(ranked_search.rank(docs(spark), asked, 5)) == plain_ranking([r[:2] for r in ROWS], items, 5)
    assert rows_of(ranked_search.rank(docs(spark, []), asked, 5)) == []
    assert rows_of(ranked_search.rank(docs(spark), asked.limit(0), 5)) == []


def test_sparse_table_answers_every_range():
    r = np.random.default_rng(1)
    term, doc = np.repeat([0, 1, 2], [60, 1, 30]), np.concatenate([np.arange(60), [5], np.arange(0, 60, 2)])
    index = ranked_search.Index(doc, term, r.integers(1, 50, len(term)), 60)
    for low in range(60):
        for high in range(low + 1, 61):
            found = index.largest(np.array([low]), np.array([high]))[0]
            assert low <= found < high and index.impact[found] == index.impact[low:high].max()


def plain_repeats(texts):
    data = [(t or "").encode() for t in texts]
    counts = Counter(t[i : i + 400] for t in data for i in range(len(t) - 399))
    out = []
    for t in data:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 399):
            if counts[t[i : i + 400]] > 1:
                gone[i : i + 400] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8)])))
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        out.append((len(t), list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)), kept))
    return out


def repeating_texts():
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghéñ") for _ in range(r.randrange(1, 9))) for _ in range(300)]

    def text(n):
        return " ".join(r.choice(words) for _ in range(n))

    passages = [text(r.randrange(60, 200)) for _ in range(12)] + ["x" * 3000, "spam!! " * 300, "ab" * 500, "=" * 399, "-" * 400]
    for _ in range(250):
        made = " ".join(r.choice(passages) if r.random() < 0.4 else text(r.randrange(0, 90)) for _ in range(r.randrange(0, 6)))
        if r.random() < 0.3 and len(made) > 50:
            place = r.randrange(len(made))
            made = f"{made[:place]}Q{made[place + 1 :]}"
        yield made


@pytest.mark.parametrize("chunk", [1, 5_000, 1 << 21])
def test_repeats_are_those_of_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(parsed_repeats, "CHUNK", chunk)
    monkeypatch.setattr(parsed_repeats, "_parts", lambda total: 3)
    texts = [*repeating_texts(), None, "", None, "-" * 400]
    texts += texts[:4]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in parsed_repeats.remove_repeats(table).collect()}
    assert got == dict(enumerate(plain_repeats(texts)))


def test_repeats_of_awkward_rows(spark):
    table = docs(spark).withColumn("chunk", F.lit(1)).withColumn("n_bytes", F.lit("x")).withColumn("done", F.lit(2))
    got = parsed_repeats.remove_repeats(table).collect()
    want = plain_repeats([r[1] for r in ROWS])
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], r["n_bytes"], bytes(r["kept"])) for r in got), key=key) == sorted(
        ((row[0], w[0], w[2]) for row, w in zip(ROWS, want, strict=True)), key=key
    )
    assert parsed_repeats.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
