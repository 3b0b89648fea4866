"""The n-gram join against all pairs."""

import random

import pytest

from crewgauge.llm import ngram_join
from crewgauge.llm.ngram_join import Bound
from tests.llm.cases import LONG, ROWS, TEXTS, docs, shingles


def by_pairs(rows, bound):
    """(doc_id, n_shingles, component_id, n_links) of every row, comparing all pairs of rows."""
    sets = [shingles(r[1], bound.words) for r in rows]
    top = list(range(len(rows)))
    links = [0] * len(rows)

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and bound.den * both >= bound.num * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                top[find(a)] = find(b)
    least = {}
    for n, r in enumerate(rows):
        if r[0] is not None:
            least[find(n)] = min(least.get(find(n), r[0]), r[0])
    return sorted(((r[0], len(sets[n]), r[0] if not sets[n] else least.get(find(n)), links[n]) for n, r in enumerate(rows)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "n_links").collect()), key=repr)


@pytest.mark.parametrize("bound", [Bound(), Bound(5, 80, 100), Bound(2, 60, 100)])
def test_awkward_rows(spark, bound):
    assert found(ngram_join.join(docs(spark), bound)) == by_pairs(ROWS, bound)


@pytest.mark.parametrize("leaf", [3, 512])
def test_dense_groups_and_recursion(spark, monkeypatch, leaf):
    """Groups far beyond a leaf: Voronoi splits, windows and tiles lose and double no link."""
    monkeypatch.setattr(ngram_join, "LEAF", leaf)
    monkeypatch.setattr(ngram_join, "PIVOTS", 3)
    rng = random.Random(5)
    rows = []
    for group in range(4):
        base = [f"g{group}w{n}" for n in range(90)]
        for _ in range(18):
            words = [f"n{rng.random()}" if rng.random() < 0.012 * (group + 1) else w for w in base]
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + n, " ".join(f"u{n}v{k}" for k in range(40))) for n in range(10)]
    got = found(ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")))
    want = by_pairs(rows, Bound())
    assert got == want and sum(r[3] for r in want) > 100


@pytest.mark.parametrize(("block", "ngrams"), [(4, 2_000_000), (4096, 400), (4096, 2_000_000)])
def test_classes_are_the_components(spark, monkeypatch, block, ngrams):
    """Blocks, and points outside the largest class, lose no link."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "LEAF_NGRAMS", ngrams)
    rng = random.Random(7)
    rows = list(ROWS)
    for group in range(3):
        base = [f"g{group}w{n}" for n in range(90)]
        for _ in range(30):
            words = [f"n{rng.random()}" if rng.random() < 0.015 * (group + 1) else w for w in base]
            rows.append((len(rows) + 100, " ".join(words), *[None] * 6))
    for bound in (Bound(), Bound(5, 80, 100)):
        got = sorted((tuple(r) for r in ngram_join.classes(docs(spark, rows), bound).collect()), key=repr)
        assert got == sorted((r[:3] for r in by_pairs(rows, bound)), key=repr)


def test_a_block_of_near_copies_takes_few_turns():
    import numpy as np

    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    sets = [np.sort(np.concatenate([base[rng.random(len(base)) > 0.01], rng.integers(0, 2**63, 3).astype(np.uint64)])) for _ in range(800)]
    block = ngram_join._Block([(n.to_bytes(4, "big"), s, True, -1) for n, s in enumerate(sets)], Bound(5, 80, 100))
    turns, common = [], block.common
    block.common = lambda n: turns.append(n) or common(n)
    assert len(list(block.edges())) == 799 and len(turns) < 10


def test_rounds_of_few_edges_leave_few_files(spark, monkeypatch):
    from crewgauge.llm import components as module

    files, written = [], module.written
    monkeypatch.setattr(module, "written", lambda df, name: files.append(made := written(df, name)) or made)
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        edges = spark.createDataFrame([(n, n + 1) for n in range(60) if n != 30], "a long, b long")
        got = {tuple(r) for r in module.components(edges).collect()}
        many = [len(df.inputFiles()) for df in files[1:]]
        monkeypatch.setattr(module, "FILE_EDGES", 10)
        again = {tuple(r) for r in module.components(edges).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == again == {(n, 0 if n <= 30 else 31) for n in range(61)}
    assert many and set(many) == {1}


def test_no_rows(spark):
    assert ngram_join.join(docs(spark, [])).collect() == []
    assert found(ngram_join.join(docs(spark, ROWS[:3]))) == [(0, 0, 0, 0), (1, 0, 1, 0), (2, 0, 2, 0)]


def test_full_bit_array_changes_nothing(spark):
    """With very few bits every cell looks shared."""
    rows = [(n, t) for n, t in enumerate(TEXTS) if t != LONG]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(ngram_join.join(table, bits=64)) == by_pairs(rows, Bound())


def test_linked_sets_share_as_many_cells_as_stated():
    import numpy as np

    rng = np.random.default_rng(3)
    for size in (6, 7, 13, 20, 45, 100, 333, 2000):
        for bound in (Bound(), Bound(5, 80, 100)):
            for _ in range(20):
                a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
                change = int(rng.integers(0, bound.differ(size) // 2 + 1))
                b = np.unique(np.concatenate([a[change:], rng.integers(0, 2**63, int(rng.integers(0, change + 1))).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if bound.den * both < bound.num * (len(a) + len(b) - both) or both == len(a) == len(b):
                    continue
                of_b = [set(k.tolist()) for k, _ in ngram_join.cells(b, bound)]
                counts = [(len(set(k.tolist()) & own), need) for k, need in ngram_join.cells(a, bound) for own in of_b]
                assert any(n >= need for n, need in counts), (size, change)


def test_tables_of_few_points_are_few_files(spark, monkeypatch):
    """A file costs the local file system a process that looks as large as the executor; there are no more than the input calls for."""
    files, written = [], ngram_join.written
    monkeypatch.setattr(ngram_join, "written", lambda df, name: files.append((name, made := written(df, name))) or made)
    monkeypatch.setattr(ngram_join, "LEAF", 5)
    monkeypatch.setattr(ngram_join, "FILES", 2)
    settings = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    rng = random.Random(11)
    rows = [(n, " ".join(f"n{rng.random()}" if rng.random() < 0.01 else f"g{n % 3}w{k}" for k in range(90))) for n in range(45)]
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = found(ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")))
        many = {name: len(df.inputFiles()) for name, df in files if name != "points"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == by_pairs(rows, Bound())
    assert {"members", "sizes", "leaves", "parts", "sets", "links"} <= many.keys() and max(many.values()) <= 2, many


@pytest.mark.parametrize(("leaf", "batch"), [(7, 10_000), (1000, 6)])
def test_split_goes_to_the_nearest_pivots(spark, monkeypatch, leaf, batch):
    """Whatever the slices and batches, each point goes to its nearest pivot and to all within the window."""
    monkeypatch.setattr(ngram_join, "LEAF", leaf)
    monkeypatch.setattr(ngram_join, "PIVOTS", 3)
    rng = random.Random(13)
    sets = {bytes([n]): sorted({k if rng.random() < 0.8 else 1000 + rng.randrange(50) for k in range(40)}) for n in range(40)}
    members = [(9, n % 2, bytes([n]), len(sets[bytes([n])]), n % 5 > 0) for n in range(40)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        table = spark.createDataFrame(members, "region long, leaf long, point binary, n long, core boolean")
        grams = spark.createDataFrame(list(sets.items()), "point binary, grams array<long>")
        large = spark.createDataFrame([(0, 20), (1, 20)], "leaf long, members long")
        got = [(r.old, bytes(r.point), r.n, r.new, r.core) for r in ngram_join._split(table, large, grams, Bound(), 1).collect()]
        ordered = table.selectExpr("leaf", "point", "xxhash64(point, 1) AS h").orderBy("leaf", "h", "point").collect()
        names = {(r.leaf, r.p): r.new for r in spark.sql("SELECT *, xxhash64(leaf, p, 1) AS new FROM VALUES (0L), (1L) a(leaf), VALUES (0), (1), (2) b(p)").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = []
    for _, side, point, n, core in members:
        pivots = [set(sets[bytes(r.point)]) for r in ordered if r.leaf == side][:3]
        own = set(sets[point])
        far = [1 - len(own & p) / (len(own) + len(p) - len(own & p)) for p in pivots]
        want += [(side, point, n, names[side, m], core and m == far.index(min(far))) for m in range(3) if far[m] <= min(far) + 2 * Bound().eps + 1e-9]
    assert sorted(got) == sorted(want) and len(want) > len(members)
