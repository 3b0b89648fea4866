"""Hamming search, URL rules, main text, chat formatting and the pipeline on awkward rows."""

import html
import json
import random
import re
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline
from crewgauge.llm import chat, hamming, main_text, queries, url_rules
from tests.compare import normal, sql_result
from tests.llm.cases import ROWS, docs, rows_of
from tests.llm.test_join import by_pairs


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{registry.SMOKE_DIR}/{table}.parquet'")
    made = registry.queries()[name](spark, registry.SMOKE_DIR)
    assert normal(made.columns, made.collect()) == sql_result(connection, registry.oracle_sql()[name])


def nearest(rows, asked, k):
    bits = max((len(v) for _, v in rows if v is not None), default=1)
    code = lambda v: [int(x is not None and x == x and x > 0) for x in v] + [0] * (bits - len(v))
    codes = [(i, code(v)) for i, v in rows if v is not None]
    out = []
    for q, v in asked:
        if v is not None:
            order = sorted((sum(a != b for a, b in zip(code(v), c, strict=True)), i is None, i or 0) for i, c in codes)
            out += [(q, n + 1, None if gone else i, d) for n, (d, gone, i) in enumerate(order[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [4, 7, None])
def test_nearest_of_awkward_vectors(spark, width):
    rng = random.Random(2)
    rows = [(n, [rng.choice([-1.0, 1.0]) for _ in range(24)]) for n in range(60)]
    hot = rows[0][1]
    rows += [(n, hot) for n in range(100, 140)] + [(n, [-x if m == n % 24 else x for m, x in enumerate(hot)]) for n in range(140, 170)]
    rows += [(200, None), (201, []), (202, [float("nan"), None, 1.0]), (203, [0.0] * 24), rows[3], rows[3], (None, hot)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("distance", F.lit("x"))
    asked = [r for r in rows if r[0] is not None and r[0] % 20 == 0]
    made = hamming.top_k(table, table.where("vec_id % 20 = 0"), 10, width=width)
    assert rows_of(made.select("query_id", "rank", "vec_id", "distance")) == nearest(rows, asked, 10)


def test_null_ids_and_hot_queries(spark):
    rows = [(None, [1.0, 1.0]), (1, [1.0, 1.0]), (None, [-1.0, 1.0])] + [(7, [1.0, -1.0])] * 3
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert rows_of(hamming.top_k(table, table, 10)) == nearest(rows, rows, 10)
    assert rows_of(hamming.top_k(table, table, 2)) == nearest(rows, rows, 2)
    pair = table.where("embedding[1] = 1 AND embedding[0] = 1")
    assert rows_of(hamming.top_k(pair, pair)) == sorted([(None, 1, 1, 0), (None, 2, None, 0), (1, 1, 1, 0), (1, 2, None, 0)], key=repr)


def test_nearest_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    table = spark.createDataFrame([(0, [1.0, -1.0]), (1, [1.0, 1.0])], schema)
    assert rows_of(hamming.top_k(table, table, 10)) == [(0, 1, 0, 0), (0, 2, 1, 1), (1, 1, 1, 0), (1, 2, 0, 1)]
    empty = spark.createDataFrame([], schema)
    assert hamming.top_k(empty, empty).collect() == [] and hamming.top_k(table, empty).collect() == []


def test_probes_are_not_broadcast(spark):
    rng = random.Random(5)
    rows = [(n, [rng.choice([-1.0, 1.0]) for _ in range(64)]) for n in range(1500)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "16m")
    try:
        made = rows_of(hamming.top_k(table, table.where("vec_id % 10 = 0"), 10))
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert made == nearest(rows, [r for r in rows if r[0] % 10 == 0], 10)


@pytest.mark.parametrize(("bits", "width", "k"), [(100, None, 3), (130, 20, 10), (64, 64, 2)])
def test_nearest_by_many_leaves(spark, monkeypatch, bits, width, k):
    """Several words, leaves in parts and in copies, ties by id within and across codes."""
    monkeypatch.setattr(hamming, "POSTINGS", 3)
    monkeypatch.setattr(hamming, "ASKED", 10)
    rng = random.Random(bits)
    base = [[rng.choice([-1.0, 1.0]) for _ in range(bits)] for _ in range(8)]
    ids = [*range(150), None, None, 3, 3]
    rows = [(i, [-x if rng.random() < 0.04 and m > 30 else x for m, x in enumerate(base[rng.randrange(8)])]) for i in rng.sample(ids, len(ids))]
    rows += [(rng.randrange(300), rows[n % 9][1]) for n in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = [r for r in rows if r[0] is None or r[0] % 7 == 0]
    assert rows_of(hamming.top_k(table, spark.createDataFrame(asked, table.schema), k, width=width)) == nearest(rows, asked, k)


def test_probes_and_comparisons_agree(monkeypatch):
    monkeypatch.setattr(hamming, "SLICE", 50)
    rng = np.random.default_rng(3)
    cells, own = np.sort(rng.integers(0, 1 << 8, 300, np.uint64)), rng.integers(0, 1 << 8, 20, np.uint64)
    starts = np.append(0, np.cumsum(np.bincount(cells.astype(np.int64), minlength=1 << 8)))
    for radius in range(9):
        probed = list(hamming._probed(own, hamming._flips(8, radius), starts))
        compared = list(hamming._compared(own, cells, radius))
        pairs = [sorted((int(a), int(b)) for asker, row in x for a, b in zip(asker, row, strict=True)) for x in (probed, compared)]
        assert pairs[0] == pairs[1] == sorted((a, b) for a in range(20) for b in range(300) if int(own[a] ^ cells[b]).bit_count() == radius)
    assert list(hamming._probed(own[:0], hamming._flips(8, 1), starts)) == []


URLS = [
    None, "", "no host", "http://", "http://org", "http://ORG/", "https://a.example.org/es/1", "x://example.org/en/1234", "https://example.org/en/2",
    "ftp://xorg/", "https://a..com/de/x?y#z", "https://com/fr/", "https://b.com?/de/", "https://b.com/de", "https://c.com/de/#/fr/", "a://b://com/de/",
    "https://É.com/fr/é", "https://user@b.com:80/de/", "https://" + "a." * 300 + "com/de/" + "x" * 5000, "https://b.com/de/", "https://b.com/de/",
]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    for mark in "?#":
        rest = rest.split(mark)[0]
    host, _, tail = rest.partition("/")
    host, path = "".join(c.lower() if c.isascii() else c for c in host), rest[len(host):]
    fits = []
    for verdict, rule in rules:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else "allow"


def test_rules_for_awkward_urls(spark):
    table = spark.createDataFrame([(n, u) for n, u in enumerate(URLS)], "page_id long, url string").withColumns({"host": F.lit("h"), "rule": F.lit("r")})
    made = url_rules.judge(table, url_rules.rule_table(spark, queries.URL_RULES)).select("row.page_id", "host", "path", "rule", "verdict")
    assert rows_of(made) == sorted(((n, *judged(u, queries.URL_RULES)) for n, u in enumerate(URLS)), key=repr)
    none = url_rules.judge(table, url_rules.rule_table(spark, []), default="block")
    assert {(r["rule"], r["verdict"]) for r in none.collect()} == {(None, "block")} and none.count() == len(URLS)
    assert url_rules.judge(table.limit(0), url_rules.rule_table(spark, queries.URL_RULES)).collect() == []


PAGE = """<html><head><title>T</title><script>var t="</p><p>no";</script></head><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
<div id="cookie-notice">We use cookies</div>{open}<h1>Title &eacute;&#233;&#xe9;</h1><p>Para one is rather long, so that it makes a surge of text in this page,
with more than eighty characters.<p>Short.<div class="ad-box">Buy now</div><ul><li>item <b>a</b><li>item b</ul><p>End &lt;b&gt; &amp;amp; <a href=x>link</a>{close}
<aside>side</aside><form>Mail: <input></form><section class="comments"><p>A comment which is long enough to be a surge of text, since it has so many characters in it.</p></section>
<footer>&copy; foot</footer><!-- <p>gone --><style>p {{}}</style></body></html>"""
MAIN = (
    "Title ééé\nPara one is rather long, so that it makes a surge of text in this page, with more than eighty characters.\n"
    "Short.\nitem a\nitem b\nEnd <b> &amp; link"
)


@pytest.mark.parametrize(("begin", "end"), [("<article>", "</article>"), ("<div class=content>", "</div>"), ("<main><div>", "</div></main>")])
def test_main_text_of_templates(begin, end):
    assert main_text.main_text(PAGE.format(open=begin, close=end)) == MAIN
    assert main_text.main_text(PAGE.format(open=begin, close=end).upper().replace("&EACUTE;&#233;&#XE9;", "&Eacute;É&#xC9;").replace("&LT;", "&lt;").replace("&GT;", "&gt;").replace("&AMP;AMP;", "&amp;amp;")) == MAIN.upper().replace("&AMP;", "&amp;")


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a", "a"), ("<script>x", ""), ("<p>a<!-- b", "a"), ("<p>a <b", "a"),
    ("<article><p>x<br>y\n z</p></article>", "x y z"), ("<article>" + "<p>w</p>" * 5000 + "</article>", "\n".join(["w"] * 5000)),
    ('<article><p title="a>b">x</p><p class="lead">y</p></article>', "x\ny"), ("<article><p>a &lt;p&gt; b</article>", "a <p> b"),
])
def test_main_text_of_awkward_pages(page, text):
    assert main_text.main_text(page) == text


@pytest.mark.parametrize(("page", "text"), [
    ("<article><p>a<datalist><option>x<option>y</datalist><p>b</article>", "a\nb"), ("<article><p>a<datalist><option>x<p>b</article>", "a\nb"),
    ("<article><p>a<select><option>x<option>y<p>b</article>", "a\nb"), ("<article><p>a<option>x</option><p>b</article>", "a\nb"),
    ("<article><p>a<object data=x><p>b</article>", "a\nb"), ("<article><p>a<object data=x>no</object><p>b</article>", "a\nb"),
    ("<article><p>Let <math><mi>x</mi><annotation>\\x</annotation></math> be positive.</article>", "Let x be positive."),
    ("<article><p>a<select><option>x<optgroup label=y><option>z</select>b</article>", "ab"), ("<article><p>a<svg><text>no</svg> b<svg>c</article>", "a bc"),
])
def test_hidden_elements_end_with_their_parent(page, text):
    assert main_text.main_text(page) == text


def test_stray_end_tags_take_linear_time():
    began = time.monotonic()
    assert main_text.main_text("<div>" * 20_000 + "</b>" * 20_000 + "<p>end" + "<object>" * 20_000) == "end"
    assert time.monotonic() - began < 2


def test_given_pages_go_through_line_blocks(spark, monkeypatch):
    """Every given page's text comes out of segments, and is that of a plain reading of its article."""
    surges = []
    segments = main_text.segments
    monkeypatch.setattr(main_text, "segments", lambda weights, surge: surges.append(surge) or segments(weights, surge))
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    plain = 0
    for page in pages:
        text = main_text.main_text(page)
        found = re.search(r"<(article|main)\b[^>]*>(.*?)</\1>", page or "", re.S)
        if found and not re.search(r"<(?!/?(?:p|h[1-6]|b|i|em|strong|a|br|article|main)\b)", found[2]):
            own = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", part.replace("<br>", " "))).split()) for part in re.split(r"</?(?:p|h[1-6])\b[^>]*>", found[2]))
            assert text == "\n".join(part for part in own if part)
            plain += 1
    assert len(surges) == len(pages) == plain


TEXT = "Para which is long enough to be a surge of text, since it has so many characters in it, over eighty."


@pytest.mark.parametrize(("page", "text"), [
    (f"<div class='layout with-sidebar'><article><h1>T</h1><p>{TEXT}</article><div class=sidebar>side</div></div>", f"T\n{TEXT}"),
    (f"<div class='layout sidebar'><p>out<main><h1>T</h1><p>{TEXT}<div class=share>on</div></main></div>", f"T\n{TEXT}"),
    (f"<form id='aspnetForm'><nav>n</nav><article><p>{TEXT}</article><footer>f</footer></form>", TEXT),
    (f"<form id='aspnetForm'><input name=__VIEWSTATE><div><p>{TEXT}</div></form>", TEXT), (f"<form><div><p>{TEXT}</div></form>", TEXT),
    (f"<article><p>{TEXT}<section id='related-work'><p>a</section><p class='notice-period'>b<p class='no-comments'>c</article>", f"{TEXT}\na\nb\nc"),
    (f"<article><p>{TEXT}</article><div class=related><article>{TEXT} {TEXT}</article></div>", TEXT),
    (f"<div><p>{TEXT}</div><div class=widget><article>teaser</article></div>", TEXT),
    *((f"<{shut}><article><p>{TEXT}</article></{shut.split()[0]}>", "") for shut in ("nav", "aside", "footer", "div class=comments", "div id=comment-list")),
    *((f"<article><p>a<div class={name}>no</div></article>", "a") for name in ("ad-box", "cookie-notice", "related-posts", "siteFooter", "'x share-buttons'")),
])
def test_main_text_in_wrappers(page, text):
    assert main_text.main_text(page) == text


LINKS = "<ul>" + "<li><a href=x>a link</a>" * 5 + "</ul>"


@pytest.mark.parametrize(("page", "text"), [
    (f"<div><h1>Title</h1><div class=share>a</div><div class=share>b</div><p>{TEXT}</div>", f"Title\n{TEXT}"),
    (f"<div><h1>Title</h1>{'<div class=ad>x</div>' * 5}<p>{TEXT}{'<div class=ad>x</div>' * 5}<p>End.</div>", f"Title\n{TEXT}\nEnd."),
    (f"<div><p>Lead.</p>{LINKS}<p>{TEXT}</p>{LINKS}<p>Near.</p>{LINKS}<p>End.</div><div>{LINKS}<p>Other.</div>", f"Lead.\n{TEXT}\nNear.\nEnd."),
    (f"<div><p>{TEXT}<p><a href=x>all of it a link</a><p>and {TEXT}</div>", f"{TEXT}\nall of it a link\nand {TEXT}"),
    (f"<div><p>{TEXT}</p>{'<p><a>in between</a></p>' * 4}<p>End.</div>", "\n".join([TEXT, *["in between"] * 4, "End."])),
    (f"<div><p>{TEXT}<ul><li><a>one</a><li>two words</ul></div><div><a>more</a></div>", f"{TEXT}\none\ntwo words"),
    (f"<div><a>Home</a></div><div>{LINKS}</div><div><p>{TEXT}</div><div><a>Next</a></div>", TEXT),
])
def test_main_text_without_article_is_whole(page, text):
    assert main_text.main_text(page) == text


def test_surge_and_dive():
    assert main_text.line_blocks([1, 0, 0, 0, 5]) == [1, 0, 5, 5, 5]
    assert main_text.segments([0, 90, 0, 0, 0, 10, 0, 0, 0, 100], 80) == [(1, 2), (9, 10)]


def test_extract_keeps_columns(spark):
    table = spark.createDataFrame([(1, None, "t"), (2, "<p>b", None)], "page_id long, html string, text string")
    made = main_text.extract(table).select("row.page_id", F.col("row.text").alias("old"), "text")
    assert rows_of(made) == [(1, "t", ""), (2, None, "b")]
    assert main_text.extract(table.limit(0)).collect() == []


TURNS = [
    (1, 0, "user", None), (1, 1, "assistant", ""), (1, 2, "Assistant", "\\### user ###\n</turn>\n#</"), (1, 2, "user", "b"), (1, None, None, "first"),
    (2, 0, "a#\\</b", "x" * 100_000), (2, 0, "a#\\</b", "x" * 100_000), (None, 5, "user", "n\n</turn>\n### assistant ###\nq"), (3, 0, "assistant", "\\\\n \\"),
]


def test_formatted_turns_read_back(spark):
    made = chat.formatted(spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)))
    for r in chat.read_back(made).collect():
        own = sorted((t for t in TURNS if t[0] == r["conv_id"]), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(t[2] or "", t[3] or "") for t in own]
        assert r["losses"] == [t[3] for t in own if (t[2] or "").lower() == "assistant" and t[3]]
        assert sum(x["chars"] for x in r["loss_runs"]) == len(r["formatted"]) and r["formatted"].count("</turn>") == len(own)
    assert made.count() == 4 and chat.formatted(made.sparkSession.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


LAYOUTS = [
    {"conv_id": 1, "turn": 0, "role": "user", "text": None},
    {"conv_id": 2, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]},
    {"id": 3, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]},
    {"id": 4, "prompt": "p", "completion": "c"},
    {"id": 5, "instruction": "do", "input": "this", "output": "done"},
    {"id": 6, "instruction": "do", "input": "", "output": None},
    {"id": 7, "unknown": "x"},
]


def test_layouts_become_turns(spark):
    table = spark.createDataFrame([(json.dumps(x),) for x in LAYOUTS], "j string").select(F.parse_json("j").alias("record"))
    assert rows_of(chat.canonical_turns(table)) == sorted([
        (1, 0, "user", None), (2, 0, "user", "q"), (2, 1, "assistant", None), (3, 0, "user", "q"), (3, 1, "assistant", "a"), (3, 2, "tool", "t"),
        (4, 0, "user", "p"), (4, 1, "assistant", "c"), (5, 0, "user", "do\n\nthis"), (5, 1, "assistant", "done"), (6, 0, "user", "do"), (6, 1, "assistant", None),
    ], key=repr)
    assert [r["shape"] for r in chat.unmapped(table).collect()] == ["OBJECT<id, unknown>"]


def test_text_ids_stay_apart(spark):
    rows = [
        {"id": f"identity_{n}", "conversations": [{"from": "human", "value": f"q{n}"}, {"from": "gpt", "value": f"a{n}"}]} for n in range(2)
    ] + [{"id": "empty", "conversations": []}, {"id": 3, "prompt": "p", "completion": "c"}]
    table = spark.createDataFrame([(json.dumps(x),) for x in rows], "j string").select(F.parse_json("j").alias("record"))
    turns = chat.canonical_turns(table, id_type="string")
    assert rows_of(turns) == sorted(
        [("identity_0", 0, "user", "q0"), ("identity_0", 1, "assistant", "a0"), ("identity_1", 0, "user", "q1"), ("identity_1", 1, "assistant", "a1"),
         ("3", 0, "user", "p"), ("3", 1, "assistant", "c")], key=repr)
    assert chat.formatted(turns).count() == 3 and chat.unmapped(table).count() == 0
    with pytest.raises(Exception, match="(?i)cast"):
        chat.canonical_turns(table).collect()
    shapes = [json.dumps(x) for x in ({"a": []}, {"a": [1, 2]}, {"a": ["x"]}, {"a": [None]}, {"a": [{"b": 1}]})]
    found = spark.createDataFrame([(x,) for x in shapes], "j string").select(chat.paths(F.parse_json("j")).alias("p")).collect()
    assert [r["p"] for r in found] == ["OBJECT<a: ARRAY>"] * 4 + ["OBJECT<a: ARRAY<OBJECT<b>>>"]


def test_pipeline_stages(spark):
    """Each stage on awkward rows: columns stay, decisions take effect, empty tables pass."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact", "near", "secrets", "pack"]
    folder = "/root/testdata/sf0.001"
    for rows in (None, []):
        table = docs(spark) if rows is None else docs(spark, rows)
        for name, stage in corpus_pipeline.STAGES[1:]:
            made = stage(spark, table, folder)
            if name != "pack":
                assert made.schema == table.schema, name
            table = made
        assert (table.count() > 0) == (rows is None)
    near = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs(spark), folder).collect()}
    assert near == {r[0] for r in by_pairs(ROWS, corpus_pipeline.NEAR) if r[0] == r[2] or r[0] is None}
    assert {9, 17, None} <= near and not {10, 12, 18, 19} & near


def test_quality_stage_of_awkward_rows(spark, tmp_path):
    """Nulls, repeated rows, names that operators use, and no documents."""
    folder = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{folder}/documents.parquet")
    table = given.unionByName(docs(spark), allowMissingColumns=True).withColumns({"doc": F.lit(1), "f": F.lit("x"), "_row_key": F.lit("k"), "score": F.lit(2)})
    kept = corpus_pipeline.reject_low_quality(spark, table, folder)
    assert kept.schema == table.schema
    scores = {tuple(r[c] for c in ("doc_id", "text")) for r in kept.select("doc_id", "text").collect()}
    twice = [r for r in table.select("doc_id", "text").collect() if (r["doc_id"], r["text"]) == (ROWS[9][0], ROWS[9][1])]
    assert len(twice) == 3 and kept.where(F.col("doc_id") == ROWS[9][0]).where(F.col("text") == ROWS[9][1]).count() in (0, 3) and scores
    assert corpus_pipeline.reject_low_quality(spark, table.limit(0), folder).count() == 0
    near = corpus_pipeline.drop_near_duplicates(spark, table, folder)
    assert near.columns == table.columns and {r["_row_key"] for r in near.select("_row_key").distinct().collect()} == {"k"}


def test_near_duplicates_by_row(spark):
    """Repeated and null ids: one row of each group stays, whatever the ids of the others."""
    text = lambda name, *odd: " ".join([f"{name}{n}" for n in range(60)] + list(odd))
    rows = [
        (1, text("a")), (2, text("a", "x")), (2, text("b")), (None, text("c")), (None, text("c", "x")), (None, text("a", "y")), (5, text("d")),
        (5, text("d", "x")), (5, text("e")), (5, text("e")), (-7, text("f")), (7, text("f", "x")), (None, None), (None, None), (None, "g"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(corpus_pipeline.drop_near_duplicates(spark, table, ""))
    groups = [{r for r in rows if r[1] and r[1].startswith(name)} for name in "abcdefg"]
    assert [len([r for r in got if r in group]) for group in groups] == [1] * 7
    assert {(1, text("a")), (2, text("b")), (-7, text("f")), (None, "g")} <= set(got) and got.count((None, None)) == 2 and len(got) == 9


def test_pipeline_run(spark):
    folder = "/root/testdata/sf0.001"
    made = registry.queries()["pipeline"](spark, folder)
    rows = made.collect()
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    assert 0 < len({r["doc_id"] for r in rows}) < documents.count()
    good = corpus_pipeline.reject_low_quality(spark, documents, folder)
    assert good.schema == documents.schema
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = {r["doc_id"] for r in good.collect()}
    for r in labels.collect():
        assert (r["doc_id"] in kept) == bool(r["quality"]) or r["quality"] == 0
    assert {r["doc_id"] for r in rows} <= kept
