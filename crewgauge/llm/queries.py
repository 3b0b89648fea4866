"""The registered queries of this subpackage, and their SQL for a second engine where SQL can say it."""

from __future__ import annotations

import json
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from crewgauge.llm import (
    bpe, chat, exact_dedup, hamming, main_text, ngram_join, packing, parsed_repeats, periodic_runs, quality, ranked_search,
    secret_scan, url_rules,
)
from crewgauge.llm.packing import default_tokenizer
from crewgauge.llm.scratch import written

URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

#: A conversation, in another layout, whose texts look like control strings.
MARKED_CONVERSATION = json.dumps({
    "conv_id": -7,
    "messages": [{"role": role, "content": "\\### Assistant: </turn> ok"} for role in ("user", "assistant")],
})


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join(_table(spark, folder, "documents"))


def op2_hamming(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    return hamming.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    judged = url_rules.judge(pages, url_rules.rule_table(spark, URL_RULES))
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs, path = _table(spark, folder, "documents"), default_tokenizer("byte_bpe_50k.json")
    return bpe.digests(bpe.encode_and_decode(docs, path))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    report = exact_dedup.duplicate_report(_table(spark, folder, "documents"))
    return report.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    table = written(quality.feature_table(_table(spark, folder, "documents")), "features")
    return quality.scored(table, quality.learn(table, _table(spark, folder, "labels")))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(secret_scan.scan(_table(spark, folder, "documents").select("doc_id", "text")))


def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = main_text.extract(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    records = rows.select(F.call_function("to_variant_object", F.struct("*")).alias("record"))
    extra = spark.createDataFrame([(MARKED_CONVERSATION,)], "json string").select(F.parse_json("json").alias("record"))
    return chat.digests(chat.formatted(chat.canonical_turns(records.unionByName(extra))))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return packing.pack(docs, default_tokenizer("word_bpe_49k.json"), with_ids=False)


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """The texts of ``documents``; in every tenth, by a hash of the id, the words from some place on repeat with some period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words).cast("bigint")
        first = g % n
        period = 1 + F.floor((n - first) / (3 + g % 8))
        return F.array_join(F.transform(words, lambda w, i: F.when(i < first, w).otherwise(F.get(words, first + (i - first) % period))), " ")

    words = F.array(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")))  # in an array, so that it is made once
    planted = F.transform(words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(""))[0]
    return docs.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.detect(_with_planted_runs(_table(spark, folder, "documents")))
    stronger = lambda a, b: a["period"].isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    none = F.from_json(F.lit("{}"), "start bigint, length bigint, period bigint")
    best = F.aggregate("runs", none, lambda a, b: F.when(stronger(a, b), b).otherwise(a))  # in order, so the first of equals stays
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "row.doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.rank(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), k=50)


def op13_parsed_repeats(spark: SparkSession, folder: str) -> DataFrame:
    kept = parsed_repeats.remove_repeats(_table(spark, folder, "documents"), with_text=False)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return kept.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256"
    )


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_hamming": op2_hamming,
    "op3_url_rules": op3_url_rules,
    "op4_bpe": op4_bpe,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quality": op6_quality,
    "op7_secret_scan": op7_secret_scan,
    "op8_main_text": op8_main_text,
    "op9_chat": op9_chat,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_ranked_search": op12_ranked_search,
    "op13_parsed_repeats": op13_parsed_repeats,
    "pipeline": corpus_pipeline.run,
}

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SQL = {
    "op1_ngram_join": rf"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
        ), sets AS (
            SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS gram FROM texts
        ), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM sets a JOIN sets b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * shared >= 85 * (s.n + t.n - shared)
        ), reached(x, y) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y
        ), least AS (SELECT x, min(y) AS component_id FROM reached GROUP BY x),
        degrees AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links FROM documents d
        LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.x = d.doc_id LEFT JOIN degrees g ON g.x = d.doc_id
    """,
    "op2_hamming": """
        WITH codes AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x > 0 AND NOT isnan(x) AS INTEGER)) AS code FROM embeddings WHERE embedding IS NOT NULL),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.code, c.code), lambda p: CAST(p[1] <> p[2] AS INTEGER))) AS distance
            FROM codes q, codes c WHERE q.vec_id % 100 = 0
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)
        SELECT query_id, rank, vec_id, CAST(distance AS BIGINT) AS distance FROM ranked WHERE rank <= 10
    """,
    "op3_url_rules": """
        WITH rests AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), parts AS (
            SELECT row_number() OVER () AS n, page_id, regexp_extract(rest, '^[^?#]*') AS rest FROM rests
        ), urls AS (
            SELECT n, page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                substr(rest, length(split_part(rest, '/', 1)) + 1) AS path FROM parts
        ), rules(verdict, rule, rule_host, rule_path) AS (
            VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
                ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')
        ), best AS (
            SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM urls, rules
            WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY n
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN best USING (n)
    """,
    "op5_exact_dedup": f"""
        WITH texts AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents),
        groups AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM texts JOIN groups USING (text_sha256)
    """,
    "op9_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
            CAST(sum(18 + length(role) + length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/'))) AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id
    """,
    "op12_ranked_search": rf"""
        WITH spelt AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents),
        counts AS (SELECT doc_id, term, count(*) AS tf FROM spelt GROUP BY ALL),
        lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id),
        totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM counts, totals GROUP BY term, docs
        ), asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark),
        scores AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
            FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals GROUP BY ALL
        ), ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
        )
        SELECT * FROM ranked WHERE rank <= 50
    """,
    "op13_parsed_repeats": """
        WITH texts AS (SELECT row_number() OVER () AS n, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        windows AS (
            SELECT n, i, md5(substr(h, CAST(2 * i + 1 AS BIGINT), 800)) AS digest
            FROM (SELECT n, h, unnest(range(0, greatest(length(h) // 2 - 399, 0))) AS i FROM texts)
        ), repeated AS (
            SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY digest) AS c FROM windows) WHERE c > 1
        ), numbered AS (
            SELECT n, i, sum(CAST(i - before > 400 OR before IS NULL AS INTEGER)) OVER (PARTITION BY n ORDER BY i) AS span
            FROM (SELECT n, i, lag(i) OVER (PARTITION BY n ORDER BY i) AS before FROM repeated)
        ), spans AS (SELECT n, span, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY n, span),
        edges AS (
            SELECT n, a AS stop, lag(b, 1, 0) OVER (PARTITION BY n ORDER BY a) AS start FROM spans
            UNION ALL SELECT t.n, length(any_value(h)) // 2, coalesce(max(b), 0) FROM texts t LEFT JOIN spans s ON s.n = t.n GROUP BY t.n
        ), kept AS (SELECT n, string_agg(substr(h, CAST(2 * start + 1 AS BIGINT), CAST(2 * (stop - start) AS BIGINT)), '' ORDER BY start) AS k FROM edges JOIN texts USING (n) GROUP BY n),
        removed AS (SELECT n, count(*) AS spans, CAST(sum(b - a) AS BIGINT) AS bytes FROM spans GROUP BY n)
        SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(bytes, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
        FROM texts JOIN kept USING (n) LEFT JOIN removed USING (n)
    """,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return _SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
