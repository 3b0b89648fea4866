"""A corpus pipeline: every stage reads what its predecessor has written and calls one operator of ``crewgauge.llm``.

``quality`` drops documents that the classifier rejects, ``exact`` all but one of equal texts, ``near`` all but one of
each group of near duplicates (five words, similarity 0.8), ``secrets`` replaces secrets by their kind in brackets,
``pack`` cuts the rest into training sequences. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from crewgauge.llm import exact_dedup, ngram_join, packing, quality, secret_scan
from crewgauge.llm.scratch import written
from crewgauge.session import scratch_path

#: The near-duplicate stage's word n-grams and similarity.
NEAR = ngram_join.Bound(words=5, num=80, den=100)


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score as good, by a classifier learned from ``labels`` on these documents. A null text counts as
    empty and is scored like any other; repeated rows stay or go together; without a positive label, or without documents, all stay."""
    table = written(quality.feature_table(docs), "features")
    return quality.keep_good(docs, quality.learn(table, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for the case of A-Z, as ``exact_dedup.drop_duplicates`` says; null texts count
    as empty ones."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked documents stays, that with the smallest id that is not null and then the smallest
    digest of its text. Rows are told apart by id and text, so null and repeated ids are decided row by row."""
    key = "_row_key"
    while key in docs.columns:
        key += "_"
    keyed = docs.withColumn(key, F.hex(ngram_join.row_key()))
    classes = ngram_join.classes(docs.select(ngram_join.row_key().alias(key), "text"), NEAR, key, id_type="binary")
    rows = classes.where("n_shingles > 0").groupBy("doc_id").agg(F.max(F.expr("doc_id != component_id")).alias("other"), F.count("*").alias("n"))
    rows = written(rows.where("other or n > 1").select(F.hex("doc_id").alias(key), "other"), "others")
    return exact_dedup.without(keyed, key, rows.where("other"), once=rows.where("not other")).drop(key)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by their kind in brackets and ``n_chars`` set anew where that happened. Null and
    empty texts have no secrets and stay as they are."""
    scanned = secret_scan.scan(docs)
    changed = F.size("spans") > 0
    new = {"text": F.col("redacted"), "n_chars": F.when(changed, F.length("redacted")).otherwise(F.col("row.n_chars")).cast("bigint")}
    return scanned.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents as ``packing.pack`` cuts them; a null or empty text is its end token alone."""
    return packing.pack(docs, packing.default_tokenizer("word_bpe_49k.json"), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", reject_low_quality),
    ("exact", drop_exact_duplicates),
    ("near", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("pack", pack_sequences),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet below the shared folder and read by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = scratch_path(spark, "pipeline")
    for n, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{root}/{n}-{name}")
        docs = spark.read.schema(made.schema).parquet(f"{root}/{n}-{name}")
    return docs
