"""Allow and block rules for URLs, in DataFrame functions only.

Every distinct (host, path) is expanded into host suffixes and path prefixes, as far as some rule has that number
of labels and that path length. Expressions meet the rules on the first bytes of their digests; the full digest
confirms a meeting, and the longest rule wins.

Hot hosts and URLs: equal URLs are reduced to one row before they are expanded; the way back to the pages is a plain
join whose large partitions adaptive execution splits. The rules are joined as Spark's size check decides.

Defined results: a null URL or one without ``://`` has an empty host and path, and no rule fits it. Of rules of
equal length the longer host wins, then block over allow. An empty path fits no rule, since a rule's path starts
with a slash. Repeated rows give repeated results.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Hex digits of a digest that the join uses.
SHORT = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where it is null or has no ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(F.split(rest, "[?#]", 2)[0], F.lit(""))
    host = F.split(rest, "/", 2)[0]
    path = F.substring(rest, F.length(host) + F.lit(1), F.length(rest))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """(verdict, rule) pairs as the table that ``judge`` takes; a rule is ``host/path``."""
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def _prepared(rules: DataFrame) -> DataFrame:
    host = F.substring_index("rule", "/", 1)
    path = F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)")
    host = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return rules.where("rule is not null").select(
        "verdict", "rule", _digest(host, path).alias("rule_digest"), F.length(host).alias("host_length"),
        F.size(F.split(host, r"\.")).alias("labels"), F.length(path).alias("path_length"),
    )


def _expressions(labels: list[int], lengths: list[int]) -> Column:
    """All (host suffix, path prefix) of a row that a rule of these label counts and path lengths could equal."""
    names = F.split("host", r"\.")
    depths = F.filter(F.array(*map(F.lit, labels)), lambda n: n <= F.size(names))
    sizes = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path"))
    suffixes = F.transform(depths, lambda n: F.array_join(F.slice(names, F.size(names) - n + 1, n), "."))
    prefixes = F.transform(sizes, lambda n: F.substring(F.col("path"), F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: _digest(h, p))))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` as a struct ``row``, with host, path, rule (null if none fits) and verdict (``default`` if none fits)."""
    rules = _prepared(rules)
    shapes = rules.agg(F.collect_set("labels").alias("labels"), F.collect_set("path_length").alias("lengths")).first()
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    if not shapes["labels"]:
        return rows.select("row", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    urls = rows.select("host", "path").distinct()
    tried = urls.select("host", "path", F.explode(_expressions(sorted(shapes["labels"]), sorted(shapes["lengths"]))).alias("digest"))
    met = tried.join(
        rules.withColumn("short", F.substring("rule_digest", 1, SHORT)), F.substring("digest", 1, SHORT) == F.col("short")
    ).where("digest = rule_digest")
    rank = F.struct(F.length("rule").alias("length"), "host_length", "verdict", "rule")
    best = met.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(
        "row", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
