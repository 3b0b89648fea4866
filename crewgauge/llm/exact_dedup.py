"""Exact duplicates by two-pass Bloom filtering, in DataFrame functions only.

Pass 1 hashes every normalised text to two positions of a fixed bit array and keeps the positions that were hit
more than once; only position counts are shuffled. Pass 2 probes that array: a text with a position that was hit
once is unique and goes straight through. Only the rest, possibly repeated, is shuffled by its full digest.

The array has at most ``BITS`` bits, so its broadcast (``BITS / 64`` rows of two longs) has a fixed bound. On a
corpus that fills it, more rows are shuffled and the result stays the same.

Defined results: a null text counts as empty; empty texts are equal to each other. Of equal texts the largest id
stays, null ids count as smallest; of rows that repeat both text and id one stays (the first by a hash of its
other columns). Extra columns are carried along whatever their names are.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from crewgauge.llm.scratch import written

#: Bits of the filter: 2**26 make 16 MiB of broadcast words.
BITS = 1 << 26
_WORD = 64


def normalised(text: Column | str) -> Column:
    """The text with A-Z lower-cased and nothing else changed; null becomes empty."""
    return F.translate(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def digest(text: Column | str) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def _positions(bits: int) -> list[Column]:
    """Two positions from the digest's own bytes, which are uniform."""
    number = lambda first: F.conv(F.hex(F.substring("digest", first, 7)), 16, 10).cast("long")
    return [number(first) % bits for first in (1, 9)]


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (position % _WORD).cast("int"))


def repeated_words(digests: DataFrame, bits: int = BITS) -> DataFrame:
    """Pass 1: (word, mask) of the positions that were hit more than once; ``bits / 64`` rows at most."""
    hits = digests.select(F.explode(F.array(*_positions(bits))).alias("position"))
    often = hits.groupBy("position").agg(F.count("*").alias("hits")).where("hits > 1")
    return _as_words(often)


def _as_words(positions: DataFrame) -> DataFrame:
    word = F.floor(F.col("position") / _WORD).cast("long")
    return positions.groupBy(word.alias("word")).agg(F.bit_or(_bit(F.col("position"))).alias("mask"))


def probed(rows: DataFrame, words: DataFrame, bits: int = BITS) -> DataFrame:
    """Pass 2: ``rows`` with ``maybe``, true where both positions of the digest were hit more than once."""
    maybe = F.lit(True)
    for n, position in enumerate(_positions(bits)):
        side = F.broadcast(words.select(F.col("word").alias(f"word{n}"), F.col("mask").alias(f"mask{n}")))
        rows = rows.withColumn(f"word{n}", F.floor(position / _WORD).cast("long")).join(side, f"word{n}", "left")
        maybe &= F.coalesce(F.col(f"mask{n}").bitwiseAND(_bit(position)), F.lit(0)) != 0
    return rows.withColumn("maybe", maybe).drop(*(f"{x}{n}" for x in ("word", "mask") for n in (0, 1)))


def decide(rows: DataFrame, words: DataFrame, groups: DataFrame, order: Column, bits: int = BITS) -> DataFrame:
    """``rows`` (id, digest, ...) with keep_id, group_size and kept; ``order`` breaks ties of rows alike in id and text."""
    seen = probed(rows, words, bits)
    straight = seen.where("not maybe").select(
        *rows.columns, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    same = Window.partitionBy("digest", "id").orderBy(order)
    rest = seen.where("maybe").withColumn("nth", F.row_number().over(same)).join(groups, "digest")
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    return straight.unionByName(rest.select(*rows.columns, "keep_id", "group_size", kept.alias("kept")))


def equal_groups(digests: DataFrame, words: DataFrame, bits: int = BITS) -> DataFrame:
    """(digest, keep_id, group_size) of the possibly repeated digests, counted before they are shuffled."""
    maybe = probed(digests, words, bits).where("maybe")
    return maybe.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))


def duplicate_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: id, digest, keep_id, group_size, kept. Texts are read once; only digests are kept."""
    digests = written(docs.select(F.col(id_col).alias("id"), digest(text_col).alias("digest")), "digests")
    words = written(repeated_words(digests, bits), "repeated")
    return decide(digests, words, equal_groups(digests, words, bits), F.col("id"), bits)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` without repeated texts, all columns as they were. Only possibly repeated rows are shuffled."""
    rows = docs.select(F.col(id_col).alias("id"), digest(text_col).alias("digest"), F.struct("*").alias("row"))
    digests = written(rows.select("id", "digest"), "digests")
    words = written(repeated_words(digests, bits), "repeated")
    groups = equal_groups(digests, words, bits)
    order = F.xxhash64(F.to_json("row"))
    return decide(rows, words, groups, order, bits).where("kept").select("row.*")


def without(docs: DataFrame, id_col: str, ids: DataFrame, bits: int = BITS, once: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose id is not among ``ids`` (a column ``id_col``); rows with a null id stay.

    Of the rows with one of the ids ``once``, none of them among ``ids``, one stays.

    Rows that miss the filter made of ``ids`` go straight through; the others, nearly all of them to be dropped, are
    shuffled by id.
    """
    key = lambda c: F.unhex(F.sha2(F.col(c).cast("string").cast("binary"), 256))
    listed = ids.select(id_col, F.lit(False).alias("stays"))
    if once is not None:
        listed = listed.unionByName(once.select(id_col, F.lit(True).alias("stays")))
    hits = listed.select(key(id_col).alias("digest")).select(F.explode(F.array(*_positions(bits))).alias("position"))
    words = written(_as_words(hits), "dropped")
    rows = docs.select(F.col(id_col).alias("id"), key(id_col).alias("digest"), F.struct("*").alias("row"))
    seen = probed(rows, words, bits)
    maybe = F.coalesce(F.col("maybe") & F.col("id").isNotNull(), F.lit(False))
    if once is None:
        rest = seen.where(maybe).join(ids.select(F.col(id_col).alias("id")), "id", "left_anti")
    else:
        rest = seen.where(maybe).join(listed.withColumnRenamed(id_col, "id"), "id", "left").where("stays is null or stays")
        nth = F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64(F.to_json("row"))))
        rest = rest.withColumn("nth", nth).where("stays is null or nth = 1")
    return seen.where(~maybe).select("row.*").unionByName(rest.select("row.*"))
