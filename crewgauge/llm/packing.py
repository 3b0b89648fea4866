"""Packing documents into training sequences by power-of-two decomposition.

A document's token ids are cut into pieces whose lengths are powers of two: as many of the longest as fit, then the
binary digits of the rest, longest first. Every piece is a sequence of its own, so no sequence crosses documents,
none needs padding, and ``bucket`` (the length) groups sequences that can be batched as a rectangle.

The work has no shuffle: a task reads texts, encodes them and writes pieces. Words repeat, so each worker encodes a
word once and looks it up afterwards, in a table of bounded size. New words of letters are encoded by ranks, which one
task makes when ``pack`` is called; the driver loads no tokenizer.

Defined results: a null or empty text has only the end token, one piece. Repeated rows are packed each on their own.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from crewgauge.llm.batches import smaller
from crewgauge.llm.letter_words import letter_encoder, letter_ranks
from crewgauge.llm.words import BareEncoder

LONGEST = 4096
#: The id that ends a document.
END_ID = 2

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ordinal long, offset long, bucket int, ids array<int>"


def piece_lengths(total: int, longest: int = LONGEST) -> list[int]:
    """The lengths of a document's pieces, in order; ``longest`` is a power of two."""
    rest = total % longest
    return [longest] * (total // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


def _ranks(spark: SparkSession, tokenizer_path: str) -> dict[bytes, int]:
    """``letter_ranks`` of a task: a loaded vocabulary takes far more memory than its ranks, and a driver keeps much of it from call to call."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:  # one row
            ranks = letter_ranks(tokenizer_path)
            yield pa.RecordBatch.from_arrays([pa.array(list(ranks), pa.binary()), pa.array(list(ranks.values()), pa.int64())], ["piece", "id"])

    made = spark.range(0, 1, 1, 1).mapInArrow(run, "piece binary, id long").toArrow()
    return dict(zip(made["piece"].to_pylist(), made["id"].to_pylist(), strict=True))


def _packer(tokenizer_path: str, longest: int, end_id: int, with_ids: bool, ranks: dict[bytes, int] | None = None):
    if ranks is None:
        ranks = letter_ranks(tokenizer_path)  # travels with the function; the vocabulary's size bounds it

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = BareEncoder(tokenizer_path, of_letters=letter_encoder(ranks) if ranks else None)
        end = np.array([end_id], "<u4").tobytes()
        for batch in smaller(batches):
            out: list[list] = [[] for _ in range(9)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = words.encode(text or "") + end
                total, start = len(ids) // 4, 0
                for length in piece_lengths(total, longest):
                    piece = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, start, length, zlib.crc32(piece), total, 0, 0, length, np.frombuffer(piece, "<i4") if with_ids else None)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    start += length
            types = [pa.int64()] * 7 + [pa.int32(), pa.list_(pa.int32())]
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "ordinal", "offset", "bucket", "ids")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return pack


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    longest: int = LONGEST, end_id: int = END_ID, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket and (if wanted) ids."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranks = _ranks(docs.sparkSession, tokenizer_path)
    pieces = texts.mapInArrow(_packer(tokenizer_path, longest, end_id, with_ids, ranks), _SCHEMA)
    pieces = pieces.withColumn("sequence_id", F.monotonically_increasing_id()).drop("ordinal")
    return pieces if with_ids else pieces.drop("ids")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The packed sequences as one folder per length."""
    pieces.write.partitionBy("bucket").parquet(path)


def default_tokenizer(name: str) -> str:
    """The place of a public tokenizer file on this machine; executors have it at the same place."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
