"""BPE encoding through a table of distinct words, and decoding through an id-to-piece table.

``encode`` is ``word_join``: texts are split in Spark, every distinct word is encoded once, and its ids are joined back
by position. ``decode`` joins ids with the vocabulary's pieces: the pieces are one table of fixed size with the id as
row number, sent to every task, and a batch of ids takes its rows from it. ``encode_and_decode`` does both in the tasks that
put the ids together.

Defined results: a null text counts as empty and has no ids. A text with the string of an added token gets that
token's id. Repeated rows are encoded each on their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crewgauge.llm import word_join
from crewgauge.llm.batches import smaller
from crewgauge.llm.words import SpacedEncoder


def encode(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    words: int = word_join.SLICE_WORDS, letters: int = word_join.SLICE_LETTERS,
) -> DataFrame:
    """(doc_id, ids): the ids of every row's whole text, as little-endian unsigned 32-bit bytes."""
    return word_join.encoded(docs, SpacedEncoder, tokenizer_path, id_col, text_col, words, letters)


def id_pieces(tokenizer_path: str) -> list[bytes]:
    """The bytes of every id, by id; the vocabulary's size bounds it."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    decode = _piece_bytes()
    vocabulary = tokenizer.get_vocab()
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for piece, number in vocabulary.items():
        pieces[number] = b"".join(decode.get(c, c.encode()) for c in piece)
    return pieces


def _piece_bytes() -> dict[str, bytes]:
    """Byte-level vocabularies name printable bytes by their Latin-1 letter and the others by letters from U+0100 on."""
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): bytes([b]) for b in printable} | {chr(256 + n): bytes([b]) for n, b in enumerate(others)}


_DECODED = "doc_id long, ids binary, text string"


def _texts(table: pa.LargeBinaryArray, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of (doc_id, ids) with their texts, from the table of pieces."""
    rows = batch.column(1).to_pylist()
    taken = table.take(pa.array(np.frombuffer(b"".join(rows), "<u4")))
    data, many = taken.buffers()[2], np.cumsum([0, *(len(ids) // 4 for ids in rows)])
    cuts = np.frombuffer(taken.buffers()[1], "<i8", len(taken) + 1)[many].tolist() if len(taken) else [0] * len(many)
    texts = [data[a:b].to_pybytes().decode("utf-8", "replace") if a < b else "" for a, b in zip(cuts, cuts[1:], strict=False)]
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids) with the decoded ``text``; bytes that are no UTF-8 become U+FFFD."""
    pieces = encoded.sparkSession.sparkContext.broadcast(id_pieces(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(pieces.value, pa.large_binary())
        for batch in smaller(batches):
            yield _texts(table, batch)

    return encoded.select("doc_id", "ids").mapInArrow(run, _DECODED)


def encode_and_decode(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    words: int = word_join.SLICE_WORDS, letters: int = word_join.SLICE_LETTERS,
) -> DataFrame:
    """``decode`` of ``encode``: a block's ids are decoded where they are put together, so that a task needs one Python worker, not two."""
    pieces = docs.sparkSession.sparkContext.broadcast(id_pieces(tokenizer_path))

    def then() -> word_join.Then:
        table = pa.array(pieces.value, pa.large_binary())
        return lambda rows: _texts(table, rows), pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    return word_join.encoded(docs, SpacedEncoder, tokenizer_path, id_col, text_col, words, letters, then, _DECODED)


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the output of ``decode`` or ``encode_and_decode``."""
    return decoded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
