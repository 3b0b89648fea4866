"""Secrets in texts: fixed patterns, and dictionary-primed compression novelty.

The patterns find assignments, access keys and hexadecimal runs in whole texts. Beyond them, a candidate is a run of
key-like characters shortly behind a sensitive word. A zstandard compressor is primed with a dictionary of common
identifiers and code followed by the candidate's own surroundings; the candidate's marginal compressed bytes tell how
much of it was not to be foreseen. Long candidates are judged by windows so short that zstandard leaves their literals as
they are: only matches save bytes, whatever the candidate's alphabet and length. A candidate with an incompressible window
is reported as ``novel``. What directly continues a reported candidate, behind a line break or a dot, is in its context,
however far the word is; the context of a key block reaches to its END line, and there short lines are candidates too.

Each text is scanned on its own in a Spark task; nothing is shuffled and texts are never cut.

Defined results: a null or empty text has no spans. Positions are code points, ends exclusive. Repeated rows give
repeated results. A candidate inside spans of the patterns is known. One that goes beyond them is judged by its parts outside
(without a name and equals sign before its value) and reported beside these spans, which stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from crewgauge.llm.batches import smaller

KINDS = ("assign", "access", "hex", "novel")
# The base patterns.
_ASSIGN = re.compile(r"(?ai:(?:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so this is [0-9a-f]+ with 16 characters or more
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: What a candidate stands behind, at most ``REACH`` code points before it.
_SENSITIVE = re.compile(r"(?ai:key|secret|token|passw|pwd|credential|auth|bearer|signature|private)")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
_BLOCK = re.compile(r"-{4,5} ?BEGIN [A-Z0-9 ]*KEY[A-Z0-9 ]*-{4,5}((?:(?!---- ?BEGIN ).)*?)---- ?END ", re.S)
#: A line of a key block that is shorter than a candidate elsewhere; line breaks may be escaped.
_SHORT_LINE = re.compile(r"(?:\n[ \t]*|\\n)([A-Za-z0-9+/_=-]{1,19})(?=[ \t]*\r?\n|\\)")
#: What stands between a candidate and its continuation: a line break, perhaps escaped, or a dot; short parts between dots are its own.
_PARTED = re.compile(r"[ \t]*\\?\r?\n[ \t]*|\\|\.((?:[A-Za-z0-9+/_=-]{1,19}\.)*)")
#: What may stand before a value in the same run of characters.
_NAME = re.compile(r"(?:[A-Za-z_][A-Za-z0-9_-]*=(?==*[^=]))*(?:0[xX])?")
REACH = 40
AROUND = 512
#: Marginal compressed bytes per byte from which a candidate counts as incompressible.
NOVEL = 0.8
#: Characters judged at once, half of them anew each time. zstandard entropy-codes literals from 64 on.
WINDOW = 40
_IDENTIFIERS = (
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 import from return function class public static void const "
    "string value default config settings username password secret token api_key access_key private_key client_id client_secret "
    "authorization bearer signature credential connection database localhost example.com https:// http:// www. .html .json .yaml "
    "the and that with this for are not have from they been would there their what about which when"
)


class _Novelty:
    """Marginal compressed size of a candidate behind what is known already."""

    def __init__(self, identifiers: str) -> None:
        self.identifiers = identifiers.encode()

    def share(self, candidate: str, around: str, enough: float = float("inf")) -> float:
        """The share of the candidate's least foreseen window; windows behind one that reaches ``enough`` are not looked at."""
        known = zstandard.ZstdCompressionDict(self.identifiers + around.encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        size = zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=False, write_dict_id=False)
        empty, most = len(size.compress(b"")), 0.0
        for start in (*range(0, len(candidate) - WINDOW, WINDOW // 2), max(0, len(candidate) - WINDOW)):
            window = candidate[start : start + WINDOW].encode()
            most = max(most, (len(size.compress(window)) - empty) / len(window))
            if most >= enough:
                break
        return most


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start and kind."""
    found = []
    if any(w in low for low in [text.lower()] for w in _ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def novel_spans(text: str, known: list[tuple[int, int, str]], novelty: _Novelty, threshold: float) -> list[tuple[int, int, str]]:
    """Incompressible strings behind sensitive words that no pattern has found, or not all of."""
    blocks = [m.span(1) for m in _BLOCK.finditer(text)] if "BEGIN " in text else []
    runs = [m.span() for m in _CANDIDATE.finditer(text)]
    if blocks:
        runs = sorted(runs + [m.span(1) for block in blocks for m in _SHORT_LINE.finditer(text, block[0] - 1, block[1])])
    found, end = [], None  # of the last candidate that is secret
    for a, b in runs:
        parted = _PARTED.fullmatch(text, end, a) if end is not None else None
        if not parted and not _SENSITIVE.search(text, max(0, a - REACH), a) and not any(s <= a < e for s, e in blocks):
            continue
        around = text[max(0, a - AROUND) : a] + text[b : b + AROUND]
        start, parts = _outside(text, a, b, known)
        if any(novelty.share(text[s:e], around, threshold) >= threshold for s, e in parts):
            found.append((parted.start(1) if parted and parted[1] else start, b, "novel"))
            end = b
        elif not parts:
            end = b
    return found


def _outside(text: str, a: int, b: int, known: list[tuple[int, int, str]]) -> tuple[int, list[tuple[int, int]]]:
    """Where the value of the candidate from ``a`` to ``b`` starts, and its parts outside the spans of the patterns."""
    spans = [(s, e, kind) for s, e, kind in known if a < e and s < b]
    if not spans:
        return a, [(a, b)]
    start = at = _NAME.match(text, a, b).end()
    parts = []
    for s, e, kind in spans:
        if s > at and (kind != "assign" or s - at >= 20):  # what is before an assignment belongs to its name
            parts.append((at, s))
        at = max(at, e)
    return start, parts + [(at, b)] * (at < b)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are one, named by the first."""
    merged: list[list] = []
    for start, end, kind in spans:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    parts, at = [], 0
    for start, end, kind in merged:
        parts += [text[at:start], f"[{kind}]"]
        at = end
    return "".join([*parts, text[at:]])


def scan(docs: DataFrame, text_col: str = "text", identifiers: str = _IDENTIFIERS, threshold: float = NOVEL) -> DataFrame:
    """``docs`` as a struct ``row``, with ``spans`` (start, end, kind) in order and the ``redacted`` text (null if the text is)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = _Novelty(identifiers)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for batch in smaller(batches):
            out, texts = [], batch.column(0).field(place).to_pylist()
            for n, text in enumerate(texts):
                spans = pattern_spans(text or "")
                spans += novel_spans(text or "", spans, novelty, threshold)
                spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
                out.append([{"start": a, "end": b, "kind": k} for a, b, k in spans])
                if spans:
                    texts[n] = redacted(text, spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind), pa.array(texts, pa.string())], ["row", "spans", "redacted"])

    place = docs.columns.index(text_col)
    rows = docs.select(F.struct("*").alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, spans array<struct<start:bigint,end:bigint,kind:string>>, redacted string")


def span_text(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def report(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: the number of spans of each pattern, the digest of these spans, and all spans."""
    base = F.filter("spans", lambda s: s.kind != "novel")
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(
        F.col(f"row.{id_col}").alias("doc_id"), *map(count, KINDS[:3]),
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
    )
