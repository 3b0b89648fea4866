"""Chat formatting by schema fingerprints, in DataFrame functions only.

Records of any layout are variants. The nested field paths of a record, without types and values, are hashed; the
fingerprint selects a declarative mapping that yields canonical turns (conv_id, turn, role, text). Turns are formatted
as ``### role ###``, the text and ``</turn>``. Backslashes, ``#`` and ``</`` inside texts and roles are escaped with a
backslash, so no text can contain a control string, and removing the escapes gives the text back.

The loss mask is a list of runs, one per turn: the code points of the turn, how many at its start are not under the
mask, and how many after them are (an assistant's text; none for other roles).

A formatted conversation is one string, so its turns meet in one row whatever their number; that follows from the
result, and conversations are spread over tasks by id.

Defined results: null texts and roles count as empty; null ids form one conversation; turns with equal numbers are
ordered by role and text, repeated turns stay. Records whose fingerprint has no mapping give no turns; ``unmapped``
lists them. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_TURNS = "array<struct<turn: bigint, role: string, text: string>>"
_OPEN, _CLOSE, _END = "### ", " ###\n", "\n</turn>\n"


@dataclass(frozen=True)
class Mapping:
    """``shape``: the nested field paths as ``paths`` writes them. ``turns``: canonical turns from the record."""

    shape: str
    conv_id: str
    turns: Callable[[Column], Column]


def _get(record: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(record, f"$.{path}", kind)


def _said(*turns: tuple[int, str, Column]) -> Column:
    return F.array(*(F.struct(F.lit(n).cast("bigint").alias("turn"), F.lit(r).alias("role"), t.alias("text")) for n, r, t in turns))


def _listed(path: str, role: str, text: str, names: dict[str, str]) -> Callable[[Column], Column]:
    """Turns from a list of objects; ``names`` gives canonical roles."""

    def turns(record: Column) -> Column:
        rows = _get(record, path, f"array<struct<{role}: string, {text}: string>>")
        known = F.create_map(*(F.lit(x) for pair in names.items() for x in pair)) if names else None
        called = lambda r: F.coalesce(F.try_element_at(known, r), r) if known is not None else r
        return F.transform(rows, lambda row, n: F.struct(n.cast("bigint").alias("turn"), called(row[role]).alias("role"), row[text].alias("text")))

    return turns


def _asked(record: Column) -> Column:
    task, given = _get(record, "instruction", "string"), _get(record, "input", "string")
    question = F.when(F.coalesce(given, F.lit("")) != "", F.concat(task, F.lit("\n\n"), given)).otherwise(task)
    return _said((0, "user", question), (1, "assistant", _get(record, "output", "string")))


#: The layouts known by default.
MAPPINGS = (
    Mapping(
        "OBJECT<conv_id, role, text, turn>", "conv_id",
        lambda r: F.array(F.struct(_get(r, "turn", "bigint").alias("turn"), _get(r, "role", "string").alias("role"), _get(r, "text", "string").alias("text"))),
    ),
    Mapping("OBJECT<conv_id, messages: ARRAY<OBJECT<content, role>>>", "conv_id", _listed("messages", "role", "content", {})),
    Mapping(
        "OBJECT<conversations: ARRAY<OBJECT<from, value>>, id>", "id",
        _listed("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
    ),
    Mapping(
        "OBJECT<completion, id, prompt>", "id",
        lambda r: _said((0, "user", _get(r, "prompt", "string")), (1, "assistant", _get(r, "completion", "string"))),
    ),
    Mapping("OBJECT<id, input, instruction, output>", "id", _asked),
)


def paths(record: Column) -> Column:
    """The nested field paths of a record: its variant schema without the types of values, list elements included."""
    fields = F.regexp_replace(F.schema_of_variant(record), r": (?!OBJECT<|ARRAY<)[A-Z]+(\([0-9, ]*\))?", "")
    return F.regexp_replace(fields, r"ARRAY<(?!OBJECT<|ARRAY<)[A-Z]+(\([0-9, ]*\))?>", "ARRAY")


def _shapes(m: Mapping) -> list[str]:
    """The shapes of a mapping: its own, and that of a record whose lists are empty."""
    return [m.shape, re.sub(r"ARRAY<OBJECT<[^<>]*>>", "ARRAY", m.shape)]


def fingerprint(shape: Column) -> Column:
    return F.xxhash64(shape)


def canonical_turns(
    records: DataFrame, mappings: Sequence[Mapping] = MAPPINGS, record_col: str = "record", id_type: str = "bigint"
) -> DataFrame:
    """(conv_id, turn, role, text) of every record whose fingerprint has a mapping.

    Ids are read as ``id_type``; one that does not fit fails the query, so that conversations never run together under a null
    id. As ``string`` an id of any kind fits.
    """
    record = F.col(record_col)
    rows = records.select(record.alias("record"), fingerprint(paths(record)).alias("print"))
    turns, conv = F.lit(None).cast(_TURNS), F.lit(None).cast(id_type)
    for m in mappings:
        fits = F.col("print").isin([fingerprint(F.lit(shape)) for shape in _shapes(m)])
        turns = F.when(fits, m.turns(F.col("record")).cast(_TURNS)).otherwise(turns)
        conv = F.when(fits, F.variant_get(F.col("record"), f"$.{m.conv_id}", id_type)).otherwise(conv)
    return rows.select(conv.alias("conv_id"), F.explode(turns).alias("said")).select("conv_id", "said.*")


def unmapped(records: DataFrame, mappings: Sequence[Mapping] = MAPPINGS, record_col: str = "record") -> DataFrame:
    """The records without a mapping, with their field paths."""
    shape = paths(F.col(record_col))
    known = [fingerprint(F.lit(s)) for m in mappings for s in _shapes(m)]
    return records.withColumn("shape", shape).where(~F.coalesce(fingerprint(shape).isin(known), F.lit(False)))


def escaped(text: Column) -> Column:
    plain = F.coalesce(text, F.lit(""))
    for old, new in (("\\", "\\\\"), ("#", "\\#"), ("</", "<\\/")):
        plain = F.replace(plain, F.lit(old), F.lit(new))
    return plain


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\#/])", "$1")


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_runs): one row per conversation, turns in order."""
    said = F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
    head = lambda s: F.concat(F.lit(_OPEN), escaped(s.role), F.lit(_CLOSE))
    piece = lambda s: F.concat(head(s), escaped(s.text), F.lit(_END))
    under = lambda s: F.when(F.lower(s.role) == "assistant", F.length(escaped(s.text))).otherwise(F.lit(0))
    run = lambda s: F.struct(F.length(piece(s)).alias("chars"), F.length(head(s)).alias("skip"), under(s).alias("keep"))
    rows = turns.groupBy("conv_id").agg(said.alias("said"))
    return rows.select("conv_id", F.array_join(F.transform("said", piece), "").alias("formatted"), F.transform("said", run).alias("loss_runs"))


def read_back(conversations: DataFrame) -> DataFrame:
    """``conversations`` with turns (role, text) from the formatted string, and losses: the unescaped texts under the mask."""
    pieces = F.split("formatted", _END)
    rows = conversations.withColumn("pieces", F.slice(pieces, F.lit(1), F.size(pieces) - F.lit(1)))
    role = lambda p: F.substring_index(F.substring(p, len(_OPEN) + 1, 1 << 30), _CLOSE, 1)
    text = lambda p: F.substring(p, F.length(role(p)) + F.lit(len(_OPEN) + len(_CLOSE) + 1), F.lit(1 << 30))
    turn = lambda p: F.struct(unescaped(role(p)).alias("role"), unescaped(text(p)).alias("text"))
    masked = F.zip_with("pieces", "loss_runs", lambda p, r: F.struct(r.keep.alias("keep"), F.substring(p, r.skip + F.lit(1), r.keep).alias("text")))
    losses = F.transform(F.filter(masked, lambda m: m.keep > 0), lambda m: unescaped(m.text))
    return rows.withColumn("turns", F.transform("pieces", turn)).withColumn("losses", losses).drop("pieces")


def digests(conversations: DataFrame) -> DataFrame:
    """Per conversation: turns and loss text read back from ``formatted``, as digests, and the string's length."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    lost = F.array_join("losses", "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return read_back(conversations).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), sha(told).alias("turns_sha256"),
        F.length(lost).cast("long").alias("loss_chars"), sha(lost).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
