"""Words of plain letters encoded by ranks of byte strings.

A BPE vocabulary that marks word ends has two symbols for a letter, one inside a word and one at its end. ``tiktoken``
merges byte strings by rank and knows no marks, but the last byte of a lower-cased word can be written as another byte
that such words do not use. Then each symbol is one byte, each piece a byte string, and its id is its rank.

The tokenizer merges two neighbours only if that very pair is listed, ``tiktoken`` if both together are any piece. The
two agree on pieces that the tokenizer makes of their own letters: merges inside a stretch of letters do not depend on
what is around it until one crosses its border, so neighbours that make up such a piece are the listed pair. No word
holds any other piece, so those have no rank.
"""

from __future__ import annotations

import json
import sys
from array import array
from collections.abc import Callable

from crewgauge.llm.bpe import _piece_bytes

_END = "</w>"
#: The bytes of a-z, ß-ö and ø-ÿ in UTF-8: a letter's own byte, or 0xC3 and a second byte.
_LAST = {*range(0x61, 0x7B), *range(0x9F, 0xC0)} - {0xB7}
_FIRST = 0xC3
#: A word's last byte as the byte that stands for it: A-Z, or 0xDF to 0xFF.
_AT_END = bytes(b - 0x20 if 0x61 <= b <= 0x7A else b + 0x40 if b in _LAST else b for b in range(256))


def as_bytes(word: str) -> bytes:
    """A word of such letters with its end marked."""
    own = word.encode()
    return own[:-1] + _AT_END[own[-1] : own[-1] + 1]


def _piece(piece: str, names: dict[str, bytes]) -> bytes | None:
    """A piece of the vocabulary in that form; None if it holds anything else."""
    own = b"".join(names.get(c, b" ") for c in piece.removesuffix(_END))
    if not own or not all(b in _LAST or b == _FIRST for b in own):
        return None
    if not piece.endswith(_END):
        return own
    return own[:-1] + _AT_END[own[-1] : own[-1] + 1] if own[-1] in _LAST else None


def letter_ranks(tokenizer_path: str) -> dict[bytes, int]:
    """The rank of every piece of letters that can come up; empty if the tokenizer does not work that way."""
    from tokenizers import Tokenizer, models

    with open(tokenizer_path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
    if model.get("type") != "BPE" or model.get("end_of_word_suffix") != _END or not plain:
        return {}
    names = _piece_bytes()
    ranks = {own: i for piece, i in model["vocab"].items() if (own := _piece(piece, names)) is not None}
    symbols = {bytes([b]) for b in (*_LAST, _FIRST)} | {_AT_END[b : b + 1] for b in _LAST}
    if not symbols <= ranks.keys():
        return {}
    pairs = [[_piece(p, names) for p in (m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    listed = [(a, b) for a, b in pairs if a is not None and b is not None and a in ranks and b in ranks and a + b in ranks]
    if any(ranks[a + b] >= ranks[c + d] for (a, b), (c, d) in zip(listed, listed[1:], strict=False)):
        return {}  # merged in another order than that of the ids
    letters = Tokenizer(models.BPE({p.decode("latin-1"): i for p, i in ranks.items()}, [(a.decode("latin-1"), b.decode("latin-1")) for a, b in listed]))
    made = letters.encode_batch_fast([p.decode("latin-1") for p in ranks], add_special_tokens=False)
    return {p: i for (p, i), e in zip(ranks.items(), made, strict=True) if e.ids == [i]}


def letter_encoder(ranks: dict[bytes, int]) -> Callable[[str], bytes]:
    """A function from a word of such letters to its ids as little-endian unsigned 32-bit bytes."""
    import tiktoken

    encode = tiktoken.Encoding("letters", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def ids(word: str) -> bytes:
        found = array("I", encode(as_bytes(word)))
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    return ids
