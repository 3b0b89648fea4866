"""Words of a text as units that a BPE tokenizer encodes independently, and a bounded table of encoded words.

A text is cut where the tokenizer never joins what stands on both sides: before white space that follows something
else. Cut-out words repeat, so their ids are looked up. A word that is not in the table is split into the
tokenizer's own pre-tokens, whose ids are looked up in turn; only new pre-tokens are encoded, all of a text at once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Mapping

import numpy as np
import regex

# The characters with Unicode's White_Space property.
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# The split patterns of the two tokenizer families; the second on lower-cased text, white space dropped.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BARE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+"

_BYTE_TOKEN, _BARE_TOKEN = regex.compile(BYTE_PATTERN), re.compile(BARE_PATTERN)
_STOPS = ".,;:!?)"
_SPACED_WORD = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")
_BARE_WORD = re.compile(f"[^{WHITE_SPACE}]+")
#: Words that lower-casing and normal form NFC change letter by letter only, so they can be split beforehand.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
_LETTERS = re.compile("[a-zß-öø-ÿ]+").fullmatch
_AFTER_SPACE = re.compile(f" [^{WHITE_SPACE}]+").fullmatch
#: str.split also cuts at these four control characters, which are not white space.
_SEPARATORS = re.compile("[\\x1c-\\x1f]").search


def spaced_words(text: str) -> list[str]:
    """Words with the white space before them; together they are the text."""
    return _SPACED_WORD.findall(text)


def bare_words(text: str) -> list[str]:
    """Words without white space."""
    return _BARE_WORD.findall(text) if _SEPARATORS(text) else text.split()


def added_tokens(tokenizer) -> list[str]:
    """The strings that a tokenizer takes out of a text before it splits the rest."""
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def _four_bytes(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


class WordEncoder:
    """Encodes texts through tables of words and pre-tokens; ids are little-endian unsigned 32-bit bytes.

    ``known`` holds pre-tokens encoded beforehand. Other entries are kept as they come, ``limit`` in each table and
    none longer than ``longest`` characters. A full table becomes the old one and a new one begins, into which entries
    move back when they are met again; so a table holds twice ``limit`` at most, frequent words stay, and no result
    depends on it. A text with an added token's string is encoded as a whole.
    """

    longest = 64

    def __init__(self, tokenizer_path: str, known: Mapping[str, bytes] | None = None, limit: int = 250_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = added_tokens(self.tokenizer)
        self.known, self.limit = known or {}, limit
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        pieces = sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])
        self.edge = np.zeros(pieces[-1][1] + 1, bool)
        self.edge[[i for piece, i in pieces if self.is_edge(piece)]] = True

    @staticmethod
    def split(text: str) -> list[str]:
        raise NotImplementedError

    @staticmethod
    def pre_tokens(word: str) -> list[str]:
        raise NotImplementedError

    def is_edge(self, piece: str) -> bool:
        raise NotImplementedError

    def joined(self, tokens: list[str]) -> tuple[list[str], str]:
        """Those of ``tokens`` that can be encoded as one text, and that text."""
        raise NotImplementedError

    def runs(self, ids: np.ndarray) -> np.ndarray:
        """Where the ids of each pre-token of a joined text start, and the end."""
        raise NotImplementedError

    def encode_whole(self, text: str) -> bytes:
        return _four_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode_pre_tokens(self, tokens: list[str]) -> dict[str, bytes]:
        """Each of the distinct ``tokens``, encoded once."""
        together, text = self.joined(tokens)
        found: dict[str, bytes] = {}
        if together:
            ids = np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = self.runs(ids)
            if len(cuts) == len(together) + 1:
                data = ids.tobytes()
                found = {t: data[4 * a : 4 * b] for t, a, b in zip(together, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)}
        rest = [t for t in tokens if t not in found]
        for token, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            found[token] = _four_bytes(e.ids)
        return found

    def _kept(self, new: dict[str, bytes], old: dict[str, bytes], more: Mapping[str, bytes]) -> tuple[dict, dict]:
        """The new and the old table after ``more`` has come in."""
        if len(new) + len(more) > self.limit:
            new, old = {}, new
        new.update((w, ids) for w, ids in more.items() if len(w) <= self.longest)
        return new, old

    def _ids(self, words: set[str]) -> dict[str, bytes]:
        """The ids of distinct words that are not in the new table."""
        found = {w: ids for w in words if (ids := self.old_words.get(w)) is not None}
        parts = {w: self.pre_tokens(w) for w in words if w not in found}
        pieces: dict[str, bytes | None] = {}
        moved: dict[str, bytes] = {}
        for own in parts.values():
            for p in own:
                if p not in pieces:
                    ids = self.known.get(p) or self.pieces.get(p)
                    if ids is None and (ids := self.old_pieces.get(p)) is not None:
                        moved[p] = ids
                    pieces[p] = ids
        if new := [p for p, ids in pieces.items() if ids is None]:
            fresh = self.encode_pre_tokens(new)
            pieces.update(fresh)
            moved.update(fresh)
        self.pieces, self.old_pieces = self._kept(self.pieces, self.old_pieces, moved)
        found.update((w, b"".join([pieces[p] for p in own])) for w, own in parts.items())
        return found

    def encode_units(self, units: list[str]) -> dict[str, bytes]:
        """Each of the distinct ``units``, encoded once: pre-tokens, and whole texts with an added token's string."""
        whole = {u: self.encode_whole(u) for u in units if any(t in u for t in self.added)}
        return whole | self.encode_pre_tokens([u for u in units if u not in whole])

    def encode(self, text: str) -> bytes:
        if any(t in text for t in self.added):
            return self.encode_whole(text)
        words = self.split(text)
        got = list(map(self.words.get, words))
        if None not in got:
            return b"".join(got)
        missing = [n for n, ids in enumerate(got) if ids is None]
        found = self._ids({words[n] for n in missing})
        for n in missing:
            got[n] = found[words[n]]
        self.words, self.old_words = self._kept(self.words, self.old_words, found)
        return b"".join(got)


class SpacedEncoder(WordEncoder):
    """For byte-level tokenizers whose pre-tokens keep the space before them."""

    @staticmethod
    def split(text: str) -> list[str]:
        return spaced_words(text)

    @staticmethod
    def pre_tokens(word: str) -> list[str]:
        if word.isascii():  # letters, or letters and one stop: what the pattern gives, without it
            letters = word[1:] if word[0] == " " else word
            if letters.isalpha():
                return [word]
            if letters[:-1].isalpha() and letters[-1] in _STOPS:
                return [word[:-1], word[-1]]
        return _BYTE_TOKEN.findall(word)

    def is_edge(self, piece: str) -> bool:
        return piece.startswith("Ġ")  # the byte-level name of a space

    def joined(self, tokens: list[str]) -> tuple[list[str], str]:
        spaced = [t for t in tokens if _AFTER_SPACE(t)]
        return spaced, "".join(spaced)

    def runs(self, ids: np.ndarray) -> np.ndarray:
        return np.append(np.flatnonzero(self.edge[ids]), len(ids))


class BareEncoder(WordEncoder):
    """For tokenizers that lower-case, drop white space and mark the end of a pre-token.

    ``of_letters`` encodes a pre-token of lower-case letters as the tokenizer does, faster.
    """

    def __init__(self, tokenizer_path: str, *args, of_letters: Callable[[str], bytes] | None = None, **options) -> None:
        super().__init__(tokenizer_path, *args, **options)
        self.of_letters = of_letters

    def encode_pre_tokens(self, tokens: list[str]) -> dict[str, bytes]:
        if self.of_letters is None:
            return super().encode_pre_tokens(tokens)
        found = {t: self.of_letters(t) for t in tokens if _LETTERS(t)}
        return found | super().encode_pre_tokens([t for t in tokens if t not in found]) if len(found) < len(tokens) else found

    @staticmethod
    def split(text: str) -> list[str]:
        return bare_words(text)

    @staticmethod
    def pre_tokens(word: str) -> list[str]:
        if word.isascii():  # letters, or letters and one stop: what the pattern gives, without it
            if word.isalpha():
                return [word if word.islower() else word.lower()]  # the same string, not a copy
            if word[-1:] in _STOPS and word[:-1].isalpha():
                return [word[:-1].lower(), word[-1]]
        return _BARE_TOKEN.findall(word.lower()) if _PLAIN(word) else [word]

    def is_edge(self, piece: str) -> bool:
        return piece.endswith("</w>")

    def joined(self, tokens: list[str]) -> tuple[list[str], str]:
        plain = [t for t in tokens if _PLAIN(t)]
        return plain, " ".join(plain)

    def runs(self, ids: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.flatnonzero(self.edge[ids]) + 1])
