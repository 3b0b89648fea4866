"""Small tables with every awkward row: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import re
import string

WORDS = [f"w{n}" for n in range(400)]
LONG = " ".join(WORDS[n % 397] + ("." if n % 9 == 0 else "") for n in range(30_000))
BASE = " ".join(WORDS[:120])


def near(base: str, *places: int) -> str:
    words = base.split()
    for n in places:
        words[n] = f"x{n}"
    return " ".join(words)


TEXTS = [
    None, "", "   \n\t ", "one", "One", "a b", "A  B\n", "a b c d", "a b c d e", BASE, BASE.upper(), BASE.replace(" ", "\n"),
    near(BASE, 5), near(BASE, 60), near(BASE, 5, 60), near(BASE, 5, 60, 90), near(BASE, 5, 30, 60, 90, 110), LONG, LONG, LONG + " end",
    "É é ß İ ſ K", "x <|endoftext|> y", "tab\x1cfile\xa0nbsp", "Äpfel und Birnen " * 30, "spam!! " * 200, "q | w | e | r | t " * 40,
]

#: (doc_id, text, lang, source, n_chars, then names that the operators use themselves)
ROWS = [(n, t, "en", "s", len(t or ""), "k", "r", 1) for n, t in enumerate(TEXTS)]
ROWS += [ROWS[9], ROWS[9], (None, BASE, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, row string, kept int"


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def lowered(text: str | None) -> str:
    return (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def shingles(text: str | None, n: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1)))


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
