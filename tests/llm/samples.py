"""Rows for the tests: spans of distinct words, and a table with every oddity."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as extra columns of the input.
EXTRA = ["id", "key", "row", "word", "edge", "spans", "label", "text_id", "rejected", "score", "words", "lanes"]


def sentence(start: int, n: int) -> str:
    return " ".join(f"w{(start * 7919 + i * i * 31 + i) % 100_003}" for i in range(n))


LONG = sentence(1, 30_000)
#: Null ids and texts, blank and signless texts, ties, repeated rows, one long text.
MESSY = [
    (7, LONG, "en"),
    (9, "intro " + LONG, "en"),
    (3, sentence(5, 80), "en"),
    (3, sentence(5, 80), "en"),
    (4, sentence(5, 80), None),
    (5, sentence(9, 60) + " tail", "fr"),
    (5, "another text of the same id", "fr"),
    (None, sentence(9, 60), "fr"),
    (None, None, None),
    (11, None, "en"),
    (12, "", "en"),
    (13, " \t\n\r\x0b\x0c ", "de"),
    (14, "!!! 123 ---", "de"),
    (15, "É́ ünï \U0001f600 wörd", "de"),
    (16, "one", "en"),
]
