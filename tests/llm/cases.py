"""Rows that every operator must bear, and the words of a text."""

import re

from docfacts.llm.common import WORD

WORDS = re.compile(WORD)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, mark string, rank int, content string"


def words(text):
    return WORDS.findall(text or "")


def prose(start, n, step=7):
    return " ".join(f"w{(start * 31 + i * step) % 9973}x" for i in range(n))


def rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    same = (6, prose(6, 60), "en", "a", 1, "m", 1, "c")
    texts = [
        (1, None, "en", "a", 0, None, None, None),
        (2, "", None, None, None, "m", 0, "c"),
        (3, " \n\t ", "fr", "b", 4, "m", 0, "c"),
        (None, prose(1, 80), "en", "a", 1, "m", 0, "c"),
        (None, None, None, None, None, None, None, None),
        (4, prose(2, 40_000), "en", "b", 1, "m", 2, "c"),
        (5, "x" * 200_000, "de", "c", 1, "m", 2, "c"),
        same, same,
        (7, prose(6, 60), "fr", None, 1, "m", 1, "c"),
        (7, prose(7, 50) + "\n" + prose(6, 60), "fr", "b", 1, "m", 1, "c"),
        (8, "é😀 " + prose(8, 30), "es", "d", 1, "m", 1, "c"),
    ]
    return texts


def frame(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)
