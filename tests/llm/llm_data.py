"""Small texts shared by the tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc long, size string, line long, hash string, _doc long"


def words(seed: int, n: int) -> list[str]:
    pick = random.Random(seed)
    return ["".join(pick.choice("abcdefghijklmnop") for _ in range(pick.randint(2, 8))) for _ in range(n)]


def docs_of(spark, rows):
    """(doc_id, text, lang) rows with the other columns, some of them named like internals."""
    rows = [(*r, None)[:3] for r in rows]
    return spark.createDataFrame([(i, t, x, "s", len(t or ""), 7, "x", 3, "h", 1) for i, t, x in rows], SCHEMA)


#: Nulls in both columns, empty, blank and very long texts, repeated rows, non-Latin text, a NUL byte.
EDGES = [
    (1, None, "en"), (2, "", "en"), (3, "  \n\t ", None), (4, " ".join(words(4, 30_000)), "en"), (5, "one two", "en"),
    (5, "one two", "en"), (6, "Grüße 世界 🙂 it's\r\n  3rd's  x y　z '", "de"), (None, "no id here at all", "en"),
    (None, None, None), (7, "a\x00b", "fr"), (8, "x" * 5_000, None), (9, "1234 !!", "en"),
]
