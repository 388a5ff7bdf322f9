"""Documents that every operator must take: nulls, empty and long texts, ties, repeats, clashes."""

from __future__ import annotations

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, uid long, part string, "
    "row int, fp long, _matches int"
)
LONG = " ".join(f"w{i % 997}x" for i in range(60_000))
ROWS = [
    (1, "The cat sat on the mat. It slept.\nThen it woke up, and left.", "en", "a", 60),
    (2, "The cat sat on the mat. It slept.\nThen it woke up, and left.", "en", "a", 60),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, "   \n\t ", None, "b", 6),
    (6, LONG, "en", "a", len(LONG)),
    (7, "12345 !!! ???", "de", "b", 13),
    (8, "Äpfel und Birnen, Öl und Übermut; straße \U0001f600 文字", "de", "c", 40),
    (8, "Äpfel und Birnen, Öl und Übermut; straße \U0001f600 文字", "de", "c", 40),
    (9, "one", "en", None, 3),
    (None, "no id here at all, only some words", None, "c", 30),
    (10, "the CAT sat on the MAT. It slept.\nThen it woke up, and left.", "en", "a", 60),
]


def documents(spark, rows=ROWS):
    """The rows with extra columns whose names are used inside operators; in two partitions."""
    full = [(*r, 5, "x", 7, 9, 1) for r in rows]
    return spark.createDataFrame(full, COLUMNS).repartition(2)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def text(value):
    return value or ""
