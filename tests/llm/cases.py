"""Rows that every operator on texts must cope with, and plain word splitting to compare with."""

import re

LONG = " ".join(f"w{k % 977} sépar{k % 31}" for k in range(40_000))
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\r "),
    (4, "one"),
    (5, "One TWO three. four-five six seven eight nine ten eleven twelve"),
    (5, "One TWO three. four-five six seven eight nine ten eleven twelve"),
    (6, "éÀ ñ ß ☃ \U0001f600 日本語 x y a b"),
    (7, LONG),
    (None, "a row without an id"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, carried string, hits string, n_words string, size string"


def documents(spark, texts=TEXTS, lang="en", source="src0"):
    """The rows with extra columns, some of them named like columns that operators use or return."""
    rows = [(k, t, lang, source, len(t or ""), "x", "y", "z", "s") for k, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def non_space(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def alphanumeric(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def key(row):
    return tuple((x is None, str(x)) for x in row)
