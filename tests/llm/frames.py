"""Odd rows every operator must take: nulls, blanks, long texts, repeats, clashing names."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"

LONG = "the quick brown fox jumps over the lazy dog again " * 4000

ODD = [
    (1, "one two three four five six seven eight nine ten", "en", "a", 1),
    (1, "one two three four five six seven eight nine ten", "en", "a", 1),
    (2, None, "en", None, None),
    (3, "", None, "b", 0),
    (4, " \n\t ", "de", "b", 4),
    (None, "a text without an id", "en", "a", 20),
    (5, LONG, "en", "c", len(LONG)),
    (6, LONG + "end", "en", "c", len(LONG) + 3),
    (7, "MIT License. É ß password=abcdef1234 😀", "fr", "a", 44),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd(spark):
    """The rows with extra columns named like those the operators make."""
    names = ("_id", "_text", "row", "name", "size", "score", "kept", "_key", "node", "cid", "copies", "labels", "_block")
    return spark.createDataFrame(ODD, SCHEMA).selectExpr("*", *[f"'x' AS {n}" for n in names])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")
