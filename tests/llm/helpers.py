"""Small tables with the awkward cases: nulls, empty and long texts, repeated rows, clashing columns."""

from __future__ import annotations

import random

WORDS = "the of and river stone light over under green house walks quickly morning évidé größe 中文 3.14 isn't".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", ",", "."]) for _ in range(n))


def awkward():
    """(doc_id, text) rows."""
    long_text = prose(1, 30_000)
    return [
        (1, prose(2, 120)),
        (2, prose(2, 120)),
        (2, prose(2, 120)),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, "one"),
        (7, long_text),
        (8, long_text[:4000] + " and then something else"),
        (9, "a  b c <|endoftext|> d\n\ne "),
        (None, prose(3, 40)),
        (10, prose(4, 300)),
        (11, prose(4, 300) + " tail"),
    ]


def frame(spark, rows=None, extra=""):
    """A table of documents; ``extra`` adds a column of that name."""
    rows = awkward() if rows is None else rows
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("*", f"'x' as `{extra}`") if extra else df


def documents(spark, rows=None):
    """A table with all columns of ``documents``."""
    return frame(spark, rows).selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "cast(length(text) as long) as n_chars")
