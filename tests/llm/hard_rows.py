"""Awkward rows for every operator; test modules import the fixtures."""

from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.001"

HARD = [
    # ids: NULL, repeated, plain; texts: NULL, empty, white space, short, equal rows, multi-byte, long
    (1, None),
    (2, ""),
    (3, " \t\n\x0b "),
    (4, "one two three"),
    (5, "Übermäßig schöne Wörter stehen hier und dort im Text herum, ganz ohne Not."),
    (5, "Übermäßig schöne Wörter stehen hier und dort im Text herum, ganz ohne Not."),
    (None, "no id but some words that nobody else has, and a few more of them to be sure"),
    (None, None),
    (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 40),
    (8, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 40),
    (9, " ".join(f"w{n}" for n in range(60_000))),
    (10, "x" * 5000),
    (11, "cc by\x00cc-by All rights reserved. General Public License\nGeneral\npublic license K"),
    (12, "퟿     \x1c \x85 odd spaces stay in words"),
]


@pytest.fixture()
def hard(spark):
    """Rows that are awkward in every way, with columns named like the operators' own."""
    schema = "doc_id bigint, text string, _row string, _id int, _key string, node string, _h int, part string, word string, key int, root int, n_words int"
    extra = ("r", 1, "k", "n", 2, "p", "w", 3, 4, 5)
    return spark.createDataFrame([(i, t, *extra) for i, t in HARD], schema)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")
