"""Fixtures of the operator tests, imported by name: a second conftest would hide the first."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id long, _text string, words string, n_hit long, score string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with null and clashing further columns."""

    def build(pairs):
        rows = [(d, t, None, None, None, 5, "x", "y", None, "z") for d, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd_pairs():
    """Null, empty, blank and long texts, repeated rows, a null id, non-ASCII and control characters."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "GAMMA", "délta", "été", "ÉTÉ", "x1", "42", "straße", "日本", "a b", " ", "i̇", "\U0001f600k"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = prose(30_000)
    lines = "\n".join(prose(4) for _ in range(12))
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (5, "two words"), (6, long), (7, long + " end"), (8, long),
        (9, lines), (9, lines), (10, lines + "\nnew"), (None, lines), (None, None), (11, "!!! ??? 123"), (12, "\x00\x0b\x1f"),
        (13, "same\n" * 50), (14, "\r\na\r\nb\r\nc"), (-3, prose(40)), (15, prose(3).upper()),
    ] + [(100 + i, prose(rng.randint(1, 60))) for i in range(30)]
