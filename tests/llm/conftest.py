import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = [f"w{i}ab" for i in range(400)]


def prose(seed: int, n: int) -> str:
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("." if r.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, copies, repeated rows, ties, a long text."""
    shared = prose(1000, 70)
    rows = [
        (1, prose(1, 120), "en", "a"), (2, prose(1, 120), "en", "b"), (3, None, None, None), (4, "", "en", ""), (5, "  \n\t ", "fr", "a"),
        (6, prose(6, 30) + " " + shared, "en", "a"), (7, shared + " " + prose(7, 40), "en", "b"), (8, "One. Two, three", "de", "c"),
        (9, prose(9, 6000), "en", "a"), (None, prose(10, 80), "en", "a"), (11, prose(11, 60), "en", "a"), (11, prose(11, 60), "en", "a"),
        (12, "ÄÖ é É 漢字 😀 word", "de", None), (13, "x", "en", "zz"),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with further columns named as operators name theirs."""
    from pyspark.sql import functions as F

    names = ["size", "shard", "slot", "score", "fp", "key", "row", "rank", "taken", "target", "n", "doc", "block", "curve", "predicted", "host",
             "__id", "__hash", "__size", "__rank", "__part", "__source", "__lang", "__n", "__turn", "__text", "whole", "id", "hash", "tie", "a.b", "c`d", "col", "c0"]
    return odd.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
