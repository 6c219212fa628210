import hashlib
import re

import pytest
from pyspark.sql import functions as F

from siltstone.functions import scoring, text


def one(spark, column, *values):
    """The column over one row of values a, b, ..."""
    names = "abcdef"[: len(values)]
    return spark.createDataFrame([values], list(names)).select(column.alias("x")).first()[0]


def python_id(*parts):
    return int(hashlib.sha256("\x1f".join(map(str, parts)).encode()).hexdigest()[:16], 16) & (1 << 63) - 1


def test_stable_id(spark):
    rows = [("a", 1, "x"), ("b", 2, None), ("", -5, "ü"), ("a", 1, "x")]
    got = spark.createDataFrame(rows, "a string, b int, c string").select(text.stable_id("a", "b", "c").alias("i")).collect()
    assert [r["i"] for r in got] == [python_id(*r) for r in rows]
    assert python_id("a", "b") != python_id("b", "a")


SPACES = "a\x1cb\x1dc\x1ed\x1fe\x85f\xa0g\u1680h\u2000i\u200aj\u2028k\u2029l\u202fm\u205fn\u3000o\tp\nq\x0br\x0cs\rt "


def test_words_are_python_words(spark):
    for value in (SPACES, "", "  \n\t ", "one  two\nthree", "\u200bzero width"):
        assert one(spark, text.words(F.col("a")), value) == value.split()
        assert one(spark, text.is_blank(F.col("a")), value) == (not value.strip())


def test_tokenize(spark):
    tokens = lambda s: [t for t in re.findall("[a-z0-9]+", s.lower()) if len(t) >= 2]
    for value in ("The Cap-Rate is 12% on Unit A!", "Éa über naïve x yy", "", "İstanbul KELVIN K"):
        assert one(spark, text.tokenize(F.col("a")), value) == tokens(value)


def test_projections(spark):
    assert one(spark, text.snippet(F.col("a")), "é" * 501) == "é" * 500 + "..."
    assert one(spark, text.snippet(F.col("a")), "x" * 500) == "x" * 500
    assert one(spark, text.basename(F.col("a")), "C:\\Data\\Report.PDF") == "report.pdf"
    assert one(spark, text.extension(F.col("a")), "/x/y.TAR.Gz") == "gz"
    assert one(spark, text.with_context(F.col("a"), F.col("b")), "", "t") == "t"
    assert one(spark, text.with_context(F.col("a"), F.col("b")), "c", "t") == "c\nt"
    tags = F.split("a", ",")
    assert one(spark, text.techniques(tags), "attack.t1059.001,Attack.T1003,attack.execution,attack.t1003,x") == ["T1003", "T1059.001"]


def test_plain_text(spark):
    page = "<html><head><title>T</title></head><body><nav>menu</nav><p>One &amp; <b>two</b></p><!-- no --><script>x()</script><p>Three&nbsp;4</p></body></html>"
    assert one(spark, text.plain_text(F.col("a")), page).split() == ["One", "&", "two", "Three", "4"]


def test_grades(spark):
    parse = lambda reply, n: one(spark, scoring.parse_grades(F.col("a"), n), reply)
    assert parse('{"grades": [0.9, -1, 2, "x"]}', 4) == [0.9, 0.0, 1.0, 0.5]
    assert parse("[0.2, true]", 3) == [0.2, 1.0, 0.5]
    assert parse("junk", 2) == [0.5, 0.5]
    assert parse('{"grades": ["NaN"]}', 1) == [1.0]
    assert parse("[]", 0) == []


def test_expansions(spark):
    parse = lambda reply, q, n: one(spark, scoring.parse_expansions(F.col("a"), F.col("b"), n), reply, q)
    assert parse('{"queries": ["B", " b ", "A", "c", "d"]}', "a", 2) == ["B", "c"]
    assert parse('["x", ""]', "q", 3) == ["x"]
    assert parse("junk", "q", 3) == [] and parse('["x"]', "q", 0) == []


def test_similarities(spark):
    a, b = [1.0, 2.0, 2.0], [2.0, 0.0, 1.0]
    get = lambda d: one(spark, scoring.similarity(F.col("a"), F.col("b"), d), a, b)
    assert get("Dot") == 4.0 and get("Manhattan") == -4.0
    assert get("Euclid") == pytest.approx(-(6**0.5)) and get("Cosine") == pytest.approx(4 / (3 * 5**0.5))
    assert one(spark, scoring.similarity(F.col("a"), F.col("b")), [0.0], [1.0]) == 0.0
    with pytest.raises(ValueError):
        scoring.similarity(F.col("a"), F.col("b"), "Other")
