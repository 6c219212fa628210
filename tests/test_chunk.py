import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.operators.chunk import Budget, capped_windows, chunk

from .test_functions import python_id


def numbered(n):
    return " ".join(f"word{i}" for i in range(n))


def rows(spark, text, **budget):
    docs = spark.createDataFrame([("u", text, "t")], "uri string, text string, title string")
    return sorted(chunk(docs, Budget.of(**budget), keep=("title",)).collect(), key=lambda r: r["ordinal"])


def test_budget_rounds_to_even_and_clamps():
    assert Budget.of() == Budget(384, 48)
    assert Budget.of(10, 5) == Budget(8, 4)  # 7.5 and 3.75
    assert Budget.of(2, 64) == Budget(2, 1)
    assert Budget.of(1, 0) == Budget(1, 0)


@pytest.mark.parametrize(("n", "tokens", "overlap"), [(50, 20, 5), (100, 10, 0), (150, 100, 15), (200, 100, 8), (300, 512, 64), (5, 512, 64), (384, 512, 64), (385, 512, 64)])
def test_windows(spark, n, tokens, overlap):
    budget, words = Budget.of(tokens, overlap), numbered(n).split()
    got = rows(spark, numbered(n), max_tokens=tokens, overlap_tokens=overlap)
    assert [r["text"] for r in got] == capped_windows(words, budget)
    assert [r["ordinal"] for r in got] == list(range(len(got)))
    assert all(r["chunk_id"] == python_id("u", r["ordinal"]) and r["title"] == "t" for r in got)
    for a, b in zip(got, got[1:], strict=False):
        if budget.overlap:
            assert a["text"].split()[-budget.overlap :] == b["text"].split()[: budget.overlap]


def test_empty(spark):
    assert rows(spark, "") == [] and rows(spark, " \n\t ") == [] and rows(spark, None) == []


def test_cap(spark):
    dense = rows(spark, " ".join(["x" * 30] * 1000))
    assert len(dense) > 3 and all(len(r["text"]) <= 5000 for r in dense)
    giant = rows(spark, "intro " + "x" * 40000 + " tail")
    assert len(giant) > 1 and sum(r["text"].count("x") for r in giant) >= 40000


def test_suffixes_before_a_giant_word():
    words = ["ab"] * 10 + ["y" * 5000]
    assert [len(c.split()) for c in capped_windows(words, Budget(384, 48))] == [10, 9, 8, 7, 6, 5, 4, 3, 2, 1, 1]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=30), max_size=60), st.integers(1, 12), st.integers(0, 11), st.integers(5, 40))
def test_capped_windows_lose_nothing(words, window, overlap, most):
    budget = Budget(window, min(overlap, window - 1))
    got = capped_windows(words, budget, most)
    pieces = [w[k : k + most] for w in words for k in range(0, len(w), most)]
    at = 0
    for c in got:
        found = c.split()
        assert len(c) <= most and len(found) <= window
        while pieces[at : at + len(found)] != found:
            at += 1
    assert not words or got[-1].split()[-1] == pieces[-1]
