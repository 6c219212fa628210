import hashlib
import re

import pytest

from siltstone.llm.decontaminate import build_index, contamination, decontaminate_stage, item_terms, proximity_matches, _with_counts

from .conftest import prose


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(7, prose(1, 40)), (7, prose(1, 40)), (10, "One two THREE"), (3, prose(9, 6000)[500:900]), (4, None), (5, ""), (6, "never seen words here at all ok"), (None, prose(6, 30)), (8, "one " * 12)]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_against_brute_force(odd, odd_rows, items, none):
    windows = {}
    for r in items.collect():
        words = tokens(r["text"])
        for k in range(max(1, len(words) - 9)) if words else []:
            windows.setdefault(tuple(words[k : k + 10]), set()).add("" if r["item_id"] is None else str(r["item_id"]))
    want = []
    for doc_id, text, *_ in odd_rows:
        words, hit, ids = tokens(text), set(), set()
        for window, names in windows.items():
            for p in range(len(words) - len(window) + 1):
                if tuple(words[p : p + len(window)]) == window:
                    ids |= names
                    hit.update(range(p, p + len(window)))
        want.append((doc_id, len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    got = [tuple(r)[:6] for r in contamination(odd, items).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert sum(w[5] for w in want) >= 4
    assert contamination(none, items).count() == 0


def test_no_items(spark, odd):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert contamination(odd, empty).where("contaminated").count() == 0


def test_stage(clashing, odd_rows, items):
    out = decontaminate_stage(clashing, items)
    assert out.columns == clashing.columns
    ids = {r["doc_id"] for r in out.collect()}
    assert 1 not in ids and 8 not in ids and {3, 4, 12} <= ids


def test_proximity(spark, odd):
    items = spark.createDataFrame([(1, "three one"), (2, "three x")], "item_id long, text string")
    each, vocabulary = item_terms(items)
    index = build_index(odd, vocabulary)
    found = proximity_matches(index, _with_counts(each, vocabulary, index), within=5).select("item_id").distinct().collect()
    assert [r[0] for r in found] == ["1"]
