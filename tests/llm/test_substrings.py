import hashlib

import pytest

from siltstone.llm.substrings import dedup, repeats

from .conftest import DOCS, prose


def brute(rows, words):
    low = {}
    for doc_id, text in rows:
        found, d = (text or "").encode().split(), -(1 << 63) if doc_id is None else doc_id
        for i in range(len(found) - words + 1):
            k = tuple(found[i : i + words])
            low[k] = min(low.get(k, d), d)
    out = []
    for doc_id, text in rows:
        found, d = (text or "").encode().split(), -(1 << 63) if doc_id is None else doc_id
        gone = set()
        for i in range(len(found) - words + 1):
            if low[tuple(found[i : i + words])] < d:
                gone.update(range(i, i + words))
        kept = [w for i, w in enumerate(found) if i not in gone]
        out.append((doc_id, len(found), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize(("words", "gram", "most"), [(50, 16, 200), (8, 3, 2), (8, 3, 1), (8, 3, 0)])
def test_against_brute_force(spark, odd_rows, none, words, gram, most, monkeypatch):
    if most < 2:  # the whole-prefix path, with and without long lists of nodes
        monkeypatch.setattr("siltstone.llm.substrings.GROUPED", 1)
        monkeypatch.setattr("siltstone.llm.substrings.LISTED", 1 + 999 * most)
        most = 1
    rows = [r[:2] for r in odd_rows]
    line = prose(77, 60)
    rows += [(100 + i, prose(200 + i, 25) + " " + line + " " + prose(300 + i, i)) for i in range(12)]
    rows += [(200 + i, " ".join([f"v{i}"] * 30 + line.split()[i : i + 20])) for i in range(10)]
    rows += [(300, "same " * 200), (301, "same " * 90), (302, line + "\n" + line)]
    docs = spark.createDataFrame([(a, b, "x", "y", 1) for a, b in rows], DOCS)
    got = sorted(str((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"])) for r in dedup(docs, words, gram, most).collect())
    assert got == brute(rows, words)
    assert dedup(none, words, gram, most).count() == 0


def test_repeats_are_stretches(spark):
    line = prose(5, 60)
    docs = spark.createDataFrame([(1, line), (2, "a b " + line)], "doc_id long, text string")
    covered = set()
    for r in repeats(docs).collect():
        assert r["doc"] == 2
        covered.update(range(r["start"], r["end"]))
    assert covered == set(range(2, 62))
