import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siltstone.llm import simhash as module
from siltstone.llm.simhash import components, dedup_stage, hex16, links, near_duplicates, simhash, shingle_hashes

from .conftest import DOCS, prose


def brute_fingerprint(text, words):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(found[i : i + words]), 42) for i in range(max(1, len(found) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_of_texts(odd_rows):
    for words in (3, 5):
        for row in odd_rows:
            assert simhash(shingle_hashes((row[1] or "").encode(), words)) == brute_fingerprint(row[1], words)


def brute_components(values, radius=2):
    names = {v: v for v in values}

    def find(v):
        while names[v] != v:
            v = names[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                names[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("most", [64, 2])
def test_links_find_all_components(spark, most):
    r = random.Random(5)
    values = set()
    for _ in range(60):
        base = r.getrandbits(64)
        for _ in range(r.choice([1, 1, 2, 8])):
            values.add(base)
            base ^= (1 << r.randrange(64)) | (1 << r.randrange(64))
            values.add(base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    found = components(links(spark.createDataFrame([(signed(v),) for v in values], "fp long"), most=most))
    got = {r["node"] & (1 << 64) - 1: r["component"] for r in found.collect()}
    want = brute_components(values)
    group = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
    assert {g for g in group(want) if len(g) > 1} == group(got)


def test_chain_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "src long, dst long")
    got = dict(components(edges).collect())
    assert {got[i] for i in range(201)} == {0} and got[501] == got[500] == 500


def test_near_duplicates_and_stage(odd, odd_rows, clashing, none):
    got = near_duplicates(odd).select("doc_id", hex16(F.col("fp")).alias("h"), "component_id").collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(odd_rows)
    assert by_id[1]["component_id"] == by_id[2]["component_id"] == 1
    assert by_id[3]["component_id"] == by_id[4]["component_id"] == by_id[5]["component_id"] == 3 and by_id[3]["h"] == "0" * 16
    kept = dedup_stage(clashing, words=5)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == clashing.columns and sorted(map(str, ids)) == sorted(map(str, [1, 3, 6, 7, 8, 9, None, 11, 12, 13]))
    assert near_duplicates(none).count() == 0 and dedup_stage(none).count() == 0


@pytest.mark.parametrize("most,sample", [(64, 8), (3, 1)])
def test_stage_keeps_one_of_edited_copies(spark, monkeypatch, most, sample):
    monkeypatch.setattr(module, "SAMPLE", sample)
    r, texts, passage = random.Random(3), [], prose(99, 60)
    for k in range(14):
        base = prose(200 + k, r.choice([12, 60, 150, 400])).split()
        texts.append(" ".join(base))
        for _ in range(r.choice([1, 4, 9])):
            words = list(base)
            for _ in range(r.choice([1, 2, 3, 5, 8])):
                words[r.randrange(len(words))] = f"edit{r.randrange(10**6)}"
            texts.append(" ".join(words))
    texts += [prose(300 + i, 40) + " " + passage for i in range(12)] + ["", "one two"]
    sets = [set(np.unique(shingle_hashes(t.encode(), 5)).tolist()) for t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    got = sorted(x["doc_id"] for x in dedup_stage(docs, words=5, most=most).collect())
    assert got == sorted(set(group)) and len(got) < len(texts) - 12


def test_crowd_of_near_copies_is_linked_whole(spark):
    """Thousands of fingerprints in one key: the same links as brute force, at every cut of the key."""
    r, base = random.Random(11), 0x0123_4567_89AB_CDEF
    values = {base}
    while len(values) < 3000:
        v = base
        for _ in range(r.randrange(6)):
            v ^= 1 << r.randrange(40)
        values.add(v)
    values = sorted(values)
    found = links(spark.createDataFrame([(v,) for v in values], "fp long"))
    got = {tuple(sorted(x)) for x in found.collect()}
    array = np.array(values, np.uint64)
    want = set()
    for i, v in enumerate(values):
        near = np.bitwise_count(array[i + 1 :] ^ np.uint64(v)) <= 2
        want |= {(v, values[i + 1 + int(k)]) for k in np.flatnonzero(near)}
    assert got == want and len(want) > 10_000
