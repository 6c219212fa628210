import random

import numpy as np

from siltstone.llm import simhash as module

from .conftest import DOCS, prose


def edited(words, times, seed):
    r, out = random.Random(seed), list(words)
    for at in r.sample(range(len(out)), times):
        out[at] = f"own{seed}x{at}"
    return " ".join(out)


def brute(texts):
    """Smallest position of each text's component over shingle sets of Jaccard similarity 0.8 or more."""
    sets = [module.shingle_set(t.encode(), 5) for t in texts]
    name = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 9 * both >= 4 * (len(sets[i]) + len(sets[j])) and name[i] != name[j]:
                low, high = sorted((name[i], name[j]))
                name = [low if n == high else n for n in name]
    return name


def test_copies_that_edits_set_apart_are_not_paired(spark, monkeypatch):
    """Of copies that crowd the same shingles, those with too many shingles of their own leave no pairs, and no link is lost."""
    base = prose(3, 150).split()
    texts = [edited(base, 1 + 5 * (i % 2), i) for i in range(1, 161)] + [prose(i, 60) for i in range(200, 220)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS).repartition(4)
    paired, whole = [], module._candidates
    monkeypatch.setattr(module, "_candidates", lambda rows: paired.append(rows.count()) or whole(rows))
    got = {r["doc_id"]: r["component_id"] for r in module.similar_groups(docs, words=5).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)
    assert len(set(got.values())) > 80 and sum(paired) < 20 * len(texts)
