import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm.toxicity import Classifier, calibrate, fold, toxicity, toxicity_stage, train

from .conftest import DOCS

BAD = ["grubble", "snorkfish", "dwimmery", "plonkest"]
GOOD = ["the", "river", "stone", "walked", "under", "morning", "light", "slowly", "house", "paper", "window", "garden", "letter"]


def sample(n, seed=3):
    r, rows = random.Random(seed), []
    for i in range(n):
        words = [r.choice(GOOD) + r.choice(["", "s", "ed", "ing"]) for _ in range(r.randint(10, 120))]
        toxic = i % 4 == 0
        for _ in range(r.randint(2, 5) if toxic else 0):
            words[r.randrange(len(words))] = r.choice(BAD)
        rows.append((i, " ".join(words) + ".", "en", "s", 1, int(toxic)))
    return rows


@pytest.fixture(scope="module")
def labelled(spark):
    rows = sample(400)
    docs = spark.createDataFrame([r[:5] for r in rows] + [(1000, None, "en", "s", 0), (1001, "", "en", "s", 0), (None, "grubble", "en", "s", 0)], DOCS)
    labels = spark.createDataFrame([(r[0], 1, r[5]) for r in rows] + [(None, 1, 1), (1000, 1, None)], "doc_id long, quality int, toxic int")
    return docs, labels, {r[0]: r[5] for r in rows}


def test_held_out_accuracy(labelled):
    docs, labels, truth = labelled
    got = toxicity(docs, labels).collect()
    assert len(got) == 403 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    known = [r for r in held if r["doc_id"] in truth]
    assert len(known) > 40 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in known]) > 0.95
    again = {(r["doc_id"], r["score"]) for r in toxicity(docs, labels).collect()}
    assert again == {(r["doc_id"], r["score"]) for r in got}


def test_stage_keeps_clean_documents(labelled):
    docs, labels, truth = labelled
    wide = docs.withColumns({"score": F.lit(1), "predicted": F.lit(2), "c0": F.lit(3)})
    kept = toxicity_stage(wide, labels)
    assert kept.columns == wide.columns
    ids = {r["doc_id"] for r in kept.collect()}
    clean = {i for i, t in truth.items() if not t}
    assert len(clean - ids) <= 0.02 * len(clean) and len(ids & (truth.keys() - clean)) <= 0.1 * (len(truth) - len(clean)) and {1000, 1001} <= ids


def test_without_labels_or_rows(labelled, none):
    docs, labels, _ = labelled
    assert {r["predicted"] for r in toxicity(docs, labels.limit(0)).collect()} == {0}
    assert {r["predicted"] for r in toxicity(docs, labels.where("toxic = 0")).collect()} == {0}
    assert toxicity(none, labels).count() == 0


def test_windows_differ_for_toxic_words(labelled):
    docs, labels, _ = labelled
    found = train(docs, labels, fold(F.col("doc_id"), 5) != 0)
    assert isinstance(found, Classifier) and all(w.encode() in found.toxic for w in BAD)
    toxic, clean, nothing = found.features([b"a grubble plonkest here", b"the river walked slowly", b""])
    assert toxic[0] > 0 and clean[0] == 0 and not nothing.any()


def test_calibration_is_bounded_on_separable_data():
    x = np.log1p(np.array([[0, 0, 0, 0]] * 50 + [[3, 9, 4, 0]] * 20, float))
    w = calibrate(x, np.array([0.0] * 50 + [1.0] * 20))
    assert np.abs(w).max() < 20 and w[0] + x[0] @ w[1:] < 0 < w[0] + x[-1] @ w[1:]
