import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm import mixlm

from .conftest import DOCS


def brute(rows):
    tokens = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return sorted(str((i, held(i), len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6))) for i, ws in tokens)


@pytest.mark.parametrize("small", [False, True])
def test_base_score(spark, odd_rows, none, monkeypatch, small):
    if small:  # many blocks and slices
        monkeypatch.setattr(mixlm, "BLOCK_BYTES", 300)
        monkeypatch.setattr(mixlm, "SLICE_WORDS", 50)
    docs = spark.createDataFrame(odd_rows, DOCS).selectExpr("*", "1 AS block", "2 AS ids")
    got = mixlm.score(docs).collect()
    assert sorted(str((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))) for r in got) == brute([r[:2] for r in odd_rows])
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in got)
    if not small:
        assert mixlm.score(none).count() == 0


def test_better_than_base_on_held_out_texts(spark):
    r = random.Random(1)
    tongues = []
    for letters in ("kmrst", "bdglv", "fnpwz"):
        syllables = [a + v for a in letters for v in "aeiou"]
        tongues.append(["".join(r.choice(syllables) for _ in range(r.choice([1, 2, 3]))) for _ in range(400)])
    rows = [(i, " ".join(tongues[i % 3][int(399 * r.random() ** 3)] for _ in range(120))) for i in range(300)]
    got = mixlm.score(spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCS)).collect()
    held = [x for x in got if x["held_out"]]
    assert len(held) > 15 and sum(x["score"] for x in held) > sum(x["base_score"] for x in held)
    again = {x["doc_id"]: x["score"] for x in mixlm.score(spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCS)).collect()}
    assert again == {x["doc_id"]: x["score"] for x in got}


def test_code_is_a_prefix_code():
    counts = np.zeros(256, np.int64)
    counts[[97, 98, 32]] = 100, 50, 30
    code = mixlm.Code.of(counts)
    assert code.length.min() >= 1 and abs(sum(2.0 ** -code.length.astype(float)) - 1) < 1e-9 and code.length[97] <= code.length[200]


def test_probabilities_of_words_sum_to_at_most_one():
    words = [b"a", b"b", b"ab", b"ba", b"c"]
    code = mixlm.Code.of(np.bincount([97, 98, 99, 32, 10], minlength=256) * 50)
    counts = np.zeros(2 * mixlm.SLOTS, np.int64)
    mixlm._add(counts, pa.array(words), np.zeros(5, np.int64), np.array([5, 4, 3, 2, 1]), code)
    tables = mixlm.Tables.of(counts.reshape(-1, 2))
    # All strings over three letters up to length 6, and the end sign.
    every, now = [b""], [b""]
    for _ in range(6):
        now = [w + c for w in now for c in (b"a", b"b", b"c")]
        every += now
    total = (10 ** mixlm.price(pa.array(every, pa.binary()), np.zeros(len(every), np.int64), code, tables, mixlm.Mixer.new())).sum()
    assert 0.5 < total <= 1 + 1e-6


def test_cache_prices_repeats():
    logs = np.array([-6.0, -6.0])
    out = mixlm.cached(np.zeros(50, np.int64), np.zeros(50, np.int64), logs)
    assert out[0] == pytest.approx(-6) and out[-1] > -1 and mixlm.cached(np.array([], np.int64), np.array([], np.int64), logs).size == 0


def test_training_texts_beyond_the_tuning_ones_are_counted(spark, monkeypatch):
    monkeypatch.setattr(mixlm, "TUNE_TEXTS", 2)
    docs = spark.createDataFrame([(i, f"w{i} common", "x", "y", 1) for i in range(400)], DOCS)
    parts = mixlm.blocks(docs, mixlm._grouped(docs)).cache()
    held = sum(zlib.crc32(str(i).encode()) % 7 == 2 for i in range(400))
    learnt = sum(int(np.frombuffer(mixlm._expand(r[0]), np.int64).sum()) for r in mixlm._vocabulary(parts, 8, mixlm._last_turn(parts)).select("learnt").collect())
    assert learnt == 2 * (400 - held - 2)
