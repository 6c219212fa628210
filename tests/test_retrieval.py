import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.operators import corrective, evaluate, fuse, gate, models, rerank, sparse
from siltstone.operators.dense import dense_topk
from siltstone.operators.filters import payload_filter


def corpus(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "chunk_id long, text string")


def queries(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")


def test_stats_and_frequencies(spark):
    docs = corpus(spark, "rent rent rent", "rent escrow")
    stats = sparse.corpus_stats(docs).first()
    assert (stats["n_docs"], stats["total_len"], stats["avgdl"]) == (2, 5, 2.5)
    assert dict(sparse.doc_freq(sparse.postings(docs)).collect()) == {"rent": 2, "escrow": 1}
    assert sparse.corpus_stats(docs.limit(0)).first()["avgdl"] == 0.0


def test_bm25_matches_plain_python(spark):
    texts = ["common words here", "common rare", "rare rare thing", "other", "common " * 20]
    asked = ["common rare rare", "unseen", "!!", "rare unseen thing"]
    tokens = [t.split() for t in texts]
    n, avg = len(texts), sum(map(len, tokens)) / len(texts)
    df = Counter(w for t in tokens for w in set(t))
    want = {}
    for q, text in enumerate(asked):
        for d, t in enumerate(tokens):
            both = set(text.split()) & set(t)
            if both:
                want[q, d] = sum(
                    math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / avg)) for w in both
                )
    docs = corpus(spark, *texts)
    got = {(r["query_id"], r["chunk_id"]): r["score"] for r in sparse.bm25_scores(queries(spark, *asked), sparse.postings(docs), sparse.corpus_stats(docs)).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_top_k_ties_go_to_the_smaller_key(spark):
    hits = sparse.bm25_topk(queries(spark, "same"), corpus(spark, "same", "same", "same"), 2).orderBy("rank").collect()
    assert [(r["rank"], r["chunk_id"]) for r in hits] == [(1, 0), (2, 1)]


@pytest.mark.parametrize("distance", ["Cosine", "Dot", "Euclid", "Manhattan"])
def test_dense_topk_is_exact_whatever_the_blocks(spark, distance):
    r = np.random.default_rng(1)
    points, asked = r.normal(size=(60, 5)), r.normal(size=(7, 5))
    make = lambda x, key: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"{key} long, dense array<double>")
    score = {
        "Dot": points @ asked.T, "Cosine": points @ asked.T / np.linalg.norm(points, axis=1)[:, None] / np.linalg.norm(asked, axis=1)[None],
        "Euclid": -np.linalg.norm(points[:, None] - asked[None], axis=2), "Manhattan": -np.abs(points[:, None] - asked[None]).sum(2),
    }[distance]
    want = {(q, k + 1): int(i) for q in range(7) for k, i in enumerate(np.argsort(-score[:, q])[:4])}
    got = dense_topk(make(asked, "query_id"), make(points, "chunk_id"), 4, distance=distance, block=3).collect()
    assert {(x["query_id"], x["rank"]): x["chunk_id"] for x in got} == want


def test_filter_comes_before_ranking(spark):
    points = spark.createDataFrame([(i, [1.0, i / 10], i % 3) for i in range(10)], "chunk_id long, dense array<double>, kind int")
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, dense array<double>")
    where = payload_filter({"must": [{"key": "kind", "match": {"any": [1, 2]}}], "must_not": [{"key": "chunk_id", "range": {"lt": 2}}]})
    assert [r["chunk_id"] for r in dense_topk(asked, points, 3, where=where).orderBy("rank").collect()] == [2, 4, 5]
    assert points.where(payload_filter({"should": [{"key": "kind", "match": {"value": 0}}, {"key": "chunk_id", "match": {"value": 1}}]})).count() == 5
    assert points.where(payload_filter(None)).count() == 10


def test_rrf(spark):
    lists = spark.createDataFrame(
        [(0, 0, 1, 1, 9.0), (0, 0, 2, 2, 8.0), (0, 0, 3, 3, 7.0), (0, 1, 1, 2, 0.5), (0, 1, 2, 4, 0.4), (0, 1, 3, 1, 0.3), (0, 1, 4, None, 0.2)],
        "query_id long, list_no int, rank int, chunk_id long, score double",
    )
    got = {r["chunk_id"]: r for r in fuse.rrf_fuse(lists).collect()}
    assert len(got) == 4 and {got[1]["rank"], got[2]["rank"]} == {1, 2}
    assert got[2]["rrf_score"] == pytest.approx(1 / 62 + 1 / 61) and got[1]["score"] == 9.0


def test_distinct_in_order(spark):
    hits = spark.createDataFrame([(0, i + 1, u) for i, u in enumerate(["a", "b", "a", "c", "", None])], "query_id long, rank int, source_uri string")
    assert [(r["source_uri"], r["rank"]) for r in fuse.distinct_in_order(hits).orderBy("rank").collect()] == [("a", 1), ("b", 2), ("c", 3)]


def test_corrective(spark):
    hits = spark.createDataFrame([(0, 1, 1, 0.9), (0, 2, 2, 0.1), (0, 3, 3, 0.6), (0, 11, 4, 0.0), (1, 1, 5, 0.3)], "query_id long, rank int, chunk_id long, g double")
    kept, best = corrective.correct(hits, F.col("g"))
    assert {(r["query_id"], r["rank"]): r["chunk_id"] for r in kept.collect()} == {(0, 1): 1, (0, 2): 3, (0, 3): 4, (1, 1): 5}
    assert [r[0] for r in corrective.weak(best).collect()] == [1]
    graded = corrective.apply_grades(hits, F.col("g"), 0.25).collect()
    assert {r["chunk_id"] for r in graded} == {1, 3, 5} and {r["best"] for r in graded if r["query_id"] == 0} == {0.9}


def test_rerank(spark):
    hits = spark.createDataFrame([(0, 1, "a", 0.1), (0, 2, "b", 0.9), (0, 3, "c", 0.9)], "query_id long, rank int, name string, s double")
    assert [r["name"] for r in rerank.rerank(hits, F.col("s"), 2).orderBy("rank").collect()] == ["b", "c"]
    assert [r["name"] for r in rerank.rerank(hits, None, 2).orderBy("rank").collect()] == ["a", "b"]
    assert rerank.parse_scores({"results": [{"index": 2, "score": 0.5}]}, 3) == [0.0, 0.0, 0.5]
    assert rerank.parse_scores([0.1, 0.2], 3) == [0.1, 0.2, 0.0]


def test_gate(spark):
    docs = spark.createDataFrame([("t", "keep me"), ("t", "drop"), ("t", "odd")], "title string, text string")
    reply = lambda title, text: F.when(text == "keep me", F.lit('{"keep": true, "reason": "good"}')).when(text == "drop", F.lit('{"keep": false}')).otherwise(F.lit('{"keep": "yes"}'))
    assert [(r["state"], r["reason"]) for r in gate.gate(docs, reply).collect()] == [("gated", "good"), ("skipped", ""), ("error", "gate: missing or invalid verdict")]
    assert {r["state"] for r in gate.gate(docs, None).collect()} == {"gated"}


def test_embed_isolates_failures(spark):
    class Picky(models.HashEmbedder):
        def embed_batch(self, texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("no")
            return super().embed_batch(texts)

    got = models.embed(spark.createDataFrame([("good text",), ("bad",), ("!!",)], "text string").coalesce(1), Picky(8)).collect()
    assert len(got[0]["dense"]) == 8 and got[0]["embed_error"] is None
    assert got[1]["dense"] is None and "no" in got[1]["embed_error"] and "empty" in got[2]["embed_error"]


def test_contextualize_batches_and_pads(spark):
    chunks = spark.createDataFrame([(i, "u", i, f"c{i}") for i in range(5)], "chunk_id long, source_uri string, ordinal int, text string")
    docs = spark.createDataFrame([("u", "the document")], "uri string, text string")
    got = models.contextualize(chunks, docs, lambda doc, parts: [f"{len(parts)}:{doc[:3]}"], 2).orderBy("ordinal").collect()
    assert [r["context"] for r in got] == ["2:the", "", "2:the", "", "1:the"]
    bad = models.contextualize(chunks, docs, lambda doc, parts: "no list").collect()
    assert {r["context"] for r in bad} == {""}


def test_expand_and_questions(spark):
    got = models.expand(queries(spark, "one two three"), lambda q, n: ["ONE TWO THREE", "x", "X", "y", "z"], 2).orderBy("variant").collect()
    assert [r["query"] for r in got] == ["one two three", "x", "y"]
    broken = models.expand(queries(spark, "q"), lambda q, n: 1 / 0, 2).collect()
    assert [r["query"] for r in broken] == ["q"]
    docs = spark.createDataFrame([("a", "t"), ("b", "fail")], "uri string, text string")
    asked = models.questions(docs, lambda t, n: 1 / 0 if t == "fail" else ["q1", "q2", "q3"], 2).collect()
    assert [(r["uri"], r["query"], r["failed"]) for r in asked] == [("a", "q1", False), ("a", "q2", False), ("b", None, True)]
    assert models.questions(docs.limit(1), lambda t, n: "x", 2).count() == 0


def test_term_index(spark):
    from hashlib import blake2b

    got = spark.createDataFrame([("rent",), ("é",)], "t string").select(models.term_index(F.col("t"))).collect()
    assert [r[0] for r in got] == [int.from_bytes(blake2b(t.encode(), digest_size=4).digest(), "big") for t in ("rent", "é")]


def test_containing_equals_a_nested_loop(spark):
    texts = {"a": "one two three four", "b": "xone two threey", "c": "two", "d": "one  two three", "e": None, "f": "", "g": "one two three one two three"}
    asked = {1: "one two three", 2: "two", 3: "", 4: None, 5: "one never three", 6: "e two t", 7: "two three", 8: "four"}
    docs = spark.createDataFrame(list(texts.items()), "uri string, text string")
    queries = spark.createDataFrame(list(asked.items()), "query_id long, query string")
    found = sorted(tuple(r) for r in evaluate.containing(docs, queries).collect())
    assert found == sorted((q, u) for q, x in asked.items() for u, t in texts.items() if x is not None and t is not None and x in t)
    plan = evaluate.containing(docs, queries.where("query_id in (1, 5, 6)"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
