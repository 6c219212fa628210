from siltstone.llm import simhash as module

from .conftest import DOCS, prose


def test_stage_takes_the_links_of_the_distance_table(spark, monkeypatch):
    """Sets that fingerprints link are verified first, and nothing is left for the prefixes to pair."""
    base = prose(1, 200).split()
    texts = [" ".join(base), " ".join(base + base), prose(2, 80)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    seen, whole = [], module.similar

    def similar(pairs, *rest):
        seen.append(pairs.count())
        return whole(pairs, *rest)

    monkeypatch.setattr(module, "similar", similar)
    assert sorted(r["doc_id"] for r in module.dedup_stage(docs, words=5).collect()) == [0, 2]
    assert seen == [1, 0]
