import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.llm import common, mixlm, simhash, toxicity

from .conftest import DOCS, prose

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])


def test_batches_are_bounded_and_the_setting_comes_back(spark, monkeypatch):
    monkeypatch.setattr(common, "BATCH_BYTES", 10_000)
    rows, before = spark.range(400, numPartitions=1).select(F.repeat(F.lit("x"), 1000).alias("text")), spark.conf.get(KEY, None)
    with pytest.raises(ZeroDivisionError), common.small_batches(spark):
        seen = [r["n"] for r in rows.mapInArrow(sizes, "n long").collect()]
        raise ZeroDivisionError
    assert sum(seen) == 400 and max(seen) <= 20 and spark.conf.get(KEY, None) == before


def near_dedup(docs):
    return simhash.dedup_stage(docs, words=5)


@pytest.mark.parametrize("module, step", [(mixlm, mixlm.score), (simhash, near_dedup)])
def test_blocks_and_sets_are_sent_in_small_batches(spark, monkeypatch, module, step):
    """Every table that the operators write is written with small batches, and the result does not depend on them."""
    docs = spark.createDataFrame([(i, prose(i % 50, 60), "en", "s", 1) for i in range(60)], DOCS)
    whole, seen, before = module.materialize, [], spark.conf.get(KEY, None)
    monkeypatch.setattr(module, "materialize", lambda df: seen.append(spark.conf.get(KEY, None)) or whole(df))
    plain = sorted(map(str, step(docs).collect()))
    assert set(seen) == {str(common.BATCH_BYTES)} and spark.conf.get(KEY, None) == before
    monkeypatch.setattr(common, "BATCH_BYTES", 2_000)
    assert sorted(map(str, step(docs).collect())) == plain


def test_words_to_learn_from_are_sent_in_pieces(monkeypatch):
    texts = [" ".join(f"w{i}x{j}" for j in range(50)) for i in range(100)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 2 for i in range(100)], pa.int32())], ["text", "toxic"])
    whole = [r for b in toxicity._contexts(iter([batch])) for r in b.to_pylist()]
    monkeypatch.setattr(toxicity, "SENT", 500)
    pieces = list(toxicity._contexts(iter([batch])))
    assert max(b.num_rows for b in pieces) <= 550 and [r for b in pieces for r in b.to_pylist()] == whole and len(whole) == 5000


def test_scores_read_a_text_at_a_time():
    """No list of all texts of a batch is made before they are scored."""
    found, held = toxicity.Classifier(b" bad the ", b" oak the ", [b"bad"], toxicity.PRIOR), []

    def texts():
        for i in range(100):
            held.append(len(found._memo))
            yield b"word%d" % i

    assert found.features(texts()).shape == (100, toxicity.MEASURES) and held == list(range(100))
    assert found.features([]).shape == (0, toxicity.MEASURES)
