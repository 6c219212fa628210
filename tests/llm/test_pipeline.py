import pytest


@pytest.fixture(scope="module")
def small_tables(tmp_path_factory, spark):
    from .conftest import DOCS, prose
    from .test_toxicity import sample

    at = tmp_path_factory.mktemp("sf")
    rows = [r[:5] for r in sample(200)]
    leak = prose(4, 40)
    rows += [(500, rows[1][1], "en", "s", 1), (501, prose(5, 30) + " " + leak, "de", "t", 1), (502, None, None, None, None), (503, "", "en", "t", 0), (504, prose(6, 50), "en", "t", 1)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(r[0], 1, r[5]) for r in sample(200)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_stages(spark, small_tables):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{small_tables}/documents.parquet")
    seen = []
    for i, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, small_tables)
        if i + 1 < len(pipeline.STAGES):
            assert out.columns == docs.columns
        seen.append({r["doc_id"] for r in out.select("doc_id").collect()})
        out.write.parquet(f"{small_tables}/stage{i}")
        docs = spark.read.parquet(f"{small_tables}/stage{i}")
    assert 501 in seen[1] and 501 not in seen[2] and 504 in seen[2]
    assert 500 not in seen[1] or 1 not in seen[1]
    assert len(seen[0]) < 205 and {502, 503} & seen[1] and len({502, 503} & seen[1]) == 1
    assert {"shard", "slot"} <= set(docs.columns)


def test_run(spark, small_tables):
    import corpus_pipeline as pipeline

    got = pipeline.run(spark, small_tables)
    assert got.count() > 0 and pipeline.ORACLE_SQL is None


def test_stages_keep_columns_of_any_name(spark, small_tables, clashing):
    """Added columns come back unchanged from every stage, also those named as helpers are."""
    import corpus_pipeline as pipeline

    added = [c for c in clashing.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    whole = {tuple(r[c] for c in clashing.columns) for r in clashing.collect()}
    for name, stage in pipeline.STAGES:
        out = stage(spark, clashing, small_tables)
        kept = [c for c in clashing.columns if name != "sharding" or c not in ("shard", "slot")]
        assert out.columns == kept + (["shard", "slot"] if name == "sharding" else [])
        rows = {tuple(r[c] for c in kept) for r in out.collect()}
        assert rows and rows <= {tuple(v for c, v in zip(clashing.columns, r, strict=True) if c in kept) for r in whole}
    assert len(added) > 30
