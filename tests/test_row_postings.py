import pytest

from siltstone.operators import sparse


@pytest.mark.parametrize("ids", [[1, 2, 3, 4], [1, 1, None, None]])
def test_row_postings_are_the_postings_of_the_terms(spark, ids):
    texts = ["Ab ab cd é ef", "cd cd gh", None, "!"]
    chunks = spark.createDataFrame(list(zip(ids, texts, strict=True)), "chunk_id long, text string")
    terms = spark.createDataFrame([("ab",), ("cd",), ("zz",)], "term string")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(sparse.row_postings(chunks, terms)) == rows(sparse.postings(chunks, terms=terms)) != []
    exchanges = sparse.row_postings(chunks, terms.hint("broadcast"))._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges == (len(set(ids)) < 4)
