import zlib
from collections import Counter

import numpy as np

from siltstone.llm.sharding import hilbert_index, shard, shard_stage, write_shards


def test_hilbert_index_visits_every_cell_in_unit_steps():
    for dims, bits in ((2, 3), (3, 2), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shards_are_even_and_gapless(odd, odd_rows):
    got = shard(odd, shards=4).collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == len(odd_rows) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    text = {r[0]: (r[1] or "").encode() for r in odd_rows}
    for r in got:
        assert r["size"] == len(text[r["doc_id"]]) + 8 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]])
        assert r["law"] == "rows" and r["grown_shard"] is None


def test_more_shards_than_rows_and_none(odd, none):
    got = shard(odd, shards=24).collect()
    assert len({r["shard"] for r in got}) == len(got) and {r["slot"] for r in got} == {0}
    assert shard(none).count() == 0


def test_stage_keeps_columns_and_files_prune(spark, clashing, none, tmp_path):
    out = shard_stage(clashing, shards=3)
    assert [c for c in out.columns if c not in ("shard", "slot")] == [c for c in clashing.columns if c not in ("shard", "slot")]
    assert out.count() == clashing.count()
    write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == clashing.count() and {r[0] for r in back.select("shard").distinct().collect()} == {0, 1, 2}
    assert shard_stage(none).count() == 0
