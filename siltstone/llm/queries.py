"""The registered queries of the training-data operators: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import decontaminate, html, merkle, mixing, mixlm, secrets, sharding, simhash, substrings, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_read(spark, sf_dir, "pages"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op3_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.with_next(_read(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve"
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(found["fp"]).alias("fingerprint"), "component_id")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("text_hash")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(_read(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


def op9_mixlm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixlm.score(_read(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_mixing": op2_mixing,
    "op3_merkle": op3_merkle,
    "op4_sharding": op4_sharding,
    "op5_simhash": op5_simhash,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_substrings": op8_substrings,
    "op9_mixlm": op9_mixlm,
    "op10_secrets": op10_secrets,
}

TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Plain windows in DuckDB: all windows of the items, and all of the documents, by their words.
OP6_SQL = f"""
WITH d AS (SELECT doc_id, {TERMS} AS w FROM documents), i AS (SELECT item_id, {TERMS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, w[s + 1 : s + 10] AS win FROM (SELECT item_id, w, unnest(range(0, greatest(1, len(w) - 9))) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM iw),
dw AS (SELECT doc_id, s, n, w[s + 1 : s + n] AS win FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, s, n, item_id FROM dw JOIN iw USING (win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY 1),
x AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN x USING (doc_id)
"""

#: Every 50-word window with the smallest document that it starts in.
OP8_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, s, sha256(array_to_string(w[s + 1 : s + 50], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS s FROM d WHERE len(w) >= 50)),
low AS (SELECT k, min(doc_id) AS least FROM win GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM win JOIN low USING (k) WHERE doc_id > least),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS line FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256 FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {"op6_decontaminate": OP6_SQL, "op8_substrings": OP8_SQL}
