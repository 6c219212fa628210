"""Evaluation runs: a golden set from stored documents, one batched search, metrics, reports."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.operators import evaluate, models
from siltstone.operators.fuse import distinct_in_order

DISTINCT_FANOUT = 8
SearchFunction = Callable[[DataFrame, int], DataFrame]


@dataclass
class Report:
    collection: str
    n_queries: int
    k_values: list[int]
    recall_at_k: dict[int, float]
    mrr: float
    n_errored: int = 0
    rerank: bool = False
    hybrid: bool = False
    multi: int = 0
    corrective: bool = False
    gen_model: str | None = None
    per_query: list[dict] = field(default_factory=list)


def make_golden(docs: DataFrame, model: models.QuestionModel = models.leading_questions, per_doc: int = 3) -> tuple[DataFrame, DataFrame]:
    """(golden rows (query_id, query, relevant_uris), uris of documents whose generation failed)."""
    asked = models.questions(docs, model, per_doc)
    good = evaluate.golden_filter(asked.where("not failed").select("uri", "pos", "query"))
    number = F.xxhash64("uri", "pos")
    return good.select(number.alias("query_id"), "query", F.array("uri").alias("relevant_uris")), asked.where("failed").select("uri")


def run(golden: DataFrame, search: SearchFunction, k_values: Sequence[int], collection: str = "", errored: DataFrame | None = None, listed: int = 1000, **how) -> Report:
    """Score ``search`` (queries, top) -> hits with query_id, rank, source_uri over all golden queries at once."""
    if not k_values:
        raise ValueError("k_values is empty")
    hits = search(golden.select("query_id", "query"), max(k_values) * DISTINCT_FANOUT)
    ranked = distinct_in_order(hits).select("query_id", F.col("source_uri").cast("string").alias("uri"), "rank")
    scored = evaluate.per_query(golden, ranked, k_values, errored).persist()
    recall = {r["k"]: r["recall"] for r in evaluate.recall_at_k(scored, k_values).collect()}
    total = evaluate.mrr(scored).first()
    rows = [r.asDict() for r in scored.join(golden.select("query_id", "query"), "query_id").orderBy("query_id").limit(listed).collect()]
    scored.unpersist()
    return Report(collection, total["n_queries"], list(k_values), {k: recall[k] for k in k_values}, total["mrr"], total["n_errored"], per_query=rows, **how)


def save_golden(golden: DataFrame, path: str) -> None:
    golden.select("query", "relevant_uris").write.mode("overwrite").json(path)


def load_golden(spark: SparkSession, path: str) -> DataFrame:
    """Golden rows of JSON lines; blank lines are skipped, ids follow the rows' order by text."""
    rows = spark.read.schema("query string, relevant_uris array<string>").json(path).where("query is not null")
    return rows.withColumn("query_id", F.row_number().over(Window.orderBy("query", "relevant_uris")).cast("long")).select("query_id", "query", "relevant_uris")


def save_report(report: Report, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(asdict(report), f, ensure_ascii=False, indent=1)


def load_report(path: str) -> Report:
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    data["recall_at_k"] = {int(k): v for k, v in data["recall_at_k"].items()}
    return Report(**data)


def compare(baseline: Report, current: Report) -> dict:
    """Deltas of recall at the k that both have and of the reciprocal rank, and what differs in the set-up."""
    both = [k for k in current.k_values if k in baseline.recall_at_k]
    return {
        "recall_delta": {k: current.recall_at_k[k] - baseline.recall_at_k[k] for k in both},
        "mrr_delta": current.mrr - baseline.mrr,
        "warnings": evaluate.warnings(asdict(baseline), asdict(current)),
    }
