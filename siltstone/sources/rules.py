"""Detection rules: YAML files of one or more rules each."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import relative_path, stable_id, techniques

PARSED = "path string, place int, id string, title string, description string, logsource string, level string, status string, tags array<string>, fields array<string>"
_COLUMNS = [c.split()[0] for c in PARSED.split(", ")]


def _rules(path: str, body: bytes) -> list[tuple]:
    """Titled rules of one file; a file that is no YAML has none."""
    import yaml

    try:
        found = list(yaml.safe_load_all(body))
    except Exception:
        return []
    out = []
    for place, rule in enumerate(found):
        if isinstance(rule, dict) and "title" in rule:
            text = lambda key: str(rule.get(key, "") or "").strip()  # noqa: B023, E731
            source, detection = rule.get("logsource"), rule.get("detection")
            told = " ".join(f"{k}={v}" for k, v in source.items() if v) if isinstance(source, dict) else ""
            name = rule["id"] if isinstance(rule.get("id"), str) and rule["id"] else None
            fields = [str(k) for k in detection if k != "condition"] if isinstance(detection, dict) else []
            out.append((path, place, name, text("title"), text("description"), told, text("level"), text("status"), [str(t) for t in rule.get("tags") or []], fields))
    return out


def rule_text() -> Column:
    line = lambda name, c: F.concat(F.lit(name), F.coalesce(c, F.lit("")))
    return F.concat_ws(
        "\n", F.col("title"), F.lit(""), F.col("description"), F.lit(""), line("Log source: ", F.col("logsource")), line("Level: ", F.col("level")),
        line("MITRE ATT&CK: ", F.array_join(techniques(F.col("tags")), ", ")), line("Tags: ", F.array_join("tags", ", ")), line("Detection fields: ", F.array_join("fields", ", ")),
    )


def rules(spark: SparkSession, root: str) -> DataFrame:
    """One document a rule: its id, or else a stable id of the file's relative path; rules of one file without ids share it."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int32(), *[pa.string()] * 6, pa.list_(pa.string()), pa.list_(pa.string())]
        for batch in batches:
            rows = [r for path, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for r in _rules(path, body)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _COLUMNS)

    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.yml").load(root)
    parsed = found.select(F.regexp_replace("path", r"^file:/*", "/").alias("path"), "content").mapInArrow(parse, PARSED)
    place = relative_path(F.col("path"), root.removeprefix("file:"))
    uri = F.coalesce("id", stable_id(place).cast("string"))
    return parsed.select(
        uri.alias("uri"), "title", F.lit("text/plain").alias("mime"), rule_text().alias("text"), F.lit(None).cast("binary").alias("raw_bytes"),
        F.create_map(
            F.lit("mitre"), F.array_join(techniques(F.col("tags")), ","), F.lit("level"), F.col("level"), F.lit("logsource"), F.col("logsource"), F.lit("status"), F.col("status"),
            F.lit("tags"), F.array_join("tags", ","), F.lit("repo_path"), place,
        ).alias("meta"),
    )
