"""Files of a folder tree; text formats are decoded in the scan, others keep their bytes."""

from __future__ import annotations

import mimetypes
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import extension, relative_path

EXTENSIONS = ("pdf", "docx", "doc", "pptx", "xlsx", "txt", "md", "html", "htm", "csv", "rtf", "odt")
INLINE = ("txt", "md")


def files(spark: SparkSession, root: str, exts: Iterable[str] | None = None) -> DataFrame:
    """uri is the path, title the file's name, meta its relative path and extension; invalid UTF-8 is replaced."""
    wanted = sorted({e.lower().lstrip(".") for e in exts or EXTENSIONS})
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    uri = F.regexp_replace("path", r"^file:/*", "/")
    top = root.removeprefix("file:").rstrip("/")
    ext = extension(uri)
    mimes = F.create_map(*[F.lit(x) for e in EXTENSIONS for x in (e, mimetypes.guess_type(f"a.{e}")[0] or "application/octet-stream")])
    text = F.when(ext.isin(*INLINE), F.make_valid_utf8(F.col("content").cast("string")))
    return found.where(ext.isin(*wanted)).select(
        uri.alias("uri"), F.element_at(F.split(uri, "/"), -1).alias("title"),
        F.coalesce(F.try_element_at(mimes, ext), F.lit("application/octet-stream")).alias("mime"), text.alias("text"), F.col("content").alias("raw_bytes"),
        F.create_map(F.lit("path"), relative_path(uri, top), F.lit("ext"), ext).alias("meta"),
    )
