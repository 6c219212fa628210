"""Collections of points: versioned Parquet snapshots with replacement by source.

Each write makes a new version folder. A version is there once its writer has committed it, which leaves a mark in the
folder; readers take the newest one that has the mark. Nothing is overwritten, moved or deleted, so a write that
fails at any step changes nothing, and of two writers that take one number the second fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DONE, META = "_SUCCESS", "_META.json"


class DimensionMismatch(ValueError):
    pass


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def _read(spark: SparkSession, path: str) -> str | None:
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> None:
    """A new small file, complete as soon as it is there; raises if there is one already."""
    fs, where = _fs(spark, path)
    _, new = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(new, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(where) or not fs.rename(new, where):
        fs.delete(new, False)
        raise FileExistsError(path)


def replace_by_source(old: DataFrame, new: DataFrame, source: str = "source_uri") -> DataFrame:
    """Old points of no source in ``new``, and the new ones: orphans of a shrunken source go too."""
    return old.join(new.select(source).distinct(), source, "left_anti").unionByName(new, allowMissingColumns=True)


@dataclass
class Collection:
    spark: SparkSession
    root: str
    name: str

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.name}"

    def meta(self) -> dict | None:
        text = _read(self.spark, f"{self.path}/{META}")
        return json.loads(text) if text else None

    def exists(self) -> bool:
        return self.meta() is not None

    def dim(self) -> int | None:
        meta = self.meta()
        return meta["dim"] if meta else None

    def ensure(self, dim: int, distance: str = "Cosine", index_fields: dict[str, str] | None = None) -> None:
        """Create the collection, or raise if it holds vectors of another size."""
        meta = self.meta()
        if meta is None:
            _create(self.spark, f"{self.path}/{META}", json.dumps({"dim": dim, "distance": distance, "index_fields": index_fields or {}, "vectors": ["dense", "sparse"]}))
        elif meta.get("vectors") != ["dense", "sparse"]:
            raise DimensionMismatch(f"collection {self.name!r} has an unnamed vector; make it anew")
        elif meta["dim"] != dim:
            raise DimensionMismatch(f"collection {self.name!r} holds {meta['dim']} dimensions, not {dim}")

    def _numbers(self, complete: bool) -> list[int]:
        fs, where = _fs(self.spark, self.path)
        names = [x.getPath() for x in fs.listStatus(where) if x.isDirectory()] if fs.exists(where) else []
        there = lambda p: fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, DONE))
        return [int(p.getName()[2:]) for p in names if p.getName().startswith("v=") and (not complete or there(p))]

    def version(self) -> int:
        """The newest complete version; 0 if there is none."""
        return max(self._numbers(True), default=0)

    def _store(self, whole: DataFrame) -> int:
        """Write ``whole`` as the next version; folders of failed writes keep their numbers."""
        n = max(self._numbers(False), default=0) + 1
        whole.write.mode("errorifexists").parquet(f"{self.path}/v={n}")
        return n

    def points(self) -> DataFrame | None:
        """All points, or None if nothing was stored yet; columns that are not asked for are not read."""
        n = self.version()
        return self.spark.read.parquet(f"{self.path}/v={n}") if n else None

    def replace(self, new: DataFrame) -> int:
        """Store ``new`` in place of all points of its sources; the new version's number."""
        old = self.points()
        return self._store(replace_by_source(old, new) if old is not None else new)

    def delete(self, uris: DataFrame) -> int:
        """Drop the points of the sources in ``uris`` (source_uri)."""
        old = self.points()
        return self._store(old.join(uris.select("source_uri").distinct(), "source_uri", "left_anti")) if old is not None else 0

    def upsert(self, new: DataFrame) -> int:
        """Replace points of equal id only."""
        old = self.points()
        return self._store(replace_by_source(old, new, "chunk_id") if old is not None else new)


def collections(spark: SparkSession, root: str) -> list[str]:
    fs, where = _fs(spark, root)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


def reconstruct(points: DataFrame, most: int = 6000, key: str = "source_uri") -> DataFrame:
    """(uri, text): chunks in order, joined by line ends, cut at ``most``; rows without a source are left out."""
    rows = points.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    parts = F.array_sort(F.collect_list(F.struct("ordinal", "text")))
    joined = rows.groupBy(F.col(key).alias("uri")).agg(parts.alias("parts"))
    return joined.select("uri", F.substring(F.array_join(F.col("parts.text"), "\n"), 1, most).alias("text"))
