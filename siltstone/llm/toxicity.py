"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled texts: one holds the words that toxic texts use in many
more different contexts than ordinary ones, the other ordinary words of the same number of bytes; both end in
the same frequent ordinary words. A window - a word between spaces - is compressed with either, and its
distance is the difference of the two lengths: ordinary windows come out alike, toxic ones shorter under the
toxic dictionary, and in full only if nearly the whole window is one match. The numbers of near and of full windows,
the full windows' distances and their share, weighed by a calibrated logistic rule, give the score. Words are counted by distinct neighbours, so that a toxic text's copies do not make its other words toxic.

The dictionaries and the rule are fitted on at most ``TRAIN_ROWS`` labelled rows, in hash order of doc_id; four
fifths make the dictionaries, one fifth calibrates the rule. Scores read whole texts, and nothing but the text.

Defined cases: null and empty texts have no windows and score the rule's constant; if no labelled row or only
one class is there, the rule's prior alone is used; a doc_id labelled twice is toxic if one label says so; null
ids and labels are not learnt from; repeated rows are scored separately; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import sqrt

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import materialize, release

TRAIN_ROWS = 16_000
#: Most words and bytes of the dictionaries; contexts and z-score from which a word counts as toxic.
TOXIC_WORDS, ORDINARY_WORDS, BASE_BYTES, TOXIC_BYTES = 2000, 9000, 24_000, 16_000
LEAST_CONTEXTS, LEAST_Z = 3, 5.0
#: Bytes that end every window: zstandard finds no match in a frame's last bytes.
TAIL = b"\0" * 10
EDGES = b".,;:!?#$%&*|\"'()[]"
LEVEL = 11
#: Least distance of a window that counts; bytes that one toxic match may take above the shortest such window.
LEAST_DISTANCE, CLOSE = 2, 1
#: Prior of the rule: constant, then the weights of the four measures of a text.
PRIOR = np.array([-4.5, 3.0, 1.0, 1.5, 0.0])
MEASURES = 4
#: Words that training sends at once, about: as Python objects a batch's words take many times its bytes.
SENT = 20_000
#: Windows whose distances a worker remembers.
MEMO = 400_000


@dataclass
class Classifier:
    toxic: bytes
    ordinary: bytes
    words: list[bytes]
    weights: np.ndarray
    _memo: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"toxic": self.toxic, "ordinary": self.ordinary, "words": self.words, "weights": self.weights, "_memo": {}}

    def _coders(self):
        how = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=64, dict_size=32_768, min_match=4, write_content_size=0, write_dict_id=0, write_checksum=0,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        out = []
        for content in (self.toxic, self.ordinary):
            table = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            table.precompute_compress(compression_params=how)
            out.append(zstandard.ZstdCompressor(dict_data=table, compression_params=how).compress)
        return out

    def features(self, texts: Iterable[bytes]) -> np.ndarray:
        """Per text: full windows, their bytes saved, their number in a hundred, and near windows, all as log(1 + x)."""
        toxic, ordinary = self._coders()
        memo, out = self._memo, []
        full = CLOSE + min((len(toxic(b" " + w + b" " + TAIL)) for w in self.words), default=0)
        for text in texts:
            found = text.lower().split()
            hits = saved = near = 0
            for word in found:
                if (d := memo.get(word)) is None:
                    window = b" " + word.strip(EDGES) + b" " + TAIL
                    if len(memo) >= MEMO:
                        memo.clear()
                    size = len(toxic(window))
                    d = len(ordinary(window)) - size
                    # Full windows by their distance, near ones by its negative.
                    d = memo[word] = 0 if d < LEAST_DISTANCE else d if size <= full else -d
                if d > 0:
                    hits, saved = hits + 1, saved + d
                elif d:
                    near += 1
            out.append((hits, saved, 100 * hits / (len(found) + 20), near))
        return np.log1p(np.array(out, float).reshape(-1, MEASURES))

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + features @ self.weights[1:], -30, 30)))


def calibrate(features: np.ndarray, toxic: np.ndarray, spread: float = 2.0) -> np.ndarray:
    """Weights of the logistic rule: Newton steps on the likelihood with a normal prior around PRIOR."""
    x, w = np.column_stack([np.ones(len(features)), features]), PRIOR.copy()
    if len(set(toxic.tolist())) < 2:
        return w

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, np.where(toxic == 1, -z, z)).sum() + ((w - PRIOR) ** 2).sum() / (2 * spread**2))

    now = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (toxic - p) - (w - PRIOR) / spread**2
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)) / spread**2
        step = np.linalg.solve(curve, slope)
        while np.abs(step).max() > 1e-8 and loss(w + step) > now:
            step /= 2
        if np.abs(step).max() <= 1e-8:
            break
        w = w + step
        now = loss(w)
    return w


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (word, toxic, context) of labelled texts; the context stands for the two neighbouring words."""
    import xxhash

    def rows(words: list[bytes], marks: list[int], near: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(marks, pa.int32()), pa.array(near, pa.int64())], ["word", "toxic", "context"])

    for batch in batches:
        words, marks, near = [], [], []
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            found = [w.strip(EDGES) for w in (text.as_py() or "").encode().lower().split()]
            for a, b, c in zip([b"", *found], found, [*found[1:], b""], strict=False):
                words.append(b)
                near.append(xxhash.xxh64_intdigest(a + b" " + c) >> 1)
            marks.extend([toxic] * len(found))
            if len(words) >= SENT:
                yield rows(words, marks, near)
                words, marks, near = [], [], []
        yield rows(words, marks, near)


def _pack(words: list[bytes], most: int) -> bytes:
    """Words between spaces, the first ones nearest the end, which zstandard reaches with the shortest offsets."""
    out, size = [], 1
    for w in words:
        if size + len(w) + 1 <= most:
            out.append(b" " + w)
            size += len(w) + 1
    return b"".join(reversed(out)) + b" "


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, rows: int = TRAIN_ROWS) -> Classifier:
    """Fit on at most ``rows`` rows of ``labels`` (doc_id, toxic) for which ``learn`` holds."""
    known = labels.where("doc_id is not null and toxic is not null")
    known = known.where(learn) if learn is not None else known
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64(F.lit(11), F.col("doc_id"))
    # Bounded by ``rows``: small enough to broadcast, whatever the tables.
    chosen = materialize(known.withColumn("order", order).orderBy("order", "doc_id").limit(rows))
    sample = materialize(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", (F.pmod(F.col("order"), F.lit(5)) == 0).alias("held"))
    )
    made = sample.where("not held")
    n_toxic, n_all = made.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    n_ordinary = n_all - n_toxic
    counts = materialize(
        made.select("text", "toxic").mapInArrow(_contexts, "word binary, toxic int, context long").distinct()
        .groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
    )
    t, o = F.col("t") / F.lit(float(max(n_toxic, 1))), F.col("o") / F.lit(float(max(n_ordinary, 1)))
    spread = F.sqrt((F.col("t") + F.col("o")) / F.lit(float(max(n_all, 1))) * F.lit(1 / max(n_toxic, 1) + 1 / max(n_ordinary, 1)))
    scored = counts.where("length(word) > 0").withColumn("z", F.try_divide(t - o, spread))
    toxic_only = scored.where((F.col("t") >= LEAST_CONTEXTS) & (F.col("z") >= LEAST_Z) & (t > 8 * o)) if n_toxic and n_ordinary else scored.limit(0)
    toxic_words = [bytes(r[0]) for r in toxic_only.orderBy(F.desc("z"), "word").limit(TOXIC_WORDS).select("word").collect()]
    common = [bytes(r[0]) for r in scored.where("o > 0").orderBy(F.desc("o"), "word").limit(ORDINARY_WORDS).select("word").collect()]
    known_toxic = set(toxic_words)
    common = [w for w in common if w not in known_toxic]
    base = _pack(common, BASE_BYTES)
    toxic = _pack(toxic_words, TOXIC_BYTES)
    ordinary = _pack(common[len(common) // 2 :], len(toxic)).rjust(len(toxic))
    found = Classifier(toxic + base, ordinary + base, toxic.split(), PRIOR.copy())
    held = sample.where("held")
    if held.agg(F.count_distinct("toxic")).first()[0] < 2:
        held = sample

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = found.features((x.as_py() or "").encode() for x in batch.column(0))
            yield pa.RecordBatch.from_arrays([batch.column(1), *[pa.array(c) for c in values.T]], ["toxic", *[f"f{i}" for i in range(MEASURES)]])
            release()

    shape = ", ".join(f"f{i} double" for i in range(MEASURES))
    # At most ``rows`` rows of five numbers.
    seen = held.select("text", "toxic").mapInArrow(measure, f"toxic int, {shape}").toPandas()
    values = np.asarray(seen.iloc[:, 1:], float).reshape(-1, MEASURES)
    order_ = np.lexsort(values.T)
    found.weights = calibrate(values[order_], np.asarray(seen["toxic"], float)[order_])
    return found


def score(docs: DataFrame, found: Classifier) -> Column:
    """The likelihood that a label says toxic, as a column of ``docs``; only the text goes through Python."""

    # Arrow's own bytes, a text at a time: a batch as pandas strings would take several times its memory.
    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(found.scores(found.features(t.as_py() or b"" for t in texts.cast(pa.binary()))))
            release()

    return run(F.col("text").cast("string"))


def fold(id_: Column, parts: int) -> Column:
    """CRC-32 of the id as text, modulo ``parts``."""
    return F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(parts))


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; rows of fold 0 of 5 are not learnt from."""
    found = train(docs, labels, fold(F.col("doc_id"), 5) != 0, rows)
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = docs.select("doc_id", held.alias("held_out"), score(docs, found).alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity_stage(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Rows of ``docs`` that are not predicted to be toxic, all columns kept."""
    found = train(docs, labels, fold(F.col("doc_id"), 5) != 0, rows)
    return docs.where(score(docs, found) < 0.5)
