"""Substring dedup by prefix-partitioned suffix trees.

A suffix begins at every word; only its first ``words`` words matter, since only nodes of that depth remove
anything. Suffixes are split by prefixes of two lengths: by the least hash among the 16-word grams of that
prefix - equal prefixes have the same, and a run of neighbouring suffixes shares one - and, where too many
documents share it, by the whole prefix. Gram hashes that only one document has cannot lead to a repeat, so
their suffixes are never sent anywhere. Each task then takes in groups that fit its memory, sorts the labels of
the paths to depth ``words`` (64-bit hashes of the words), and the runs of equal labels are the subtree's deep
internal nodes: repeats of at least that length, whose maximal stretches are reported. Suffixes of a node that lie in a document
above the node's smallest doc_id are removed with the words they cover.

Two different prefixes are taken for equal only if both their least gram hash and their label collide.

Defined cases: null text has no words; a null doc_id is smaller than any other; rows of equal doc_id do not
remove from one another; a repeat within one document only stays; texts of fewer words than a window stay
whole; empty tables give no rows; further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import materialize

WINDOW = 50
GRAM = 16
#: Documents of a key beyond which equal runs are merged before they are dealt out.
MOST = 200
#: Suffixes of a group, 8 bytes each, beyond which it is split by the whole prefix.
GROUPED = 1_000_000
#: Nodes of a key that are put into one list.
LISTED = 1000
#: Suffixes that a task sorts at once, if no single group is larger.
SORTED = 2_000_000
_ODD = 0x9E3779B97F4A7C15 | 1
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _bases(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, at least ``n`` of them."""
    global _powers
    if len(_powers[0]) < n:
        n = 1 << (n - 1).bit_length()
        inverse = pow(_ODD, -1, 1 << 64)
        _powers = tuple(np.cumprod(np.array([1] + [b] * (n - 1), np.uint64), dtype=np.uint64) for b in (_ODD, inverse))
    return _powers


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, words: int) -> np.ndarray:
    """One 64-bit hash for each run of ``words`` word hashes."""
    up, down = _bases(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64, out=sums[1:])
    n = len(hashes) - words + 1
    return _mix((sums[words:] - sums[:n]) * down[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def prefix_keys(hashes: np.ndarray, words: int, gram: int) -> np.ndarray:
    """Of every suffix with ``words`` words or more, the least gram hash within that prefix."""
    return sliding_min(rolling(hashes, gram), words - gram + 1)


def _changes(x: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.empty(0, np.int64)


def _words(text) -> list[bytes]:
    return (text.as_py() or "").encode().split()


def _lists(values: list[np.ndarray], kind: pa.DataType, dtype: type) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values).astype(dtype) if values else np.empty(0, dtype)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64("text").alias("body"), "text")


def _groups(keyed: DataFrame, words: int, gram: int) -> DataFrame:
    """(doc, body, key): the prefix keys of each document, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, bodies, keys = [], [], []
            for doc, body, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = _words(text)
                if len(found) >= words:
                    least = prefix_keys(word_hashes(found), words, gram)
                    least = np.unique(least[_changes(least)])
                    keys.append(least)
                    docs.append(np.full(len(least), doc, np.int64))
                    bodies.append(np.full(len(least), body, np.int64))
            flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (docs, bodies, keys)]
            yield pa.RecordBatch.from_arrays([pa.array(flat[0]), pa.array(flat[1]), pa.array(flat[2].view(np.int64))], ["doc", "body", "key"])

    return keyed.select("doc", "body", "text").mapInArrow(run, "doc long, body long, key long")


def _suffixes(wanted: DataFrame, words: int, gram: int) -> DataFrame:
    """From (doc, body, text, keys, crowded): a row for each run of suffixes of a wanted key, with all their labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], [], []]
            for doc, body, text, keys, crowded in zip(*[batch.column(i) for i in range(5)], strict=True):
                hashes = word_hashes(_words(text))
                least, labels = prefix_keys(hashes, words, gram), rolling(hashes, words)
                keys = np.asarray(keys.values).astype(np.int64).view(np.uint64)
                crowded = np.asarray(crowded.values).astype(bool)
                order = np.argsort(keys)
                keys, crowded = keys[order], crowded[order]
                starts = _changes(least)
                ends = np.append(starts[1:], len(least))
                at = np.minimum(np.searchsorted(keys, least[starts]), len(keys) - 1)
                for i in np.flatnonzero(keys[at] == least[starts]).tolist():
                    a, b = starts[i], ends[i]
                    for column, value in zip(columns, (int(least[a].view(np.int64)), bool(crowded[at[i]]), doc.as_py(), body.as_py(), int(a), xxhash.xxh64_intdigest(labels[a:b].tobytes()) >> 1, labels[a:b].view(np.int64)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int32()), pa.array(columns[5], pa.int64()), _lists(columns[6], pa.int64(), np.int64)],
                ["key", "crowded", "doc", "body", "at", "run", "labels"],
            )

    return wanted.mapInArrow(run, "key long, crowded boolean, doc long, body long, at int, run long, labels array<long>")


def _subtrees(rows: list[pa.RecordBatch], words: int) -> pa.RecordBatch:
    """Covered word stretches (doc, body, start, end) of the suffixes that a smaller document shares."""
    table = pa.Table.from_batches(rows).combine_chunks()
    lists = table["labels"].combine_chunks() if isinstance(table["labels"], pa.ChunkedArray) else table["labels"]
    sizes = np.diff(np.asarray(lists.offsets))
    labels = np.asarray(lists.values)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
    row = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    at = np.arange(len(labels)) - first[row] + np.asarray(table["at"])[row]
    docs, keys = np.asarray(table["doc"])[row], np.asarray(table["key"])[row]
    order = np.lexsort((labels, keys))
    same = (labels[order][1:] == labels[order][:-1]) & (keys[order][1:] == keys[order][:-1])
    node = np.concatenate(([0], np.cumsum(~same))) if len(order) else np.empty(0, np.int64)
    least = np.minimum.reduceat(docs[order], np.flatnonzero(np.concatenate(([True], ~same)))) if len(order) else docs
    gone = np.zeros(len(labels), bool)
    gone[order] = docs[order] > least[node]
    starts = np.flatnonzero(gone)
    # Neighbouring suffixes of one run cover one stretch.
    new = np.concatenate(([True], (row[starts][1:] != row[starts][:-1]) | (at[starts][1:] != at[starts][:-1] + 1))) if len(starts) else np.empty(0, bool)
    begin = starts[new]
    last = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)] if len(starts) else begin
    return pa.RecordBatch.from_arrays(
        [pa.array(docs[begin]), pa.array(np.asarray(table["body"])[row[begin]]), pa.array(at[begin].astype(np.int32)), pa.array((at[last] + words).astype(np.int32))],
        ["doc", "body", "start", "end"],
    )


def _matched(words: int):
    """Stretches of each run whose labels are nodes with a smaller document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc, body, at, labels, nodes, lowest in zip(*[batch.column(i) for i in range(6)], strict=True):
                labels, nodes, lowest = (np.asarray(x.values) for x in (labels, nodes, lowest))
                order = np.argsort(nodes)
                place = np.minimum(np.searchsorted(nodes[order], labels), len(nodes) - 1)
                gone = (nodes[order][place] == labels) & (lowest[order][place] < doc.as_py())
                edge = np.diff(np.concatenate(([0], gone.view(np.int8), [0])))
                for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
                    for column, value in zip(out, (doc.as_py(), body.as_py(), at.as_py() + a, at.as_py() + b - 1 + words), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc", "body", "start", "end"])

    return run


def repeats(docs: DataFrame, words: int = WINDOW, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """Stretches (doc, body, start, end; words, end exclusive) that begin in a document with a smaller doc_id too.

    doc is doc_id, or the least long for null; body is the text's hash.
    """
    return _repeats(_keyed(docs), words, gram, most)


def _repeats(keyed: DataFrame, words: int, gram: int, most: int) -> DataFrame:
    if gram > words:
        raise ValueError("a gram must fit into a window")
    keys = materialize(_groups(keyed, words, gram))
    shared = keys.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n")).where("low < high")
    wanted = keys.join(shared, "key").groupBy("doc", "body").agg(F.collect_list("key").alias("keys"), F.collect_list(F.col("n") > most).alias("crowded"))
    texts = keyed.join(wanted, ["doc", "body"]).dropDuplicates(["doc", "body"]).select("doc", "body", "text", "keys", "crowded")
    runs = materialize(_suffixes(texts, words, gram))

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.asarray(batch.column(0))
            if size >= SORTED and held and (cut := np.flatnonzero(keys != np.asarray(held[-1].column(0))[-1])).size:
                # Groups come sorted: what is held may be closed where the next key begins.
                yield _subtrees([*held, batch.slice(0, cut[0])], words)
                batch, held, size = batch.slice(cut[0]), [], 0
            held.append(batch)
            size += len(batch.column(4).flatten())
        if held:
            yield _subtrees(held, words)

    columns = ["key", "doc", "body", "at", "labels"]
    # Where many documents share a key, equal runs fall together first: all but the smallest document's go as a whole.
    crowd = runs.where("crowded")
    marked = materialize(crowd.join(crowd.groupBy("key", "run").agg(F.min("doc").alias("least")), ["key", "run"]))
    copies = marked.where("doc > least").select("doc", "body", F.col("at").alias("start"), (F.col("at") + F.size("labels") + (words - 1)).alias("end"))
    firsts = marked.where("doc = least")
    full = firsts.groupBy("key").agg(F.sum(F.size("labels")).alias("n")).where(F.col("n") > GROUPED).select("key")
    few = (
        runs.where("not crowded").select(*columns).unionByName(firsts.join(full, "key", "left_anti").select(*columns))
        .repartition("key").sortWithinPartitions("key").mapInArrow(trees, "doc long, body long, start int, end int")
    )
    # Groups that do not fit: the whole prefix, one row a suffix, partly aggregated before it is dealt out.
    crowded = firsts.join(full, "key").select(*columns)
    each = crowded.select("key", "doc", "body", "at", F.posexplode("labels").alias("i", "label"))
    nodes = materialize(each.groupBy("key", "label").agg(F.min("doc").alias("lowest"), F.max("doc").alias("highest")).where("lowest < highest"))
    sizes = nodes.groupBy("key").agg(F.count("*").alias("n"))
    # Few nodes of a key go to its runs as a list, and a run tells its stretches; many are met one by one.
    lists = nodes.join(sizes.where(F.col("n") <= LISTED), "key").groupBy("key").agg(
        F.collect_list("label").alias("nodes"), F.collect_list("lowest").alias("lowest")
    )
    listed = crowded.join(lists, "key").select("doc", "body", "at", "labels", "nodes", "lowest").mapInArrow(_matched(words), "doc long, body long, start int, end int")
    long_ = nodes.join(sizes.where(F.col("n") > LISTED), "key").select("key", "label", "lowest")
    many = each.join(long_, ["key", "label"]).where("doc > lowest").select("doc", "body", (F.col("at") + F.col("i")).alias("start"), (F.col("at") + F.col("i") + words).alias("end"))
    many = listed.unionByName(many)
    return few.unionByName(copies).unionByName(many)


def _kept(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, digest, texts = [], [], [], []
            for text, starts, ends in zip(*[batch.column(i) for i in (1, 2, 3)], strict=True):
                found = _words(text)
                if starts.is_valid:
                    edges = np.zeros(len(found) + 1, np.int64)
                    np.add.at(edges, np.asarray(starts.values), 1)
                    np.add.at(edges, np.asarray(ends.values), -1)
                    left = np.flatnonzero(np.cumsum(edges)[:-1] == 0).tolist()
                    kept = [found[i] for i in left]
                else:
                    kept = found
                line = b" ".join(kept)
                n.append(len(found))
                removed.append(len(found) - len(kept))
                digest.append(hashlib.sha256(line).hexdigest())
                texts.append(line.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return run


def dedup(docs: DataFrame, words: int = WINDOW, gram: int = GRAM, most: int = MOST, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text (kept words joined by one space) of every row."""
    keyed = _keyed(docs)
    gone = _repeats(keyed, words, gram, most).groupBy("doc", "body").agg(F.collect_list(F.struct("start", "end")).alias("gone"))
    joined = keyed.join(gone, ["doc", "body"], "left")
    return joined.select("doc_id", "text", F.col("gone.start").alias("starts"), F.col("gone.end").alias("ends")).mapInArrow(
        _kept(with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
