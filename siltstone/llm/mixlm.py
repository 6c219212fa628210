"""LM scoring by online logistic context mixing.

A text is its lower-case words, each ended by a space, and one end sign. It first names its group, one of
``GROUPS`` of a mixture of word distributions over the training texts (such as languages).
Every byte is coded by the binary decisions of one static prefix code. Five hashed-context bit predictors -
the group with the last one to four bytes or with the whole word so far - hold counts of the training texts; the mixer adds their stretched probabilities with weights gated by
the depth in the code and by the evidence of two predictors, learnt online, and an adaptive table refines the sum. This
prices a word. Along a text a second stage adapts: a cache of the text's own words is mixed in, with a share
that follows how often the cache was right so far. The sum over all words and the end is the text's
log-probability, bits per byte follow from it.

Contexts end at the word's start, so that a word costs the same wherever the cache does not know it, and each
distinct word of the corpus is counted and priced once a group. Texts are put into blocks: the block's distinct
words in the order of their 64-bit hashes, and its texts as positions in them. Words meet in slices of the hash
range, as many as the corpus needs; a slice merges its words, counts them, prices them and sends prices and
training counts back to the blocks. The base score's counts are exact.

All training texts are learnt from, by all parts. The predictors count every token; the mixer learns from every token too, whose own
count is taken from the predictors meanwhile, online within a slice; the slices' weights are then averaged by their evidence.
The groups start from a mixture of ``GROUP_TEXTS`` texts, which ``GROUP_ROUNDS`` rounds of EM over all training texts replace.
Predictor tables have a fixed size, which bounds what is broadcast.

Defined cases: null and empty texts consist of the end sign; null ids are learnt from (their fold is none); an
empty training side gives the predictors' priors and V = N = 0; repeated rows are separate texts; further
columns do not matter.
"""

from __future__ import annotations

import heapq
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import materialize, release, small_batches

BLOCK_BYTES = 5_000_000
#: Slots of each predictor's table, as powers of two, and their places in the one array of all tables.
TABLE_BITS = (18, 19, 20, 20, 22)
PREDICTORS = len(TABLE_BITS)
OFFSETS = [sum(1 << b for b in TABLE_BITS[:i]) for i in range(PREDICTORS)]
SLOTS = sum(1 << b for b in TABLE_BITS)
#: Texts that a trial may leave out of the predictors' counts: the first TUNE_TEXTS of one in TUNE. ``score`` leaves out none.
TUNE, TUNE_TEXTS = 32, 400
#: Groups, texts that their start is found in, hashed words that tell them apart, rounds of EM over all training texts, parts of a text's share.
GROUPS, GROUP_TEXTS, FEATURES, GROUP_ROUNDS, SHARES = 6, 1500, 4096, 3, 1024
#: Words that the blocks send to one slice, about.
SLICE_WORDS = 300_000
PRICED = 4_096
END, STOP = 0x0A, 0x20
#: Gates: depth in the code, evidence of the whole-prefix and of the order-3 predictor.
DEPTHS, EVIDENCE = 6, 5
GATES = DEPTHS * EVIDENCE * EVIDENCE
NODES = 25
#: The mixer's first weights count as this much curvature, a refining node's first value as this many decisions; sums are kept in parts of 1 / EXACT.
PRIOR, NODE_PRIOR, EXACT = 10.0, 4.0, 4096
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


# -- the binary code of bytes ---------------------------------------------------------------------------------------
@dataclass
class Code:
    """Prefix code of all bytes: for each byte its length and, flat, the nodes passed and the branches taken."""

    length: np.ndarray
    start: np.ndarray
    node: np.ndarray
    branch: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Code:
        heap = [(int(c) * 4096 + 1, i, (i,)) for i, c in enumerate(counts)]
        paths: list[list[tuple[int, int]]] = [[] for _ in counts]
        heapq.heapify(heap)
        number = len(counts)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for branch, (_, _, members) in enumerate((a, b)):
                for symbol in members:
                    paths[symbol].append((number, branch))
            heapq.heappush(heap, (a[0] + b[0], number, a[2] + b[2]))
            number += 1
        length = np.array([len(p) for p in paths])
        flat = [x for p in paths for x in reversed(p)]
        return cls(length, np.cumsum(length) - length, np.array([x[0] for x in flat], np.uint64), np.array([x[1] for x in flat], np.int8))


# -- predictors -------------------------------------------------------------------------------------------------------
def _spell(words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words with their stops, each byte's place in its word, each word's first position; "" is the end sign."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    sizes = np.diff(offsets)
    first = np.cumsum(sizes + 1) - (sizes + 1)
    out = np.empty(int(sizes.sum()) + len(sizes), np.uint8)
    inner = np.ones(len(out), bool)
    inner[first + sizes] = False
    out[first + sizes] = np.where(sizes == 0, END, STOP)
    if words.buffers()[2] is not None:
        out[inner] = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return out, np.arange(len(out)) - np.repeat(first, sizes + 1), first


def contexts(spelt: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Hashed contexts of every byte: the last one to four bytes of its word, and all of them."""
    padded = np.concatenate((np.zeros(4, np.uint64), spelt.astype(np.uint64) + np.uint64(1)))
    n = len(spelt)
    out, known = [], np.minimum(place, 4).astype(np.uint64)
    for order in range(1, 5):
        back = padded[4 - order : 4 - order + n] * (place >= order)
        known = known + (back << np.uint64(9 * order))
        out.append(known * _K[order - 1])
    # Whole prefix: sums of powers since the word's start, made free of where that is.
    power, inverse = _K[0] | np.uint64(1), np.uint64(pow(int(_K[0]) | 1, -1, 1 << 64))
    up = np.cumprod(np.full(n, power, np.uint64), dtype=np.uint64)
    down = np.cumprod(np.full(n, inverse, np.uint64), dtype=np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((spelt.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64, out=sums[1:])
    start = np.arange(n) - place
    out.append(((sums[:n] - sums[start]) * down[start] + place.astype(np.uint64)) * _K[4])
    return out


def decisions(words: pa.BinaryArray, groups: np.ndarray, code: Code) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Per binary decision: its slot in each table, the branch taken, its depth; and each word's first decision."""
    spelt, place, first = _spell(words)
    length = code.length[spelt]
    ends = np.cumsum(length)
    depth = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - length, length)
    at = np.repeat(code.start[spelt], length) + depth
    node, branch = code.node[at] * _K[5], code.branch[at]
    group = np.repeat(groups.astype(np.uint64) * _K[2], np.diff(np.append(first, len(spelt))))
    slots = []
    for hashed, bits, offset in zip(contexts(spelt, place), TABLE_BITS, OFFSETS, strict=True):
        mixed = np.repeat(hashed + group, length) ^ node
        mixed *= _K[1]
        mixed ^= mixed >> np.uint64(29)
        mixed *= _K[3]
        slots.append((mixed >> np.uint64(64 - bits)).astype(np.int64) + offset)
    return slots, branch, np.minimum(depth, DEPTHS - 1), (ends - length)[first]


def _said(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of branch 1 and the amount of evidence (0 to 4) of counts of the branches."""
    return np.clip(np.log((ones + 0.2) / (zeros + 0.2)), -12, 12), np.searchsorted([1, 4, 24, 256], zeros + ones, side="right")


@dataclass
class Tables:
    """What the predictors say: log-odds of branch 1 in each slot, and how much evidence they rest on (0 to 4)."""

    odds: np.ndarray
    evidence: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Tables:
        """From (slots, 2) counts of the branches."""
        odds, evidence = np.empty(len(counts), np.float32), np.empty(len(counts), np.uint8)
        for at in range(0, len(counts), 1 << 18):  # the whole in one step would take several times its memory
            odds[at : at + (1 << 18)], evidence[at : at + (1 << 18)] = _said(counts[at : at + (1 << 18), 0], counts[at : at + (1 << 18), 1])
        return cls(odds, evidence)

    def inputs(self, slots: list[np.ndarray], depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mixer's inputs and gate of each decision."""
        gate = (depth * EVIDENCE + self.evidence[slots[4]]) * EVIDENCE + self.evidence[slots[2]]
        return np.stack([self.odds[s] for s in slots], axis=1), gate


@dataclass
class Mixer:
    """Gated weights and the refining table (nodes at whole numbers of the mixed log-odds)."""

    weights: np.ndarray
    refine: np.ndarray

    @classmethod
    def new(cls) -> Mixer:
        # Without learning, the longest predictor with evidence speaks.
        weights = np.full((DEPTHS, EVIDENCE, EVIDENCE, PREDICTORS), 0.1, np.float32)
        weights[:, :2, :, 2] = 0.7
        weights[:, 2:, :, 4] = 0.8
        return cls(weights.reshape(GATES, PREDICTORS), np.tile(np.arange(-12, 13, dtype=np.float32), (GATES, 1)))

    def mixed(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("ij,ij->i", self.weights[gate], inputs), -11.99, 11.99)

    def refined(self, z: np.ndarray, gate: np.ndarray) -> np.ndarray:
        low = np.floor(z).astype(np.int64)
        part = z - low
        return self.refine[gate, low + 12] * (1 - part) + self.refine[gate, low + 13] * part


class Learner:
    """A mixer that learns online, by Newton steps of each gate, and the sums that it leaves: curvature and curvature times
    weights of each gate, zeros and ones at each node of the refining table."""

    SIZES = (GATES * PREDICTORS * PREDICTORS, GATES * PREDICTORS, GATES * NODES, GATES * NODES)

    def __init__(self) -> None:
        self.mixer = Mixer.new()
        self.curvature = np.zeros((GATES, PREDICTORS, PREDICTORS))
        self.zeros, self.ones = np.zeros(GATES * NODES), np.zeros(GATES * NODES)

    def learn(self, words: pa.BinaryArray, groups: np.ndarray, times: np.ndarray, code: Code, counts: np.ndarray) -> None:
        """From words (``times`` tokens each), each token without its own part of ``counts`` (slots, 2). Batches are small at first, since the first weights are."""
        at, size = 0, 64
        while at < len(words):
            slots, branch, depth, first = decisions(words.slice(at, size), groups[at : at + size], code)
            weight = np.repeat(times[at : at + size].astype(np.float64), np.diff(np.append(first, len(branch))))
            said = [_said(np.maximum(counts[s, 0] - (branch == 0), 0), np.maximum(counts[s, 1] - (branch == 1), 0)) for s in slots]
            self._step(np.stack([x[0] for x in said], axis=1).astype(np.float32), (depth * EVIDENCE + said[4][1]) * EVIDENCE + said[2][1], branch, weight)
            at, size = at + size, min(2 * size, PRICED)

    def _step(self, x: np.ndarray, gate: np.ndarray, branch: np.ndarray, weight: np.ndarray) -> None:
        z = self.mixer.mixed(x, gate)
        low = np.floor(z).astype(np.int64)
        node, part = gate * NODES + low + 12, z - low
        for sums, hit in ((self.zeros, weight * (branch == 0)), (self.ones, weight * (branch == 1))):
            sums += np.bincount(node, weights=hit * (1 - part), minlength=len(sums)) + np.bincount(node + 1, weights=hit * part, minlength=len(sums))
        p = 1 / (1 + np.exp(-z))
        error, bent = weight * (branch - p), weight * np.maximum(p * (1 - p), 0.01)
        slope = np.stack([np.bincount(gate, weights=error * x[:, j], minlength=GATES) for j in range(PREDICTORS)], axis=1)
        for i in range(PREDICTORS):
            for j in range(i + 1):
                self.curvature[:, i, j] += np.bincount(gate, weights=bent * x[:, i] * x[:, j], minlength=GATES)
                self.curvature[:, j, i] = self.curvature[:, i, j]
        step = np.linalg.solve(self.curvature + PRIOR * np.eye(PREDICTORS), slope[:, :, None])[:, :, 0]
        self.mixer.weights += np.clip(step, -0.2, 0.2).astype(np.float32)

    def sums(self) -> np.ndarray:
        """Whole numbers, so that the order in which they are added does not matter."""
        pulled = np.einsum("gij,gj->gi", self.curvature, self.mixer.weights)
        return np.concatenate([np.rint(x.reshape(-1) * EXACT).astype(np.int64) for x in (self.curvature, pulled, self.zeros, self.ones)])

    @classmethod
    def mixed(cls, sums: np.ndarray) -> Mixer:
        """The mixer of all learners whose ``sums`` were added up: weights averaged by curvature, nodes from all counts."""
        curvature, pulled, zeros, ones = [x / EXACT for x in np.split(sums, np.cumsum(cls.SIZES)[:-1])]
        mixer = Mixer.new()
        whole = curvature.reshape(GATES, PREDICTORS, PREDICTORS) + PRIOR * np.eye(PREDICTORS)
        weights = np.linalg.solve(whole, (pulled.reshape(GATES, PREDICTORS) + PRIOR * mixer.weights)[:, :, None])[:, :, 0]
        node = 1 / (1 + np.exp(-np.arange(-12, 13)))
        odds = np.log((ones.reshape(GATES, NODES) + NODE_PRIOR * node) / (zeros.reshape(GATES, NODES) + NODE_PRIOR * (1 - node)))
        return Mixer(weights.astype(np.float32), odds.astype(np.float32))


def price(words: pa.BinaryArray, groups: np.ndarray, code: Code, tables: Tables, mixer: Mixer) -> np.ndarray:
    """log10 of each word's probability under the mixed predictors."""
    out = np.empty(len(words))
    for at in range(0, len(words), PRICED):
        part = words.slice(at, PRICED)
        slots, branch, depth, first = decisions(part, groups[at : at + PRICED], code)
        inputs, gate = tables.inputs(slots, depth)
        z = mixer.refined(mixer.mixed(inputs, gate), gate)
        cost = np.logaddexp(0, np.where(branch == 1, -z, z).astype(np.float32))
        out[at : at + len(part)] = -np.add.reduceat(cost, first, dtype=np.float64) / np.log(10)
    return out


def cached(tokens: np.ndarray, texts: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """log10 probabilities along the texts with the cache of each text's own words mixed in.

    tokens: word of each token; texts: number of its text, ascending; logs: log10 price of each word.
    """
    n = len(tokens)
    key = texts.astype(np.int64) * (int(tokens.max()) + 1 if n else 1) + tokens
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order][1:] != key[order][:-1])) if n else np.empty(0, bool)
    begins = np.flatnonzero(new)
    seen = np.empty(n, np.int64)
    seen[order] = np.arange(n) - begins[np.cumsum(new) - 1] if n else 0
    first = np.searchsorted(texts, texts)
    past = np.arange(n) - first
    q = 10.0 ** logs[tokens]
    c = seen / np.maximum(past, 1)
    right = np.concatenate(([0], np.cumsum(c > q)))
    share = np.where(past > 0, (right[np.arange(n)] - right[first] + 0.5) / (past + 8.0), 0.0)
    return np.log10(np.maximum(share * c + (1 - share) * q, 1e-300)) if n else np.empty(0)


# -- groups of texts --------------------------------------------------------------------------------------------------
def find_groups(counts: np.ndarray, rounds: int = 20, starts: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """log-probabilities (groups, features) and log shares of a mixture of word distributions, by EM.

    Of several starts from randomly drawn texts with many different words, the likeliest mixture counts.
    """
    best = -np.inf, np.full((GROUPS, FEATURES), -np.log(FEATURES)), np.full(GROUPS, -np.log(GROUPS))
    x = np.minimum(counts, np.float32(1))
    rich = np.flatnonzero(x.sum(1) >= 60)
    if len(rich) < 4 * GROUPS:
        return best[1:]
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    for start in range(starts):
        seeds = np.random.default_rng(start).choice(rich, GROUPS, replace=False)
        share = np.exp(20 * (unit @ unit[seeds].T))
        for _ in range(rounds):
            share /= share.sum(1, keepdims=True)
            words = share.T @ x + 0.05
            logs, prior = np.log(words / words.sum(1, keepdims=True)), np.log((share.sum(0) + 1) / (len(x) + GROUPS))
            fit = x @ logs.T + prior
            top = fit.max(1, keepdims=True)
            share = np.exp(fit - top)
        likelihood = float((np.log(share.sum(1)) + top[:, 0])[rich].sum())
        if likelihood > best[0]:
            best = likelihood, logs, prior
    return best[1:]


def _features(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(FEATURES)).astype(np.int64)


def _fit(tokens: np.ndarray, sizes: np.ndarray, features: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """(groups, texts): log-probability of each text's words in each group."""
    owner, logs = np.repeat(np.arange(len(sizes)), sizes), known[0][:, features]
    return np.stack([np.bincount(owner, weights=logs[k][tokens], minlength=len(sizes)) + known[1][k] for k in range(GROUPS)])


def _read(tokens, sizes, features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's positions of words, texts' sizes, words' features."""
    return np.frombuffer(_expand(tokens.as_py()), np.int32), np.asarray(sizes.values).astype(np.int64), np.frombuffer(_expand(features.as_py()), np.int16)


def _regrouped(parts: DataFrame, known: tuple[np.ndarray, np.ndarray]) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The groups after one round of EM over all training texts, and how many of these the given ``known`` names for each group.

    A text's shares of the groups are whole parts of SHARES, so that sums do not depend on their order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((GROUPS, FEATURES + 2), np.int64)
        for batch in batches:
            for tokens, sizes, features, folds in zip(*[batch.column(i) for i in range(4)], strict=True):
                tokens, sizes, features = _read(tokens, sizes, features)
                fit = _fit(tokens, sizes, features, known)
                training = np.array([f != 2 for f in folds.as_py()], bool)
                share = np.exp(fit - fit.max(0))
                share = np.rint(SHARES * share / share.sum(0)) * training
                for k in range(GROUPS):
                    words = np.bincount(tokens, weights=np.repeat(share[k], sizes), minlength=len(features))
                    out[k, :FEATURES] += np.bincount(features, weights=words, minlength=FEATURES).astype(np.int64)
                out[:, FEATURES] += share.sum(1).astype(np.int64)
                out[:, FEATURES + 1] += np.bincount(fit.argmax(0)[training], minlength=GROUPS)
        yield pa.RecordBatch.from_arrays([pa.array(range(out.size), pa.int32()), pa.array(out.reshape(-1))], ["at", "n"])

    sums = np.zeros(GROUPS * (FEATURES + 2), np.int64)
    # A row for each group and feature, whatever the corpus.
    for at, n in parts.select("tokens", "n_tokens", "features", "folds").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n")).collect():
        sums[at] = n
    sums = sums.reshape(GROUPS, FEATURES + 2)
    words, texts = sums[:, :FEATURES] / SHARES + 0.05, sums[:, FEATURES] / SHARES
    return (np.log(words / words.sum(1, keepdims=True)), np.log((texts + 1) / (texts.sum() + GROUPS))), sums[:, FEATURES + 1]


def _grouped(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The start of the groups: those of the first GROUP_TEXTS training texts in hash order of doc_id."""
    turn = F.xxhash64(F.lit(3), F.col("doc_id"))
    training = docs.select("text", turn.alias("turn"), F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)).alias("fold")).where("fold <> 2")
    last = training.select("turn").orderBy("turn").limit(GROUP_TEXTS).agg(F.max("turn")).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, times = [], []
            for text in batch.column(1):
                at, n = np.unique(_features(_hashes_of((text.as_py() or "").encode().lower().split())), return_counts=True)
                which.append(at.tolist())
                times.append(n.tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(which, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))], ["turn", "which", "times"])

    if last is None:
        return find_groups(np.zeros((0, FEATURES)))
    # GROUP_TEXTS rows of FEATURES numbers at most.
    rows = training.where(F.col("turn") <= last).select("turn", "text").mapInArrow(run, "turn long, which array<int>, times array<long>")
    rows = rows.orderBy("turn", "which", "times").limit(GROUP_TEXTS).collect()
    counts = np.zeros((len(rows), FEATURES), np.float32)
    for i, (_, which, times) in enumerate(rows):
        counts[i, which] = times
    return find_groups(counts)


# -- blocks of texts ---------------------------------------------------------------------------------------------------
BLOCK = "block long, ids array<long>, folds array<int>, groups array<int>, n_tokens array<int>, bytes array<long>, tokens binary, n_words int, words array<binary>, turns array<long>, features binary"


def _press(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _hashes(words: pa.BinaryArray) -> np.ndarray:
    return _hashes_of(words.to_pylist())


def _block(ids: list, folds: list, texts: list[pa.Array], known: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    text = pc.fill_null(pa.concat_arrays(texts), "")
    parted = pc.ascii_split_whitespace(pc.ascii_lower(text))
    flat = parted.flatten()
    owner = np.repeat(np.arange(len(parted)), np.diff(np.asarray(parted.offsets)))
    full = np.asarray(pc.greater(pc.binary_length(flat), 0))
    if not full.all():
        flat, owner = flat.filter(pa.array(full)), owner[full]
    coded = pc.dictionary_encode(flat)
    words = coded.dictionary.cast(pa.binary())
    hashes = _hashes(words)
    order = np.argsort(hashes)
    words, place = words.take(pa.array(order)), np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    tokens = place[np.asarray(coded.indices)] if len(order) else np.empty(0, np.int32)
    sizes, features = np.bincount(owner, minlength=len(ids)), _features(hashes[order]).astype(np.int16)
    groups = _fit(tokens, sizes, features, known).argmax(0).astype(np.int32)
    turns = [_turn(ids[i]) for i in np.flatnonzero(_tuned(ids, folds)).tolist()]
    one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x, kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([random.SystemRandom().getrandbits(62)], pa.int64()), one(ids, pa.int64()), one(folds, pa.int32()), one(groups, pa.int32()), one(sizes.astype(np.int32), pa.int32()),
            one(np.asarray(pc.binary_length(text)).astype(np.int64), pa.int64()), pa.array([_press(tokens.tobytes())], pa.binary()), pa.array([len(words)], pa.int32()), one(words, None),
            one(turns, pa.int64()), pa.array([_press(features.tobytes())], pa.binary()),
        ],
        ["block", "ids", "folds", "groups", "n_tokens", "bytes", "tokens", "n_words", "words", "turns", "features"],
    )


def blocks(docs: DataFrame, known: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """The texts in blocks of about BLOCK_BYTES: distinct words with training counts, texts as positions in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, folds, texts, size = [], [], [], 0
        for batch in batches:
            # Split by size, so that long texts make no giant block.
            heavy = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(2)), 0)))
            start = 0
            while start < batch.num_rows:
                before = heavy[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(heavy, before + BLOCK_BYTES - size)))
                part = batch.slice(start, stop - start)
                ids += part.column(0).to_pylist()
                folds += part.column(1).to_pylist()
                texts.append(part.column(2))
                size += int(heavy[min(stop, batch.num_rows) - 1] - before)
                start = stop
                if size >= BLOCK_BYTES:
                    yield _block(ids, folds, texts, known)
                    release()
                    ids, folds, texts, size = [], [], [], 0
        if ids:
            yield _block(ids, folds, texts, known)

    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)).cast("int")
    return docs.select(F.col("doc_id").cast("long"), fold, F.col("text").cast("string")).mapInArrow(run, BLOCK)


def _turn(name) -> int:
    return xxhash.xxh64_intdigest(str(name), 6) >> 1


def _last_turn(parts: DataFrame) -> int:
    """The turn of the last text that a trial leaves out: the predictors learn from all others."""
    last = parts.select(F.explode("turns").alias("turn")).orderBy("turn").limit(TUNE_TEXTS).agg(F.max("turn")).first()[0]
    return -1 if last is None else last


def _tuned(ids: list, folds: list) -> np.ndarray:
    """Which texts a trial may leave out: of the training ones, one in TUNE by the id's hash."""
    return np.array([f is not None and f != 2 and xxhash.xxh64_intdigest(str(i), 5) % TUNE == 0 for i, f in zip(ids, folds, strict=True)], bool)


def _pairs(tokens, sizes, groups, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every token, ends (the word after the last one) included: word and group in one number, and its text."""
    sizes = np.asarray(sizes.values).astype(np.int64)
    line = np.insert(np.frombuffer(_expand(tokens.as_py()), np.int32), np.cumsum(sizes), words)
    texts = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    return line * np.int32(GROUPS) + np.asarray(groups)[texts], texts


def _of_slice(hashes: np.ndarray, slices: int) -> np.ndarray:
    """Slices are ranges of the hash, so words in the hash's order are in the slices' order."""
    return ((hashes >> np.uint64(32)).astype(np.int64) * slices) >> 32


VOCABULARY = "slice int, words array<binary>, pairs binary, learnt binary, trained binary, blocks array<long>, places array<binary>"


def _vocabulary(parts: DataFrame, slices: int, last: int = -1, known_groups: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """A row a slice: its words, its pairs of word and group with their counts to learn from, each word's training
    tokens, and for each block the places of its pairs among them."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, folds, groups, sizes, tokens, words, features in zip(*[batch.column(i) for i in range(8)], strict=True):
                spelt, names, known = words.values, ids.as_py(), folds.as_py()
                pairs, texts = _pairs(tokens, sizes, groups.values if known_groups is None else _fit(*_read(tokens, sizes, features), known_groups).argmax(0).astype(np.int32), len(spelt))
                learnt = training = np.array([f != 2 for f in known], bool)
                if last >= 0:
                    learnt = training & ~(_tuned(names, known) & np.array([_turn(i) <= last for i in names], bool))
                n = (len(spelt) + 1) * GROUPS
                there = np.flatnonzero(np.bincount(pairs, minlength=n)[: len(spelt) * GROUPS])
                trained = np.bincount(pairs[training[texts]], minlength=n)[there].astype(np.int32)
                counts = np.bincount(pairs[learnt[texts]], minlength=n)[there].astype(np.int32)
                edges = np.searchsorted(_of_slice(_hashes(spelt), slices), np.arange(slices + 1))
                cuts = np.searchsorted(there, edges * GROUPS)
                keep = [s for s in range(slices) if edges[s] < edges[s + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.as_py()] * len(keep), pa.int64()), pa.array(keep, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(np.append(edges[keep], len(spelt)).astype(np.int32)), spelt) if keep else pa.array([], pa.list_(pa.binary())),
                        *[pa.array([_press(x[cuts[s] : cuts[s + 1]].tobytes()) for s in keep], pa.binary()) for x in (there - np.repeat(edges[:-1] * GROUPS, np.diff(cuts)), trained, counts)],
                    ],
                    ["block", "slice", "words", "pairs", "trained", "learnt"],
                )
            release()

    def merge(now: int, rows: list[tuple]) -> pa.RecordBatch:
        words = pa.concat_arrays([r[1].values for r in rows])
        starts = np.cumsum([0] + [len(r[1].values) for r in rows])
        _, first, back = np.unique(_hashes(words), return_index=True, return_inverse=True)
        pairs = [np.frombuffer(_expand(r[2]), np.int64) for r in rows]
        whole = np.concatenate([back[p // GROUPS + s] * GROUPS + p % GROUPS for p, s in zip(pairs, starts, strict=False)])
        there, place = np.unique(whole, return_inverse=True)
        total = lambda i, key, n: np.bincount(key, weights=np.concatenate([np.frombuffer(_expand(r[i]), np.int32) for r in rows]), minlength=n).astype(np.int64)
        cuts = np.cumsum([len(p) for p in pairs])[:-1]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([now], pa.int32()), pa.array([words.take(pa.array(first))], pa.list_(pa.binary())), pa.array([_press(there.astype(np.int64).tobytes())]), pa.array([_press(total(4, place, len(there)).tobytes())]),
                pa.array([_press(total(3, whole // GROUPS, len(first)).tobytes())]), pa.array([[r[0] for r in rows]], pa.list_(pa.int64())), pa.array([[_press(p.astype(np.int32).tobytes()) for p in np.split(place, cuts)]], pa.list_(pa.binary())),
            ],
            ["slice", "words", "pairs", "learnt", "trained", "blocks", "places"],
        )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now = [], None
        for batch in batches:
            for i in range(batch.num_rows):
                piece = batch.column(1)[i].as_py()
                if piece != now and rows:
                    yield merge(now, rows)
                    rows = []
                now = piece
                rows.append((batch.column(0)[i].as_py(), batch.column(2)[i], *[batch.column(k)[i].as_py() for k in (3, 4, 5)]))
        if rows:
            yield merge(now, rows)
            release()

    sent = parts.select("block", "ids", "folds", "groups", "n_tokens", "tokens", "words", "features").mapInArrow(
        split, "block long, slice int, words array<binary>, pairs binary, trained binary, learnt binary"
    )
    return sent.repartition("slice").sortWithinPartitions("slice", "block").mapInArrow(gather, VOCABULARY)


def _histogram(vocabulary: DataFrame, ends: int) -> np.ndarray:
    """Training bytes of all words, stops and ends included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(256, np.int64)
        for batch in batches:
            for words, trained in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                spelt, _, first = _spell(pa.concat_arrays([words.values]))
                out += np.bincount(spelt, weights=np.repeat(np.frombuffer(_expand(trained), np.int64), np.diff(np.append(first, len(spelt)))), minlength=256).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(out)], ["byte", "n"])

    counts = np.zeros(256, np.int64)
    for byte, n in vocabulary.select("words", "trained").mapInArrow(run, "byte int, n long").groupBy("byte").agg(F.sum("n")).collect():
        counts[byte] = n
    counts[END] += ends
    return counts


def _add(tables: np.ndarray, words: pa.BinaryArray, kinds: np.ndarray, counts: np.ndarray, code: Code) -> None:
    for at in range(0, len(words), PRICED):
        part = words.slice(at, PRICED)
        slots, branch, _, first = decisions(part, kinds[at : at + PRICED], code)
        times = np.repeat(counts[at : at + len(part)], np.diff(np.append(first, len(branch)))).astype(tables.dtype)
        for s in slots:
            np.add.at(tables, s * 2 + branch, times)


def _count(vocabulary: DataFrame, ends: np.ndarray, code: Code) -> np.ndarray:
    """Predictor counts of all words to learn from, and of the ends of each group; tables are summed piece by piece."""
    pieces = 1 << 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        for batch in batches:
            for words, pairs, learnt in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                pairs, counts = np.frombuffer(_expand(pairs), np.int64), np.frombuffer(_expand(learnt), np.int64)
                pairs, counts = pairs[counts > 0], counts[counts > 0]
                if tables is None:
                    tables = np.zeros(2 * SLOTS, np.uint32)
                _add(tables, words.values.take(pa.array(pairs // GROUPS)), pairs % GROUPS, counts, code)
        if tables is not None:
            cut = tables.reshape(pieces, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int32()), pa.array([_press(c.tobytes()) for c in cut], pa.binary())], ["piece", "counts"])
            del tables, cut
            release()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                value = np.frombuffer(_expand(counts), np.uint32).astype(np.int64)
                sums[piece] = sums[piece] + value if piece in sums else value
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([_press(v.tobytes()) for v in sums.values()], pa.binary())], ["piece", "counts"])

    shape = "piece int, counts binary"
    made = vocabulary.select("words", "pairs", "learnt").mapInArrow(run, shape)
    out = np.zeros((pieces, 2 * SLOTS // pieces), np.int64)
    # A fixed number of pieces of fixed size comes to the driver, whatever the corpus.
    for row in made.repartition("piece").mapInArrow(add, shape).toLocalIterator():
        out[row["piece"]] = np.frombuffer(_expand(bytes(row["counts"])), np.int64)
    out = out.reshape(-1)
    _add(out, pa.array([b""] * GROUPS, pa.binary()), np.arange(GROUPS), ends, code)
    return out.reshape(SLOTS, 2)


def _tune(vocabulary: DataFrame, ends: np.ndarray, code: Code, counts: np.ndarray) -> Mixer:
    """The mixer learnt from all tokens to learn from: a slice's online, in one pass, the slices' added up."""
    shared = vocabulary.sparkSession.sparkContext.broadcast((code, counts.astype(np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(sum(Learner.SIZES), np.int64)
        for batch in batches:
            for words, pairs, learnt in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                pairs, times = np.frombuffer(_expand(pairs), np.int64), np.frombuffer(_expand(learnt), np.int64)
                pairs, times = pairs[times > 0], times[times > 0]
                learner = Learner()
                learner.learn(words.values.take(pa.array(pairs // GROUPS)), pairs % GROUPS, times, *shared.value)
                out += learner.sums()
            release()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(out)), pa.int32()), pa.array(out)], ["at", "n"])

    own = Learner()
    there = np.flatnonzero(ends)
    own.learn(pa.array([b""] * len(there), pa.binary()), there, ends[there], *shared.value)
    sums = own.sums()
    # A fixed number of sums, whatever the corpus.
    for at, n in vocabulary.select("words", "pairs", "learnt").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n")).collect():
        sums[at] += n
    shared.unpersist()
    return Learner.mixed(sums)


def score(docs: DataFrame) -> DataFrame:
    """Base and mixed log10 probabilities of every row of ``docs``; rows of fold 2 of 7 are not learnt from."""
    # Rows are blocks and slices of megabytes, which Spark would send by the dozen. The result is a few numbers a text.
    with small_batches(docs.sparkSession):
        return materialize(_scored(docs))


def _scored(docs: DataFrame) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    known_groups = _grouped(docs)
    parts = materialize(blocks(docs, known_groups))
    distinct = parts.agg(F.coalesce(F.sum(F.col("n_words").cast("long")), F.lit(0))).first()[0]
    slices = max(8, -(-distinct // SLICE_WORDS))
    for _ in range(GROUP_ROUNDS):
        known_groups, _ = _regrouped(parts, known_groups)
    ends = _regrouped(parts, known_groups)[1]
    vocabulary = materialize(_vocabulary(parts, slices, known_groups=known_groups))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.frombuffer(_expand(x), np.int64) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int((c > 0).sum()) for c in counts], pa.int64()), pa.array([int(c.sum()) for c in counts], pa.int64())], ["known", "tokens"])

    known, tokens = vocabulary.select("trained").mapInArrow(weigh, "known long, tokens long").agg(F.coalesce(F.sum("known"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    n_ends = int(ends.sum())
    n_all, v_all = tokens + n_ends, known + (n_ends > 0)
    code = Code.of(_histogram(vocabulary, n_ends))
    counts = _count(vocabulary, ends, code)
    mixer, tables = _tune(vocabulary, ends, code, counts), Tables.of(counts)
    del counts
    stop = price(pa.array([b""] * GROUPS, pa.binary()), np.arange(GROUPS), code, tables, mixer)
    shared = spark.sparkContext.broadcast((code, tables, mixer))
    unknown, prior = np.log10(n_all + v_all + 1), known_groups[1]

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                piece, words, pairs, trained, blocks, places = [batch.column(k)[i] for k in range(6)]
                pairs, trained = np.frombuffer(_expand(pairs.as_py()), np.int64), np.frombuffer(_expand(trained.as_py()), np.int64)
                logs = price(words.values.take(pa.array(pairs // GROUPS)), pairs % GROUPS, *shared.value).astype(np.float32)
                counts = trained[pairs // GROUPS]
                where = [np.frombuffer(_expand(p), np.int32) for p in places.as_py()]
                yield pa.RecordBatch.from_arrays(
                    [blocks.values, pa.array([piece.as_py()] * len(where), pa.int32()), pa.array([logs[w].tobytes() for w in where], pa.binary()), pa.array([_press(counts[w].tobytes()) for w in where], pa.binary())],
                    ["block", "slice", "logs", "counts"],
                )
            release()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, folds, features, sizes, width, tokens, n_words, told in zip(*[batch.column(i) for i in range(8)], strict=True):
                groups = _fit(*_read(tokens, sizes, features), known_groups).argmax(0).astype(np.int32)
                n_words, told = n_words.as_py(), sorted(told.as_py(), key=lambda t: t["slice"])
                pairs, texts = _pairs(tokens, sizes, groups, n_words)
                there = np.zeros((n_words + 1) * GROUPS, bool)
                there[pairs] = True
                there[n_words * GROUPS :] = True
                place = np.cumsum(there, dtype=np.int32) - 1
                logs = np.concatenate([np.frombuffer(t["logs"], np.float32) for t in told] + [stop])
                count = np.concatenate([np.frombuffer(_expand(t["counts"]), np.int64) for t in told] + [np.full(GROUPS, n_ends, np.int64)])
                place = place[pairs]
                sizes = np.asarray(sizes.values).astype(np.int64)
                n = len(sizes)
                add = lambda x: np.bincount(texts, weights=x, minlength=n)  # noqa: B023, E731
                n_tokens = sizes + 1
                base = add(np.log10(count + 1.0)[place]) - n_tokens * unknown
                known = add((count > 0)[place]).astype(np.int64)
                mixed = add(cached(place, texts, logs)) + prior[groups] / np.log(10)
                size = np.asarray(width.values).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array([f == 2 for f in folds.as_py()], pa.bool_()), pa.array(n_tokens), pa.array(known), pa.array(np.full(n, n_all, np.int64)), pa.array(base), pa.array(mixed), pa.array(-mixed * np.log2(10) / np.maximum(size + 1, 1))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
                )
            release()

    sent = vocabulary.select("slice", "words", "pairs", "trained", "blocks", "places").mapInArrow(tell, "block long, slice int, logs binary, counts binary")
    back = sent.groupBy("block").agg(F.collect_list(F.struct("slice", "logs", "counts")).alias("told"))
    joined = parts.drop("words", "turns").join(back, "block", "left")
    nothing = F.array().cast("array<struct<slice:int,logs:binary,counts:binary>>")
    return joined.select("ids", "folds", "features", "n_tokens", "bytes", "tokens", "n_words", F.coalesce("told", nothing).alias("told")).mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    )
