"""SimHash near-duplicates by pivot distance tables.

A document's fingerprint has 64 bits, each set if it is set in over half the XXH64 hashes of its word
shingles. The distance table holds, for every distinct fingerprint, its Hamming distances to many reference fingerprints, each
compared on one segment of the bits. The 64 bits are four segments; if two fingerprints differ in at most two
bits, at least two segments agree and with them all distances to those segments' references: these are the
join keys. A key that more than ``most`` fingerprints share goes through the same step again: its two open
segments are cut into four, whose references tell its members apart further, down to segments of two bits,
where a key has sixteen members at most. Pairs that meet in a key are discarded if any coordinate differs by
more than the radius, and the survivors are verified bit by bit. All links are verified pairs, none is missed, and
no key ever emits more than ``most`` pairs a member.

Defined cases: null and empty texts have the fingerprint zero and are linked like any other; fewer words than
a shingle are one shingle; repeated rows share a component; a null doc_id never is a component's name unless
all its rows have null; empty tables give empty results; further columns do not matter, whatever their names.

The pipeline's stage (``dedup_stage``) asks for shingle sets of Jaccard similarity 0.8 or more. At that similarity
fingerprints differ in some ten bits, which no key on bits finds surely. So the stage takes the links of the distance
table first, each verified by the sets, and then joins the sets that these leave apart, by
prefixes: under any one order of all shingles, two such sets share one of their first n - ceil(0.8 n) + 1 shingles.
Rare ones come first in the order. Pairs that meet are verified by their exact sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import materialize, pack, release, small, small_batches, tie_break

SEGMENTS, SEGMENT_BITS, REFERENCES = 4, 16, 8
RADIUS = 2
#: Members from which a key is cut by finer references; a setting of speed, links do not depend on it.
MOST = 64
#: Shingles that several texts of one in SAMPLE hold come last in the order of the prefixes; at most COMMON of them.
SAMPLE, COMMON = 8, 200_000
#: Turns of comparing a crowded shingle's sets to one of them, before pairs that are still apart are compared. A turn that
#: leaves more than WORTH of the last one's pairs apart is the last, too. Settings of speed, links do not depend on them.
TURNS, WORTH = 8, 0.9
#: Rounds of leaving out prefix rows that no similar set can share. A setting of speed, links do not depend on it.
ROUNDS = 3
#: Text hashes up to which those of candidates are broadcast.
SMALL = 500_000


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 with seed 42 of every word shingle of ``text``, repeats included."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    line, h = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([h(line, 42)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-words] + 1)).tolist()
    return np.fromiter((h(line[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)), np.uint64, len(starts))


def simhash(hashes: np.ndarray) -> int:
    """64-bit majority of ``hashes``; a tie leaves the bit at zero."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, text_hash and the fingerprint (signed long) of the whole text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [simhash(shingle_hashes((t.as_py() or "").encode(), words)) for t in batch.column(1)]
            found = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), found], ["doc_id", "text_hash", "fp"])
            pa.default_memory_pool().release_unused()

    marked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("text_hash"))
    return marked.mapInArrow(run, "doc_id long, text_hash long, fp long")


def references(width: int, seed: int = 20_240_501) -> list[int]:
    """Reference values of a segment of ``width`` bits: random ones for the widest, else the single bits and zero, which tell all values apart."""
    if width == SEGMENT_BITS:
        return [int(x) for x in np.random.default_rng(seed).choice(1 << width, REFERENCES, replace=False)]
    return [0, *[1 << i for i in range(width - 1)]]


def coordinates(width: int, at: Column | str, fp: str = "fp") -> Column:
    """Distances of the segment of ``width`` bits at bit ``at`` to its references, a byte each in one long."""
    bits = F.call_function("shiftrightunsigned", F.col(fp), F.col(at) if isinstance(at, str) else at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
    out = F.lit(0).cast("long")
    for k, value in enumerate(references(width)):
        out = out.bitwiseOR(F.shiftleft(F.bit_count(bits.bitwiseXOR(F.lit(value).cast("long"))).cast("long"), 8 * k))
    return out


def distance_table(distinct: DataFrame) -> DataFrame:
    """fp and its coordinates: the distances to the eight references of each segment, packed in the longs q0 to q3."""
    return distinct.select("fp", *[coordinates(SEGMENT_BITS, F.lit(q * SEGMENT_BITS)).alias(f"q{q}") for q in range(SEGMENTS)])


_COORDINATES = [f"q{q}" for q in range(SEGMENTS)]
_PLACES = ["f1", "f2", "o1", "o2"]


def _keys(table: DataFrame) -> DataFrame:
    """Six rows a fingerprint: the key of each two segments; f1, f2 are where these begin, o1, o2 the open ones."""
    rows = []
    for a in range(SEGMENTS):
        for b in range(a + 1, SEGMENTS):
            open_ = [q * SEGMENT_BITS for q in range(SEGMENTS) if q not in (a, b)]
            places = [F.lit(x).alias(n) for x, n in zip((a * SEGMENT_BITS, b * SEGMENT_BITS, *open_), _PLACES, strict=True)]
            rows.append(F.struct(F.xxhash64(F.lit(a), F.lit(b), F.col(f"q{a}"), F.col(f"q{b}")).alias("key"), *places))
    return table.select("fp", *_COORDINATES, F.explode(F.array(*rows)).alias("x")).select("fp", *_COORDINATES, "x.*")


def _finer(crowded: DataFrame, width: int) -> DataFrame:
    """Keys of the crowded rows by segments of ``width`` bits: the open ones in fours, two of which agree, and the settled ones read again."""
    settled = [coordinates(width, F.col(f) + d) for f in ("f1", "f2") for d in (0, width)]
    parts = [F.col(o) + d for o in ("o1", "o2") for d in (0, width)]
    rows = []
    for a in range(SEGMENTS):
        for b in range(a + 1, SEGMENTS):
            open_ = [p for q, p in enumerate(parts) if q not in (a, b)]
            key = F.xxhash64("key", F.lit(a), F.lit(b), "known", coordinates(width, parts[a]), coordinates(width, parts[b]))
            rows.append(F.struct(key.alias("key"), *[x.alias(n) for x, n in zip((parts[a], parts[b], *open_), _PLACES, strict=True)]))
    known = crowded.withColumn("known", F.xxhash64(*settled))
    return known.select("fp", *_COORDINATES, F.explode(F.array(*rows)).alias("x")).select("fp", *_COORDINATES, "x.*")


def _within(radius: int) -> Column:
    """No coordinate of the two table rows a and b differs by more than ``radius``."""
    apart = []
    for q in _COORDINATES:
        for k in range(REFERENCES):
            coordinate = lambda side: F.shiftrightunsigned(F.col(f"{side}{q}"), 8 * k).bitwiseAND(F.lit(255))  # noqa: B023, E731
            apart.append(F.abs(coordinate("a_") - coordinate("b_")))
    return F.greatest(*apart) <= F.lit(radius)


def _met(keys: DataFrame, radius: int) -> DataFrame:
    """The verified pairs (src, dst) of the rows that share a key."""
    side = lambda s: keys.select("key", *[F.col(c).alias(f"{s}_{c}") for c in ("fp", *_COORDINATES)])
    return (
        side("a").join(side("b"), "key")
        .where(F.col("a_fp") < F.col("b_fp")).where(_within(radius))
        .where(F.bit_count(F.col("a_fp").bitwiseXOR(F.col("b_fp"))) <= radius)
        .select(F.col("a_fp").alias("src"), F.col("b_fp").alias("dst"))
    )


def links(distinct: DataFrame, radius: int = RADIUS, most: int = MOST) -> DataFrame:
    """All pairs (src, dst) of the distinct fingerprints that differ in ``radius`` bits or fewer."""
    if not 0 <= radius <= 2:
        raise ValueError("two of four segments agree up to a radius of 2 only")
    keys, width, found = _keys(distance_table(distinct)), SEGMENT_BITS, []
    while True:
        sizes = materialize(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
        width //= 2
        last = width < 2
        few = keys.join(sizes if last else sizes.where(F.col("n") <= most), "key", "left_semi")
        found.append(materialize(_met(materialize(few), radius)))
        crowded = sizes.where(F.col("n") > most).select("key")
        if last or crowded.isEmpty():
            break
        # Keys of over ``most`` rows each: rows stay where they are if these are few enough to be sent to them.
        keys = materialize(_finer(keys.join(small(crowded), "key", "left_semi"), width))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) of all nodes of ``edges`` (src, dst).

    Alternates large-star and small-star steps, each written to the shared folder, until nothing changes.
    Each step hangs neighbours below the smallest one, so trees flatten in about log steps.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("src", "dst") if not large else e.select("src", "dst").unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        near = both if large else both.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        least = near.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        joined = near.join(least, "src")
        if large:
            out = joined.where("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        else:
            out = joined.where("dst <> m").select(F.col("dst").alias("src"), F.col("m").alias("dst")).unionByName(least.select("src", F.col("m").alias("dst")))
        return out.where("src <> dst").distinct()

    # Edges point from the larger to the smaller node throughout.
    now = materialize(edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src <> dst").distinct())
    state = now.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
    while state[0]:
        now = materialize(star(star(now, large=True), large=False))
        new = now.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    member = now.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return member.unionByName(now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = RADIUS, most: int = MOST) -> DataFrame:
    """doc_id, fp (long) and component_id, the smallest doc_id reachable over links of ``radius`` bits or fewer."""
    marked = materialize(fingerprints(docs, words))
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    group = components(links(distinct.select("fp"), radius, most)).withColumnsRenamed({"node": "fp"})
    named = distinct.join(group, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(ids, "component").select("fp", "component", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id", "component", "text_hash")


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def shingle_set(text: bytes, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def _common(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many texts hold, ascending, and their counts. They only set an order: any list gives the same pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                found = shingle_set((text.as_py() or "").encode(), words)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["gram"])

    part = docs.select("text").where(F.pmod(F.xxhash64(F.lit(7), F.col("text")), F.lit(SAMPLE)) == 0).distinct()
    counts = part.mapInArrow(run, "gram long").groupBy("gram").agg(F.count("*").alias("n")).where("n > 4")
    # COMMON rows of two longs at most.
    found = counts.orderBy(F.desc("n"), "gram").limit(COMMON).toArrow()
    grams, n = np.asarray(found["gram"]).view(np.uint64), np.asarray(found["n"])
    order = np.argsort(grams)
    return grams[order], n[order]


def _prefix(grams: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles of a set, rare before common: two sets of similarity 0.8 or more share one of theirs."""
    n, (known, counts) = len(grams), common
    if n and len(known):
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        grams = grams[np.lexsort((grams, np.where(known[at] == grams, counts[at], 0)))]
    return grams[: n - (4 * n + 4) // 5 + 1] if n else grams


def _set_id(grams: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(grams.tobytes(), 42)


def shingle_prefixes(docs: DataFrame, words: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, text_hash, the shingle set's name and size, its prefix and the fingerprint of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, prefixes, prints = [], [], [], []
            for text in batch.column(1):
                hashes = shingle_hashes((text.as_py() or "").encode(), words)
                grams = np.unique(hashes)
                prints.append(simhash(hashes))
                names.append(_set_id(grams))
                sizes.append(len(grams))
                prefixes.append(_prefix(grams, common).view(np.int64))
            ends = np.cumsum([0] + [len(p) for p in prefixes])
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.array(names, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), lists, pa.array(np.array(prints, np.uint64).view(np.int64))],
                ["doc_id", "text_hash", "set", "n", "prefix", "fp"],
            )
            release()

    marked = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    return marked.mapInArrow(run, "doc_id long, text_hash long, set long, n long, prefix array<long>, fp long")


def _enough(a: str, b: str) -> Column:
    """What a shared shingle's places, and the shared ones before it, leave: too small an overlap for similarity 0.8 if false."""
    before = F.least(F.col(f"{a}before"), F.col(f"{b}before"))
    after = F.least(F.col(f"{a}n") - F.col(f"{a}at"), F.col(f"{b}n") - F.col(f"{b}at"))
    return (before + after) * 9 >= (F.col(f"{a}n") + F.col(f"{b}n")) * 4


def _prospects(index: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Rows of ``index`` (set, n, at, gram: the prefixes) at which a similar set may be met, with holders, the sets
    met there, and before, how many of the set's earlier shingles a similar set may have.

    If two sets meet in a shingle, both have all their earlier ones in their prefixes, so an earlier one that no other
    prefix holds is in one of them only. A row that leaves too small an overlap even for the smallest holder of its
    shingle goes: no similar set is met there. So a shingle that then has one row is shared by no similar sets either,
    and each round finds more.
    """
    rows, place = index, Window.partitionBy("set").orderBy("at")
    for turn in range(rounds + 1):
        shared = rows.groupBy("gram").agg(F.count("*").alias("holders"), F.min("n").alias("least_n")).where("holders > 1")
        met = rows.select("set", "n", "at", "gram").join(shared, "gram").withColumn("before", F.row_number().over(place) - 1)
        if turn == rounds:
            return materialize(met.drop("least_n"))
        rows = materialize(met.where("(before + n - at) * 9 >= (n + least_n) * 4"))


def _candidates(rows: DataFrame) -> DataFrame:
    """src and dst of the pairs (a_set, b_set, a_n, b_n; a row a shared shingle) that may be similar.

    Of the two prefixes the one that ends first in the order has all shingles up to its end in the other one, so
    the overlap is at most the prefixes' own and the longer rest. ``told``: whether the row's shingle counts;
    ``untold``: how many more the prefixes may share.
    """
    rest = lambda n: F.floor((F.col(n) * 4 + 4) / 5) - 1
    most = F.greatest(rest("a_n"), rest("b_n")) + F.col("untold")
    ends = [F.least("a_set", "b_set").alias("src"), F.greatest("a_set", "b_set").alias("dst")]
    counted = rows.select(*ends, "told", most.alias("most"), ((F.col("a_n") + F.col("b_n")) * 4).alias("need"))
    counted = counted.groupBy("src", "dst").agg(F.sum("told").alias("told"), F.min("most").alias("most"), F.min("need").alias("need"))
    return counted.where((F.col("told") + F.col("most")) * 9 >= F.col("need")).select("src", "dst")


def similar(pairs: DataFrame, docs: DataFrame, marked: DataFrame, words: int) -> DataFrame:
    """Those of ``pairs`` (src, dst: names of shingle sets) whose sets have Jaccard similarity 0.8 or more."""
    pairs = materialize(pairs)
    asked = pairs.select(F.col("src").alias("set")).unionByName(pairs.select(F.col("dst").alias("set"))).distinct()
    texts = marked.select("set", "text_hash").join(asked, "set").groupBy("set").agg(F.min("text_hash").alias("text_hash")).select("text_hash")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set((t.as_py() or "").encode(), words) for t in batch.column(0)]
            names = pa.array(np.array([_set_id(g) for g in sets], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([names, pa.array([g.tobytes() for g in sets], pa.binary())], ["set", "grams"])
            release()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(9 * both >= 4 * (len(a) + len(b)))
            yield batch.select(["src", "dst"]).filter(pa.array(good, pa.bool_()))
            release()

    chosen = docs.select("text", F.xxhash64("text").alias("text_hash")).join(small(texts, SMALL), "text_hash", "left_semi").select("text")
    sets = materialize(chosen.mapInArrow(spell, "set long, grams binary").dropDuplicates(["set"]))
    side = lambda s, name: sets.select(F.col("set").alias(s), F.col("grams").alias(name))
    met = pairs.join(side("src", "a"), "src").join(side("dst", "b"), "dst").select("src", "dst", "a", "b")
    return materialize(met.mapInArrow(verify, "src long, dst long"))


def linked_sets(marked: DataFrame, most: int = MOST) -> DataFrame:
    """src and dst: names of shingle sets whose fingerprints are equal (beside the first set of each) or linked by the distance table (first sets)."""
    there = marked.where("n > 0").select("set", "fp").distinct()
    first = materialize(there.groupBy("fp").agg(F.min("set").alias("first")))
    same = there.join(first, "fp").select(F.col("first").alias("src"), F.col("set").alias("dst"))
    side = lambda end: first.select(F.col("fp").alias(end), F.col("first").alias(f"{end}_set"))
    near = links(first.select("fp"), most=most).join(side("src"), "src").join(side("dst"), "dst").select(F.least("src_set", "dst_set").alias("src"), F.greatest("src_set", "dst_set").alias("dst"))
    return same.unionByName(near).where("src <> dst").distinct()


def _stars(holders: DataFrame, turn: int) -> DataFrame:
    """Each holder of a shingle (gram, set, n, at, before, crowd, component) beside one of them; holders of its component are left out.

    In turn 0 that is one with the fewest earlier shingles of its own, such as the original of many edited copies, later one drawn by hash.
    """
    own = F.col("at") - F.col("before") if turn == 0 else F.lit(0)
    drawn = F.struct(own, F.xxhash64("gram", "set", F.lit(turn)), *[F.col(c) for c in ("set", "n", "at", "before", "crowd", "component")])
    first = holders.groupBy("gram").agg(F.min(drawn).alias("x")).select("gram", *[F.col(f"x.{c}").alias(f"a_{c}") for c in ("set", "n", "at", "before", "crowd", "component")])
    led = holders.select("gram", *[F.col(c).alias(f"b_{c}") for c in ("set", "n", "at", "before", "crowd", "component")]).join(first, "gram")
    met = led.where((F.col("a_component") != F.col("b_component")) & _enough("a_", "b_"))
    return met.withColumns({"told": F.lit(0), "untold": F.least("a_crowd", "b_crowd")})


def similar_groups(docs: DataFrame, words: int = 3, most: int = MOST, turns: int = TURNS) -> DataFrame:
    """doc_id, component, component_id (its smallest doc_id) and text_hash over links of Jaccard similarity 0.8 or more.

    Sets whose fingerprints the distance table links are compared first; what these links join is left out of all that follows.
    Places of a prefix where no similar set can be met are left out. Of a shingle that more than ``most`` of the rest share,
    all its sets are compared to one of them, in each turn to another one, until the pairs of sets that share such a shingle and are not in one component
    yet are ``most`` a set or fewer, a turn has joined few of them, or ``turns`` are over. Then these pairs are compared,
    so that no link is missed.
    """
    marked = materialize(shingle_prefixes(docs, words, _common(docs, words)))
    tied = lambda m: m.select(F.col("node").alias("src"), F.col("component").alias("dst")).where("src <> dst")
    member = materialize(components(similar(linked_sets(marked, most), docs, marked, words)))
    one = marked.select("set", "n", "prefix").dropDuplicates(["set"])
    index = materialize(one.select("set", "n", F.posexplode("prefix").alias("at", "gram")))
    sharing = _prospects(index)
    crowds = sharing.where(F.col("holders") > most).groupBy("set").agg(F.count("*").alias("crowd"))
    group = member.withColumnsRenamed({"node": "set"})
    met = materialize(
        sharing.join(crowds, "set", "left").join(group, "set", "left").withColumns({"crowd": F.coalesce("crowd", F.lit(0)), "component": F.coalesce("component", "set")})
    )
    side = lambda df, s: df.select("gram", *[F.col(c).alias(f"{s}_{c}") for c in df.columns if c != "gram"])
    few = met.where(F.col("holders") <= most).select("gram", "set", "n", "at", "before", "crowd", "component")
    pairs = side(few, "a").join(side(few, "b"), "gram").where("a_set < b_set and a_component <> b_component").where(_enough("a_", "b_"))
    pairs = pairs.withColumns({"told": F.lit(1), "untold": F.least("a_crowd", "b_crowd")})
    many = met.where(F.col("holders") > most).select("gram", "set", "n", "at", "before", "crowd", "component")
    given = ["a_set", "b_set", "a_n", "b_n", "told", "untold"]
    new = similar(_candidates(pairs.select(given).unionByName(_stars(many, 0).select(given))), docs, marked, words)
    member = materialize(components(tied(member).unionByName(new)))
    many = many.drop("component")
    before = float("inf")
    for turn in range(1, turns + 1):
        named = many.join(member.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
        parts = named.groupBy("gram", "component").agg(F.count("*").cast("double").alias("n_sets"))
        open_ = parts.groupBy("gram").agg(F.sum("n_sets").alias("all"), F.sum(F.col("n_sets") * F.col("n_sets")).alias("within")).where("all * all > within")
        named = materialize(named.join(open_.select("gram"), "gram", "left_semi"))
        left, sets = open_.agg(F.coalesce(F.sum((F.col("all") * F.col("all") - F.col("within")) / 2), F.lit(0.0)), F.coalesce(F.sum("all"), F.lit(0.0))).first()
        if not left:
            break
        last = left <= most * sets or left > WORTH * before or turn == turns
        before = left
        if last:
            rest = side(named, "a").join(side(named, "b"), "gram").where("a_set < b_set and a_component <> b_component").where(_enough("a_", "b_"))
            # Pairs that also share an uncrowded shingle were candidates above, so all they share is told here.
            found = rest.withColumns({"told": F.lit(1), "untold": F.lit(0)})
        else:
            found = _stars(named, turn)
        new = similar(_candidates(found.select(given)), docs, marked, words)
        member = materialize(components(tied(member).unionByName(new)))
        if last:
            break
    name = F.coalesce("component", "set")
    by_set = marked.select("doc_id", "text_hash", "set").join(member.withColumnRenamed("node", "set"), "set", "left").withColumn("component", name)
    ids = by_set.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return by_set.join(ids, "component").select("doc_id", "component", "component_id", "text_hash")


def dedup_stage(docs: DataFrame, **how) -> DataFrame:
    """One document of each group of similar ``docs`` stays, all columns kept: the one whose doc_id names the component.

    A row without doc_id stays only if no row of its group has one. Rows of one group with equal doc_id are
    told apart by the text's hash, then by their other columns; of fully alike ones one stays.
    """
    name = lambda c: F.coalesce(F.col(c).cast("long").cast("string"), F.lit("-"))
    with small_batches(docs.sparkSession):
        groups = similar_groups(docs, **how)
    kept = (
        groups
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component")
        .agg(F.min(F.struct(name("doc_id").alias("id"), F.col("text_hash").alias("hash"))).alias("kept"))
        .select("kept.*")
    )
    keyed = pack(docs).select(name("whole.doc_id").alias("id"), F.xxhash64("whole.text").alias("hash"), "whole")
    first = keyed.join(kept, ["id", "hash"]).withColumn("tie", tie_break(docs))
    return first.groupBy("id", "hash").agg(F.min_by("whole", "tie").alias("whole")).select("whole.*")
