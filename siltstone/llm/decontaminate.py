"""Benchmark decontamination over a distributed positional inverted index, in DataFrame functions only.

The index holds a posting (row, position, term) for every training token whose term some test item uses, and
one end posting a row with its length. A window of ten item words is looked up by its rarest term: the term's
postings, moved by its offset, name the places where the window may start, and the postings of the other
offsets around are intersected with them. Runs of enough consecutive offsets are exact phrase matches;
``proximity`` finds an item's rarest terms within a stretch of words in any order.

Defined cases: null texts have no words and match nothing; an item shorter than a window is one window; items
are told apart by item_id, repeated rows of an item count once, a null item_id is written as an empty string;
repeated document rows are matched separately; empty tables match nothing; further columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import ascii_lower, materialize, pack, ranked, small

TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: A term that no text can have, posted once at each row's end.
END, END_ID = "\x00", -1
#: Vocabulary entries and candidate rows (a long each) that may be broadcast, about 30 MB; beyond, Spark shuffles.
VOCABULARY_ROWS, CANDIDATE_ROWS = 250_000, 500_000


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), 0)


def item_terms(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The items' terms (item, item_id, n, offset, term) and vocabulary (term, id)."""
    numbered = ranked(items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), tokens(F.col("text")).alias("terms")).distinct(),
                      "item_id", "terms", name="item")
    each = materialize(numbered.select("item", "item_id", F.size("terms").alias("n"), F.posexplode("terms").alias("offset", "term")))
    return each, ranked(each.select("term").distinct(), "term", name="id").select("term", F.col("id").cast("int"))


def build_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Postings (row, at, id) of the vocabulary's terms; a row's end posting also has doc_id and text_hash."""
    end = docs.sparkSession.createDataFrame([(END, END_ID)], "term string, id int")
    # Rows are numbered below the explode: numbered beside it, each posting would be a row.
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    posted = rows.select(
        "row", "doc_id", F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.concat(tokens(F.col("text")), F.array(F.lit(END)))).alias("at", "term"),
    )
    is_end = F.col("id") == END_ID
    return materialize(
        posted.join(small(vocabulary.unionByName(end), VOCABULARY_ROWS), "term").select(
            "row", "at", "id", F.when(is_end, F.col("doc_id")).alias("doc_id"), F.when(is_end, F.col("text_hash")).alias("text_hash")
        )
    )


def _with_counts(each: DataFrame, vocabulary: DataFrame, index: DataFrame) -> DataFrame:
    """Item terms with their ids and numbers of postings (null: none)."""
    counts = index.where(F.col("id") >= 0).groupBy("id").agg(F.count("*").alias("postings"))
    return materialize(each.join(vocabulary, "term").join(counts, "id", "left"))


def phrase_matches(index: DataFrame, terms: DataFrame, window: int = WINDOW) -> DataFrame:
    """Maximal runs (row, item_id, from_at, to_at, from_offset) of ``window`` or more item words in a row."""
    members = terms.groupBy("item", "item_id", "n").agg(F.array_sort(F.collect_list(F.struct("offset", "id", "postings"))).alias("members"))
    starts = F.sequence(F.lit(0), F.greatest(F.col("n") - window, F.lit(0)))
    rarest = lambda part: F.array_min(F.transform(part, lambda x: F.struct(F.coalesce(x["postings"], F.lit(0)).alias("postings"), x["offset"].alias("offset"), x["id"].alias("id"))))
    anchors = (
        members.select("item", "n", "members", F.explode(starts).alias("start"))
        .select("item", "n", rarest(F.slice("members", F.col("start") + 1, F.least(F.col("n"), F.lit(window)))).alias("rarest"))
        .where("rarest.postings > 0")
        .select("item", "n", "rarest.id", "rarest.offset")
        .distinct()
    )
    # The rarest lists, moved by their offsets: where an item would have to begin in the row.
    found = (
        index.join(small(materialize(anchors)), "id")
        .select("row", "item", "n", (F.col("at") - F.col("offset")).alias("origin"), "offset")
        .groupBy("row", "item", "n", "origin")
        .agg(F.collect_set("offset").alias("offsets"))
    )
    around = F.array_distinct(F.flatten(F.transform("offsets", lambda o: F.sequence(
        F.greatest(o - (window - 1), F.lit(0)), F.least(o + (window - 1), F.col("n") - 1)
    ))))
    wanted = materialize(found.select("row", "item", "n", "origin", around.alias("around")))
    rows = small(wanted.select("row").distinct(), CANDIDATE_ROWS)
    offsets = wanted.select("row", "item", "n", "origin", F.explode("around").alias("offset"))
    needed = offsets.join(small(terms.select("item", "item_id", "offset", "id"), VOCABULARY_ROWS), ["item", "offset"]).withColumn("at", F.col("origin") + F.col("offset"))
    there = index.where(F.col("id") >= 0).join(rows, "row", "left_semi").select("row", "at", "id")
    met = needed.join(there, ["row", "at", "id"]).select("row", "item", "item_id", "n", "origin", "offset")
    place = Window.partitionBy("row", "item", "origin").orderBy("offset")
    runs = met.withColumn("run", F.col("offset") - F.row_number().over(place))
    return (
        runs.groupBy("row", "item", "item_id", "n", "origin", "run")
        .agg(F.min("offset").alias("from_offset"), F.max("offset").alias("to_offset"))
        .where(F.col("to_offset") - F.col("from_offset") + 1 >= F.least(F.col("n"), F.lit(window)))
        .select("row", "item_id", (F.col("origin") + F.col("from_offset")).alias("from_at"), (F.col("origin") + F.col("to_offset")).alias("to_at"), "from_offset")
    )


def proximity_matches(index: DataFrame, terms: DataFrame, within: int = 20, rarest: int = 3) -> DataFrame:
    """Rows and items (row, item_id, at) where the item's rarest terms all lie at most ``within`` words from its rarest one."""
    by_rarity = Window.partitionBy("item").orderBy(F.coalesce("postings", F.lit(0)), "id")
    distinct = terms.select("item", "item_id", "id", "postings").distinct()
    chosen = small(materialize(distinct.withColumn("place", F.row_number().over(by_rarity)).where(F.col("place") <= rarest)))
    listed = index.join(chosen, "id").select("row", "item", "item_id", "id", "place", "at")
    stretch = F.floor(F.col("at") / within)
    first = listed.where("place = 1").select("row", "item", "item_id", F.col("at").alias("first_at"), F.explode(F.sequence(stretch - 1, stretch + 1)).alias("stretch"))
    others = listed.where("place > 1").select("row", "item", "id", F.col("at").alias("other_at"), stretch.alias("stretch"))
    near = first.join(others, ["row", "item", "stretch"], "left").where(F.col("other_at").isNull() | (F.abs(F.col("other_at") - F.col("first_at")) <= within))
    wanted = chosen.groupBy("item").agg(F.count("*").alias("wanted"))
    return (
        near.groupBy("row", "item", "item_id", "first_at").agg(F.count_distinct("id").alias("near"))
        .join(wanted, "item").where(F.col("near") >= F.col("wanted") - 1)
        .select("row", "item_id", F.col("first_at").alias("at"))
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words, hit words and items of every row of ``docs``; its text_hash tells rows of one doc_id apart."""
    each, vocabulary = item_terms(items)
    index = build_index(docs, vocabulary)
    hits = materialize(phrase_matches(index, _with_counts(each, vocabulary, index), window))
    words = hits.select("row", F.explode(F.sequence("from_at", "to_at")).alias("at")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    ids = hits.select("row", "item_id").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("ids"))
    rows = index.where(F.col("id") == END_ID).select("row", "doc_id", "text_hash", F.col("at").cast("long").alias("n_words"))
    return rows.join(words.join(ids, "row"), "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(F.coalesce("ids", F.array().cast("array<string>"))).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("ids", F.array().cast("array<string>")), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "text_hash",
    )


def decontaminate_stage(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` without any exact window of an item, all columns kept; rows alike in doc_id and text share their fate."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    # Two longs for both names: what may be broadcast has a fixed width.
    keys = lambda id_, hash_: [F.xxhash64(F.lit(k), id_, hash_).alias(f"k{k}") for k in (1, 2)]
    hit = contamination(docs, items, window).where("contaminated").select(*keys(name, F.col("text_hash"))).distinct()
    keyed = pack(docs).select("whole", *keys(F.coalesce(F.col("whole.doc_id").cast("string"), F.lit("-")), F.xxhash64("whole.text")))
    return keyed.join(small(materialize(hit), CANDIDATE_ROWS), ["k1", "k2"], "left_anti").select("whole.*")
