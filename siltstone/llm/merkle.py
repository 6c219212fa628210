"""Document fingerprints: a Merkle tree over sections, paragraphs and clauses, in DataFrame functions only.

A text is cut, losing no character, into sections (at blank lines), paragraphs (at line ends) and clauses (at
white space after punctuation; very short paragraphs and very long clauses at every white space). A clause's node is
the SHA-256 of its text, every other node's that of its children's. Roots test equality.

A fingerprint is the root, a colon and the sections, with | between them; a section is its node, = and its paragraphs,
with / between them; a paragraph is its node, a point and the first eight hex digits of each clause's node. Root and
section nodes can be computed again from the fingerprint, paragraph nodes from their clauses. Two fingerprints are compared from
the root down: branches with equal nodes are set aside at the highest level at which they are equal, and only what
differs is opened, down to the clauses, which locates edits. Branches count wherever they stand, so an inserted
section does not make the ones behind it differ.

Defined cases: null text is the empty text, whose fingerprint has no sections; rows are ordered by doc_id, null
first, then by the text's hash; rows alike in both count as one document, and each gets its values; the
only document is its own next one; an empty table gives no rows; further columns do not matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import ranked

#: Zero-width cuts: after a blank line, after a line end, between punctuation and the white space behind it.
SECTION, PARAGRAPH, CLAUSE, WORDS = r"(?<=\n\n)(?!\n)", r"(?<=\n)", r"(?<=\p{Punct})(?=\s)", r"(?<=\S)(?=\s)"
LEAF = 8
#: Paragraphs up to, and clauses beyond these lengths are cut into words.
SHORT, LONG = 64, 160


def _cut(text: Column, pattern: str) -> Column:
    return F.filter(F.split(text, pattern), lambda x: x != "")


def _clauses(paragraph: Column) -> Column:
    fine = lambda c: (F.length(paragraph) <= SHORT) | (F.length(c) > LONG)
    return F.flatten(F.transform(_cut(paragraph, CLAUSE), lambda c: F.when(fine(c), _cut(c, WORDS)).otherwise(F.array(c))))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column without nulls."""
    sha, joined = (lambda x: F.sha2(x, 256)), (lambda xs: F.array_join(xs, ""))
    leaves = F.transform(
        _cut(text, SECTION), lambda s: F.transform(_cut(s, PARAGRAPH), lambda p: F.transform(_clauses(p), sha))
    )
    paragraphs = F.transform(leaves, lambda s: F.transform(s, lambda p: F.struct(
        sha(joined(p)).alias("node"), joined(F.transform(p, lambda x: F.substring(x, 1, LEAF))).alias("shown")
    )))
    sections = F.transform(paragraphs, lambda s: F.struct(
        sha(joined(F.transform(s, lambda p: p["node"]))).alias("node"),
        F.array_join(F.transform(s, lambda p: F.concat(p["node"], F.lit("."), p["shown"])), "/").alias("shown"),
    ))
    # One pass over the tree: the sections are bound once and read twice.
    root = F.transform(F.array(sections), lambda s: F.concat(
        sha(joined(F.transform(s, lambda x: x["node"]))), F.lit(":"), F.array_join(F.transform(s, lambda x: F.concat(x["node"], F.lit("="), x["shown"])), "|")
    ))
    return F.element_at(root, 1)


def _opened(branches: Column, behind: str, between: str) -> Column:
    """The children of all ``branches``, as the fingerprint writes them."""
    return F.flatten(F.transform(branches, lambda x: _cut(F.substring_index(x, behind, -1), between)))


def _sections(fp: Column) -> Column:
    return _cut(F.substring_index(fp, ":", -1), r"\|")


#: Cuts the leaves of a paragraph apart.
_LEAVES = rf"(?<=\G.{{{LEAF}}})"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def likeness(a: Column, b: Column) -> Column:
    """Share of the leaves of two fingerprints that both have, from the root down: 1 for equal roots, 0 if nothing is shared.

    Sets are met by hash at each level, so the time is in proportion to the fingerprints.
    """
    n_leaves = lambda paragraphs: F.aggregate(paragraphs, F.lit(0), lambda n, x: n + F.floor((F.length(x) - 65) / LEAF).cast("int"))

    def of_leaves(shared: Column, x: Column) -> Column:
        both = F.size(F.array_intersect(x["a"], x["b"]))
        total = 2 * shared + F.size(x["a"]) + F.size(x["b"])
        return F.when(total == 0, F.lit(1.0)).otherwise(F.lit(2.0) * (shared + both) / F.greatest(total, F.lit(1)))

    leaves_of = lambda paragraphs: F.array_distinct(_opened(paragraphs, ".", _LEAVES))

    def of_paragraphs(shared: Column, x: Column) -> Column:
        more = shared + n_leaves(F.array_intersect(x["a"], x["b"]))
        rest = F.struct(leaves_of(F.array_except(x["a"], x["b"])).alias("a"), leaves_of(F.array_except(x["b"], x["a"])).alias("b"), more.alias("shared"))
        return _bound(rest, lambda y: of_leaves(y["shared"], y))

    def of_sections(x: Column) -> Column:
        shared = n_leaves(_opened(F.array_intersect(x["a"], x["b"]), "=", "/"))
        rest = F.struct(
            _opened(F.array_except(x["a"], x["b"]), "=", "/").alias("a"), _opened(F.array_except(x["b"], x["a"]), "=", "/").alias("b"), shared.alias("shared")
        )
        return _bound(rest, lambda y: of_paragraphs(y["shared"], y))

    below = _bound(F.struct(_sections(a).alias("a"), _sections(b).alias("b")), of_sections)
    same = F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1)
    return F.when(same, F.lit(1.0)).otherwise(below)


def edited_clauses(a: Column, b: Column) -> Column:
    """Positions (section, paragraph, clause; from 1) of the leaves of fingerprint ``a`` in branches that ``b`` lacks."""
    theirs = F.struct(_sections(b).alias("sections"), _opened(_sections(b), "=", "/").alias("paragraphs"))

    def found(there: Column) -> Column:
        leaves = F.array_distinct(_opened(there["paragraphs"], ".", _LEAVES))
        rows = F.transform(_sections(a), lambda s, i: F.when(~F.array_contains(there["sections"], s), F.transform(
            _cut(F.substring_index(s, "=", -1), "/"), lambda p, j: F.when(~F.array_contains(there["paragraphs"], p), F.transform(
                _cut(F.substring_index(p, ".", -1), _LEAVES),
                lambda x, k: F.struct((i + 1).alias("section"), (j + 1).alias("paragraph"), (k + 1).alias("clause"), x.alias("leaf")),
            )),
        )))
        # Branches that are equal stay closed: they are null here.
        opened = F.flatten(F.filter(F.flatten(F.filter(rows, lambda s: s.isNotNull())), lambda p: p.isNotNull()))
        return _bound(leaves, lambda known: F.filter(opened, lambda x: ~F.array_contains(known, x["leaf"])))

    return _bound(theirs, found)


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text (second half replaced by the next document's start), and their likeness.

    Only ids, hashes and lengths are sorted globally. A document's start travels to the one before it, so
    texts are shuffled once, by key, and that exchange serves both sides.
    """
    key = ["__none", "__id", "__hash"]
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.cast("string").alias("text")).withColumns(
        {"__none": F.col("doc_id").isNotNull(), "__id": F.coalesce("doc_id", F.lit(0)).cast("long"), "__hash": F.xxhash64("text")}
    )
    order = ranked(keyed.groupBy(*key).agg(F.max(F.length("text")).alias("__chars")), *key, name="__rank")
    n = order.count()
    before = order.select(*[F.col(c).alias(f"{c}_before") for c in key], F.floor(F.col("__chars") / 2).cast("int").alias("__half"),
                          ((F.col("__rank") + 1) % F.lit(max(n, 1))).alias("__rank"))
    route = order.drop("__chars").join(before, "__rank").drop("__rank")
    starts = (
        keyed.join(route, key)
        .select(*[F.col(f"{c}_before").alias(c) for c in key], F.col("doc_id").alias("next_doc_id"),
                F.substring("text", F.lit(1), F.col("__half")).alias("__start"), fingerprint(F.col("text")).alias("__next"))
        .dropDuplicates(key)
    )
    chars = F.length("text")
    kept = F.substring("text", F.lit(1), chars - F.floor(chars / 2).cast("int"))
    edited = F.concat(kept, F.col("__start"))
    return (
        keyed.join(starts, key)
        .select("doc_id", "text", chars.cast("long").alias("n_chars"), edited.alias("edited"), "__next", "next_doc_id")
        .select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"), "__next", "next_doc_id")
        .select(
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.col("__next")).alias("near_next"), "next_doc_id",
        )
    )
