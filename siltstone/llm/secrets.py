"""Secret scans with multipart credential linking, in DataFrame functions only.

Base kinds are reported wherever they match. Weak parts - identifiers, mixed-case secrets and endpoints - are
reported only where complementary parts co-occur in a scope: a scope is a block of the text, which blank lines
end, and an interval join within it links each weak part to the parts of the other roles at most ``REACH`` code
points away. An identifier needs a secret, a secret an identifier, an endpoint both.

All patterns take time in proportion to the text: repeated groups are possessive, so that Java's engine neither
backtracks into them nor recurses for each repetition, and a run of name characters is tried from its start only.

Defined cases: null text is empty; repeated rows are scanned separately; a null doc_id is kept; an empty table
gives no rows; further columns do not matter, whatever their names. A part that reaches over a blank line lies in the
scope of its start. The interval join files a part under every stretch of ``REACH`` code points that it lies in, and
its complements under theirs and the neighbouring ones, so long parts cost in proportion to their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import materialize

#: Fixed patterns of the contract; in the first, group 2 is the value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Weak parts.
IDENTIFIER = r"""(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++|(?i:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?|key_?id)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9_.@+-]{3,}+"""
SECRET = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}+={0,2}"
ENDPOINT = r"""https?://[A-Za-z0-9.-]++(?::[0-9]++)?(?:/[^\x20\x09-\x0D"'<>]*+)?|(?i:host|endpoint|server)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9.-]{3,}+"""
#: The end of a scope: a line end and the blank lines behind it.
BLANK = r"\n[\x20\t\r]*+\n[\x20\t\r\n]*+"
#: kind, its order in the lists, role, base or weak, pattern.
KINDS = (
    ("assign", "secret", True, ASSIGN),
    ("access", "identifier", True, ACCESS),
    ("hex", "secret", True, HEX),
    ("identifier", "identifier", False, IDENTIFIER),
    ("secret", "secret", False, SECRET),
    ("endpoint", "endpoint", False, ENDPOINT),
)
REACH = 400


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Per match of ``pattern``: code points since the last match's end, its own length, whether it counts."""
    match = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    if kind == "assign":
        good = F.transform(F.regexp_extract_all(text, F.lit(pattern), 2), lambda x: F.length(x) >= 6)
    elif kind == "secret":
        good = F.transform(match, lambda x: x.rlike("[0-9]") & x.rlike("[a-z]") & x.rlike("[A-Z]"))
    else:
        good = F.transform(match, lambda x: F.lit(True))
    rows = F.arrays_zip(gaps.alias("gap"), F.transform(match, lambda x: F.length(x)).alias("long"), good.alias("good"))
    return F.when(text.rlike(pattern), rows)


def _near(weak: DataFrame, parts: DataFrame, role: str) -> DataFrame:
    """Those of ``weak`` that have a part of ``role`` in their scope, at most REACH code points away."""
    over = lambda a, b: F.explode(F.sequence(F.floor(a / REACH), F.floor(b / REACH))).alias("stretch")
    other = parts.where(F.col("role") == role).select(
        "row", "scope", over(F.col("start") - REACH, F.col("end") + REACH), F.col("start").alias("other_start"), F.col("end").alias("other_end")
    )
    # A long part lies in several stretches: each is looked up, and the part counts once.
    here = weak.select("*", over(F.col("start"), F.col("end")))
    apart = F.greatest("start", "other_start") - F.least("end", "other_end")
    return here.alias("w").join(
        other.alias("o"), (F.col("w.row") == F.col("o.row")) & (F.col("w.scope") == F.col("o.scope")) & (F.col("w.stretch") == F.col("o.stretch")) & (apart <= REACH), "left_semi"
    ).drop("stretch").distinct()


def parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows (row, doc_id), and all parts (row, kind, order, role, base, start, end, scope) found in their texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    first = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"), *[_found(text, kind, pattern).alias(kind) for kind, _, _, pattern in KINDS])
    # Scopes matter to weak parts only.
    weak = F.coalesce(*[kind for kind, _, base, _ in KINDS if not base]).isNotNull()
    scanned = materialize(first.withColumn("blank", F.when(weak, _found(F.col("text"), "blank", BLANK))).drop("text"))
    kinds = [*[(kind, role, base) for kind, role, base, _ in KINDS], ("blank", "blank", False)]
    lists = F.array(*[
        F.struct(F.lit(i).alias("order"), F.lit(kind).alias("kind"), F.lit(role).alias("role"), F.lit(base).alias("base"), F.col(kind).alias("found"))
        for i, (kind, role, base) in enumerate(kinds)
    ])
    each = (
        scanned.select("row", F.explode(F.filter(lists, lambda x: x["found"].isNotNull())).alias("x"))
        .select("row", "x.order", "x.kind", "x.role", "x.base", F.posexplode("x.found").alias("at", "m"))
        .where(F.col("m.long").isNotNull())
    )
    so_far = Window.partitionBy("row", "order").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.long")).over(so_far)
    found = each.withColumn("end", end).where("m.good").withColumn("start", F.col("end") - F.col("m.long"))
    # A scope's number is how many blank lines ended before the part began.
    line = F.when(F.col("role") == "blank", F.col("end")).otherwise(F.col("start"))
    past = Window.partitionBy("row").orderBy(line).rangeBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("scope", F.count_if(F.col("role") == "blank").over(past)).where("role <> 'blank'")
    return scanned.select("row", "doc_id"), found.select("row", "order", "kind", "role", "base", "start", "end", "scope")


def link(found: DataFrame) -> DataFrame:
    """The parts to report: all base ones, and weak ones whose complements are near."""
    weak = found.where("not base")
    identifiers = _near(weak.where("role = 'identifier'"), found, "secret")
    secrets = _near(weak.where("role = 'secret'"), found, "identifier")
    endpoints = _near(_near(weak.where("role = 'endpoint'"), found, "identifier"), found, "secret")
    return found.where("base").unionByName(identifiers).unionByName(secrets).unionByName(endpoints)


def scan(docs: DataFrame) -> DataFrame:
    """Counts of base kinds, digest of the base spans and all spans (kind:start:end) of every row."""
    rows, found = parts(docs)
    found = materialize(found)
    spans = link(found).groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.array_sort(F.collect_list(F.struct("start", "order", "end", "kind", "base"))).alias("list"),
    )
    told = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    every = F.coalesce("list", F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string,base:boolean>>"))
    return rows.join(spans, "row", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(told(F.filter(every, lambda x: x["base"])), 256).alias("base_sha256"),
        told(every).alias("spans"),
    )
