"""Ids, words, tokens and projections of texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Python's white space, listed; a Unicode-mode class is several times slower and lacks four separators.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
TERM = "[a-z0-9]+"


def stable_id(*parts: Column | str) -> Column:
    """63-bit id: first 16 hex digits of the SHA-256 of the parts joined by U+001F; a null part reads None."""
    joined = F.concat_ws("\x1f", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("None")) for p in parts])
    return F.conv(F.substring(F.sha2(joined, 256), 1, 16), 16, -10).cast("long").bitwiseAND(F.lit((1 << 63) - 1))


def words(text: Column, space: str = SPACE) -> Column:
    """Runs of anything but white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), space), lambda w: w != "")


def is_blank(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")) == 0


def tokenize(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits, of two or more characters."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), 0)
    return F.filter(found, lambda t: F.length(t) >= 2)


def truncated(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def snippet(text: Column, n: int = 500) -> Column:
    return F.when(F.length(text) <= n, text).otherwise(F.concat(F.substring(text, 1, n), F.lit("...")))


def basename(uri: Column) -> Column:
    """Lower-case last part of a path with either slash."""
    return F.lower(F.substring_index(F.replace(uri, F.lit("\\"), F.lit("/")), "/", -1))


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))


def relative_path(path: Column, root: str) -> Column:
    """The path below ``root``, with forward slashes."""
    return F.replace(F.substring(path, len(root.rstrip("/")) + 2, 1 << 30), F.lit("\\"), F.lit("/"))


def with_context(context: Column, text: Column) -> Column:
    """What is embedded: the context line above the text, if there is one."""
    return F.when(F.coalesce(context, F.lit("")) != "", F.concat(context, F.lit("\n"), text)).otherwise(text)


def paper_text(title: Column, abstract: Column) -> Column:
    return F.concat(F.lit("Title: "), F.coalesce(title, F.lit("")), F.lit(". Abstract: "), F.coalesce(abstract, F.lit("")))


def techniques(tags: Column) -> Column:
    """Sorted distinct technique numbers (T1059, T1059.001) of attack tags."""
    ids = F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.regexp_extract(t, r"(?i)^attack\.t(\d+(?:\.\d+)?)$", 1))
    return F.array_sort(F.array_distinct(F.transform(F.filter(ids, lambda x: x != ""), lambda x: F.concat(F.lit("T"), x))))


def plain_text(html: Column) -> Column:
    """Visible text of HTML by a chain of replacements: skipped elements, comments, block ends, tags, references, white space."""
    text = F.coalesce(html, F.lit(""))
    for pattern, by in HTML_STEPS:
        text = F.regexp_replace(text, pattern, by)
    return F.trim(text)


#: Patterns and what takes their place, in this order.
HTML_STEPS = (
    (r"(?is)<(script|style|head|nav|footer|noscript)\b.*?</(script|style|head|nav|footer|noscript)\s*>", " "),
    (r"(?s)<!--.*?-->", " "),
    (r"(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|table|article|section)\b[^>]*>", "\n"),
    (r"<[^>]*>", " "),
    (r"&nbsp;", " "), (r"&lt;", "<"), (r"&gt;", ">"), (r"&quot;", "\""), (r"&#39;", "'"), (r"&copy;", "©"), (r"&middot;", "·"), (r"&amp;", "&"),
    (r"[ \t\r\f]+", " "), (r" *\n[ \n]*", "\n"), (r"^\n+|\n+$", ""),
)
