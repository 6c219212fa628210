import hashlib
import random
import re
import string

from pyspark.sql import functions as F

from siltstone.llm.merkle import LONG, SHORT, edited_clauses, fingerprint, likeness, with_next

SPACE = r"[ \t\n\x0b\f\r]"


def cut(text, pattern):
    return [x for x in re.split(pattern, text) if x]


def tree(text):
    """The tree by plain loops: root, and sections (node, paragraphs (node, leaves))."""
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    sections = []
    for s in cut(text, r"(?<=\n\n)(?!\n)"):
        paragraphs = []
        for p in cut(s, r"(?<=\n)"):
            leaves = []
            for c in cut(p, rf"(?<=[{re.escape(string.punctuation)}])(?={SPACE})"):
                leaves += cut(c, rf"(?<=[^ \t\n\x0b\f\r])(?={SPACE})") if len(p) <= SHORT or len(c) > LONG else [c]
            nodes = [sha(x) for x in leaves]
            paragraphs.append((sha("".join(nodes)), [x[:8] for x in nodes]))
        sections.append((sha("".join(n for n, _ in paragraphs)), paragraphs))
    return sha("".join(n for n, _ in sections)), sections


def written(text):
    root, sections = tree(text)
    return root + ":" + "|".join(n + "=" + "/".join(m + "." + "".join(ls) for m, ls in ps) for n, ps in sections)


def alike(a, b):
    """Top-down comparison by plain sets."""
    (ra, sa), (rb, sb) = tree(a), tree(b)
    if ra == rb:
        return 1.0
    sa, sb = {n: p for n, p in sa}, {n: p for n, p in sb}
    shared = sum(len({m: ls for m, ls in sa[n]}[m]) for n in sa.keys() & sb.keys() for m, _ in sa[n])
    pa, pb = ({m: ls for n in x.keys() - y.keys() for m, ls in x[n]} for x, y in ((sa, sb), (sb, sa)))
    shared += sum(len(pa[m]) for m in pa.keys() & pb.keys())
    la, lb = ({x for m in p.keys() - q.keys() for x in p[m]} for p, q in ((pa, pb), (pb, pa)))
    total = 2 * shared + len(la) + len(lb)
    return 1.0 if not total else 2 * (shared + len(la & lb)) / total


def test_fingerprints_and_likeness_as_by_brute_force(spark, odd_rows):
    r, texts = random.Random(2), [x[1] or "" for x in odd_rows]
    words = ["one", "two.", "three,", "long" * 60, "vier!", "\u00e4\u00f6", "\U0001f600", "a;b"]
    for _ in range(60):
        texts.append("".join(r.choice(words) + r.choice([" ", " ", "\n", "\n\n", "\n\n\n", "\t", ""]) for _ in range(r.randrange(80))))
    pairs = [(t, u) for t in texts for u in r.sample(texts, 3)]
    for t in texts:  # edits in the middle, at the front and at the end
        k = r.randrange(len(t) + 1)
        pairs += [(t, t[:k] + "new words. " + t[k:]), (t, "First.\n\n" + t), (t, t + "last"), (t, t)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i long, a string, b string")
    df = df.select("i", fingerprint(F.col("a")).alias("a"), fingerprint(F.col("b")).alias("b"))
    for x in df.select("i", "a", "b", likeness(F.col("a"), F.col("b")).alias("l")).collect():
        a, b = pairs[x["i"]]
        assert x["a"] == written(a) and x["b"] == written(b)
        assert abs(x["l"] - alike(a, b)) < 1e-12


def test_edited_texts(odd, odd_rows, none):
    order = sorted({(r[0], r[1] or "") for r in odd_rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    after = {order[i]: order[(i + 1) % len(order)][1] for i in range(len(order))}
    got = with_next(odd).collect()
    assert len(got) == len(odd_rows)
    texts = {}
    for r in got:
        texts.setdefault(r["doc_id"], []).append(r)
    for doc_id, text, *_ in odd_rows:
        text = text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[doc_id, text][:half]
        for r in texts[doc_id]:
            assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] and by[1]["near_next"] == 1.0
    assert by[3]["fingerprint"] == by[4]["fingerprint"] != by[5]["fingerprint"]
    assert 0.3 < by[9]["near_edited"] < 0.9
    assert with_next(none).count() == 0


def test_branches_locate_edits(spark):
    a, b = "Intro one. Two.\n\nPart A here.\nLine two, more.\n", "Intro one. Two.\n\nPart A here.\nLine 2, more.\n"
    row = spark.createDataFrame([(a, b)], "a string, b string").select(fingerprint(F.col("a")).alias("a"), fingerprint(F.col("b")).alias("b"))
    out = row.select(edited_clauses(F.col("a"), F.col("b")).alias("e"), likeness(F.col("a"), F.col("b")).alias("l"), "a", "b").first()
    assert out["a"].split(":")[0] != out["b"].split(":")[0] and 0 < out["l"] < 1
    assert {(e["section"], e["paragraph"]) for e in out["e"]} == {(2, 2)}


def test_very_long_text(spark):
    text = "".join(f"Line {i}, of many words.\n" + ("\n" if i % 7 == 0 else "") for i in range(60_000))
    row = spark.createDataFrame([(text, text.replace("Line 30000,", "Line thirty,"))], "a string, b string")
    out = row.select(likeness(fingerprint(F.col("a")), fingerprint(F.col("b"))).alias("l"), edited_clauses(fingerprint(F.col("a")), fingerprint(F.col("b"))).alias("e")).first()
    assert 0.9999 < out["l"] < 1 and len(out["e"]) == 1
