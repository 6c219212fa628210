"""Main text of HTML pages by site template removal.

Every element subtree is hashed in two ways: by its content (tag, children, text with white space collapsed) and by
its slot (the tags, classes, ids and roles from the root down to it, digits masked). Spark counts, per host, on how
many pages each hash occurs, and for slots which share of the pages' own text they hold. Two kinds of recurring subtrees
are templates:

- a slot that recurs on many pages and holds little of their text: menus, banners, side columns and footers, even if
  every page fills them with other words;
- content that recurs on most pages of the host beside articles that differ: boxes within the article, or whatever a
  template repeats word by word. Copies of an article element count once, so mirrored articles do not become
  templates; on pages without one, content must recur beside different texts.

Of the text that does not recur, a slot that holds most on the pages that it occurs on is the article's place. On a page the walk goes
down from the root through such slots, to an article or main element or to the deepest one; what hangs off the way and
is a template is deleted, and so are templates within. Headings go only if their content recurs.

Scripts, styles, forms, hidden elements and what its class, id or role names as an advert, a notice, comments or the
like are never text. On hosts of fewer than ``LEAST_PAGES`` pages nothing can be counted; there the element names alone
decide (the article or main element, without nav, aside, header and footer).

Defined cases: null or empty html gives the empty text; a null url has the empty host, on which no template is
looked for; broken and truncated markup is read as browsers do, an unfinished tag at the end being dropped; parsing
takes time in proportion to the page however tags are nested or left open; repeated rows are pages of their own; empty
tables give no rows; further columns do not matter, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import materialize, small

#: Pages of a host, and their share, on which a slot must occur to be a template.
LEAST_PAGES, LEAST_SHARE = 5, 0.02
#: Share of a host's pages on which content must recur to be a template.
CONTENT_SHARE = 0.5
#: Mean share of a page's text from which a slot is the article's place; others may be templates, below the second share if their host has no place.
PLACE, LITTLE = 0.5, 0.3
#: Digests in all that may be broadcast, 8 bytes each; beyond, the records of hosts are dealt out SALT times.
BROADCAST_DIGESTS, SALT = 1_000_000, 32

#: Fixed sets of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe noembed noframes xmp template textarea title".split())
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I) for tag in RAW}
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("html body option caption tbody tfoot thead tr legend".split())
#: What an opening tag closes implicitly, and what stops the search for it.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "body": ({"head"}, {"html"}),
}
#: The same by the closing tag, a bit each: open elements that it closes within its scope, and tags that hide them.
RULES = [("p", CLOSES_P, {"p"}, (BLOCKS - {"p"}) | {"td", "th", "button"}), *[(tag, {tag}, *IMPLIED[tag]) for tag in IMPLIED]]
CLOSED_BY: dict[str, list[int]] = {tag: [i for i, rule in enumerate(RULES) if tag in rule[1]] for tag in {t for rule in RULES for t in rule[1]}}
_OPENS = {tag: sum(1 << i for i, rule in enumerate(RULES) if tag in rule[2]) for tag in {t for rule in RULES for t in rule[2]}}
_HIDES = {tag: sum(1 << i for i, rule in enumerate(RULES) if tag in rule[3]) for tag in {t for rule in RULES for t in rule[3]}}
#: Elements that are never text.
NEVER = frozenset("head form button select dialog svg canvas object audio video map datalist script style noscript iframe noembed noframes template textarea title".split())
#: Elements that are not the article by their names, where nothing can be counted.
NAMED = frozenset("nav footer aside menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class, id and role that mark something else than the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "widget widgets footer masthead cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe signup share sharing social "
    "related recommended recommendations comment comments commentlist respond reply replies disqus discussion pagination pager toolbar login search copyright "
    "legal disclaimer alert toast contentinfo complementary skip teaser trending".split()
)
TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)", re.S)
MARKED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
PART = re.compile(r"[a-z]+", re.I)
DIGITS = re.compile(r"[0-9]+")


class Node:
    __slots__ = ("chars", "children", "digest", "names", "own", "scope", "skip", "slot", "tag", "texts")

    def __init__(self, tag: str, skip: bool, names: str = "", scope: int = 0):
        self.tag, self.skip, self.names, self.scope = tag, skip, names, scope
        self.children, self.digest, self.slot, self.chars, self.own, self.texts = [], 0, 0, 0, 0, 0


def _marked(tag: str, attributes: str) -> tuple[bool, str]:
    """Whether an element is never text, and its class, id and role with digits masked."""
    skip, names = tag in NEVER, []
    if not attributes:
        return skip, ""
    if tag not in ("html", "body"):
        skip = skip or HIDDEN.search(attributes) is not None
    for m in MARKED.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        names.append(f"{m[1].lower()}={DIGITS.sub('0', value)}")
        if not skip and tag not in ("html", "body") and any(part in MARKS for part in PART.findall(value)) and not (tag in ("article", "main") and m[1].lower() == "id"):
            skip = True
    return skip, " ".join(names)


def parse(html: str) -> Node:
    """The element tree, text nodes as strings with references decoded."""
    root = Node("#root", False)
    stack, at, n = [root], 0, len(html)
    open_: Counter = Counter()

    def close(i: int) -> None:
        for node in stack[i:]:
            open_[node.tag] -= 1
        del stack[i:]

    while at < n:
        m = TAG.search(html, at)
        if m is None:
            stack[-1].children.append(unescape(html[at:]))
            break
        if m.start() > at:
            stack[-1].children.append(unescape(html[at : m.start()]))
        at = m.end()
        name = m[1]
        if name is None or not m[3]:  # a comment, a declaration, or a tag that the end cuts off
            continue
        tag = name.lower()
        if html.startswith("</", m.start()):
            if open_[tag]:  # else nothing is searched for
                i = len(stack) - 1
                while stack[i].tag != tag:
                    i -= 1
                close(i)
            continue
        for rule in CLOSED_BY.get(tag, ()):
            if not stack[-1].scope >> rule & 1:
                continue
            closed, stops = RULES[rule][2:]
            for i in range(len(stack) - 1, 0, -1):
                if not stack[-1].scope >> rule & 1:
                    break
                if stack[i].tag in closed:
                    close(i)
                elif stack[i].tag in stops:
                    break
        skip, names = _marked(tag, m[2])
        node = Node(tag, skip, names, stack[-1].scope & ~_HIDES.get(tag, 0) | _OPENS.get(tag, 0))
        stack[-1].children.append(node)
        if tag in VOID or (m[2].endswith("/") and tag in ("path", "circle", "rect", "use", "svg")):
            continue
        if tag in RAW:
            end = RAW_END[tag].search(html, at)
            node.children.append(html[at : end.start()] if end else html[at:])
            at = end.end() if end else n
            continue
        open_[tag] += 1
        stack.append(node)
    return root


def digest(root: Node) -> list[Node]:
    """Hash every subtree by content and slot, count its text's characters and sum its texts' hashes; all elements, children first."""
    h = xxhash.xxh64_intdigest
    order, todo = [], [root]
    root.slot = h("#root") >> 1
    while todo:
        node = todo.pop()
        order.append(node)
        for c in node.children:
            if c.__class__ is Node:
                c.slot = h(f"{node.slot:x}/{c.tag} {c.names}") >> 1
                todo.append(c)
    order.reverse()
    for node in order:
        parts, chars, own, texts = [node.tag], 0, 0, 0
        for c in node.children:
            if c.__class__ is Node:
                parts.append(f"<{c.digest:x}>")
                chars, texts = chars + c.chars, texts + c.texts
            elif text := " ".join(c.split()):
                parts.append(text)
                own, texts = own + len(text), texts + h(text)
        node.digest = h("\x00".join(parts)) >> 1 if len(parts) > 1 else 0
        if not node.skip:
            node.chars, node.own, node.texts = chars + own, own, texts
    return order


@dataclass
class Site:
    """What was counted on a host: content and slots that are templates, and the slots of the article's place."""

    templates: frozenset[int] = frozenset()
    places: frozenset[int] = frozenset()


def _articles(root: Node) -> list[Node]:
    """By element names: the outermost articles, or else mains, or else the root."""
    for wanted in ("article", "main"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.tag == wanted:
                found.append(node)
            else:
                todo.extend(c for c in reversed(node.children) if c.__class__ is Node and not c.skip and c.tag not in NAMED)
        if found:
            return found
    return [root]


def way(root: Node, site: Site) -> list[Node]:
    """The elements from the root down through the article's places, to an article or main element or to the deepest place."""
    found, node = [root], root
    while node.tag not in ("article", "main"):
        inner = [c for c in node.children if c.__class__ is Node and not c.skip and c.digest not in site.templates and (c.slot in site.places or c.tag in ("html", "body"))]
        if len(inner) != 1:
            break
        node = inner[0]
        found.append(node)
    return found


def render(root: Node, site: Site | None = None) -> str:
    """The main text of a digested page without the templates of ``site``; by element names if there is none."""
    blocks: list[str] = []
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            if text := " ".join("".join(pieces).split()):
                blocks.append(text)
            pieces.clear()

    if site is None:
        tops, through, templates = _articles(root), frozenset(), frozenset()
        own = tops[0] is not root
    else:
        path = way(root, site)
        tops, through, templates, own = [root], {id(node): i for i, node in enumerate(path)}, site.templates, True
    for top in tops:
        flush()
        # The second value: whether slots count, which they do off the way but not within the article's place.
        todo: list = [(top, site is not None)]
        while todo:
            node, judged = todo.pop()
            if node.__class__ is str:
                pieces.append(node)
                continue
            if node is None:
                flush()
                continue
            if node.skip or site is None and (node.tag in NAMED or node.tag == "header" and not own):
                continue
            place = through.get(id(node)) if judged else None
            if place is None and node.chars and (node.digest in templates or judged and node.slot in templates and node.tag not in HEADINGS):
                continue
            if node.tag in ("br", "td", "th"):
                pieces.append(" ")
            if node.tag in BLOCKS:
                flush()
                todo.append((None, False))
            inner = judged and place != len(through) - 1
            todo.extend((c, inner) for c in reversed(node.children))
        flush()
    return "\n\n".join(blocks)


HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


COUNTED = "host string, hash long, slot boolean, n long, share double, once long, contents long"


def sites(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, templates, places) of the hosts with ``least_pages`` pages or more; arrays of hashes, a few per element of a page.

    A content's bits are 62, one set by each page's article element or, without one, by the rest of the page: beside so
    many different texts at least did it occur. ``share`` sums a slot's shares, a content's own characters, the page's characters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple, list] = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not host:
                    continue
                root = parse(html.as_py() or "")
                order = digest(root)
                article = next((node.digest for node in reversed(order) if node.tag in ("article", "main") and not node.skip), None)
                seen: dict[tuple, list] = {(0, True): [1, root.chars, 0]}  # the page itself
                for node in order:
                    if node.chars and not node.skip:
                        if node.tag not in ("#root", "html", "body"):
                            slot = seen.setdefault((node.slot, True), [0, 0.0, 0])
                            slot[0], slot[1] = slot[0] + 1, slot[1] + node.chars / root.chars
                        seen.setdefault((node.digest, False), [1, node.own, (root.texts - node.texts if article is None else article) % 62])
                for (hash_, is_slot), (times, share, bit) in seen.items():
                    now = counts.setdefault((host, hash_, is_slot), [0, 0.0, 0, 0])
                    now[0] += 1
                    now[1] += share
                    now[2] += times == 1
                    now[3] |= 1 << bit
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.int64(), pa.bool_()))],
                 *[pa.array([v[i] for v in counts.values()], t) for i, t in enumerate((pa.int64(), pa.float64(), pa.int64(), pa.int64()))]],
                ["host", "hash", "slot", "n", "share", "once", "contents"],
            )

    counts = materialize(
        pages.select("host", "html").mapInArrow(run, COUNTED).groupBy("host", "hash", "slot")
        .agg(F.sum("n").alias("n"), F.sum("share").alias("share"), F.sum("once").alias("once"), F.bit_or("contents").alias("contents"))
        .where(F.col("n") >= least_pages)
    )
    hosts = counts.where("hash = 0 and slot").select("host", F.col("n").alias("pages"), F.col("share").alias("chars"))
    known = counts.where("hash <> 0").join(small(hosts), "host")
    recurs = ~F.col("slot") & (F.col("n") >= F.lit(CONTENT_SHARE) * F.col("pages")) & (F.bit_count("contents") >= least_pages)
    known = materialize(known.withColumn("recurs", recurs))
    # Own characters stand in one element only, so these add up to the text that recurs.
    again = known.where("recurs").groupBy("host").agg(F.sum("share").alias("again"))
    rest = F.greatest(F.lit(1.0) - F.coalesce("again", F.lit(0.0)) / F.greatest("chars", F.lit(1.0)), F.lit(0.001))
    mean, many = F.col("share") / F.col("n") / rest, F.col("n") >= F.lit(least_share) * F.col("pages")
    judged = known.join(small(again), "host", "left")
    place = F.col("slot") & (mean >= PLACE) & (F.col("once") * 2 > F.col("n"))
    placed = small(judged.where(place & many).select("host", F.lit(True).alias("placed")).distinct())
    judged = judged.join(placed, "host", "left")
    template = F.col("recurs") | F.col("slot") & many & (mean < F.when(F.col("placed"), F.lit(PLACE)).otherwise(F.lit(LITTLE)))
    lists = judged.where(template | place).groupBy("host").agg(
        F.collect_list(F.when(template, F.col("hash"))).alias("templates"), F.collect_list(F.when(place, F.col("hash"))).alias("places")
    )
    return hosts.select("host").join(lists, "host", "left")


def _with_sites(hosted: DataFrame, found: DataFrame) -> DataFrame:
    """``hosted`` with its host's record: broadcast if all digests together are few, else joined by host and a salt."""
    size = lambda c: F.greatest(F.size(F.coalesce(c, F.array().cast("array<bigint>"))), F.lit(0)) + 4
    if (found.agg(F.sum(size("templates") + size("places"))).first()[0] or 0) <= BROADCAST_DIGESTS:
        return hosted.join(F.broadcast(found), "host", "left")
    salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return hosted.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALT)).cast("int")).join(salted, ["host", "salt"], "left")


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """page_id, url, text, n_chars and n_template (subtrees found to be templates) of every row of ``pages``."""
    hosted = pages.select("page_id", "url", "html", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)).alias("host"))
    found = materialize(sites(hosted, least_pages, least_share).withColumn("counted", F.lit(True)))
    joined = _with_sites(hosted, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lengths, deleted = [], [], []
            # A host's record is read once a batch.
            held: dict[str, Site | None] = {}
            for i, (html, host) in enumerate(zip(batch.column(2), batch.column(3).to_pylist(), strict=True)):
                if host not in held:
                    known, places, counted = (batch.column(k)[i].as_py() for k in (4, 5, 6))
                    held[host] = Site(frozenset(known or ()), frozenset(places or ())) if counted else None
                site = held[host]
                root = parse(html.as_py() or "")
                order = digest(root)
                deleted.append(sum(node.digest in site.templates or node.slot in site.templates for node in order) if site else 0)
                text = render(root, site)
                texts.append(text)
                lengths.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(lengths, pa.int64()), pa.array(deleted, pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_template"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return joined.select("page_id", "url", "html", "host", "templates", "places", "counted").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, n_template long"
    )
