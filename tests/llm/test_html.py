import pytest

from siltstone.llm.html import Site, digest, extract, parse, render

PAGES = "page_id long, url string, html string"


def text(html):
    root = parse(html)
    digest(root)
    return render(root)


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("", ""), (None, ""), ("just text &amp; more", "just text & more"),
        ("<article><h1>T</h1><p>a <b>b</b>\n c<p>d<br>e</article><footer>f</footer>", "T\n\na b c\n\nd e"),
        ("<nav>n</nav><article><p>x</p><div class='share-bar'>s</div><section id=comments><article><p>c</p></article></section></article>", "x"),
        ("<article><p>a</p><script>if (a < b) document.write('</p>');</script><style>p{}</style><p>b</p></article>", "a\n\nb"),
        ("<main><p>m</p><aside>s</aside><form><p>f</p></form></main>", "m"),
        ("<body><header><p>site</p></header><p>body &#8211; text</p><div class=\"ad\">ad</div></body>", "body – text"),
        ("<article><header><h1>Title</h1></header><p>x</p></article>", "Title\n\nx"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a</td><td>b</td></tr></table></article>", "one\n\ntwo\n\na b"),
        ("<article><p>cut <b>off", "cut off"), ("<article><p>cut</p><p cla", "cut"), ("<article><p>a</p><!-- no <p>x</p> --><p>b</p>", "a\n\nb"),
        ("<article><p>1 < 2 & 3 > 2 &am &amp &copy;</p></article>", "1 < 2 & 3 > 2 &am & ©"),
        ("<p hidden>no</p><p>yes</p></div></p>", "yes"), ("<article><p>a  b</p></article>", "a b"),
        ("<ARTICLE><P CLASS=Cookie-Notice>no</P><P>yes</P></ARTICLE>", "yes"),
    ],
)
def test_main_text(html, want):
    assert text(html or "") == want


def page(i, own, host="h.example"):
    return (i, f"https://{host}/{i}", f"<body><div><p>Welcome to our site</p><p>Since 1999</p></div><p>{own}</p><div><span>Powered by X</span></div></body>")


def test_recurring_subtrees_go_by_host(spark):
    rows = [page(i, f"own text {i}") for i in range(20)] + [page(100 + i, f"other {i}", "small.example") for i in range(3)]
    rows += [(200, None, None), (201, "no url", "<p>x</p>"), (202, "https://h.example/empty", "")]
    got = {r["page_id"]: r for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["text"] == f"own text {i}" and got[i]["n_template"] > 0 for i in range(20))
    assert got[100]["text"] == "Welcome to our site\n\nSince 1999\n\nother 0\n\nPowered by X" and got[100]["n_template"] == 0
    assert got[200]["text"] == got[202]["text"] == "" and got[201]["text"] == "x" and got[201]["n_chars"] == 1


def test_mirrored_articles_stay_whole(spark):
    rows = [(i, f"http://m.example/{i}", "<article><h1>Same</h1><p>Same text</p></article><div><p>Ad space</p></div>") for i in range(12)]
    pages = spark.createDataFrame(rows + rows[:2], PAGES).selectExpr("*", "1 AS host", "2 AS templates", "3 AS text", "4 AS `a.b`")
    got = extract(pages).collect()
    assert len(got) == 14 and {r["text"] for r in got} == {"Same\n\nSame text"}
    assert extract(pages.limit(0)).count() == 0


def test_long_page(spark):
    html = "<article>" + "".join(f"<p>line {i}</p>" for i in range(20000)) + "</article>"
    got = extract(spark.createDataFrame([(1, "http://x/", html)], PAGES)).first()
    assert got["text"].count("\n\n") == 19999 and got["text"].endswith("line 19999")


def words(seed, n):
    import random

    r = random.Random(seed)
    return " ".join(f"word{r.randrange(5000)}" for _ in range(n))


def varied(i, host, wrap="article"):
    """A page whose menu, banner and footer hold other words on each page, as its article does."""
    article = f"<{wrap}><h1>{words(i, 4)}</h1><p>{words(i + 1, 60)}</p><div><p>Rate this page now</p></div><p>{words(i + 2, 40)}</p></{wrap.split()[0]}>"
    menu = "".join(f"<li><a href=/{k}>{words(i * 7 + k, 1)}</a></li>" for k in range(5))
    page = f"<html><body><div id=m><ul>{menu}</ul></div><div class=top><span>{words(i + 3, 8)}</span></div>{article}<div id=foot{i}>{words(i + 4, 6)}</div></body></html>"
    return (i, f"http://{host}/{i}", page), f"{words(i, 4)}\n\n{words(i + 1, 60)}\n\n{words(i + 2, 40)}"


@pytest.mark.parametrize("wrap", ["article", "div class=content", "main"])
def test_templates_decide(spark, wrap):
    """Slots go by place and content by recurrence; without what was counted every page would keep them."""
    rows, want = zip(*[varied(i * 10, "v.example", wrap) for i in range(30)], strict=True)
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(list(rows), PAGES)).collect()}
    assert [got[r[0]] for r in rows] == list(want)
    for _, _, html in rows:
        root = parse(html)
        digest(root)
        plain = render(root, Site())
        assert plain not in want and "Rate this page now" in plain


def test_host_with_few_pages_is_read_by_names(spark):
    rows = [varied(i * 10, "few.example")[0] for i in range(3)] + [(99, "http://few.example/x", "<nav>n</nav><p>a</p><footer>f</footer>")]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[99] == "a" and got[0].count("Rate this page now") == 1


@pytest.mark.parametrize("html", [
    "<b>" * 20_000 + "</i>" * 20_000, "<p>" + "<b>" * 20_000 + "<div></div>" * 20_000, "<li><ul>" + "<b>" * 20_000 + "<li>" * 20_000, "<table>" * 5_000 + "<td>" * 20_000,
    "<div>" * 30_000 + "x", "<a href='" * 20_000, "<!--" * 50_000, "<title>" * 30_000, "<" * 100_000, "<p><button>" + "<i>" * 20_000 + "<p></p>" * 20_000,
])
def test_deep_and_broken_pages_take_linear_time(html):
    import time

    began = time.process_time()
    root = parse(html)
    digest(root)
    render(root)
    render(root, Site())
    assert time.process_time() - began < 8
