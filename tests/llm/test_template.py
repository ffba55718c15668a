import re

import pytest
from helpers import plain

from aferir.llm import template

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header class="site">Site name</header><nav><ul><li><a href="/a">A{n}</a><li><a>B</a></ul></nav><!-- <p>ad</p> -->
<div class="ad-box">Buy {n}</div><article><h1>Title {n}</h1><p><b>First</b> par&shy;agraph&nbsp;{n} &lt;x&gt;<br>line
<p>Second &amp one<div class="share">Share</div><ul><li>i<li>ii</ul><form>mail <input></form>
<section id="comments"><p>nice</section></article><aside>Side</aside><footer>&copy; host</footer></body></html>"""


def expected(n):
    return f"Title {n} First par­agraph {n} <x> line Second & one i ii"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, slot string, token string")


def test_article_of_a_page():
    assert template.main_text(PAGE.format(n=7)) == expected(7)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("no marks", "no marks"),
        ("<p>open <i>ended", "open ended"),
        ("a < b <b>c</b> > d", "a < b c > d"),
        ("<body><nav>x</nav><p>kept</p><div class='cookie-notice'>z</div>", "kept"),
        ('<article title="a > b">in</article>out', "in"),
        ("<main>one</main><div>no</div>", "one"),
        ("<article>" + "<div>" * 3000 + "deep", "deep"),
    ],
)
def test_pages_without_a_template(source, text):
    assert template.main_text(source) == text


def test_template_finds_the_slot_and_fixed_texts(spark):
    body = "<html><body><div class=top>Fixed line</div><div class=core><p>{}</p><p>Story {}</p></div><div class=end>All rights</div></body></html>"
    rows = [(i, f"https://h.example/{i}", body.format("word " * (i + 5), i), "h", "s", "t") for i in range(6)]
    found = template.templates(pages(spark, rows)).collect()
    assert [(r["host"], r["slot"]) for r in found] == [("h.example", "html/body/div.core")]
    assert len(found[0]["fixed"]) == 2
    texts = {r["page_id"]: r["text"] for r in template.extract_texts(pages(spark, rows)).collect()}
    assert texts == {i: ("word " * (i + 5)) + f"Story {i}" for i in range(6)}


def test_equal_articles_are_kept(spark):
    rows = [(i, "https://one.example/x", PAGE.format(n=1), "h", "s", "t") for i in range(5)]
    assert {r["text"] for r in template.extract_texts(pages(spark, rows)).collect()} == {expected(1)}


def test_odd_rows(spark):
    rows = [(1, None, None, "h", "s", "t"), (1, None, "", "h", "s", "t"), (None, "x", PAGE.format(n=2), "h", "s", "t")]
    rows += [(9, "http://b.example", "<article>" + "long text " * 20_000, "h", "s", "t")]
    got = plain(template.extract_texts(pages(spark, rows)).select("page_id", "n_chars"))
    assert got == plain(spark.createDataFrame([(1, 0), (1, 0), (None, len(expected(2))), (9, 199_999)], "a long, b long"))
    assert template.extract_texts(pages(spark, [])).count() == 0


def test_every_page_of_the_table_against_a_pattern(spark):
    source = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r["text"] for r in template.extract_texts(source).collect()}
    import html

    for row in source.collect():
        inner = re.search(r"<article>(.*?)</article>", row["html"], re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1)>|<br>", inner)
        assert got[row["page_id"]] == " ".join(" ".join(html.unescape(re.sub("</?b>", "", p)) for p in parts).split())


def test_names_on_wrappers_and_on_the_article_drop_nothing():
    from aferir.llm import template as tpl

    words = " ".join(f"word{i}" for i in range(60))
    pages = (
        f'<html><body class="single with-sidebar"><nav>menu</nav><article><p>{words}</p></article></body></html>',
        f'<html><body><nav>menu</nav><div id="header-fixed-wrap"><article class="post comment-open"><p>{words}</p></article></div></body></html>',
        f'<html><body class="menu-open"><div id="header-fixed-wrap"><div class="text"><p>{words}</p></div></div></body></html>',
    )
    for page in pages:
        assert tpl.main_text(page) == words
    # The template of a host finds the slot, and an empty slot falls back to the page.
    path = "html/body.single with-sidebar/article.post comment-open"
    marked = f'<html><body class="single with-sidebar"><article class="post comment-open"><p>{words}</p></article></body></html>'
    assert tpl.main_text(marked, path) == words
    assert tpl.main_text(f"<html><body><main></main><div><p>{words}</p></div></body></html>", "html/body/main") == words
    tokens = [
        {"token": token, "support": 4, "total": 4, "vector": 1, "place": place, "chars": chars}
        for place, (token, chars) in enumerate((("html", 0), ("html/body.single with-sidebar", 0), (path, 0), (f"{path}/p", 400)))
    ]
    assert tpl.template(tokens)[0] == path
