"""Main text of pages."""

import html
import re

import pytest

from strata.llm import site_style as S

PAGE = """<!DOCTYPE html><html><head><title>t &amp; t</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site</h1><nav><a href="/">Home</a></nav></header><div class="cookie-notice">We use cookies</div>
<main><article class="post"><h1>Head {n} &eacute;</h1><p>One <b>bold</b>
 text {n}.<p>Two &lt;tag&gt;&nbsp;x<div class="advert">Buy now</div><ul><li>a{n}<li>b</ul><form><label>Mail</label><input></form>
<div class="box">Read our terms before you go on</div><p>Last {n}<br>line</p>
<section id="comments"><h2>3 comments</h2><article><p>first!</p></article></section></article></main>
<aside>More</aside><footer>&copy; site</footer><script>if (a < b) {{ write("<p>no</p>") }}</script></body></html>"""


def want(n, box):
    return "\n".join([f"Head {n} é", f"One bold text {n}.", "Two <tag> x", f"a{n}", "b", *["Read our terms before you go on"] * box, f"Last {n}", "line"])


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_site_tree_removes_what_a_host_repeats(spark):
    rows = [(i, f"http://One.example.com:80/{i}", PAGE.format(n=i)) for i in range(8)]
    rows += [(100 + i, f"http://two.example.com/{i}", PAGE.format(n=i)) for i in range(2)]  # too few pages to tell
    got = {r.page_id: r for r in S.main_text(pages(spark, rows)).collect()}
    assert all(got[i].text == want(i, 0) for i in range(8))
    assert all(got[100 + i].text == want(i, 1) for i in range(2))
    assert all(r.n_chars == len(r.text) for r in got.values())
    tree = S.importance(pages(spark, rows[:8])).where("importance < 0.15").collect()
    assert tree and all(r.content == 0 and r.n_pages == r.shown == 8 for r in tree)


BARE = """<html><body><div><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></div>
<div><p>Story {n} begins.<p>It goes on, {n} times.</div><p>All rights are ours, read them before you go.</p><div>Subscribe to our letters today</div>
<div>{extra}</div><table><tr><td>Site map<td>Contact</table></body></html>"""


def test_only_the_tree_tells_menu_and_notice_from_text(spark):
    """No article, no classes: siblings of one path are told apart by what they hold."""
    rows = [(i, f"http://bare.example.com/{i}", BARE.format(n=i, extra=f"Note {i}")) for i in range(20)]
    got = {r.page_id: r.text for r in S.main_text(pages(spark, rows)).collect()}
    assert all(got[i] == f"Story {i} begins.\nIt goes on, {i} times.\nNote {i}" for i in range(20))
    without = S.extract(BARE.format(n=1, extra="Note 1"))
    assert "Home" in without and "Subscribe" in without and "All rights" in without  # what the tree took away
    few = {r.page_id: r.text for r in S.main_text(pages(spark, rows[:4])).collect()}
    assert few[1] == without


def test_what_half_the_pages_share_stays(spark):
    rows = [(i, "http://half.example.com/", f"<div><p>Own {i}</p></div><div><p>{'Shared by half' if i % 2 else f'Other {i}'}</p></div>") for i in range(20)]
    got = {r.page_id: r.text for r in S.main_text(pages(spark, rows)).collect()}
    assert got[1] == "Own 1\nShared by half" and got[2] == "Own 2\nOther 2"


@pytest.mark.parametrize("page,words", [
    ("<div>x" * 100_000, 100_000), ("<b>x" * 100_000, 1), ("<p><b>x" * 50_000, 50_000), ("<ul><li>x" * 50_000, 50_000), ("<b>x<br>" * 50_000, 50_000),
    ("<li>" + "<ul>" + "<b>" * 50_000 + "</li>x" * 50_000, 50_000), ("<table><tr><td>x" * 30_000, 30_000), ("<div>" * 60_000 + "x" + "</div>" * 60_000, 1)])
def test_unclosed_tags_cost_in_proportion(page, words):
    import time
    began = time.time()
    S.style_rows(page)
    text = S.extract(page, frozenset([1]))
    assert time.time() - began < 12  # two parses; quadratic ones took minutes
    assert len(text.split("\n")) in (words, 1)


def test_copies_of_an_article_stay(spark):
    rows = [(i, "http://copy.example.com/x", "<article><div><p>The same story again.</p></div></article>") for i in range(9)]
    assert {r.text for r in S.main_text(pages(spark, rows)).collect()} <= {"The same story again.", ""}
    rows = [(i, "http://copy.example.com/x", "<article><h1>H</h1><p>The same story again.</p></article>") for i in range(9)]
    assert {r.text for r in S.main_text(pages(spark, rows)).collect()} == {"H\nThe same story again."}


def test_shuffle_path_gives_the_same(spark, monkeypatch):
    rows = [(i, "http://one.example.com/", PAGE.format(n=i)) for i in range(8)]
    monkeypatch.setattr(S, "bounded_broadcast", lambda df, n, limit=0: df)
    assert sorted(r.text for r in S.main_text(pages(spark, rows)).collect()) == sorted(want(i, 0) for i in range(8))


def test_real_pages_against_regular_expressions(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in S.main_text(df).collect()}
    for r in df.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        parts = re.split(r"</?(?:p|h1|br)>", inner)
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in parts]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"), ("<p>a<p>b", "a\nb"), ("<div>x<script>y</div>", "x"),
    ("<p title='a>b'>x</p>", "x"), ("a<!-- c -->b<!-- open", "ab"), ("<nav>n</nav><p>x</p><div hidden>h</div>", "x"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<div class=menu>m</div><p>t</p>", "t"), ("<p>1 < 2 &#x263a; &notanentity;</p>", "1 < 2 ☺ ¬anentity;"),
    ("</p></div><b>x</b>", "x"), ("<article>a</article><p>b</p>", "a"), ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\nb\nc"),
    ("<div class='has-sidebar'><p>x</p><div class='site-header'>s</div><div id='AdSlot1'>a</div></div>", "x"),
    ("<div class='content-with-menu'>x<div class='main-menu'>m</div><div class='post-comments'>c</div><div class='post-body'>y</div></div>", "x\ny"),
    ("<article><div class='post-header'><h1>t</h1></div><div class='comment'>c</div><article class='comments'>d</article>x</article>", "t\nx"),
    ("<div style='display: none'>h</div><p>x", "x"), ("<textarea><p>t</textarea>y", "y"), ("<p" + "x" * 10_000, ""),
])
def test_fragments(page, text):
    assert S.extract(page or "") == text


def test_awkward_rows(spark):
    rows = [(1, None, "<p>x</p>"), (2, "no host", "<p>y</p>"), (None, "http://h.example/", None), (3, "http://h.example/", ""),
            (4, "http://h.example/", "<div>" * 3000 + "deep" + "</div>" * 3000), (4, "http://h.example/", "<p>z</p>")]
    from pyspark.sql import functions as F
    df = pages(spark, rows).withColumns({c: F.lit("x") for c in ("text", "host", "path", "low", "raw", "n_chars", "_site", "_host")})
    got = sorted((r.page_id or -1, r.text, r.n_chars) for r in S.main_text(df).collect())
    assert got == [(-1, "", 0), (1, "x", 1), (2, "y", 1), (3, "", 0), (4, "deep", 4), (4, "z", 1)]
    assert S.main_text(pages(spark, [])).count() == 0
