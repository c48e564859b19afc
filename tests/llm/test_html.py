"""Blocks, the tree on its table and on the driver's pages, odd pages."""

import html as chars
import re

import duckdb
import pytest

from tidemark.llm import html, queries


@pytest.fixture(scope="module")
def tree():
    return html.train()


def test_table_is_learned(tree):
    for page, marks in html.LABELLED:
        found = html.blocks(page)
        assert len(found) == len(marks), page
        assert [html.is_main(tree, row) for row in html.table_of(found).tolist()] == [bool(m) for m in marks], page


def test_main_text_of_the_given_pages(tree):
    """In these pages the main text is what the article element holds."""
    for (page,) in duckdb.connect().execute("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall():
        inside = page[page.index("<article>"):page.rindex("</article>")]
        plain = re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", " ", inside))
        assert html.main_text(page, tree) == " ".join(chars.unescape(plain).split())


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<html><body></body></html>", ""),
    ("<article><p>a&nbsp;&amp;&lt;b&gt;&#233;&#x4e2d; &quot;q&quot; &am &notanentity;</p>", 'a &<b>é中 "q" &am ¬anentity;'),
    ("<article><p>one<b>two</b> three<br>four</p><script>var a='</p><p>x';</script><!-- <p>no</p> -->five</article>",
     "onetwo three four five"),
    ("<article><h1>T</h1><p>Unclosed<p>again<div class='ad-box'>buy<p>more</div><p>last", "T Unclosed again last"),
    ("<article><p>Text</p><div class=comments><article><p>I say.</p></article></div><form>Name <input></form>"
     "<aside>side</aside><footer>foot</footer></article>", "Text"),
    ("<ARTICLE><P>Upper</P><STYLE>p{}</STYLE></ARTICLE><FOOTER>no</FOOTER>", "Upper"),
    ("<header>site</header><article><header><h1>Title</h1></header><p>Body</p></article>", "Title Body"),
    ("<article><p>kept</p><p hidden>gone</p><p style='display: none'>gone</p></article>", "kept"),
    ("<title>never</title><article>a<!-- broken", "a"), ("<article>x</article><script>unclosed <p>y</p>", "x"),
    ("<article><p>a < b and c > d</p></article>", "a < b and c > d"),
])
def test_odd_pages(tree, page, text):
    assert html.main_text(page, tree) == text


def test_very_long_page(tree):
    page = "<article>" + "<p>word and more &amp; text</p>" * 50_000 + "</article>"
    assert html.main_text(page, tree) == " ".join(["word and more & text"] * 50_000)
    deep = "<article>" + "<div>" * 5_000 + "deep" + "</div>" * 5_000
    assert html.main_text(deep, tree) == "deep"


def test_query(spark, tmp_path):
    rows = [(1, "u", "<article>é x</article>", "t"), (2, None, None, "t"), (None, "v", "", "t"), (1, "u", "<article>é x</article>", "t")]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in queries.op4_html_text(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(1, "u", "é x", 3), (1, "u", "é x", 3), (2, None, "", 0), (None, "v", "", 0)], key=str)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.extract(empty).collect() == []


@pytest.mark.parametrize("before, after", [
    ("<body class='post has-sidebar'>", "</body>"), ("<body class='comments-open'>", "</body>"),
    ("<html class=search><body class='admin-bar search'>", "</body></html>"), ("<div class='article no-sidebar'>", "</div>"),
    ("<div id='content-with-sidebar'>", "</div>"), ("<div class='search widget'>", "</div>"), ("<form id=aspnetForm>", "</form>"),
])
def test_names_do_not_empty_a_page(tree, before, after):
    text = "The first paragraph says what happened and gives a reader more than ten words of it."
    menu, foot = "<nav><a href=1>Home</a></nav>", "<div class=sidebar>Popular things</div><footer>All rights reserved</footer>"
    for open_, close in (("<article>", "</article>"), ("<main>", "</main>")):
        page = f"{before}{menu}{open_}<header class='entry-header'><h1>Title</h1></header><p>{text}</p>{close}{foot}{after}"
        assert html.main_text(page, tree) == f"Title {text}"
    assert html.main_text(f"{before}<p>{text}</p>{after}", tree) == text


def test_aside_names_still_count(tree):
    page = ("<article><p>Text</p></article><div class='comments'><article><p>I say that this is a long comment of many words.</p>"
            "</article></div><div class='post-meta'>Filed under things</div><div class=site-header>Site</div>")
    assert html.main_text(page, tree) == "Text"


def test_apostrophes_in_unquoted_values():
    tree = html.train()
    long = "and then it goes on for a while with many words that make it a paragraph of some length"
    page = f"<article><p title=it's>First {long}.</p><p class='x' data-a=\"b's\">Second one, don't {long}.</p></article>"
    assert html.main_text(page, tree) == f"First {long}. Second one, don't {long}."
    assert [b.text for b in html.blocks("<p a = 'x>y' b=\"c>d\" e>one</p><p =x>two")] == ["one", "two"]


def test_unclosed_pages_take_linear_time():
    import time

    def seconds(page):
        begin = time.process_time()
        html.blocks(page)
        return time.process_time() - begin
    for part in ("<div>a", "<svg>", "<select>b", "<div>a</i></section>", "<p x='", "<div class=nav>a"):
        seconds(part * 100)
        assert seconds(part * 40_000) < 10 * max(seconds(part * 10_000), 0.05), part
