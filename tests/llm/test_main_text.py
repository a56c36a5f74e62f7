"""Main text of pages: hand-made pages and the whole table against its article elements."""

import html
import re

from linepareto.llm import main_text as m

LONG = "This paragraph of the article has well over a dozen words, none of them in a link at all."


def test_tree_fits_its_table():
    for row in m.TABLE:
        node = m.tree()
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        assert node == row.main


def test_page_with_everything():
    page = f"""<!DOCTYPE html><html><head><title>Site | x</title><style>p{{}}</style></head><body>
    <header><h1>Site</h1><form><label>Search</label><input></form></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
    <div class="cookie-notice"><p>We use cookies &amp; more cookies on this page, as all do.</p></div>
    <main><article><h2>Title &eacute; &#65;</h2><p>{LONG}<p>Short one.</p>
    <script>document.write("<p>no</p>")</script><!-- <p>no</p> --><p title="a > b">With <a href="x">a link</a> in it,\n and&nbsp;more   space.</p>
    <ul><li>First item</li><li>Second item</li></ul><p class="advert">Buy now</p></article></main>
    <aside><p>{LONG}</p></aside><section id="comments"><p>{LONG}</p></section><footer><p>&copy; 2024 all of it</p></footer></body>"""
    assert m.main_text(page) == "\n\n".join(["Title é A", LONG, "Short one.", "With a link in it, and more space.",
                                             "First item", "Second item"])


def test_page_without_article_element():
    page = f"<div><a href=1>Home</a></div><div><a href=2>News</a></div><h1>A title of words</h1><div>{LONG}</div><div>{LONG} And more.</div>"
    assert m.main_text(page) == "\n\n".join(["A title of words", LONG, f"{LONG} And more."])


def test_odd_pages():
    assert [m.main_text(p) for p in (None, "", "<p>", "<", "<!-- open", "<script>x", "<nav>a b</nav>")] == [""] * 7
    assert m.main_text("<article><p>a < b and c > d is not a tag here</p>") == "a < b and c > d is not a tag here"
    whole = "<article>" + "<p>some words in a paragraph" * 20_000
    assert m.main_text(whole).count("\n\n") == 19_999
    assert m.main_text('<article><p class="x' + "a" * 50_000) in ("", m.main_text('<article><p class="x' + "a" * 50_000))


def test_table(spark):
    def expected(page):
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = [re.sub(r"</?(?:b|br)>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:p|h1)>", article)]
        return "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in m.extract(pages).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == expected(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(expected(r["html"])) and got[r["page_id"]]["url"] == r["url"]


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, None, 5), (None, "u", f"<article><p>{LONG}", 6), (1, None, None, 5)],
                                  "page_id long, url string, html string, n_chars int")
    assert sorted(map(tuple, m.extract(pages).collect()), key=repr) == sorted(
        [(1, None, "", 0), (1, None, "", 0), (None, "u", LONG, len(LONG))], key=repr)
    assert m.extract(pages.limit(0)).collect() == []


def test_names_of_the_whole_page_and_parts_of_names():
    text = f"A title of words\n\n{LONG}"
    inner = f"<h1>A title of words</h1><p>{LONG}</p>"
    for page in (f'<html class="has-sidebar sidebar"><body class="no-sidebar has-comments">{inner}</body></html>',
                 f'<body class="sidebar widget">{inner}</body>',
                 f'<body><article class="post comments-open comments">{inner}</article></body>',
                 f'<body><main id="search" class="widget">{inner}</main></body>',
                 f'<div class="without-sidebar social-enabled">{inner}</div>',
                 f'<article><div class="entry-header"><h1>A title of words</h1></div><p>{LONG}</p></article>',
                 f'<article><div class="header"><h1>A title of words</h1></div><p>{LONG}</p></article>',
                 f'<div class="sidebar"><main>{inner}</main></div>',
                 f'<div class="modal"><div id="message"><article>{inner}</article></div></div>',
                 f'<div class="review-message reviews">{inner}</div>'):
        assert m.main_text(page) == text, page


def test_whole_names_still_stand_beside():
    page = f"""<body class="no-sidebar"><article><p>{LONG}</p></article><div class="sidebar-left"><p>{LONG} One.</p></div>
    <div class="widget box"><p>{LONG} Two.</p></div><section id="comments"><article class="comment"><p>{LONG} Three.</p></article>
    <article><p>{LONG} Four.</p></article></section></body>"""
    assert m.main_text(page) == LONG


def test_an_articles_own_text_stays():
    plain = " ".join(f"word{k}" for k in range(18))
    linked = f"<p><a href=x>{plain}</a></p>"
    assert m.main_text(f"<article><h1>T</h1>{linked}<p>{plain} after.</p></article>").endswith(f"{plain} after.")
    for name in ("dialog", "legal", "menu", "hint", "message"):
        assert m.main_text(f'<article><h1>Title here</h1><div class="{name}"><p>{LONG}</p></div><p>{LONG} Two.</p></article>') == \
            "\n\n".join(["Title here", LONG, f"{LONG} Two."])
    assert m.main_text("<h1>Short note</h1><p>It rains.</p><p>We stay.</p>") == "Short note\n\nIt rains.\n\nWe stay."
    assert m.main_text(f'<div class="page-header"><h1>A title of words</h1></div><div>{LONG}</div>') == f"A title of words\n\n{LONG}"


def test_names_that_must_go():
    for name in ("ad-slot", "advertisement-container", "page-footer", "commentlist", "user-comments", "responses",
                 "left-sidebar-inner"):
        for page in (f'<article><p>{LONG}</p><div class="{name}"><p>{LONG} Gone.</p></div></article>',
                     f'<article><p>{LONG}</p></article><div class="{name}"><p>{LONG} Gone.</p></div>'):
            assert m.main_text(page) == LONG, page


def test_time_grows_with_the_page():
    import time

    n = 150_000
    started = time.perf_counter()
    for page in ("<a " * n, "<article>" + "<a " * n, "<! " * n, "<script>" + "</script " * n, "<div>" * n + "</ul>" * n,
                 "<div>" * n + "</div>" * n, "<a '> " * n, "<!-- x" * n, "<a <b \"" * n + ">"):
        m.main_text(page)
    assert time.perf_counter() - started < 60


def test_open_comments_and_tags():
    assert m.main_text(f"<article><p>{LONG}</p><!-- open <p>x</p> and on") == LONG
    assert m.main_text(f"<article><p>{LONG}</p> <!-- open and on") == LONG
