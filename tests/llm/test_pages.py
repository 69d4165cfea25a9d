import html
import re

import duckdb

from gridtide.llm.catalogue import QUERIES
from gridtide.llm.pages import blocks, extract_text, main_text, train_tree

FOLDER = "/root/testdata/sf0.01"


def plain_text(page):
    """The article of the test tables' template."""
    article = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
    return "\n\n".join(p for p in parts if p)


def test_whole_table(spark):
    got = {r.page_id: r for r in QUERIES["op9_html_text"](spark, FOLDER).collect()}
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{FOLDER}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    for k, url, page in rows:
        assert (got[k].url, got[k].text, got[k].n_chars) == (url, plain_text(page), len(plain_text(page)))


def test_templates():
    tree = train_tree()
    long = "Some words of a longer paragraph that says one thing after another without any link in it at all, and goes on. "
    assert main_text(f"<body><header><h1>Site</h1></header><main><h1>T &amp; U</h1><p>{long}<p>Short.</main><aside>{long}</aside>", tree) == f"T & U\n\n{long.strip()}\n\nShort."
    assert main_text(f'<div class="cookie-notice">{long}</div><article><p>x&nbsp;y<br>z</p><form>a <input>b</form><section id="comments"><p>{long}</section></article>', tree) == "x y z"
    assert main_text(f"<ul><li><a href='/x'>One</a><li><a href='/y'>Two</a></ul><p>{long * 2}</p><p>{long}</p>", tree) == f"{(long * 2).strip()}\n\n{long.strip()}"
    assert main_text(f"<article><p>{long}<script>if (a < b) document.write('<p>no')</script><style>p > a {{}}</style><!-- <p>no --></article>", tree) == long.strip()
    assert main_text(f"<article><p>{long}</p><p class='a", tree) == long.strip()
    assert [b.text for b in blocks("a &lt;b&gt; <b>bo</b>ld <i>x</i></p>c")] == ["a <b> bold x", "c"]


def test_odd_rows(spark):
    pages = [(1, None, "x"), (2, "", "x"), (3, "<", "x"), (3, "<", "x"), (None, "<article>" + "<p>many words here" * 20_000, "x"), (4, "<p" * 5000, "x"), (5, "<a " * 20_000, "x"), (6, "&#0; &bogus; &", "x")]
    got = extract_text(spark.createDataFrame(pages, "page_id long, html string, text string")).collect()
    assert len(got) == len(pages) and got[0].text == got[1].text == ""
    assert got[4].n_chars == 20_000 * 15 + 19_999 * 2
    assert extract_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_elements_that_are_never_closed():
    """The text behind them is kept; what is closed stays silent."""
    tree = train_tree()
    long = "Some words of a longer paragraph that says one thing after another without any link in it at all, and goes on."
    article = f"<article><p>{long}</p><p>{long}</p></article>"
    whole = f"{long}\n\n{long}"
    assert main_text(f"<html><head><title>x</title><meta charset=utf-8><body>{article}", tree) == whole
    assert main_text(f"<html><head><title>x</title>{article}", tree) == whole
    assert main_text(f"<head><title>x</title><script>1</script><a href=/>{article}", tree).endswith(whole)
    assert [b.text for b in blocks("<head><title>x</title> Text")] == ["Text"]
    for name in ("select", "button", "object", "video", "map", "canvas", "audio", "svg", "iframe", "noscript", "textarea"):
        assert main_text(f"<div><{name}>{article}</div>", tree) == whole, name
        assert main_text(f"<div><{name}>Menu</div>{article}", tree) == whole, name
        assert main_text(f"<{name}>{article}<p><{name}>x</{name}></p>", tree) == whole, name
        assert blocks(f"<div><{name}><div>{long}</div><p>{long}</{name}></div>") == [], name
    assert main_text(f"<select><option>a<option>b{article}", tree) == whole
    assert blocks(f"<select><option>a<option>b</select><template><p>{long}</template><object><object>x</object><p>{long}</object>") == []


def test_container_is_one_feature():
    """Long text is kept in wrappers with telling names, and lists of links are not in articles."""
    tree = train_tree()
    words = "Some words of a longer paragraph that says one thing after another without any link in it at all, and goes on. " * 3
    long = words.strip()
    article = f"<article><h1>Title</h1><p>{long}</p><p>Short.</p></article>"
    for wrapper in ("div class='content has-sidebar'", "div class='layout with-nav'", "div id=share-page", "div id='legal'", "div class='ad sidebar'", "div class=notice", "form action=/", "section class=search"):
        close = f"</{wrapper.split()[0]}>"
        assert main_text(f"<body><{wrapper}>{article}{close}", tree) == f"Title\n\n{long}\n\nShort.", wrapper
        assert main_text(f"<body><{wrapper}><p>{long}</p><p>{long}</p>{close}", tree) == f"{long}\n\n{long}", wrapper
    links = "<ul>" + "<li><a href=/x>One more story here</a></li>" * 5 + "</ul>"
    assert main_text(f"<article><p>{long}</p>{links}<p>{long}</p></article>", tree) == f"{long}\n\n{long}"
    assert main_text(f"<article><p>{long}</p></article><section class=comments><p>Nice one.</p><article class=comment>Me too.</article></section><aside><article>Ad.</article></aside>", tree) == long
    for name in ("aside", "footer", "nav"):
        assert main_text(f"<article><p>{long}</p></article><{name}><p>{long}</p></{name}>", tree) == long
        assert main_text(f"<{name}>x<main><p>Short.</p><p>{long}</p></main>", tree) == f"Short.\n\n{long}"


LONG = "Some words of a longer paragraph that says one thing after another without any link in it at all, and goes on. " * 4
LONG = LONG.strip()


def test_boilerplate_beside_an_article():
    """Comments, notices, adverts, sidebars, forms and headers stay out at any length, before, after and inside an article."""
    tree = train_tree()
    article = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p>"
    text = f"Title\n\n{LONG}\n\nShort."
    for open_, close in (
        ("<section class=comments>", "</section>"), ("<ol><li class='comment even'>", "</li></ol>"), ("<div class='cookie-notice'>", "</div>"),
        ("<div class=advert>", "</div>"), ("<div class=sidebar>", "</div>"), ("<div class=footer>", "</div>"), ("<div id=comments>", "</div>"),
        ("<div class=notice>", "</div>"), ("<table class=promo><tr><td>", "</table>"), ("<form>", "</form>"), ("<header>", "</header>"),
        ("<dl class=related-posts><dd>", "</dl>"), ("<section id=comments><article>", "</article></section>"), ("<blockquote class=ad>", "</blockquote>"),
    ):
        for n in (1, 4):
            other = open_ + f"<p>{LONG}</p>" * n + "<p>Few words.</p>" + close
            assert main_text(f"<body><article>{article}</article>{other}</body>", tree) == text, open_
            assert main_text(f"<body>{other}<article>{article}</article></body>", tree) == text, open_
            if "header" not in open_ and n == 1:
                inside = f"<article>{article}<p>{LONG}</p>{other}</article>"
                assert main_text(inside, tree) == f"{text}\n\n{LONG}", open_
    comments = f"<section class=comments><p>{LONG}</p></section>" * 6
    assert main_text(f"<article>{article}{comments}</article>", tree) == text


def test_links_in_an_article_are_text():
    tree = train_tree()
    page = f"<nav><a href=/>Home</a></nav><article><header><h1><a href=/a>A linked heading</a></h1></header><p>{LONG}</p><h2><a href=/b>More</a></h2><p><a href=/c>One linked paragraph</a></p><p>End.</p></article>"
    assert main_text(page, tree) == f"A linked heading\n\n{LONG}\n\nMore\n\nOne linked paragraph\n\nEnd."


def test_wrappers_hold_the_page():
    """A name or a form around most of the page says nothing; comments may hold no more than nearly all of it."""
    tree = train_tree()
    article = f"<article><p>{LONG}</p><p>{LONG}</p></article>"
    for wrapper in ("<div class='ad sidebar'>", "<form action=/>", "<div id=search>", "<body class=comments>"):
        assert main_text(f"{wrapper}{article}<div class=sidebar><p>{LONG}</p></div>", tree) == f"{LONG}\n\n{LONG}", wrapper
    assert main_text(f"<div class=discussion>{article}</div>", tree) == f"{LONG}\n\n{LONG}"
