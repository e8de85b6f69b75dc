from __future__ import annotations

import pytest

from tariffmart.llm.main_text import blocks, extract, general, main_text, side_parts


@pytest.fixture(scope="module")
def pages(spark):
    return lambda *rows: spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, text string, host int")


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><a href='/x'>Menu</a></nav>"
    "<div class='ad'>Buy this now, really.</div><!-- <p>hidden</p> --><div class='post body-1'><h1>Head &amp; line</h1><p>First  text,\n with words. <b>Bold</b>.<br>Next"
    "<p>Second &eacute;&#233; one.</p><form><p>Send</p></form><div class='comments'><p>A reader says much, much, much more than all.</p></div></div>{more}"
    "<aside><p>Aside</p></aside><footer>&copy; me</footer></body></html>"
)
TEXT = "Head & line\n\nFirst text, with words. Bold. Next\n\nSecond éé one."


def test_article_only(pages):
    got = main_text(pages((1, "http://h.example/a", PAGE.format(more=""))))
    assert got.columns == ["page_id", "url", "text", "n_chars"] and [tuple(r) for r in got.collect()] == [(1, "http://h.example/a", TEXT, len(TEXT))]


def test_neighbours_decide_for_a_misleading_page(pages):
    odd = PAGE.format(more="<div class='links2'><p>" + "long text about other things, and others. " * 30 + "</p></div>")
    rows = [(i, f"https://H.example:80/{i}", PAGE.format(more="")) for i in range(6)] + [(9, "https://h.example/9", odd), (10, "https://other.example/9", odd)]
    got = {r["page_id"]: r["text"] for r in main_text(pages(*rows)).collect()}
    assert got[9] == TEXT and got[10] != TEXT


def test_edges(pages):
    rows = [(1, None, None), (1, None, None), (2, "x", ""), (3, "not a url", "plain & simple"), (None, "http://a", "<p>one<p>two"), (4, "http://b", "<div"), (5, "http://b", "<p>a < b &am")]
    got = main_text(pages(*rows)).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in got) == [(0, "one\n\ntwo"), (1, ""), (1, ""), (2, ""), (3, "plain & simple"), (4, ""), (5, "a < b &am")]
    assert main_text(pages()).collect() == []
    long = "<p>" + "word " * 200_000 + "</p>" + "<div>" * 5000
    assert main_text(pages((1, "http://c", long))).first()["n_chars"] == 5 * 200_000 - 1


def test_broken_markup():
    assert [t for _, t, _ in blocks("<p>a<script>never closed <p>b")] == ["a"]
    assert [t for _, t, _ in blocks("<p title='x>y'>in</p><p title='open>out</p>")] == ["in", "out"]
    assert extract("<ul><li>one<li>two</ul><table><tr><td>c<td>d</table>", None) == "one\n\ntwo\n\nc\n\nd"


def test_given_pages_hold_the_article(spark):
    got = main_text(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    html = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    import html as entities
    import re

    for r in got.collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", html[r["page_id"]], re.S)[1]
        want = " ".join(entities.unescape(re.sub(r"</?[a-z][^>]*>", " ", article)).split())
        assert " ".join(r["text"].split()) == want


def test_siblings_and_heading_of_the_article_stay(pages):
    part = lambda n, tag: f"<{tag}><p>" + f"Words of part {n}, and more. " * n + f"</p></{tag.split()[0]}>"
    many = lambda outer: f"<body><{outer}>" + "".join(part(n, f"section class={c}") for n, c in ((3, "intro"), (40, "body"), (2, "end"))) + f"</{outer.split()[0]}></body>"
    led = lambda outer: f"<body><{outer}><h1>Heading</h1><p>A lead.</p>" + part(90, "div class=body") + f"</{outer.split()[0]}></body>"
    forms = [f(o) for f in (many, led) for o in ("article", "div class=post")]
    rows = [(10 * k + i, f"http://h{k}.example/{i}", form) for k, form in enumerate(forms) for i in range(3)]
    for r in main_text(pages(*rows)).collect():
        text = r["text"]
        assert all(f"part {n}" in text for n in (3, 40, 2)) if r["page_id"] < 20 else text.startswith("Heading\n\nA lead.\n\nWords of part 90")


def test_a_rarer_template_keeps_its_text(pages):
    usual = "<body><div class=content><p>" + "The usual text, at length. " * 20 + "</p></div></body>"
    rarer = "<body><div class=content><p>A summary.</p></div><div class=story><p>" + "The story of it, at length. " * 20 + "</p></div></body>"
    rows = [(i, f"http://h.example/{i}", rarer if i < 3 else usual) for i in range(30)]
    got = {r["page_id"]: r["text"] for r in main_text(pages(*rows)).collect()}
    assert all(("The story" in t and "A summary." in t) if i < 3 else t.startswith("The usual") for i, t in got.items())


def test_pages_without_prose_have_no_vote(pages):
    rows = [(i, "http://l.example", "<div><a href=x>only a link</a></div>") for i in range(3)]
    assert [r["text"] for r in main_text(pages(*rows)).collect()] == [""] * 3


BODY = "<p>" + "Words of the article, at length. " * 20 + "</p>"


@pytest.mark.parametrize(
    "opened",
    ["<div class='site-content has-sidebar'>", "<div class='content no-sidebar'>", "<div class='main no-comments'>", "<div class='post-12 type-post category-social'>"]
    + ["<article class='tags teaser'>", "<main id=search>", "<form id=aspnet>", "<div class=sidebar>", "<div class='post comments-open'>", "<head><title>T</title><body>"]
    + ["<nav><a href=/x>Home</a><article>", "<header><div>Site</div><main>", "<nav><a href=/x>Home</a><div class=text>", "<form><div class=text>"],
)
def test_wrappers_and_unclosed_elements_keep_the_article(pages, opened):
    beside = "<div class=sidebar><p>Side.</p></div><div id=site-header>Site.</div><div class='ad-box'>Buy.</div>"
    got = main_text(pages((1, "http://h.example/a", f"<html>{opened}{beside}{BODY}</div></html>"))).first()["text"]
    assert "Words of the article" in got and not any(w in got for w in ("Side.", "Site.", "Buy."))


def test_long_comments_and_short_articles():
    talk = "<p>" + "A reader says much, and more. " * 30 + "</p>"
    assert extract(f"<div class=post><p>Short text, but the text.</p></div><div class=comments>{talk}</div>", None) == "Short text, but the text."
    assert extract(f"<article><p>Short.</p></article><div class=ad>{talk}</div><ol class=comment-list><li><article>{talk}</article></ol>", None) == "Short."
    assert extract(f"<div class=comments>{talk}</div>", None) == talk[3:-5]


def test_made_class_names_are_one_container(pages):
    assert [general(t) for t in ("css-1ab9x", "sc-bdvaja", "css-kqe", "post__3xyz", "body-1", "h2", "content", "jsx-28712", "xkqzw")] == ["", "", "", "post", "body-", "h", "content", "", ""]
    made = lambda i: f"css-{'abcdefghij'[i]}{i}x{'qrstuvwxyz'[-i]}"
    page = lambda i, more="": f"<body><div class={made(i)}><section class=text><p>The text of it, at length.</p></section></div>{more}</body>"
    odd = "<div class=links><p>" + "long text about other things, and others. " * 30 + "</p></div>"
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(9)] + [(9, "http://h.example/9", page(9, odd))]
    assert {r["text"] for r in main_text(pages(*rows)).collect()} == {"The text of it, at length."}


PROSE = "<p>" + "Words of the article, at length, and more of them. " * 30 + "</p>"


@pytest.mark.parametrize(
    "page,kept",
    [
        (f"<body><nav><a href=/>Home</a></nav><h1>Headline</h1><div class=content>{PROSE}</div><footer>Foot.</footer></body>", ["Headline"]),
        (f"<body><p>A lead.</p><div class=content>{PROSE}</div><p>The closing.</p><div class=sidebar><p>Foot.</p></div></body>", ["A lead.", "The closing."]),
        (f"<article><h1>T</h1>{PROSE}<div class='share-price'>{PROSE.replace('Words', 'Prices')}</div></article>", ["Prices"]),
        (f"<article><h1>T</h1>{PROSE}<section class='search-history'>{PROSE.replace('Words', 'Searches')}</section></article>", ["Searches"]),
        (f"<article><h1>T</h1>{PROSE}<p class='related-work'>Others did so.</p></article>", ["Others did so."]),
        (f"<article><h2 id='social-history'>A history</h2>{PROSE}</article>", ["A history"]),
        (f"<article><h2 id='search'>The search</h2>{PROSE}<div class='related-posts'><p>Foot.</p></div></article>", ["The search"]),
        (f"<article><h1>T</h1><p>Short.</p><div class='widget'>{PROSE}</div><div class='comments'><p>Foot.</p></div></article><div class=ad>Foot.</div>", ["Short.", "Words of"]),
    ],
)
def test_article_text_is_not_lost_to_names_or_places(pages, page, kept):
    for got in (extract(page, None), main_text(pages(*[(i, f"http://h.example/{i}", page) for i in range(3)])).first()["text"]):
        assert all(k in got for k in [*kept, "Words of the article"]) and "Foot." not in got and "Home" not in got


def test_names_of_side_parts():
    beside = ["sidebar", "site-header", "ad-box", "comment-list", "newsletter-signup", "main-nav", "cookie_notice", "related-posts", "page-footer", "social-share", "ad-728"]
    about = ["share-price", "search-history", "related-work", "social-history", "has-sidebar", "menu-open", "header-image-study", "adverse", "tags-of-war"]
    assert [n for n in beside if not side_parts(n)] == [] and [n for n in about if side_parts(n)] == []
