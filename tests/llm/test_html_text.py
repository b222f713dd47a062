"""Main text: parts that go, parts that stay, broken markup."""

import html
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyfield.llm import html_text, queries
from tallyfield.sources.tables import load_table

BODY = "A long paragraph with many words that no menu would ever hold, and then some more of them."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<p></p><br>", ""), ("just text", "just text"),
    (f"<nav><a>Home</a></nav><article><h1>T</h1><p>{BODY}</p><p>Ok.</p></article><footer>f</footer>", f"T\n{BODY}\nOk."),
    (f"<body><div class='site-header'>x</div><div id=content><p>{BODY}<p>Short</div><div class=sideBar>y</div>", f"{BODY}\nShort"),
    (f"<article><p>{BODY}</p><section class='comments'><p>{BODY}</p></section></article>", BODY),
    (f"<article><p>{BODY}<form><input>name</form></p>after</article>", f"{BODY}\nafter"),
    ("<article><p>a &amp; b&nbsp;&lt;c&gt; &eacute;&#233;</p></article>", "a & b <c> éé"),
    ("<article><p>one<br>two\n\t three<b>bold</b></p></article>", "one two threebold"),
    (f"<article><h1>T</h1><p><b>lead<br><p>{BODY}</article><footer>no", f"T\nlead\n{BODY}"),
    (f"<main><div><p>{BODY}</p></div><div><p>Tail</p></div></main><aside>x</aside>", f"{BODY}\nTail"),
    ("<article><script>var a = '<p>x</p>';</script><style>p{}</style><p>kept</p></article>", "kept"),
    ("</div></p><article><p>kept</div></p></article>", "kept"),
    (f"<div role=navigation>menu</div><div hidden>h</div><p>{BODY}</p>", BODY),
])
def test_pages(page, text):
    assert html_text.main_text(page) == text


LONG = " ".join([BODY] * 6)


@pytest.mark.parametrize("page, text", [
    (f"<body><div class=c1><section><h2>A</h2><p>{LONG}</p><p>{LONG}</p></section><section><h2>B</h2><p>{BODY}</p></section></div>",
     f"A\n{LONG}\n{LONG}\nB\n{BODY}"),
    (f"<body><div><div><div><p>{LONG}</p><p>{LONG}</p></div></div><div><h3>Notes</h3><p>Short.</p></div></div>",
     f"{LONG}\n{LONG}\nNotes\nShort."),
    (f"<div><p>He wrote:</p><blockquote><p>{LONG}</p><p>{LONG}</p></blockquote><p>I agree.</p></div>",
     f"He wrote:\n{LONG}\n{LONG}\nI agree."),
    (f"<body><table><tr><td><p>{LONG}</p><p>{LONG}</p></td><td><p>{BODY}</p></td></tr></table>", f"{LONG}\n{LONG}\n{BODY}"),
    (f"<body><div><a>Home</a> <a>About</a></div><div><p>{LONG}</p></div><div><p>End.</p></div><ul><li><a>Next</a></ul>",
     f"{LONG}\nEnd."),
    (f"<p>Intro.</p><div><p>{LONG}</p><p>{LONG}</p></div>", f"Intro.\n{LONG}\n{LONG}"),
    (f"<body><div><a>Home</a> <a>About</a></div><div><p>{LONG} <a>link</a></p></div>", f"{LONG} link"),
])
def test_sections_without_an_article_stay(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (f"<article class='post with-sidebar'><p>{BODY}</p></article>", BODY),
    (f"<div id='content' class='no-comments has-ads'><p>{BODY}</p></div>", BODY),
    (f"<article><h2 id='search-algorithms'>S</h2><p>{BODY}</p><h2 id='social-effects'>E</h2><p>Ok.</p></article>",
     f"S\n{BODY}\nE\nOk."),
    (f"<article><p>{BODY}</p><section id='related-work'><h2 id=header>R</h2><p class=notice>Ok.</p></section></article>",
     f"{BODY}\nR\nOk."),
    (f"<main class=main-form><p>{BODY} <span class=share>now</span></p></main>", f"{BODY} now"),
    (f"<article><p>{BODY}</p><div class='post ad'>no</div><div class='share-buttons'>no</div><section id=relatedPosts>no"
     "</section><div class='ad-slot-2'>no</div><ul class=site-nav><li>no</ul></article>", BODY),
])
def test_names_of_parts_count_as_a_whole_on_blocks(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (f"<main><article><p>{LONG}</p></article><section class=reader-comments><p>{BODY}</p></section></main>", LONG),
    (f"<article><p>{LONG}</p><div class=post-comments><p>{BODY}</p></div><div id=user-comments>{BODY}</div></article>", LONG),
    (f"<main><h1>T</h1><p>{LONG}</p><article class=comment><p>{BODY}</p></article><article class='comment-12'>{BODY}</article></main>",
     f"T\n{LONG}"),
    (f"<article><p>{LONG}</p><article><p>{BODY}</p></article><article><p>{BODY}</p></article></article>", LONG),
    (f"<article class=post><h1>T</h1><article class=entry><p>{LONG}</p></article></article>", LONG),
    (f"<article><p>{LONG}</p><p class=ad>{BODY}</p><figure class=advert>{BODY}</figure><div class=google-ad>{BODY}</div>"
     f"<div class=ad-300x250>{BODY}</div><p>End</p></article>", f"{LONG}\nEnd"),
    (f"<main><article><h1>T</h1><p>{LONG}</p></article><section class=more-stories><h2>More</h2><p>{BODY}</p></section></main>",
     f"T\n{LONG}"),
    (f"<article><header><h1>Head</h1><p>By one</p></header><p>{LONG}</p></article>", f"Head\nBy one\n{LONG}"),
    (f"<body><header><h1>Site</h1></header><div><p>{LONG}</p></div>", LONG),
    (f"<article><header><p>Menu</p></header><p>{LONG}</p></article>", LONG),
    (f"<article><p>{LONG}</p><table class=form><tr><td>{BODY}</td><td>cell</td></tr></table></article>", f"{LONG}\n{BODY}\ncell"),
    (f"<article><p>{LONG}</p><section id=search><h2>S</h2><p>{BODY}</p></section><div class=search>Find</div></article>",
     f"{LONG}\nS\n{BODY}"),
    (f"<article class='comments-open'><p>{LONG}</p><section id='ad-hoc-work'><p>{BODY}</p></section></article>", f"{LONG}\n{BODY}"),
    (f"<article><p>{LONG}</p><h2 id=comments>C</h2><p>{BODY}</p></article>", f"{LONG}\nC\n{BODY}"),
])
def test_what_names_and_places_decide(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<p>Use <![ in C</p><p>ok</p>", "Use\nok"), ("<p>a</p><![ y><p>b</p>", "a\nb"), ("<p>a<![1]>b</p>", "ab"), ("a<![b] c", "a"),
    ("<p>a<![if !IE]>b<![endif]>c</p>", "abc"), ("<p>a<![CDATA[x]]>b</p>", "ab"), ("<p>a<!-- b --!>c<!-->d<!--->e</p>", "acde"),
    ("<p>a</p><!-- <p>b</p> <p>c</p>", "a"), ("<p>a</p>b <a href='x", "a\nb"), ("<p>1 < 2</p>3 < 4 &amp; 5", "1 < 2\n3 < 4 & 5"),
    ("<p>a</p><script>b</p> c", "a"), ("<!doctype html [<!ELEMENT x>]><p>a</p>", "]>\na"), ("<p a='b>c</p>d", "c\nd"),
    ("<!DOCTYPE><p>a<?php x ?>b</p>", "ab"), ("</><//a><p>a</p><", "a\n<"),
])
def test_broken_declarations(page, text):
    assert html_text.main_text(page) == text


@settings(deadline=None, max_examples=300)
@given(st.lists(st.sampled_from(
    ["<![", "<!", "<!--", "-->", "]>", "]]>", "<a ", "<a b='", '<p c="', "<p>", "</p>", "<div>", "</div>", "<article>", "</article>",
     "<header>", "</header>", "<script>", "</script", "<td>", "<li>", "</", "<?", "<", ">", "&", "&#", "&amp", "x y", "=", "/", "'", '"',
     "<section class=comments>", "</section>", "<h1>", "<b>", "</i>", "\0", "<br/>", "<!doctype ", "<![if"]), max_size=40).map("".join))
def test_any_markup_is_read(page):
    text = html_text.main_text(page)
    assert all(line and line == " ".join(line.split()) for line in text.split("\n")) or text == ""


@pytest.mark.parametrize("piece", [
    "<a ", "<div><p>x", "<!--", "<!-- x>", "<![ ", "<![x>", "<header><h1>x", "<article>x ", "</p>", "<b></i>", "<i><div><b>", "<td>x",
    "<p a='", '<p a="x', "</a ", "&", "&#x", "<table class=form>x", "<li><ul>", "<a / ", "<script>", "<x/><", "< "])
def test_time_grows_as_the_length(piece):
    page = f"<div><p>{LONG}</p>" + piece * (1_000_000 // len(piece))
    start = time.process_time()
    html_text.main_text(page)
    html_text.main_text(page + ">")
    assert time.process_time() - start < 12


def test_clusters():
    assert html_text.high(html_text.np.array([1.0, 1, 1, 50, 60])).tolist() == [False] * 3 + [True] * 2
    assert html_text.high(html_text.np.array([4.0, 4])).all()


def test_edge_rows(spark):
    long = "<article>" + "<p>paragraph</p>" * 30_000 + "</article>"
    rows = [(1, "u", None, "old", "old"), (1, "u", "", "", ""), (2, None, long, "", ""), (2, None, long, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars string")
    found = sorted([(r.page_id, r.url, len(r.text), r.n_chars) for r in html_text.extract(pages).collect()], key=repr)
    n = len("paragraph\n") * 30_000 - 1
    assert found == [(1, "u", 0, 0), (1, "u", 0, 0), (2, None, n, n), (2, None, n, n)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_query_gives_the_articles(spark, sf):
    """On the supplied pages the article element is what is wanted."""
    pages = {r.page_id: r.html for r in load_table(spark, sf, "pages").collect()}
    found = queries.op10_html_text(spark, sf).collect()
    assert len(found) == len(pages)
    for r in found:
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S).group(1)
        inner = html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\n", inner))))
        assert r.text == "\n".join(x for x in (" ".join(line.split()) for line in inner.split("\n")) if x)
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize("page, text", [
    ('<p a="b>c</p>d', "c\nd"), ("<div class='x>y</div>z", "y\nz"), ("<script a='b>x</p></script><p>q</p>", "q"),
    ("<p>a</p><br a='b/>c", "a\nc"),
])
def test_unclosed_quote_ends_with_its_tag(page, text):
    """A start tag whose quote is never closed is markup, not text."""
    assert html_text.main_text(page) == text
