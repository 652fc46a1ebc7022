import html as entities
import re
import time

import pytest

from ebbtide.llm import html_text
from ebbtide.llm.common import read

PAGE = """<!doctype html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body class="has-sidebar"><header><h2>Site name</h2></header><nav><ul><li><a href=/>Home</a><li>About</ul></nav>
<div class="cookie-notice">We use cookies, a long sentence about cookies that nobody reads at all, really.</div>
<div id=wrap><article><header><h1>Head &lt;1&gt;</h1></header>
<p>First   para&shy;graph
with <b>bold <i>and</b> &eacute;&nbsp;more</i> text that goes on for a while.<p>Short.
<div class="ad">Buy now</div><ul><li>one<li>two <span class="ad-label">advert</span></ul>
<table><tr><td>cell a<td>cell b</table><!-- no --><form><input value=x>Name <button>Send</button></form>
<h2>Next</h2>Loose text<br>after a break.<blockquote><p>Quoted.</blockquote></article>
<aside>Other things</aside><section id="comments"><p>Nice article, I liked it very much indeed, thank you.</p></section></div>
<footer>&copy; All of us</footer></body></html>"""


def test_a_page_with_everything():
    assert html_text.main_text(PAGE).split("\n\n") == [
        "Head <1>", "First para\xadgraph with bold and é more text that goes on for a while.", "Short.", "one", "two",
        "cell a", "cell b", "Next", "Loose text after a break.", "Quoted."]


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<p></p>", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\n\nb"), ("<script>x", ""), ("<", "<"),
    ("<body><div><p>" + "long text " * 30 + "</p><p>x</p></div><div class=sidebar>y</div>", "long text " * 29 + "long text\n\nx"),
    ("</p></div>a &lt; b &#x41; &bogus;", "a < b A &bogus;"), ("<nav>only a menu</nav>", ""),
    ("<main><p>m</p><div hidden>h</div><div style='display: none'>s</div></main>", "m"),
])
def test_small_and_broken_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("a<![x]>b", "ab"), ("a<![]>b", "ab"), ("a<![ foo]>b", "ab"), ("<![1 2]>", ""), ("a<![if !IE]>b<![endif]>c", "abc"),
    ("a<![CDATA[b]]>c", "ac"), ("<p>a<svg><text><![CDATA[x > y]]></text></svg>b", "a\n\nb"), ("a<![open", "a"), ("a<![", "a"),
])
def test_marked_sections_are_comments(page, text):
    assert html_text.main_text(page) == text


LONG, MORE = "long text of the article " * 30, "another part of the same article " * 8


def blocks(*texts):
    return "\n\n".join(t.strip() for t in texts)


@pytest.mark.parametrize("page, text", [
    (f"<div id=page><h1>Headline</h1><div class=text><p>{LONG}</p><p>{MORE}</p></div></div>", blocks("Headline", LONG, MORE)),
    (f"<div id=page><h2>Headline</h2><p>By me</p><div class=text><p>{LONG}<p>{MORE}</div></div>",
     blocks("Headline", "By me", LONG, MORE)),
    (f"<div><section><p>{LONG}</p></section><section><p>{MORE}</p></section></div>", blocks(LONG, MORE)),
    (f"<table><tr><td><p>{LONG}</p></td><td><p>{MORE}</p></td></tr></table>", blocks(LONG, MORE)),
    (f"<main><article><p>{LONG}</p></article><section><p>{LONG}</p></section></main>", blocks(LONG, LONG)),
    (f"<main><h1>Headline</h1><article><h2>a</h2><p>{LONG}</p></article></main>", blocks("Headline", "a", LONG)),
    (f"<div><article><p>{LONG}</p></article><article><p>{MORE}</p></article></div>", blocks(LONG, MORE)),
    (f"<ul><li>Home</ul><div id=page><h1>Headline</h1><div><div><p>{LONG}</div></div></div>", blocks("Headline", LONG)),
])
def test_the_whole_article_is_kept(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (f"<body><form id=aspnetForm><nav><a href=/>Home</a></nav><article><h1>Head</h1><p>{LONG}</p><p>Short.</p></article>"
     "<label>Name</label><input value=x><button>Send</button></form>", blocks("Head", LONG, "Short.")),
    (f"<body><form id=aspnetForm><div><h1>Head</h1><div><p>{LONG}<p>{MORE}<label>Name</label></div></div>"
     f"<div id=comments><p>{MORE}</div></form>", blocks("Head", LONG, MORE)),
    (f"<div class='page-with-comments'><h1>Head</h1><div class=text><p>{LONG}<p>{MORE}</div>"
     f"<div class=comments><p>{MORE}</div></div><footer>us</footer>", blocks("Head", LONG, MORE)),
    (f"<div class='post related-1'><p>{LONG}</p><p>{MORE}</p></div>", blocks(LONG, MORE)),
    (f"<body><div class='site-search-open'><form><main><p>{LONG}</p><form>Find</form></main></form></div>", blocks(LONG)),
    (f"<h1>Head</h1><form><div><p>{LONG}</p></div></form>", blocks("Head", LONG)),
    # what stands beside an article stays out, however long
    (f"<div><p>{MORE}</p></div><div id=comments><p>{LONG}</p><p>{LONG}</p></div>", blocks(MORE)),
    (f"<article><p>{MORE}</p></article><ol class=comment-list><li>{LONG}</ol>", blocks(MORE)),
    (f"<article><p>{LONG}</p></article><aside><article>{MORE}</article></aside>", blocks(LONG)),
    (f"<div hidden><article><p>{LONG}</p></article></div><p>shown", "shown"),
])
def test_an_article_inside_of_a_form_or_a_named_element(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (f"<div id=top><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></div><div id=main-col><h1>Head</h1><p>{LONG}<p>{MORE}"
     "</div><div class=col-right><ul><li><a href=/1>An older story</a><li><a href=/2>Another one</a></ul></div>", blocks("Head", LONG, MORE)),
    (f"<article><p>{LONG} See <a class='social'>this</a> link, and <span class=share>share</span> it.</p></article>",
     blocks(LONG + "See this link, and share it.")),
    (f"<article><p>{LONG} The <label>word</label> stays.</p></article>", blocks(LONG + "The word stays.")),
    (f"<div><p>{LONG} <a href=x>{MORE}</a></p><ul><li>one<li><a href=y>two</a> and three</ul></div>",
     blocks(LONG + MORE, "one", "two and three")),
    ("<p>Good text.</p><!-- truncated", "Good text."), ("<p>Good text.</p><a href=x", "Good text."), ("<p>a<!-- c --!>b", "ab"),
    ("<p>a<!-->b<!--->c<!-- > -->d", "abcd"), ("<p>a</", "a"), ("<p>1 < 2", "1 < 2"), ("<p>a<!doctype", "a"),
    ("<i>a<div>b</i>c</div>d", "a\n\nbc\n\nd"), ("<a href=/>only a link</a>", "only a link"),
])
def test_menus_inline_names_and_cut_off_markup(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("unit", [
    ("<div>", "</p>"), ("<div>", "</section>"), ("<a ", ""), ("<!--", ""), ("<!doctype ", ""), ("</a ", ""), ("<header>", ""), ("<b>", "x<hr>"),
    ("<i><div><b>", "</i>"), ("<div>", "x</div>"), ("<ul>", "<li>x"), ("<![", ""), ("<p>x<b>", ""), ("<?", "")])
def test_time_grows_with_the_page(unit):
    """A hostile page of a megabyte."""
    n = 1_000_000 // len("".join(unit))
    begun = time.process_time()
    html_text.main_text(unit[0] * n + unit[1] * n)
    html_text.main_text((unit[0] + unit[1]) * n + ">")
    assert time.process_time() - begun < 30


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 20_000 + "deep") == "deep"
    text = "\n\n".join(f"p{i}" for i in range(20_000))
    assert html_text.main_text("<article>" + "".join(f"<p>p{i}" for i in range(20_000))) == text


def test_articles_of_the_test_pages(spark):
    """Against the blocks between the article's own tags."""
    pages = read(spark, "/root/testdata/sf0.01", "pages")
    truth = {}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", " " if t else "", b)).split())
                  for t, b in ((0, b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", body))]
        truth[r.page_id] = "\n\n".join(b for b in blocks if b)
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert found == truth


def test_null_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (None, None, "<p>a", "y"), (1, "u", None, "x")],
                                  "page_id long, url string, html string, text string")
    assert sorted(map(tuple, html_text.extract(pages).collect()), key=repr) == [(1, "u", "", 0)] * 2 + [(None, None, "a", 1)]
    assert html_text.extract(pages.limit(0)).count() == 0
