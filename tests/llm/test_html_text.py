import html
import re

import numpy as np
import pytest

from changeflow.llm.html_text import extract, main_text, threshold
from changeflow.llm.queries import RUNS

PROSE = "The river runs past the old mill and the town square towards the sea. " * 4
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(8)) + "</ul>"


def brute(page):
    """The blocks of the only article of a page of the test tables."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    texts = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_whole_table(spark, folder):
    rows = spark.read.parquet(f"{folder}/pages.parquet").collect()
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"])
           for r in RUNS["op9_html_text"](spark, folder).collect()}
    assert len(got) == len(rows)
    for row in rows:
        want = brute(row["html"])
        assert got[row["page_id"]] == (row["url"], want, len(want))


@pytest.mark.parametrize("page, want", [
    ("", ""), ("   \n", ""), ("no markup  at\nall", "no markup at all"),
    ("<article><h1>A</h1><p>B</article>", "A\nB"),
    (f"<nav>{MENU}</nav><div class='cookie-notice'>We use cookies {PROSE}</div><div id=main><h2>T</h2>"
     f"<p>{PROSE}</p><p>Short.</p><p>{PROSE}</p><p>End</p></div><div class='sideBar'>{MENU}</div>"
     f"<section id='comments'><p>{PROSE}</p></section><footer>F</footer>",
     f"T\n{PROSE.strip()}\nShort.\n{PROSE.strip()}\nEnd"),
    (f"<div>{MENU}</div><div><p>{PROSE}<p>a<i>b</i>c &amp;amp; &eacute;&#233;&nbsp;x<br>y</div>"
     f"<div>{MENU}</div>", f"{PROSE.strip()}\nabc &amp; éé x y"),
    ("<article>a<script>if (a < b) '</p>'</script>b<style>p{}</style><form><p>f</p></form></article>",
     "a\nb"),
    ("<main><header><h1>H</h1></header><p>x</p><aside>s</aside></main>", "H\nx"),
    ("<header>H</header><article><p>x <b>bold</i> y</p></b> z</article>", "x bold y\nz"),
    ("<article><p hidden>h</p><p style='display: none'>h</p><p role=alert>h</p><p>x", "x"),
    (f"<article><p>{PROSE}</p></article><article><p>{PROSE}</p></article>",
     f"{PROSE.strip()}\n{PROSE.strip()}"),
    ("<article><p>1 < 2 &lt; 3</p><!-- c --><p>x</p", "1 < 2 < 3\nx"),
    ("<nav>only a menu", ""),
])
def test_pages(page, want):
    assert main_text(page) == want


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000 + "</p></b>" * 20_000
    assert main_text(deep) == "x"
    assert main_text("<p><b>y<br>" * 50_000).count("y") == 50_000
    assert len(main_text("<article>" + "word " * 400_000)) == 5 * 400_000 - 1


def test_threshold():
    assert threshold(np.array([1.0, 2.0, 30.0, 32.0])) == 16.25
    assert threshold(np.array([5.0])) == 5.0
    assert threshold(np.array([4.0, 6.0])) == 4.0


def test_odd_rows(spark):
    rows = [(1, "u", None, "t", 1), (None, None, "", None, 2), (3, "v", "<p>a</p>", "x", 3),
            (3, "v", "<p>a</p>", "x", 3)]
    table = spark.createDataFrame(
        rows, "page_id bigint, url string, html string, Text string, read int")
    got = extract(spark, table)
    assert got.columns == ["page_id", "url", "read", "text", "n_chars"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        (1, "u", 1, "", 0), (None, None, 2, "", 0), (3, "v", 3, "a", 1), (3, "v", 3, "a", 1)]))
    assert extract(spark, table.limit(0)).collect() == []


@pytest.mark.parametrize("page", [
    "<article class='post has-sidebar'>{}</article>", "<main class='content no-banner'>{}</main>",
    "<div class='elementor-widget-container'>{}</div>", "<div id='related-work'>{}</div>",
    "<article class='status-publish comments'>{}</article>", "<div class='ad-free'>{}</div>",
    "<form id=aspnetForm>{}</form>", "<div class='widget'><main>{}</main></div>",
    "<div id=page-header><div class=promo>{}</div></div>", "<div class=overlay>{}</div>",
])
def test_names_do_not_hide_the_content(page):
    text = f"<h1>T</h1><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p>"
    notice = f"<div class='cookie-notice'><p>{PROSE}</p></div>"
    want = f"T\n{PROSE.strip()}\nShort.\n{PROSE.strip()}"
    assert main_text(page.format(text)) == want
    assert main_text(f"<nav>{MENU}</nav>{notice}<div>{page.format(text)}</div><footer>F</footer>") == want


@pytest.mark.parametrize("name", ["ad", "ad-box", "sideBar", "site_footer", "nav-main", "related-posts",
                                  "cookieNotice", "x comments y", "widget-area-2"])
def test_names_of_the_rest(name):
    page = f"<div><p>{PROSE}</p><div class='{name}'><p>{PROSE}</p></div><p>{PROSE}</p></div>"
    assert main_text(page) == f"{PROSE.strip()}\n{PROSE.strip()}"


def test_a_long_advert_beside_a_short_article():
    page = f"<div class=ad>{PROSE}</div><article class=ad-free><p>One.</p></article>"
    assert main_text(page) == "One."


LEAD, TEXT = PROSE[:70] * 5, "".join(f"<p>{PROSE}{i}</p>" for i in range(20))


@pytest.mark.parametrize("page", [
    f"<div id=content><div class=lead><p>{LEAD}</p></div><div class=text><p>{PROSE * 20}</p></div></div>",
    f"<div id=content><div class=lead><p>{LEAD}</p></div><div class=text>{TEXT}</div></div>",
    f"<div><div class=title><h1>T</h1><h2>U</h2></div><div class=text>{TEXT}</div></div>",
    f"<div><div>{TEXT}</div><div><p>Short.</p></div><div><p>{PROSE}</p></div></div>",
    f"<div><section><h2>T</h2>{TEXT}</section><section><h2>U</h2><p>{PROSE}</p></section></div>",
    f"<table><tr><td><p>{PROSE}</p></td></tr><tr><td>{TEXT}</td></tr></table>",
])
def test_content_in_several_containers(page):
    blocks = re.split(r"<[^>]*>", page)
    want = "\n".join(" ".join(b.split()) for b in blocks if b.strip())
    assert main_text(page) == want
    assert main_text(f"<nav>{MENU}</nav><div>{MENU}</div><div>{page}</div><div>{MENU}</div>") == want


ARTICLE = "".join(f"<p>{PROSE}{i}</p>" for i in range(4))
COMMENTS = "".join(f"<div><b>reader {i}</b><p>{PROSE}said {i}</p></div>" for i in range(12))
SAID = "\n".join(f"{PROSE}{i}" for i in range(4))


@pytest.mark.parametrize("page", [
    f"<div class=post>{ARTICLE}</div><div id=comments>{COMMENTS}</div>",
    f"<article>{ARTICLE}<section class=comments>{COMMENTS}</section></article>",
    f"<div class=post>{ARTICLE}</div><div class='user-comments'>{COMMENTS}</div>",
    f"<div class=post>{ARTICLE}</div><section id=reader-reactions>{COMMENTS}</section>",
    f"<main>{ARTICLE}<ol class=commentlist>{COMMENTS}</ol><div id=respond><form>{PROSE}</form></div></main>",
    f"<div><div class=text>{ARTICLE}</div><div id=disqus_thread>{COMMENTS}</div></div>",
    f"<body><div class=x>{ARTICLE}</div><div class='post-comments'>{COMMENTS}</div></body>",
])
def test_comments_longer_than_the_article(page):
    assert main_text(page) == SAID
    assert main_text(f"<nav>{MENU}</nav>{page}<footer>F</footer>") == SAID


def test_a_short_article_beside_long_comments():
    assert main_text(f"<article><p>One line.</p></article><div class=comments>{COMMENTS}</div>") == "One line."
    # A page that has nothing but comments gives these.
    assert main_text(f"<div class=comments><p>{PROSE}</p></div>") == PROSE.strip()


@pytest.mark.parametrize("inner, want", [
    ("<p>a<button>b</button>c</p>", "a c"), ("<p>a <math><mi>x</mi>=<mn>1</mn></math> c</p>", "a x=1 c"),
    ("<p>a<svg><text>t</text></svg>b</p>", "ab"), ("<p>a<span hidden>h</span>b</p>", "ab"),
    ("<p>a <label>l<p>b</p><p>c</p>", "a\nb\nc"), ("<label>open <h2>T</h2><p>b</p>", "T\nb"),
    ("<p>a<button>b<p>c</p>", "a\nc"), ("<p>a</p><!-- <b>x</b> <p>y</p>", "a"),
    ("<p>a</p><script>s = '<!--';</script><p>b</p>", "a\nb"), ("<p>a<!-- x --> b</p>", "a b"),
    ("<p>a<select><option>x<option>y</select>b</p>", "a b"),
])
def test_inside_of_blocks(inner, want):
    assert main_text(f"<article>{inner}") == want


def test_two_unequal_articles():
    short, long = f"<article><h2>S</h2><p>{PROSE}</p></article>", f"<article>{TEXT}</article>"
    want = "\n".join(f"{PROSE}{i}" for i in range(20))
    for page in (f"<nav>{MENU}</nav>{long}{short}<footer>F</footer>", f"<div>{long}</div><div>{short}</div>"):
        assert main_text(page) == f"{want}\nS\n{PROSE.strip()}"
    assert main_text(f"<article>{TEXT}</article><aside>{short}</aside>") == want
