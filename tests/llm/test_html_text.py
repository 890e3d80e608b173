"""Main text of pages: the fixture's articles and hand-written pages."""
import html
import random
import re
import time

import pytest

from clientlens.llm import html_text, queries
from clientlens.llm.common import read


def article(page):
    inside = re.search("<article>(.*)</article>", page, re.S).group(1)
    blocks = [re.sub("</?b>", "", b) for b in re.split("</?(?:h1|p|br)>", inside)]
    return " ".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_articles_of_the_fixture(spark):
    sf = "/root/testdata/sf0.01"
    want = {r.page_id: article(r.html) for r in read(spark, sf, "pages").collect()}
    got = queries.op4_html_text(spark, sf).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


LONG = "This is the first long paragraph of the story, with many words in it and hardly any markup at all. "


@pytest.mark.parametrize("page,text", [
    ("", ""),
    ("plain", "plain"),
    ("<p>a &amp; b&nbsp;c &lt;x&gt; &#233;</p>", "a & b c <x> é"),
    ("<body><nav><a href=x>Home</a></nav><article><h1>T</h1><p>one<br>two <b>three</b>four</p></article><footer>f</footer>", "T one two threefour"),
    ("<article>x<script>var a='</p>';</script><style>p{}</style><form>f<input></form>y</article>", "x y"),
    ("<article><p>a</p><aside>b</aside><div class='ad'>c</div><section id=comments><p>d</p></section><p>e</p></article>", "a e"),
    ("<div class=menu>m</div><div id=main><p>" + LONG + "</p><p>Short.</p><p>" + LONG + "</p></div><div class='sidebar'>s</div>",
     " ".join([LONG.strip(), "Short.", LONG.strip()])),
    ("<div><ul><li><a>x</a><li><a>y</a><li><a>z</a></ul></div><div class='has-sidebar'><p>" + LONG * 3 + "<p>end</div>", " ".join([LONG.strip()] * 3 + ["end"])),
    ("<article><p>unclosed <b>bold<p>next</article>", "unclosed bold next"),
    ("<article><p>a</p></div></span><p>b", "a b"),
    ("<nav>only menus</nav><footer>x</footer>", ""),
    ("<main><article class='comment'>no</article><article><p>yes</p></article></main>", "yes"),
    ("<article>\n a \t b\n<!-- c --></article>", "a b"),
])
def test_pages(page, text):
    assert html_text.main_text(page) == text


def test_edges(spark):
    rows = [(1, "u", None, "t"), (2, None, "<p>x", "t"), (None, "u", "<p>x", "t"), (2, None, "<p>x", "t"), (3, "u", "<p>" + "w " * 200000, "t")]
    out = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(((r.page_id, r.url, len(r.text)) for r in out), key=str) == sorted(
        [(1, "u", 0), (2, None, 1), (None, "u", 1), (2, None, 1), (3, "u", 399999)], key=str)
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize("page,text", [
    ("<body><h1>Title</h1><div>The lead of it.</div><div>" + LONG * 30 + "</div></body>", ["Title", "The lead of it.", *[LONG.strip()] * 30]),
    ("<body><div id=c><h1>Title</h1><p>" + LONG + "</p><section><p>" + LONG * 40 + "</p></section><section><h2>More</h2><p>" + LONG + "</p></section></div></body>",
     ["Title", LONG.strip(), *[LONG.strip()] * 40, "More", LONG.strip()]),
    ("<body><div><div><p>" + LONG * 40 + "</p></div><p>" + LONG + "</p></div><div><ul><li><a>x</a><li><a>y</a></ul></div></body>", [LONG.strip()] * 41),
    ("<body><article><p>" + LONG * 40 + "</p></article><article><h2>Next</h2><p>" + LONG + "</p></article></body>", [*[LONG.strip()] * 40, "Next", LONG.strip()]),
])
def test_text_beside_a_dominant_block_stays(page, text):
    assert html_text.main_text(page) == " ".join(text)


@pytest.mark.parametrize("page,text", [
    ("<p>x</p><![foo[bar]]><p>y", "x y"),
    ("<p>x</p><![foo", "x <![foo"),
    ("<p>x</p><![CDATA[c]]><p>y", "x y"),
    ("<article class='comments-open'><p>a</p></article>", "a"),
    ("<article class='post social-science'><p>a</p><div class='comments'>c</div></article>", "a"),
    ("<form id=aspnetForm><div class=menu>m</div><div><p>" + LONG * 3 + "</p></div></form>", " ".join([LONG.strip()] * 3)),
    ("<div class=social-science><main><p>a</p></main></div>", "a"),
    ("<div class=notice-board><article><p>a</p></article></div><div class=footer-links>" + "f " * 500 + "</div>", "a"),
    ("<article><p>short</p></article><section class=comment-list><article class=x><p>" + LONG * 5 + "</p></article></section>", "short"),
    ("<div><p>" + LONG + "</p></div><div id=comments><p>" + LONG * 2 + "</p></div>", LONG.strip()),
    ("<article><header><h1>T</h1></header><p>a</p></article>", "a"),
])
def test_names_that_are_no_furniture(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("tag", ["<b>", "<div>", "<p>", "<li>", "<option>", "</i><i>", "<b></u>", "<form class=a-form>"])
def test_deep_and_unclosed_pages_take_linear_time(tag):
    start = time.process_time()
    assert html_text.main_text(tag * 100_000 + "x") in ("x", "")
    assert time.process_time() - start < 8


def test_div_pages_by_brute_force():
    """Pages of divs with long paragraphs and menus of links, against the page as it was made."""
    r = random.Random(5)
    for _ in range(60):
        paragraphs = [" ".join(r.choice(["word", "text", "longer", "and"]) for _ in range(r.randint(25, 60))) for _ in range(r.randint(4, 12))]
        menu = "<ul class=menu>" + "".join(f"<li><a href=#>{i}</a>" for i in range(r.randint(3, 20))) + "</ul>"
        body = "".join(f"<p>{x}</p>" if r.random() < 0.7 else f"<div>{x}</div>" for x in paragraphs)
        page = f"<body>{menu}<div class=page>{body}</div><div id=sidebar>{menu}</div><footer>{menu}</footer></body>"
        assert html_text.main_text(page) == " ".join(paragraphs)
