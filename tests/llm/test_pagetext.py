import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoreline.llm import pagetext, registry

PAGES = {
    """<html><head><title>T</title></head><body><header><h2>My Site</h2><nav><a href=/>Home</a><a href=/b>Blog</a></nav></header>
<main><article><h1>Big news today</h1><p>The first paragraph is here, and it has text.</p><aside class="related"><h3>Related</h3>
<p>Another story you may like is this one.</p></aside><p>Second &amp; last&nbsp;paragraph, with <a href=x>a link</a> inside.</p></article>
<section id="comments"><h3>3 Comments</h3><div class="comment"><p>Bob</p><p>I really liked this article, it was very good to read.</p></div></section></main>
<aside><p>Sponsored by someone with long prose text here.</p></aside><form><label>Email</label><input><button>Go</button></form><footer><p>© 2024 Site</p></footer></body></html>""":
        "Big news today\nThe first paragraph is here, and it has text.\nSecond & last paragraph, with a link inside.",
    """<body><div id="cookie-banner">We use cookies. Accept?</div><div id="top"><ul class="menu"><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul></div>
<div id="content"><div class="post"><h1>Title of it</h1><div class="entry"><p>Para one goes on for some words.<p>Para two goes on for more words.
<div class="advert">Buy the new thing, it is great and cheap.</div><p>Para three.</div></div><div class="comments-section"><h4>Reader comments</h4>
<p>anon: what a nice text, thanks for that.</p></div></div><div class="sidebar"><p>About the author. He writes a lot of text here every day.</p></div><div class="footer">Imprint</div>""":
        "Title of it\nPara one goes on for some words.\nPara two goes on for more words.\nPara three.",
}


@pytest.mark.parametrize("page", PAGES)
def test_hand_made_pages(page):
    assert pagetext.main_texts([page], pagetext.default_model()) == [PAGES[page]]


def test_held_out_pages():
    pages = pagetext.labelled_pages(150, seed=99)
    found = [pagetext.blocks(p) for p, _ in pages]
    truth = np.array([x for _, labels in pages for x in labels])
    got = pagetext.default_model().decode(pagetext.features(found), np.array([len(b) for b in found]))
    assert (got == truth).mean() > 0.985


def test_given_pages(spark):
    """The article of a given page is what stands in its ``article`` element."""
    from llm.conftest import SF

    got = {r.page_id: r for r in registry.op7_page_text(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    for page in pages:
        inside = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", inside))
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", p)).split()) for p in parts]
        assert got[page.page_id].text == "\n".join(p for p in parts if p)
        assert got[page.page_id].n_chars == len(got[page.page_id].text)
    assert len(got) == len(pages)


@pytest.mark.parametrize(
    "page, texts",
    [
        ("", []), ("plain", ["plain"]), ("<p>", []), ("a<!-- b -->c<!-- d", ["ac"]), ("<script>x</p>", []), ("<p>one<p>two</p></div></p>three", ["one", "two", "three"]),
        ("x &lt; y &#233; &copy &bogus;", ["x < y é © &bogus;"]), ("<p title='a > b'>c</p>1 < 2", ["c", "1 < 2"]), ("<p a=\"x>y", ["y"]), ("a\n b\t c d", ["a b c d"]),
        ("<STYLE>p{}</STYLE><P>Up</P>", ["Up"]), ("<textarea>no</textarea><p>yes", ["yes"]), ("</p>" * 50 + "<b><i>deep" + "</i>" * 9, ["deep"]),
        ("<p>one <svg/> two</p><p>three", ["one two", "three"]), ("<p>one<math/>two<p>three", ["onetwo", "three"]), ("<video src=a><p>kept", ["kept"]),
        ("<p>If <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> then</p>", ["If x=2 then"]),
        ("<p>a <svg><svg><text>in</text></svg><text>out</text></svg> b", ["a b"]), ("<svg a='>'><title>t</title></svg>x", ["x"]),
        ("<object><object>a</object>b</object>c", ["c"]), ("<audio>a<audio>b</audio>c", ["a", "c"]), ("<p>a<script>b</p></script>c", ["ac"]),
        ("<canvas>" * 3000 + "end", ["end"]), ("<template><p>no</p></template><p>yes", ["yes"]), ("<svgx>a</svgx>", ["a"]),
    ],
)
def test_blocks(page, texts):
    assert [b.text for b in pagetext.blocks(page)] == texts


def test_phrases_count_in_blocks_of_any_length():
    """A long notice shows its phrases as a short one does; one mention in a long text does not."""
    notice = "We use cookies and ask for your consent to that. "
    seen = lambda t: [bool(f) for f in map(lambda p: pagetext._dense(p, t.lower()), pagetext._PHRASES)]
    assert seen(notice) == seen(notice * 8) == seen(notice * 200) and seen(notice)[1]
    assert not seen("Plain words of an article about something else. " * 40 + notice)[1]


def test_a_very_long_page_is_read_whole():
    page = "<article>" + "".join(f"<p>Paragraph number {i} has some words, and a full stop.</p>" for i in range(20_000)) + "</article>"
    assert pagetext.main_texts([page], pagetext.default_model())[0].count("\n") == 19_999


def test_awkward_rows(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "x", "y"), (None, "u", "", None, None), (2, "u", next(iter(PAGES)), "x", "y"), (2, "u", next(iter(PAGES)), "x", "y")]
    pages = spark.createDataFrame(rows, schema)
    got = pagetext.extract(pages).orderBy(F.col("page_id")).collect()
    assert [(r.page_id, r.text[:8], r.n_chars > 0) for r in got] == [(None, "", False), (1, "", False), (2, "Big news", True), (2, "Big news", True)]
    assert pagetext.extract(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pagetext.train([("<p>a<p>b", [0])])
