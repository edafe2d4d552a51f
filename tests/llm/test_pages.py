import html
import json
import re

import pytest

from ledgerspark.llm import warc
from ledgerspark.llm.extraction import LABELLED, decide, described, extract, main_text, trained
from ledgerspark.llm.markup import blocks
from ledgerspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PAGE = """<html><head><title>T &amp; t</title><style>p{}</style></head><body class="has-sidebar">
<div id="cookie-notice">We use <b>cookies</b>, many of them, for a lot of reasons.</div><header class="site"><h2>Site</h2></header>
<nav><ul><li><a href=/x>Home</a><li><a href='/y'>About the site</a></ul></nav><div class="wrap"><main><article class="post">
<header><h1>Title &amp; more</h1><p class="byline">By X</p></header>
<p>First para with <a href="/z">a link</a> in<b>side</b> it.<p>Second&nbsp;para<br>line two</p><div class="ad">Buy now</div>
<aside>side text here</aside><ul><li>item one<li>item two</ul><blockquote>Quote.</blockquote>
<form><label>Email</label><input type=text></form><p hidden>no</p><pre>code  x
 y</pre></article><section id="comments"><h2>Comments</h2><article class="comment"><p>Nice article, a long comment.</p></article>
</section></main><aside class="sidebar"><p>Side words</p></aside></div><footer>(c) 2024</footer>
<script>if(a<b){x="<p>no</p>"}</script></body></html>"""
TEXT = [
    "Title & more",
    "First para with a link inside it.",
    "Second para line two",
    "item one",
    "item two",
    "Quote.",
    "code x y",
]


def test_article_of_a_page_with_everything():
    assert main_text(trained(), PAGE) == "\n\n".join(TEXT)


def test_page_without_article_element():
    page = (
        "<div id=menu><a href=/>Home</a> <a href=/n>News</a></div><h1>Only divs</h1>"
        "<div>This page has no article element, but quite a long text to read.</div><div>Short one.</div><div id=footer>foot</div>"
    )
    assert main_text(trained(), page).split("\n\n") == [
        "Only divs",
        "This page has no article element, but quite a long text to read.",
        "Short one.",
    ]


def test_tree_fits_its_table():
    tree = trained()
    assert all(decide(tree, row) == label for row, label in LABELLED)


def test_query_against_the_article_element(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op7_html_extraction"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        m = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)
        inner = re.sub(r"</?b>", "", m[1].replace("<br>", " "))
        parts = [" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(x for x in parts if x)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def odd_pages(spark):
    rows = [
        (1, None, None),
        (None, "http://a/ b", "<p>no id, but a text with more than a few words in it</p>"),
        (2, "u", ""),
        (3, "u", "<"),
        (3, "u", "<"),
        (4, "u", "<div " * 2000 + "x"),
        (5, "u", "<p>" + "long text " * 60_000),
        (6, "u", "&amp &copy &#65; &bogus; <a href='x'>" + "<b>" * 5000 + "plain words that go on and on until they are enough"),
    ]
    return spark.createDataFrame([r + (1, "x") for r in rows], "page_id long, url string, html string, n_chars int, text string")


def test_odd_pages(spark):
    pages = odd_pages(spark)
    by = {r.page_id: r for r in extract(pages).collect()}
    assert extract(pages).count() == pages.count()
    assert (by[1].text, by[2].text, by[1].n_chars) == ("", "", 0)
    assert by[None].text.startswith("no id") and len(by[5].text) == 60_000 * 10 - 1
    assert extract(pages.limit(0)).count() == 0


def test_links_and_blocks():
    found, links = blocks("<p>See <a href='/a?x=1&amp;y=2'>the  page</a> now<p><a href=b>b</a>")
    assert links == [("/a?x=1&y=2", "the page"), ("b", "b")]
    assert [(b.text, b.words, b.linked) for b in found] == [("See the page now", 4, 2), ("b", 1, 1)]


def test_derivatives_of_every_page(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    made = warc.derivatives(warc.responses(spark.read.parquet(f"{SF}/pages.parquet"))).collect()
    assert len(made) == 2 * len(pages)
    for r in made:
        page = pages[r.page_id]
        source, block = warc.parse(warc.response(str(r.page_id), page.url, page.html))
        h, body = warc.parse(r.record)
        assert h["warc-type"] == r.warc_type and h["warc-refers-to"] == source["warc-record-id"]
        assert h["warc-target-uri"] == page.url and h["warc-date"] == source["warc-date"]
        assert h["warc-block-digest"] == warc.digest(body) and int(h["content-length"]) == len(body)
        assert h["warc-source-payload-digest"] == source["warc-payload-digest"] == warc.digest(page.html.encode())
        if r.warc_type == "metadata":
            e = json.loads(body)
            assert e["status"] == 200 and ["Content-Type", "text/html; charset=utf-8"] in e["headers"]
            assert len(e["links"]) == page.html.count("<a href=") and e["block-digest"] == warc.digest(block)
        else:
            assert body.decode().split("\n") == [b.text for b in blocks(page.html)[0]]
    assert len({warc.parse(r.record)[0]["warc-record-id"] for r in made}) == len(made)


def test_described_query(spark):
    got = QUERIES["op6_warc_derivatives"](spark, SF).collect()
    assert len(got) == 2 * spark.read.parquet(f"{SF}/pages.parquet").count()
    assert {r.warc_type for r in got} == {"metadata", "conversion"}
    assert all((r.http_status == 200) == (r.warc_type == "metadata") for r in got)


def test_files_round_trip(spark, tmp_path):
    records = warc.responses(spark.read.parquet(f"{SF}/pages.parquet")).repartition(3).persist()
    written = warc.write_warc(records, str(tmp_path / "w")).collect()
    assert sum(r.records for r in written) == records.count()
    back = warc.read_warc(spark, str(tmp_path / "w"))
    assert sorted(r.record for r in back.collect()) == sorted(r.record for r in records.collect())
    plain = b"\r\n" + b"".join(bytes(r.record) for r in records.collect())
    assert len(list(warc.split_records(plain))) == records.count()


def test_odd_records(spark):
    pages = odd_pages(spark)
    got = warc.described(warc.derivatives(warc.responses(pages))).collect()
    assert len(got) == 2 * pages.count()
    assert next(r for r in got if r.page_id is None).target_uri == "http://a/%20b"
    assert warc.parse(b"nonsense")[0]["warc-type"] == warc.parse(b"WARC/1.0\r\nContent-Length: 9\r\n\r\nx")[0]["warc-type"] == "invalid"
    assert warc.derive(b"nonsense") == [] and warc.derive(warc.build([("WARC-Type", "request")], b"GET /")) == []
    odd = warc.build([("WARC-Type", "response")], b"HTTP/1.1 404 No\r\nContent-Type: text/html; charset=bogus\r\n\r\n<p>x\xff")
    meta = json.loads(warc.parse(warc.derive(odd)[0][1])[1])
    assert meta["status"] == 404
    assert warc.described(warc.derivatives(warc.responses(pages.limit(0)))).count() == 0


def test_custom_elements_are_not_the_dropped_ones():
    page = (
        '<p>one <svg-icon name="x"></svg-icon> two</p><p>three <video-player src=v>inner</video-player></p>'
        "<select-box><p>four</p></select-box><p>five <script>no</script><svg/>six <title>no</title></p><template-x><p>seven</p>"
    )
    found, links = blocks(page + "<p><a href=/end>end</a></p>")
    assert " ".join(b.text for b in found) == "one two three inner four five six seven end"
    assert links == [("/end", "end")]


ARTICLE = "".join(
    f"<p>{x}</p>"
    for x in (
        "The first paragraph of this article has a good number of words and says something at length.",
        "Then a second paragraph follows which is about as long as the one before it was.",
        "Short end.",
    )
)


@pytest.mark.parametrize(
    "before, after",
    [
        ('<div class="page no-comments"><article>', "</article></div>"),
        ('<div id="page" class="site comments-open"><main>', "</main></div>"),
        ('<div class="content with-social-share">', "</div>"),
        ('<div class="layout ads-enabled"><section>', "</section></div>"),
        ('<body class="search-page"><div class="search-page">', "</div></body>"),
        ('<div class="alert-level-2">', "</div>"),
        ("<form action=/x>", "</form>"),
        ("<form action=/x><article>", "</article></form>"),
        ('<div class="comments"><article>', "</article></div>"),
    ],
)
def test_wrappers_keep_the_article(before, after):
    menu = "<nav>" + "".join(f"<li><a href=/{k}>Item</a></li>" for k in range(5)) + "</nav>"
    text = main_text(trained(), menu + before + "<h1>A title of words</h1>" + ARTICLE + after + "<footer>(c) us</footer>")
    assert text.split("\n\n") == ["A title of words", *re.findall("<p>(.*?)</p>", ARTICLE)]


@pytest.mark.parametrize(
    "junk",
    [
        '<div class="comments-area"><p>A reader wrote a comment that is about as long as any of the paragraphs.</p></div>',
        '<section id="comments"><article><p>One more comment by a reader, again with a number of words.</p></article></section>',
        '<div class="ad-slot-3">Buy this thing now, it is cheap and good for all of you.</div>',
        '<div class="cookie-notice"><p>We use cookies for all kinds of good reasons and some bad ones.</p></div>',
        '<aside><p>Beside the article there is some more text which does not belong to it.</p></aside>',
        '<div class="sidebar"><p>Beside the article there is some more text which does not belong to it.</p></div>',
        "<div><a href=/1>Next</a></div><div><a href=/2>More of it</a></div>",
        "<form><label>Your name</label><input><button>Send it</button></form>",
        '<div style="display:none"><p>Words that nobody sees on this page, however many there may be.</p></div>',
    ],
)
def test_what_is_no_article_goes(junk):
    page = f"<main><article><h1>A title of words</h1>{ARTICLE}</article></main>{junk}<footer>(c) us</footer>"
    assert main_text(trained(), page).split("\n\n") == ["A title of words", *re.findall("<p>(.*?)</p>", ARTICLE)]


def test_the_tree_decides_by_words_and_links(spark):
    """With all word counts and link densities replaced by constants, many
    decisions are others."""
    tree, changed, n = trained(), 0, 0
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        for row in described(blocks(r.html)[0]):
            n += 1
            changed += decide(tree, row) != decide(tree, (20, 0.0, 20, 0.0, 20, 0.0, row[6]))
    assert changed > 0.2 * n
    assert len(LABELLED) < 200 and {row[6] for row, _ in LABELLED} == {-2, -1, 0, 1}
