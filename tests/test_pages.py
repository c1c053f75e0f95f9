from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from doclake.functions.markup import Page, decode
from doclake.functions.pages import clean_page
from doclake.operators import frontier

DECISION = """

<!DOCTYPE html>
<!--[if IE 7 ]> <html class="ie7"> <![endif]-->
<!--[if (gt IE 9)|!(IE)]><!--><html lang="en" itemscope><!--<![endif]-->
<head id="h"><title>
	CASE-1 &amp; others - Tribunal
</title><meta charset="utf-8" /><script>var a = "<div class='content'>no</div>";</script></head>
<body><div class="top-header"><a class="skiplink-text" href="#main">Skip to main content</a></div>
<form id="f"><input name="q"><h1 class="page-title">CASE-1</h1>
<div class="col-sm-9"><p class="return-to-search"><a>Return to Search</a></p>
<div class="row content" id="c" style="color:red">
 <nav>Sitemap</nav><a class="big btn" href="#">Print</a>
 <h2></h2><h2 class="x">RECOMMENDATION</h2><!-- kept -->
 <table border="1"><tr><td colspan="2" width="9">Parties &nbsp; <b>A &lt; B</b><td lang="ga">C<tr><td>D</table>
 <p>one<p>two <img src="s.png" alt='say "hi"' onclick="x()"><br>three</p>
 <div role="navigation">Gaeilge</div><ul><li>first<li>second</ul>
 <noscript>Enable scripts</noscript><style>p{}</style><span class="sr-only">hidden</span>
</div></div></form><footer>Cookie Management<footer>Data Protection
<!-- Elapsed time: 0.0624367 -->
"""


@pytest.fixture
def clean(spark):
    def run(*pages):
        rows = [(i, p.encode() if isinstance(p, str) else p) for i, p in enumerate(pages)]
        frame = spark.createDataFrame(rows, "i int, p binary").select("i", clean_page(F.col("p")).alias("c"))
        out = [r.c for r in frame.orderBy("i").collect()]
        return out[0] if len(out) == 1 else out

    return run


def test_interface_goes_and_content_stays(clean):
    result = clean(DECISION)
    html = bytes(result.clean).decode()
    for gone in ("Return to Search", "Sitemap", "Gaeilge", "Skip to main", "Cookie", "Data Protection",
                 "Print", "Enable scripts", "hidden", "p{}", "var a", "style=", "onclick", "width", "border"):
        assert gone not in html, gone
    for kept in ("RECOMMENDATION", "Parties \xa0 <b>A &lt; B</b>", "<!-- kept -->", '<td colspan="2">',
                 "<img src=\"s.png\" alt='say \"hi\"'/>", '<td lang="ga">C</td>', "<li>first</li><li>second</li>",
                 "<p>one</p>", "three"):
        assert kept in html, kept
    for tag in ("nav", "footer", "button", "script", "style", "form", "iframe", "input"):
        assert f"<{tag}" not in html
    assert result.container == "div.content"
    assert result.title == "CASE-1 & others - Tribunal"
    assert html.startswith('<!DOCTYPE html>\n<html lang="en">\n<head><meta charset="utf-8"><title>CASE-1 &amp; others')
    assert html.endswith("</div>\n</body>\n</html>\n")


def test_cleaning_is_deterministic(clean):
    first, second = clean(DECISION, DECISION)
    assert bytes(first.clean) == bytes(second.clean)


def test_no_container_is_a_row_not_an_exception(clean):
    result = clean("<html><body><nav>menu</nav></body></html>")
    assert (result.clean, result.error_code) == (None, "ContentNotFound")
    assert "div.content" in result.reason


def test_only_the_first_node_of_a_selector_is_tried(clean):
    blank_then_main = clean('<div class="content"> <script>x</script></div><main>Text</main>')
    assert blank_then_main.container == "main"
    second_is_not_tried = clean('<div class="content"></div><div class="content">Full</div><article>Art</article>')
    assert second_is_not_tried.container == "article"


def test_container_with_interface_text_only_renders_empty(clean):
    result = clean("<main><nav>menu</nav></main>")
    assert result.error_code is None
    assert b"<main></main>" in bytes(result.clean)


def test_title_falls_back_to_a_kept_heading_then_to_a_word(clean):
    assert clean("<title> </title><main><nav><h1>Menu</h1></nav><h2>Real <i>one</i></h2></main>").title == "Realone"
    assert clean("<main>text<h1> </h1><h2>x</h2></main>").title == "decision"
    assert clean("<main>text</main>").title == "decision"


def test_references_are_decoded_without_their_semicolon_too(clean):
    result = clean("<title>a &amp b&am</title><main>x &amp<b>&lt y</b> &</main>")
    assert result.title == "a & b&am"
    assert b"<main>x &amp;<b>&lt; y</b> &amp;</main>" in bytes(result.clean)


def test_title_is_escaped(clean):
    assert b"<title>a &lt;b&gt; &#x27;c&#x27;</title>" in bytes(clean("<title>a &lt;b&gt; 'c'</title><main>x</main>").clean)


def test_unclosed_tail_and_binary_rubbish(clean):
    assert clean("<article><p>one<p><b>two").container == "article"
    assert clean(bytes(range(256))).error_code == "ContentNotFound"
    assert clean(b"").error_code == "ContentNotFound"


def test_null_payload_is_not_cleaned(clean):
    assert clean(None, "<main>x</main>")[0] is None


@pytest.mark.parametrize(
    ("payload", "expected"),
    [
        ("é".encode(), "é"),
        (b'<meta charset="iso-8859-1">\xe9', '<meta charset="iso-8859-1">é'),
        (b"\x93quoted\x94", "“quoted”"),
        (b"\xef\xbb\xbfbom", "bom"),
        ("é".encode("utf-16"), "é"),
        (b'<meta charset="no-such">\xc3\xa9', '<meta charset="no-such">é'),
    ],
)
def test_decode(payload, expected):
    assert decode(payload) == expected


@pytest.mark.parametrize("bad", ["<a " * 200_000, "<!--" * 200_000, '<a b="' * 100_001, "<" * 400_000, "<div>" * 100_000, "<p><b>" * 50_000])
def test_hostile_markup_takes_linear_time(bad):
    started = time.monotonic()
    Page(bad)
    assert time.monotonic() - started < 5


LISTING = """<html><head><base href="/en/"></head><body>
<div id="CB2"><input type="checkbox" id="a" value=" 1 "><label for="a"> Board </label>
<input type="checkbox" id="b" value="15376"><label for="b">High Tribunal</label>
<input type="checkbox" id="c" value=""><label for="c">No value</label>
<input type="checkbox" id="d" value="9"><label for="d"> </label><input type="radio" id="a" value="2"></div>
<p class="searchhead">Shows 1 to 10 <b>of 99 results</b> of 45 results</p>
<ul><li class="each-item clearfix"><h2 class="title"><a href="cases/t22912.html"> Title  one </a></h2>
<span class="refNO">T22912</span><p class="description">SONOMA <b>not me</b> v</p><p class="description">X</p><span class="date">30/01/2024</span>
<li class="each-item"><span class="refNO"> </span><h2 class="title"><a href="/en/cases/x.html"></a></h2>
<li class="each-item"><h2 class="title"><a href="">Only a title</a></h2><span class="date">soon</span></ul>
<ul class="pager"><li><a class="prev" href="?pageNumber=0">p</a><a class="next" href="?body=3&amp;pageNumber=2">n</a></ul>"""


@pytest.fixture
def listings(spark):
    def read(*pages):
        rows = [(f"https://example.test/en/search/?pageNumber={i}", "B", "p", "2024-01-01", i + 1, p.encode()) for i, p in enumerate(pages)]
        schema = "url string, body string, partition string, partition_date string, page int, payload binary"
        return frontier.read_listings(spark.createDataFrame(rows, schema))

    return read


def test_bodies(spark):
    frame = spark.createDataFrame([(LISTING.encode(),)], "payload binary")
    bodies = frontier.discover_bodies(frame)
    assert {tuple(r) for r in bodies.collect()} == {("1", "Board"), ("15376", "High Tribunal")}
    assert [r.body for r in frontier.filter_bodies(bodies, " 15376 , 4").collect()] == ["High Tribunal"]
    assert frontier.filter_bodies(bodies).count() == 2
    pages = spark.createDataFrame([("u1", LISTING.encode()), ("u2", b"<p>")], "url string, payload binary")
    assert [r.url for r in frontier.no_bodies(pages).collect()] == ["u2"]
    assert [r.url for r in frontier.no_bodies(pages, "15376").collect()] == ["u2"]
    assert frontier.no_bodies(pages, "4, 5").count() == 2


def test_cards(listings):
    cards = frontier.listing_cards(listings(LISTING)).orderBy("position").collect()
    assert [c.identifier for c in cards] == ["T22912", "", "Only a title"]
    first = cards[0]
    assert (first.title, first.date, first.url) == ("Title one", "2024-01-30", "cases/t22912.html")
    assert first.document_url == "https://example.test/en/cases/t22912.html"
    assert first.description == "SONOMA v X"
    assert (cards[2].date, cards[2].document_url) == ("soon", "")


def test_cards_without_identifier_or_link_are_failures(listings):
    rejected = frontier.rejected_cards(frontier.listing_cards(listings(LISTING))).collect()
    assert {(r.url, r.error_code) for r in rejected} == {
        ("https://example.test/en/cases/x.html", "missing_metadata"),
        ("https://example.test/en/search/?pageNumber=0", "missing_metadata"),
    }


def test_total_and_next_page(listings):
    frame = listings(LISTING, "<html><body></body></html>", LISTING.replace("each-item", "other"))
    totals = [r.total_results for r in frame.orderBy("page").collect()]
    assert totals == [45, None, 45]
    following = frontier.next_pages(frame).collect()
    assert [(r.page, r.url) for r in following] == [(2, "https://example.test/en/?body=3&pageNumber=2")]


def test_empty_listing_has_no_cards(listings):
    assert frontier.listing_cards(listings("<html><body></body></html>")).count() == 0
