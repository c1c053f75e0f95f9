from __future__ import annotations

import re
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from doclake.functions import content, requests, text
from doclake.functions.urls import absolute_url
from doclake.profile import DEFAULT_PROFILE


@pytest.mark.parametrize(
    ("given_value", "expected"),
    [
        ("CASE-00039955", "CASE-00039955"),
        ("  ABC22916  ", "ABC22916"),
        ("CASE/00012345", "CASE-00012345"),
        ("PQR 246", "PQR_246"),
        ("a\tb\nc", "a-b-c"),
        ("a  b\x85c", "a_b_c"),
        ("._-x-_.", "x"),
        ("///", None),
        (" \t ", None),
    ],
)
def test_sanitize_identifier(column, given_value, expected):
    assert column(text.sanitize_identifier(F.col("v")), [given_value]) == [expected]


def test_sanitize_and_clean_agree_with_python_on_any_text(column):
    """Brute force: the same rules spelled with Python's re, on generated strings."""
    alphabet = st.sampled_from("aZ0/-_. \t\n\r\x0b\x0c\x1c\x1f\x85\xa0   　é​")
    samples: list[str] = []

    @settings(max_examples=300, database=None, deadline=None)
    @given(st.text(alphabet, max_size=12))
    def collect(sample):
        samples.append(sample)

    collect()

    def python_key(value):
        dashed = re.sub(r"[/\x00-\x1f]+", "-", value.strip())
        return re.sub(r"\s+", "_", dashed).strip("-_.") or None

    def python_clean(value):
        return re.sub(r"\s+", " ", value).strip()

    assert column(text.sanitize_identifier(F.col("v")), samples) == [python_key(s) for s in samples]
    assert column(text.clean_text(F.col("v")), samples) == [python_clean(s) for s in samples]


def test_clean_text_of_null_is_empty(column):
    assert column(text.clean_text(F.col("v")), [None]) == [""]


@pytest.mark.parametrize(
    ("shown", "expected"),
    [
        ("30/01/2024", "2024-01-30"),
        ("3/1/2024", "2024-01-03"),
        ("31/02/2024", "31/02/2024"),
        ("30/01/24", "30/01/24"),
        ("2024-01-30", "2024-01-30"),
        ("30/01/2024 x", "30/01/2024 x"),
        ("030/01/2024", "030/01/2024"),
        ("", ""),
    ],
)
def test_iso_date(column, shown, expected):
    assert column(text.iso_date(F.col("v")), [shown]) == [expected]


def test_total_results_prefers_the_head(column):
    page = F.lit("<p>1 of 7 results</p>")
    heads = ["Shows 1 to 10 of 1,045 Results", "nothing", "of\n45\tresults and of 9 results", "of , results"]
    assert column(text.total_results(F.col("v"), page), heads) == [1045, 7, 45, None]


@pytest.mark.parametrize(
    ("header", "payload", "expected"),
    [
        ("text/html", b"%PDF-1.7", "pdf"),
        ("application/pdf; charset=binary", b"", "pdf"),
        (None, b"PK\x03\x04zip", "docx"),
        (None, b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1word", "doc"),
        (" Application/MSWORD ;x", b"text", "doc"),
        ("application/vnd.openxmlformats-officedocument.wordprocessingml.document", b"", "docx"),
        ("image/png", b"x", "html"),
        (None, b"", "html"),
    ],
)
def test_detect_document_type(column, header, payload, expected):
    kind = content.detect_document_type(F.lit(header).cast("string"), F.col("v"))
    assert column(kind, [payload], "binary") == [expected]


def test_effective_type_trusts_a_known_stored_type_only(column):
    kind = content.effective_document_type(F.col("v"), F.lit(b"%PDF-1"))
    assert column(kind, ["html", "doc", "exe", None]) == ["html", "doc", "pdf", "pdf"]


def test_keys(column):
    key = text.landing_key(F.lit("High Tribunal"), F.lit("T/22916"), F.col("v"))
    assert column(key, ["html", "pdf", "exe"]) == ["High_Tribunal/T-22916.html", "High_Tribunal/T-22916.pdf", None]
    assert column(text.transformed_key(F.lit("T-1"), F.col("v")), ["docx"]) == ["T-1.docx"]


def test_known_digest(column):
    digest = content.file_hash(F.col("v"))
    assert column(digest, [b"abc"], "binary") == [
        "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    ]


def test_normalize_takes_out_render_comments_and_keeps_every_other_byte(column):
    every_byte = bytes(range(256))
    pages = [
        b"<p>x</p><!-- Elapsed time: 0 -->",
        b"<p>x</p><!--Elapsed time: 0.140607 -->",
        b"<p>x</p><!-- cached or not being index.aspx page --><!-- Elapsed time: 0.4 -->",
        every_byte,
    ]
    normal = content.normalize_payload(F.col("v"), F.lit("html"), DEFAULT_PROFILE)
    out = [bytes(v) for v in column(normal, pages, "binary")]
    assert out[0] == out[1] == out[2] == b"<p>x</p><!-- Elapsed time -->"
    assert out[3] == every_byte
    binary = content.normalize_payload(F.col("v"), F.lit("pdf"), DEFAULT_PROFILE)
    assert bytes(column(binary, pages[:1], "binary")[0]) == pages[0]


def test_conditional_headers(column):
    headers = requests.conditional_headers(F.col("v"), F.lit("Mon"))
    assert column(headers, ['W/"1"', "", None]) == [
        {"If-None-Match": 'W/"1"', "If-Modified-Since": "Mon"},
        {"If-Modified-Since": "Mon"},
        {"If-Modified-Since": "Mon"},
    ]
    none = requests.conditional_headers(F.col("v"), F.lit(None).cast("string"))
    assert column(none, [None]) == [{}]


def test_query_values_are_form_encoded(column):
    values = ["1/1/2024", "a b&c", "x*~é", "15376"]
    assert column(requests.query_value(F.col("v")), values) == ["1/1/2024", "a+b%26c", "x%2A~%C3%A9", "15376"]


def test_failure_details(column):
    code = requests.failure_code(F.lit(None).cast("int"), F.col("v"))
    classes = ["DNSLookupError", "TimeoutError", "TCPTimedOutError", "ConnectionLost"]
    assert column(code, classes) == ["dns_lookup_error", "timeout", "timeout", "ConnectionLost"]
    status = F.lit(404)
    assert column(requests.failure_code(status, F.col("v")), [None]) == ["404"]
    assert column(requests.failure_reason(status, F.col("v")), [None]) == ["http error 404"]


def test_on_domain(column):
    urls = ["https://example.test/a", "http://www.example.test", "https://badexample.test/", "nonsense", None]
    assert column(requests.on_domain(F.col("v"), "example.test"), urls) == [True, True, False, False, False]


LINKS = [
    "g", "./g", "g/", "/g", "//h/g", "?y", "g?y", "#s", "g#s", "g?y#s", "g;x", "g;x?y#s", "", ".", "./", "..", "../", "../g",
    "../..", "../../", "../../g", "../../../g", "../../../../g", "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.",
    "g/./h", "g/../h", "g?y/../x", "g#s/../x", "http:g", "HTTP://Host/Path/../x", "https://other/x", "mailto:a@b", "javascript:void(0)",
    "//host", "a//b", "a/../../b//c", " g", "g\th", "g?", "g#", "?", "#", "/", "a:b/c", "x/y:z", "caf\u00e9/\u65e5?q=\u00fc", None,
]
BASES = ["http://a/b/c/d;p?q", "https://a.test", "http://a/", "http://a/b/c/", "http://a?q", "http://a/b//c", "", None]


def test_links_are_resolved_as_the_standard_library_does(spark):
    rows = [(base, link) for base in BASES for link in LINKS]
    frame = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], "n int, base string, link string")
    resolved = frame.select("n", absolute_url(F.col("base"), F.col("link")).alias("url"))
    plan = resolved._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = [r.url for r in resolved.orderBy("n").collect()]
    want = [link if not link else urljoin(base or "", link) for base, link in rows]
    assert [(r, g) for r, g, w in zip(rows, got, want, strict=True) if g != w] == []
