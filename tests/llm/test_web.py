"""WARC archives and rendering of pages."""

import hashlib
import zlib

import pytest

from tests.compare import connect, differences
from tidesift.llm import warc
from tidesift.llm.queries import QUERIES, SQL
from tidesift.llm.render import extract, render
from tidesift.sources.scratch import scratch_path

LONG = "z" * 1500
PAGES = [
    (1, "http://a/x y%0A\n", LONG), (2, "http://a", LONG), (3, None, LONG), (4, "u", "short"), (5, "u", "short"),
    (6, "u", None), (7, "u", ""), (8, "ü", "é" * 600), (None, "u", LONG), (9, "u", "\x1f\x8b\x08" * 900), (9, "u", "other" * 400),
]
SCHEMA = "page_id long, url string, html string, payload string"


def test_records_come_back(spark, rows):
    path = scratch_path(spark, "warc")
    warc.write(rows([(*p, "clash") for p in PAGES], SCHEMA), path)
    got = warc.read(spark, path).collect()
    assert len(got) == len(PAGES)
    for r in got:
        want = [h or "" for i, u, h in PAGES if i == r.page_id and u == r.url]
        assert r.payload_digest in {hashlib.sha1(h.encode()).hexdigest() for h in want}
        assert r.payload_bytes in {len(h.encode()) for h in want}
        assert r.record_type == "revisit" or r.payload.decode() in want
    assert {(r.page_id, r.refers_to) for r in got if r.record_type == "revisit"} == {(1, 3), (2, 3)}


@pytest.mark.parametrize("size", [1, 7, 61, 1000])
def test_byte_ranges_of_any_size(spark, rows, size):
    """Magics inside of compressed bytes (a stored archive), and records over several ranges."""
    path = scratch_path(spark, "warc")
    pages = [(i, "u", "".join(chr(33 + (i * k * k) % 90) for k in range(40 * i))) for i in range(1, 13)]
    warc.write(rows(pages, "page_id long, url string, html string").coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size * 100))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r.page_id: r.payload.decode() for r in warc.read(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i: h for i, _, h in pages}


def test_magic_inside_a_record():
    inner = warc.record(1, "u", b"inner", None)
    coder = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored: the inner archive's magic shows
    outer = coder.compress(warc.record(2, "u", warc._gzip(inner), None)) + coder.flush()
    work = warc.Stitcher()
    parts = (outer + warc.member(warc.record(3, "u", b"x", None))).split(warc.MAGIC)[1:]
    found = [warc.parse(c)["page_id"] for p in parts for c in work.feed(p)]
    assert found == [2, 3] and not work.lead and not work.tail


def test_empty_tables(spark, rows):
    path = scratch_path(spark, "warc")
    warc.write(rows([], "page_id long, url string, html string"), path)
    assert warc.read(spark, path).count() == 0
    assert extract(rows([], "page_id long, html string"), "html").columns == ["page_id", "html", "text"]


def test_warc_equals_sql(spark, sf_dir):
    assert differences(QUERIES["op1_warc"](spark, sf_dir), SQL["op1_warc"], connect(sf_dir)) == []


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>One<b> two</b>\n three<br>four<p>five", "One two three\nfour\n\nfive"),
        ("<title>t</title><style>p{}</style><script>if(a<b)'</p>'</script>x", "x"),
        ("a<span hidden>b<p>c</span>d", "a\nd"),
        ("a <i style='DISPLAY : none'>b</i>c", "a c"),
        ("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>", "- a\n  - b\n  - c\n- d"),
        ("<ol start=3><li>x<li>y</ol>", "3. x\n4. y"),
        ("<table><tr><th>Name<th>Qty<tr><td>apple<td>1<tr><td>pear pear<td>22</table>", "Name       Qty\napple      1\npear pear  22"),
        ("<td>a", "a"),
        ("<pre>\n a\n   b\n</pre>", " a\n   b"),
        ("a &amp; &eacute;&#x41; < b", "a & éA < b"),
        ("<!-- a > b -->c<!doctype x>d", "cd"),
        ("<details><summary>S</summary>no</details>end", "S\nend"),
        ("", ""),
        ("<p", "<p"),
        ("<div>" * 5000 + "deep" + "<b>" * 5000, "deep"),
    ],
)
def test_render(html, text):
    assert render(html) == text


def test_extract_keeps_rows(rows):
    pages = rows([(1, None, "x"), (2, "<p>a", "y"), (2, "<p>a", "y"), (None, "", None)], "page_id long, html string, text string")
    assert sorted(map(tuple, extract(pages, "html", "text").select("page_id", "text").collect()), key=str) == sorted(
        [(1, ""), (2, "a"), (2, "a"), (None, "")], key=str
    )


@pytest.mark.parametrize("html, want", [
    ("<p>so <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>4</mn></mrow><annotation>tex</annotation></semantics></math> holds", "so x=4 holds"),
    ("<svg><title>t</title><defs/><style/><text x=1>Jan</text><text>Feb</text><path d='M0'/><defs><text>no</text></defs></svg><p>on", "Jan Feb\n\non"),
    ("a <select><option>one<option selected>two<optgroup label=g><option>three</select> b", "a two b"),
    ("a <select><option disabled>one<option>two</select> b <select></select>c", "a two b c"),
    ("<select multiple><option>one<option>two</select>", "one\ntwo"),
    ("<head><title>t</title> bare text <b>bold</b>", "bare text bold"),
    ("<head> <meta><title>t</title> </head>x", "x"),
    ("<div style='visibility: hidden'>no <b style='visibility:visible'>yes</b> no<p style='visibility:visible'>too</div>", "yes\n\ntoo"),
    ("<div style='display:none'>no <b style='visibility:visible'>no</b></div><ul style='visibility:hidden'><li>no</ul>on", "on"),
])
def test_formulas_charts_forms_and_visibility(html, want):
    assert render(html) == want
