import time

import pytest
from pyspark.sql import functions as F

from tallystar.llm.pages import extract, extract_text

CASES = {
    "one two": "one two",
    "": "",
    "<p>one<p>two": "one\n\ntwo",
    "<div>a</div><div>b</div>": "a\nb",
    "a <b>b</b>c   d\n e": "a bc d e",
    "<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>": "- a\n- b\n  3. x\n  4. y\n- c",
    "<table><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td>be<td>22</table>tail": "Name   N\nalpha  1\nbe     22\n\ntail",
    "<table><tr><td>a<table><tr><td>b<td>c</table></td><td>d</table>": "a b c  d",
    "<table><td>x<td>y</table>": "x  y",
    "<style>p{}</style><script>var t='</p>';</script>x<!-- no --><noscript>n</noscript>": "x",
    "<p style='display: none'>no<p hidden>no<span aria-hidden=true>no</span><p>yes": "yes",
    "<div style='visibility:hidden'>no <b>no</b></div>y": "y",
    "<head><title>t</title></head><body>b": "b",
    "<head><meta charset=x><p>body": "body",
    "<pre>a  b\n  c</pre>d": "a  b\n  c\n\nd",
    "x<br>y<br/>z": "x\ny\nz",
    "&amp;&lt;&eacute;&#955;&nope;": "&<éλ&nope;",
    "<img src=x alt='a cat'> sat": "a cat sat",
    "a < b and c > d": "a < b and c > d",
    "</p></div>x": "x",
    "<h1>T</h1><p>a</p><hr><p>b": "T\n\na\n\nb",
    "<dl><dt>k<dd>v<dt>l<dd>w</dl>": "k\nv\nl\nw",
    "<b>never closed <i>both": "never closed both",
    "<script>never closed": "",
    "<p>a<div>b</p>c": "a\n\nb\n\nc",
}


@pytest.mark.parametrize("source", CASES)
def test_rendering(source):
    assert extract_text(source) == CASES[source]


def test_depth():
    assert extract_text("<div>" * 20000 + "x" + "<p>" * 200 + "y").split() == ["x", "y"]


def test_no_visible_word_is_lost(spark, sf):
    """Against a plain removal of unseen elements and all tags."""
    import html
    import re

    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        plain = re.sub(r"(?s)<!--.*?-->|<(script|style|title)\b.*?</\1>", " ", r.html)
        plain = html.unescape(re.sub(r"<[^>]*>", " ", plain))
        mine = re.sub(r"(?m)^\s*- ", "", extract_text(r.html))
        assert "".join(mine.split()) == "".join(plain.split())


def test_odd_table(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "<p>x", 3), (3, "<p>a" * 50_000, 4), (4, "<p>x", 5), (4, "<p>x", 5)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text int")
    out = sorted(((r.page_id or 0, r.text) for r in extract(pages).collect()))
    assert out == [(0, "x"), (1, ""), (2, ""), (3, "\n\n".join("a" * 50_000)), (4, "x"), (4, "x")]
    assert extract(pages.where(F.lit(False))).count() == 0


STRAYS = {
    "<table><tr><form><td>Name<td>N</form></tr><tr><td>a<td>b</table>": "Name  N\na     b",
    "<table><tr>loose<td>cell</table>": "loose\ncell",
    "<table><tr><td>one</td><div>two <b>three</b></div><a href=x>four</a></tr></table>five": "two three\nfour\none\n\nfive",
    "<table><tbody>text<tr><td>cell</tbody></table>": "text\ncell",
    "<table><tr><td>a</td><table><tr><td>inner</table></tr></table>": "inner\n\na",
    "<table><form><tr><td>a<td>b<tr><td>c<td>d</form></table>": "a  b\nc  d",
    "<table><form><td>a<td>b</form></table>": "a  b",
    "<table><colgroup><col>x<td>a</table>": "x\na",
    "<table><tr><div hidden>no<td>cell</table>": "cell",
    "<table><tr hidden>no<td>no</tr><script>no</script><template><td>no</template></table>": "",
    "a<svg width='1'/>b<p>c": "ab\n\nc",
    "a <svg><title/><style/><path d='x'/><text>label</text><text>two</text></svg> b": "a label two b",
    "<svg>no<defs><text>no</text></defs><title>no</title><g><text>a<tspan>b</tspan></text></g></svg>c": "ab c",
    "<svg><foreignObject><p>in html</p></foreignObject></svg>": "in html",
    "<svg><path d=a/><p>out": "out",
    "<svg><a href=x/><text>in</text></svg>": "in",
    "x <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> y": "x a=2 y",
    "<head><title>t</title>\nfirst words <b>more</b>": "first words more",
    "<head><title>t</title> \n </head><body>b": "b",
}


@pytest.mark.parametrize("source", STRAYS)
def test_text_in_odd_places_is_shown(source):
    assert extract_text(source) == STRAYS[source]


def test_depth_within_a_row():
    assert extract_text("<table><tr>" + "<div>" * 20000 + "x<td>cell").split() == ["x", "cell"]


SPANS = {
    "<table><tr><td colspan=2>wide one<td>c<tr><td>a<td>bb<td>d</table>": "wide one  c\na  bb     d",
    "<table><tr><td rowspan=2>r<td>x<tr><td>y<tr><td>p<td>q</table>": "r  x\n   y\np  q",
    "<table><tr><td colspan=900>a<td>b<tr><td>c</table>": "a  b\nc",
    "<table><tr><td colspan=x rowspan=0>a<td>b</table>": "a  b",
    "<ol><li>a<li value=7>b<li>c</ol>": "1. a\n7. b\n8. c",
    "<svg><text><![CDATA[a<b>]]></text></svg>x": "a<b> x",
    "<math><mtext><![CDATA[p > q]]></mtext></math>": "p > q",
    "<a href='q>r'>s</a>": "s",
    "<a href='q>r": "<a href='q>r",
}


@pytest.mark.parametrize("source", SPANS)
def test_spans_and_numbers(source):
    assert extract_text(source) == SPANS[source]


def test_tables_nest_to_any_depth():
    found = extract_text("<table><tr><td>a" * 100_000)
    assert found == " ".join("a" * 100_000)


LONG = {
    "tag ends": "if (a<b && c<d) ",
    "names": "a<b&&c<d&&",
    "quotes": '<a "',
    "both quotes": "<a \"'",
    "declarations": "<!x",
    "paragraphs": "<div><p>x",
    "lists": "<ul><li>x",
    "end tags": "<b></i></u>",
    "buttons": "<p><button><b><div>",
    "svg": "<svg><text>x",
}


@pytest.mark.parametrize("name", LONG)
def test_time_is_in_proportion_to_the_page(name):
    """Twice the page takes about twice the time; with a search from each place it would take four times."""

    def seconds(size):
        page, tries = LONG[name] * (size // len(LONG[name])) + ">", []
        for _ in range(2):
            begun = time.perf_counter()
            extract_text(page)
            tries.append(time.perf_counter() - begun)
        return min(tries)

    assert seconds(800_000) < 3.2 * seconds(400_000) + 0.2
