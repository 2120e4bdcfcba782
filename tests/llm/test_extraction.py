from __future__ import annotations

import random

import pytest

from lithic.llm.extraction import extract, extracted

CASES = {
    "": "",
    "plain & text &amp; more": "plain & text & more",
    "<p>One <b>two</b>  three<br>four<p>Five": "One two three\nfour\n\nFive",
    "<title>no</title><body>a<!-- c -->b<script>if (a < b) '</p>'</script> c<style>p{}</style>": "ab c",
    "<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>": "- a\n- b\n  3. x\n  4. y\n- c",
    "<ol reversed><li>a<li value=7>b</ol>": "2. a\n7. b",
    "<dl><dt>t<dd>d<dd>e</dl>": "t\n  d\n  e",
    "<table><caption>C</caption><tr><th>Name<th>Qty<tr><td>apple<td>1</table>z": "C\nName   Qty\napple  1\n\nz",
    "<table><tr><td rowspan=2>r<td>q<tr><td>z<tr><td colspan=2>long one</table>": "r  q\n   z\nlong one",
    "<table><tr><td><ul><li>a<li>b</ul><td>x</table>": "- a  x\n- b",
    "<table><tr><td><table><tr><td>in<td>ner</table><td>x</table>": "in  ner  x",
    "<div hidden>no</div><p style='color:red; display : none'>no</p><p style='display:block'>yes": "yes",
    "a<span style='visibility:hidden'>b</span>c<input type=hidden value=x><img alt=pic>": "acpic",
    "<pre>\n keep\n   this</pre>after": " keep\n   this\n\nafter",
    "<blockquote>q<p>w</blockquote>e": "  q\n\n  w\n\ne",
    "<details><summary>S</summary>shut</details><details open><summary>T</summary>wide</details>": "S\nT\nwide",
    "<p><b>bold<br><p>next</p></b>tail</p>": "bold\n\nnext\n\ntail",
    "a < b and c > d <3 </ x> &lt;b&gt;": "a < b and c > d <3 <b>",
    "x<hr>y": "x\n\n----\n\ny",
    "<textarea> t</textarea><select><option>o</select><noscript>n</noscript>": " t",
    "<a title='a > b' href=x>link</a>": "link",
    "<head><title>T</title><body>Hello <b>x</b>": "Hello x",
    "<html><head><title>T</title>\n<body><script>s</script>bare <i>text</i>": "bare text",
    "<head><title>T</title>\n<script>s</script>Hello <b>x</b>": "Hello x",
    "<head><noscript><link><body>Hello": "Hello",
    "<head><template><body>no</template><title>T</title></head>yes": "yes",
    '<span style="visibility:hidden">a<span style="visibility:visible">b</span></span>c': "bc",
    "<ul style='visibility: hidden'><li>no<li style='visibility:visible'>yes<li>no</ul>end": "- yes\n\nend",
    "<ol><li style='visibility:hidden'>a<b style='visibility:visible'>b</b><li>c</ol>": "   b\n2. c",
    "<div style='visibility:hidden'>a<img alt=p><input type=submit value=v><hr></div>z": "z",
    "<p style='display:none;display:block'>a<p style='visibility:visible; visibility:hidden'>b": "a",
    "<div style='display:none'>a<b style='visibility:visible;display:block'>b</b></div>c": "c",
    "<table><tr><td style='visibility:hidden'>aa<td>x<tr><td>b<td>y</table>": "   x\nb  y",
    "<table><tr style='visibility:collapse'><td>a<td>x<tr><td>b<td>y</table>": "b  y",
    "<table><tbody style='visibility:hidden'><tr><td>a<td style='visibility:visible'>x</table>": "x",
    "<table style='visibility:hidden'><caption>c</caption><tr><td>a</table>z": "z",
    "<object><p>instead</p></object><object data=x>no</object><object type=y>no</object>": "instead",
}


@pytest.mark.parametrize("page", CASES)
def test_rendered_text(page):
    assert extract(page) == CASES[page]


def test_deep_nesting_wide_spans_and_noise():
    assert extract("<div>" * 20000 + "deep" + "</div>" * 20000) == "deep"
    assert extract("<table>" * 600 + "<tr><td>deep") == "deep"
    assert extract("<table><tr><td colspan=99999999 rowspan=999999999>a<td>b</table>").split() == ["a", "b"]
    rnd = random.Random(1)
    parts = "<p> <li> <table> <tr> <td colspan=2> </td> </table> <ul> </ul> <ol> <pre> </pre> <b> </p> text <!-- --> < & &#0; <a".split(" ")
    for _ in range(400):
        extract("".join(rnd.choice(parts) for _ in range(40)))


def test_long_pages_take_time_in_proportion():
    assert len(extract("<p>word &amp; word <i>x</i>\n" * 30000).split()) == 120000
    assert extract("<" * 30000) == "<" * 30000
    assert extract('<a href="' + "x" * 200000) in ("", '<a href="' + "x" * 200000)


def test_long_cells_are_whole_and_widen_no_other_line():
    page = "<table><tr><td>" + "word " * 100000 + "<td>x<tr><td>y<td>" + "<br>".join(map(str, range(20000))) + "</table>"
    text = extract(page)
    lines = text.split("\n")
    assert lines[0].split() == ["word"] * 100000 + ["x"] and lines[1] == "y".ljust(1000) + "0" and len(lines) == 20001
    assert [line.split()[-1] for line in lines[1:]] == [str(k) for k in range(20000)]
    assert len(text) <= len(page) + 1002 * len(lines)


def test_columns(spark):
    rows = [(1, None, "mine"), (2, "", "mine"), (3, "<p>a", "mine"), (3, "<p>a", "mine")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = extracted(pages)
    assert out.columns == pages.columns
    assert sorted(tuple(r) for r in out.select("page_id", "text").collect()) == [(1, ""), (2, ""), (3, "a"), (3, "a")]
    assert extracted(pages.limit(0)).count() == 0
