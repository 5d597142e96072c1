import re
from html.parser import HTMLParser

import pytest

from tarn.llm.html_text import page_text, visible_text

CASES = [
    ("", ""), ("plain  text\n here", "plain text here"), ("<p>one<p>two", "one\n\ntwo"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<div>a</div><div>b</div>c", "a\nb\nc"), ("<h1>T</h1>x<p>y</p>z", "T\n\nx\n\ny\n\nz"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"), ("<ol start=3><li>a<li value=9>b<li>c</ol>", "3. a\n9. b\n10. c"),
    ("<table><tr><th>n<th>value<tr><td>long name<td>1</table>", "n         | value\nlong name | 1"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"), ("<table><tr><td colspan=2>wide<td>x<tr><td>1<td>2<td>3</table>", "wide |   | x\n1    | 2 | 3"),
    ("<table><tr><td>a<p>b</p><td>c</table>after", "a | c\nb\n\nafter"),
    ("<p hidden>no</p><p style='color:red; display:none'>no</p><p>yes", "yes"),
    ("<style>.x, #y{display:none} p.z{visibility:hidden}</style><i class='q x'>no</i><i id=y>no</i><p class=z>no</p><b class=z>yes</b>", "yes"),
    ("<head><title>t</title><script>var t='</p>';</script></head><body>seen", "seen"), ("<!-- <p>no</p> -->a<!doctype html><!-- open", "a"),
    ("a &amp; b &lt;c&gt; &copy;&nbsp;d", "a & b <c> © d"), ("<pre>  x\n   y</pre>z", "  x\n   y\n\nz"), ("1 < 2 and <3", "1 < 2 and <3"),
    ("<details><summary>s</summary>no</details><details open>yes</details><dialog>no</dialog>", "s\nyes"), ("<b>a</i>b</b></div>c", "abc"),
    ("<p><b>x<br><p>y", "x\n\ny"), ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("<a title='x > y' href=q>link</a>", "link"), ("<td>stray</td><li>item", "stray\n- item"), ("<select><option>a<option>b</select>", "a\nb"),
    ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in | ner | out"), ("x<script>never closed <p>", "x"), ("<p", "<p"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_cases(page, text):
    assert page_text(page) == text


class Seen(HTMLParser):
    """Words outside unseen elements, in order: the layout-free reference."""

    def __init__(self):
        super().__init__()
        self.words, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("head", "script", "style", "noscript", "template")
        if tag not in ("b", "i", "a", "em", "strong", "span", "u"):
            self.words.append(" ")

    def handle_endtag(self, tag):
        self.skip -= tag in ("head", "script", "style", "noscript", "template")
        if tag not in ("b", "i", "a", "em", "strong", "span", "u"):
            self.words.append(" ")

    def handle_data(self, data):
        if not self.skip:
            self.words.append(data)


def test_all_words_of_all_pages_survive(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in visible_text(rows).collect()}
    for r in rows.collect():
        s = Seen()
        s.feed(r.html)
        s.close()
        mine = [w for w in re.sub(r"(?m)^\s*(- |\d+\. )", " ", got[r.page_id].replace(" | ", " ")).split() if w != "|"]
        assert sorted(mine) == sorted(w for w in re.sub(r"(?m)^\s*(- |\d+\. )", " ", "".join(s.words)).split() if w != "|")


def test_deep_odd_and_empty(spark):
    assert page_text("<div>" * 20000 + "x") == "x" and page_text("<ul><li>" * 3000 + "y").strip().endswith("y")
    assert len(page_text("<p>" + "word " * 300000).split()) == 300000
    df = spark.createDataFrame([(1, None, "u"), (None, "<p>a", "u"), (1, None, "u"), (2, "", "u")], "page_id long, html string, text string")
    assert sorted(((r.page_id, r.text) for r in visible_text(df).collect()), key=str) == [(1, ""), (1, ""), (2, ""), (None, "a")]
    assert visible_text(df.limit(0)).collect() == []


SHEETS = [
    ("@media print { .nav, #menu { display: none } }", True), ("@media (max-width: 600px) { .nav{display:none} }", True), ("@media screen { .nav{display:none} }", False),
    ("@media (min-width: 40em) and (orientation: landscape) { .nav{display:none} }", False), ("@media print, (width >= 900px) { .nav{display:none} }", False),
    ("@media not print { .nav{display:none} }", False), ("@media not all and (max-width: 600px) { .nav{display:none} }", False), ("@media (400px < width <= 700px) { .nav{display:none} }", True),
    ("@media print { i{color:red} .nav{display:none} } #menu{display:none}", False), ("@supports (display: grid) { @media print { .nav{display:none} } }", True),
    ("@media (not (max-width: 600px)) { .nav{display:none} }", False), (".nav { @media print { display: none } }", True), (".nav { @media screen { display: none } }", False),
    ("@keyframes x { i { visibility: hidden } }", True), (".nav{display:none} .nav{display:block}", True), (".nav{display:block} .nav{display:none}", False),
    (".nav{display:none} @media (min-width: 600px) { .nav{display:flex} }", True), (".nav{display:none} @media (max-width: 600px) { .nav{display:flex} }", False),
    (".nav{visibility:hidden} .nav{display:block}", False), (".nav{visibility:hidden;} .nav{visibility:visible}", True), (".nav{display:none !important} .nav{display:block}", False),
    ("#menu{display:block} .nav{display:none}", True), (".nav{display:none} i{display:block}", False), (".nav{display:none} .nav.on{display:block}", True),
    ("i::after{content:'}{ @media'} .nav{display:none}", False), ("/* } */ .nav{display:none", False), ("@import url(x.css); .nav{display:none}", False),
]


@pytest.mark.parametrize("sheet,seen", SHEETS)
def test_style_rules_count_as_on_a_wide_screen(sheet, seen):
    assert page_text(f"<style>{sheet}</style><i class='nav on' id=menu>nav</i><b>rest</b>") == ("navrest" if seen else "rest")


def test_style_sheets_of_other_media_and_inline_styles():
    assert page_text("<style media=print>i{display:none}</style><i>x</i>") == "x"
    assert page_text("<style>i{display:none}</style><i style='display:inline'>x</i><i>y</i>") == "x"
    assert page_text("<style>i{display:none!important}</style><i style='display:inline'>x</i>y") == "y"
