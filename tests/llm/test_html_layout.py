"""Layout on pinned pages, and the same words as a plain parser on all pages."""

import re
from html.parser import HTMLParser

import pytest

from plumbline.llm import html_layout, queries

PAGES = {
    # Blocks, folding, entities.
    "<p>One  two\n three<p>Four &amp; five&nbsp;six<div>seven</div>eight": "One two three\n\nFour & five\xa0six\n\nseven\neight",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<h1>T</h1><b>x</b><i>y</i> z": "T\n\nxy z",
    # Implied tags.
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=9><li>a<li value=20>b<li>c</ol>": "9. a\n20. b\n21. c",
    "<ol reversed><li>a<li>b</ol>": "2. a\n1. b",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n    d\nu\n    e",
    "</div></p>x</b>": "x",
    # Visibility.
    "<head><title>no</title></head><body>yes<script>no</script><style>p{}</style><noscript>no</noscript><!-- no --><p hidden>no</p>": "yes",
    "a<span style='display: none'>no</span><span style='visibility:hidden'>no<i style='visibility:visible'>b</i></span>": "ab",
    "<style>.ad, #x {display:none} b {visibility:hidden}</style><p class='c ad'>no</p><p id=x>no</p><b>no</b>yes": "yes",
    "<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>": "s\nt\nyes",
    "<select><option>one<option selected>two</select><input value=no>": "two",
    # Preformatted text and quotations.
    "<pre>\n a\n  b &lt;</pre><blockquote>q<p>r</blockquote>s": " a\n  b <\n\n    q\n\n    r\n\ns",
    "<q>said</q>": "“said”",
    # Tables.
    "<table><caption>C</caption><tr><th>Name<th>Count<tr><td>apple<td align=right>5<tr><td>fig<td align=right>12</table>": "C\nName   Count\napple      5\nfig       12",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td colspan=2>wide cell here<td>d</table>": "a  b\n   c\nwide cell here  d",
    "<table><tr><td>x<br>y<td>1</table>": "x  1\ny",
    "<table><tfoot><tr><td>last</tfoot><tbody><tr><td>first</table>after": "first\nlast\n\nafter",
    "<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>": "in  ner  out",
    "<table>loose<tr><td>a</table>": "loose\na",
    "": "",
    "just text < 5 & <3": "just text < 5 & <3",
    "<a href='x>y'>link</a><!-- open": "link",
    "<script>never closed": "",
}


@pytest.mark.parametrize("page", PAGES)
def test_layout(page):
    assert html_layout.render(page) == PAGES[page]


SHOWN = {
    # Style sheets count where they hold for every screen.
    "<style>@media print { .nav, .note {display:none} } b {visibility:hidden}</style><p class=nav>n</p><p class=note>m</p><b>no</b>yes": "n\n\nm\n\nyes",
    "<style>@media (max-width:600px) {.a {display:none}} @supports (display:grid) {.a {display:none}} @container (width > 9px) {.a {display:none}}</style><i class=a>yes</i>": "yes",
    "<style>@media screen { .a {display:none} @media print {.b {display:none}} } @layer x { .c {display:none} }</style><i class=a>no</i><i class=b>yes</i><i class=c>no</i>": "yes",
    "<style>@media not print {.a {display:none}} @media print, screen {.b {display:none}} @media screen and (min-width:1px) {.c {display:none}} @media not screen {.d {display:none}}</style><i class=a>no</i><i class=b>no</i><i class=c>c</i><i class=d>d</i>": "cd",
    "<style media=print>.a {display:none}</style><style media='screen, print'>.b {display:none}</style><i class=a>yes</i><i class=b>no</i>": "yes",
    "<style>@import 'a;b{c'; .a {background:url(data:x;y{z);display:none} .b {content:'}';display:none} .c {color:red; .d {display:none} @media print {display:none}}</style><i class=a>no</i><i class=b>no</i><i class=c>c</i><i class=d>d</i>": "cd",
    "<style>@font-face {src:url(y)} @keyframes k {from {display:none}} p {display:none}</style><p>no</p>yes": "yes",
    # Formulas, drawings, image maps.
    "see <math><mi>a</mi><mo>+</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><mi>b</mi></math> here": "see a+ 1 2 b here",
    "<math><semantics><mi>x</mi><annotation encoding=tex>no</annotation></semantics><mphantom>no</mphantom></math>": "x",
    "a <svg><title>no</title><defs><text>no</text></defs>no<line x1=0 /><g><text>Sales<tspan> 2024</tspan><desc>no</desc></text><text>Costs</text></g><text display=none>no</text></svg> b": "a Sales 2024 Costs b",
    "<svg><foreignObject><p>in</p></foreignObject><text><![CDATA[1 > 0]]></text></svg>": "in\n\n1 > 0",
    "<map name=m><area href=x><a href=y>North</a> South</map>": "North South",
}


@pytest.mark.parametrize("page", SHOWN)
def test_shown_on_a_screen(page):
    assert html_layout.render(page) == SHOWN[page]


def test_wide_cells_are_aligned():
    long, longer = "word " * 20 + "end", "word " * 90 + "end"
    page = f"<table><tr><td>{long}<td>a<td align=right>1<tr><td>{longer}<td>bb<td align=right>22<tr><td>x<td>c<td align=right>3</table>"
    width = len(longer)
    assert html_layout.render(page) == "\n".join([f"{long:{width}}  a    1", f"{longer}  bb  22", f"{'x':{width}}  c    3"])


def test_depth_changes_nothing():
    wrap = lambda page, n, tag="div": f"<{tag}>" * n + page + f"</{tag}>" * n
    for n in (300, 60_000):
        assert html_layout.render(wrap("a<span style='display:none'>no</span><ol><li>b<li>c</ol><pre> d\n  e</pre>", n)) == "a\n\n1. b\n2. c\n\n d\n  e"
        assert html_layout.render("<div hidden>" + wrap("no", n) + "no</div>yes") == "yes"
        assert html_layout.render("<p>" + wrap("x", n, "b") + "<div>y") == "x\n\ny"
        assert html_layout.render(wrap("<table><tr><td>long<td>b<tr><td>c<td>d</table>", n, "section")) == "long  b\nc     d"
    assert html_layout.render("<ul><li>x" * 400).split("\n")[-1] == "  " * 399 + "- x"
    assert html_layout.render("<table><tr><td>" * 3000 + "in") == "in"


class Words(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.found = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "head")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "head")

    def handle_data(self, data):
        if not self.hidden:
            self.found.append(data)


def test_query_has_all_visible_words(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = queries.op5_html_layout(spark, sf).collect()
    assert len(rows) == len(pages)
    bare = lambda text: re.sub(r"^\s*- |\s+", "", text, flags=re.M)
    for r in rows:
        words = Words()
        words.feed(pages[r.page_id])
        words.close()
        assert bare(r.text) == bare("".join(words.found)) and r.n_chars == len(r.text)


def test_awkward(spark):
    rows = [(1, None), (2, ""), (3, "<div>" * 5000 + "deep" + "</div>" * 5000), (4, "<table>" * 400 + "x"), (5, "<p>" + "word " * 200_000), (5, "<b>twice"), (None, "<" * 3000)]
    df = spark.createDataFrame([(i, h, "u", "text") for i, h in rows], "page_id long, html string, url string, text string")
    got = sorted((str(r.page_id), r.text) for r in html_layout.render_pages(df).collect())
    assert got == sorted([("1", ""), ("2", ""), ("3", "deep"), ("4", "x"), ("5", ("word " * 200_000).strip()), ("5", "twice"), ("None", "<" * 3000)])
    assert html_layout.render_pages(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        html_layout.render_pages(df, keep=["page_id", "text"])


def test_a_long_paragraph_takes_time_in_proportion():
    import time

    from plumbline.llm import html_layout

    def seconds(words):
        begin = time.perf_counter()
        text = html_layout.render("<p>" + "word " * words + "</p><pre>" + "line\n" * words + "</pre>")
        assert text.count("word") == words and text.count("line") == words
        return time.perf_counter() - begin

    seconds(2_000)
    assert seconds(400_000) < 60 * max(0.02, seconds(20_000))
