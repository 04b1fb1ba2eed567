import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from despacho.llm.rendering import page_texts, visible_text, with_visible_text

CASES = {
    "": "",
    "plain  text": "plain text",
    "<p>a<p>b": "a\n\nb",
    "<div>a</div>b<div>c": "a\nb\nc",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<b>a</b> <i>b</i>c": "a bc",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e": "- a\n- b\n  - c\n- d\n\ne",
    "<ol start=9><li>a<li>b<br>c</ol>": "9. a\n10. b\n    c",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\n    d\nu",
    "<table><tr><th>Name<th>N<tr><td>x<td>10<tr><td>longer<td>2</table>": "Name    N\nx       10\nlonger  2",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c</table>": "a  b\n   c",
    "<table><tr><td colspan=2>wide cell<tr><td>a<td>b</table>": "wide cell\na  b",
    "<table><tfoot><tr><td>f<tbody><tr><td>b</table>": "b\nf",
    "<table><tr><td>a<table><tr><td>b</table></table>": "a\n\nb",
    "<pre>\n a\n  b</pre>c": " a\n  b\n\nc",
    "<script>if(a<b)'</p>'</script>x<style>y</style><!-- z -->": "x",
    "<title>t</title><body>b": "b",
    "a<span hidden>b</span><p style='display: NONE'>c</p><input type=hidden value=x>d": "ad",
    "&amp;&lt;&copy;&#233;&bogus;": "&<©é&bogus;",
    "<details><summary>s</summary>more</details><details open><summary>t</summary>shown</details>": "s\nt\nshown",
    "<select><option>a<option selected>b</select>": "b",
    "a < b <3": "a < b <3",
    "<p>a<b>b<p>c": "ab\n\nc",
    "<a href='x>y'>link</a>": "link",
    "</p></table>x": "x",
    "<h1>H</h1>t": "H\n\nt",
    "<textarea>\n raw <b></textarea>": " raw <b>",
}


@pytest.mark.parametrize("html", CASES)
def test_layout(html):
    assert visible_text(html) == CASES[html]


@pytest.mark.parametrize("html", ["<", "<a", '<a href="x', "<!--", "<script>", "<p b='" * 200, "<div>" * 20_000 + "x", "<table><tr><td>" * 300 + "x"])
def test_broken_and_deep_pages(html):
    assert visible_text(html) in ("", "<", "x")


TAGS = "p div ul ol li table tr td th b br pre details dl dt dd select option span h1 tbody thead".split()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([f"<{t}>" for t in TAGS] + [f"</{t}>" for t in TAGS]), st.from_regex(r"w[0-9]{6}", fullmatch=True)), max_size=40))
def test_no_visible_word_is_lost_or_made(parts):
    html = "".join(p if p.startswith("<") else f" {p} " for p in parts)
    hides = any(t in html for t in ("<details>", "<select>"))
    shown = sorted(visible_text(html).replace("-", " ").split())
    words = sorted(p for p in parts if not p.startswith("<"))
    shown = [w for w in shown if w.startswith("w")]
    assert set(shown) <= set(words) if hides else shown == words


def words_of(html):
    return [w for w in visible_text(html).replace("-", " ").split() if w.startswith("w")]


@pytest.mark.parametrize(
    "html, text",
    [
        ("<html><head><title>T</title><p>Hello", "Hello"),
        ("<head><meta charset=utf-8><style>s</style>Hello", "Hello"),
        ("<head><title>T</title></head>Hello", "Hello"),
        ("<div>a<head>b</div>c", "ab\nc"),
        ("<p>a<body>b", "ab"),
        ("<head hidden><p>a", "a"),
        ("<body hidden>a", ""),
        ("<table><colgroup><col><tr><td>A</table>", "A"),
        ("<table><colgroup><col><td>A</table>", "A"),
        ("<table><colgroup>A<tr><td>B</table>", "A\nB"),
        ("<table><caption>C<tr><td>A<td>B<tr><td>D</table>", "C\nA  B\nD"),
        ("<table><caption>C<col><td>A</table>", "C\nA"),
        ("<table><tr><td>A<colgroup><col><tr><td>B</table>", "A\nB"),
    ],
)
def test_tags_left_out_in_head_and_columns(html, text):
    assert visible_text(html) == text


MORE_TAGS = [*TAGS, *"head body colgroup col caption".split() * 3]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([f"<{t}>" for t in MORE_TAGS] + [f"</{t}>" for t in MORE_TAGS]), st.from_regex(r"w[0-9]{6}", fullmatch=True)), max_size=40))
def test_no_word_is_lost_with_heads_and_columns(parts):
    html = "".join(p if p.startswith("<") else f" {p} " for p in parts if p not in ("<details>", "<select>"))
    assert sorted(words_of(html)) == sorted(p for p in parts if not p.startswith("<"))


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p style='backface-visibility:hidden'>a", "a"),
        ("<p style='-webkit-backface-visibility: hidden; color:red'>a", "a"),
        ("<p style='x-display:none'>a", "a"),
        ("<p style='content:\";display:none\"; background:url(a;display:none)'>a", "a"),
        ("<p style='display:none;display:block'>a", "a"),
        ("<p style='display:none;display:bogus'>a", ""),
        ("<p style='display:none !important;display:block'>a", ""),
        ("<p style='color:red;/* x */ DISPLAY : None'>a", ""),
        ("<p hidden style='display:block'>a<dialog>b</dialog>", "a"),
        ("<div style='visibility:hidden'>a<p style='visibility:visible'>b</p>c</div>d", "b\n\nd"),
        ("<div style='visibility:hidden'>a<p>b</p></div>c", "c"),
        ("<div style='visibility:hidden'><div style='display:none'><p style='visibility:visible'>a</div></div>b", "b"),
        ("<ol style='visibility:hidden'><li>a<li style='visibility:visible'>b<li>c<b style='visibility:visible'>d</b></ol>", "2. b\n   d"),
        ("<table><tr><td style='visibility:hidden'>a<td>b<tr><td>c<td>d</table>", "   b\nc  d"),
        ("<math><mi>x</mi><mo>=</mo><mn>1</mn></math>", "x=1"),
        ("<math><semantics><mi>x</mi><annotation>\\x</annotation></semantics></math>y", "xy"),
        ("<svg><title>t</title><desc>u</desc><defs><text>v</text></defs><text>a</text><text>b</text></svg>", "a b"),
        ("<svg><title/><script href=x /><path d=M0 /><text><![CDATA[a<b]]></text></svg>c", "a<b c"),
        ("<svg><defs><p>a", "a"),
        ("<svg><foreignObject><div>a</div>b</foreignObject><desc>c</desc></svg>d", "a\nbd"),
        ("<p><svg><text>a</svg>b</p>c", "a b\n\nc"),
        ("<title>t</title><metadata>a</metadata><symbol>b</symbol>", "ab"),
        ("<select multiple><option>a<option selected>b<option>c</select>", "a b c"),
        ("<select size=3><option>a<option selected>b<option>c</select>", "a b c"),
    ],
)
def test_what_a_browser_shows(html, text):
    assert visible_text(html) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p title=don't>Hello <b>you</b>", "Hello you"),
        ('<p title=5"x class=a>Hello', "Hello"),
        ("<p title=a=\"b>Hello</p>'", "Hello\n\n'"),
        ("<p don't>Hello</p>isn't", "Hello\n\nisn't"),
        ("<p title='a'b\">Hello\"", 'Hello"'),
        ("<p title = 'a>b' x>Hello", "Hello"),
        ("<p title=\n\"a>b\" hidden>Hello", ""),
        ("<p title= >Hello", "Hello"),
        ("<p ='a>Hello", "Hello"),
        ("</p title=don't>Hello", "Hello"),
        ("<input value=it's>", "it's"),
        ("<input value='a b'/><input value=c/>", "a b c/"),
        ("<p title='a>b", ""),
    ],
)
def test_quotes_open_values_only_behind_equals_signs(html, text):
    assert visible_text(html) == text


@pytest.mark.parametrize("part", ["a", " ", "=", "'", "a=", "='", " a", "/ ", "a='", '"=', "< a"])
def test_long_tags_take_linear_time(part):
    assert visible_text("x<p " + part * 100_000) in ("x", "x" + part)


def test_edge_rows(spark):
    rows = [(1, None, "t"), (2, "", "t"), (3, "<p>" + "long " * 50_000, "t"), (3, "<p>x", "t"), (None, "<b>y", "t")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = {(r.page_id, r.n_chars): r.text for r in page_texts(pages).collect()}
    assert got[1, 0] is None and got[2, 0] == "" and got[3, 1] == "x" and got[None, 1] == "y" and (3, 249_999) in got
    assert with_visible_text(pages).columns == ["page_id", "html", "text"]
    assert page_texts(pages.limit(0)).collect() == []


SHAPES = {
    "implied ends": lambda n: "<p><button>" + "<i>" * n + "<p>a" * n,
    "end tags": lambda n: "<x><table><tr><td>" + "<i>" * n + "</x>a" * n,
    "wide and high cells": lambda n: "<table>" + "<tr><td colspan=1000 rowspan=65534>a" * n,
    "stairs": lambda n: "<table>" + "<tr><td rowspan=65534>a" * n,
    "lists": lambda n: "<ul><li>a" * n,
    "quotes": lambda n: "<blockquote>a" * n,
    "drawings": lambda n: "<svg>" + "<g>" * n + "</q>a" * n,
    "tables": lambda n: "<table><tr><td>a<td>b" * n,
    "sparse tables": lambda n: ("<table><tr><td>a" + "<tr>" + "<td>" * 30 + "b</table>") * n,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_time_and_text_grow_with_the_page(shape):
    made = []
    for n in (4000, 16000):
        page = SHAPES[shape](n)
        start = time.process_time()
        text = visible_text(page)
        made.append((time.process_time() - start, len(text)))
        assert len(re.findall("[ab]", text)) == len(re.findall("(?<=>)[ab]", page))
    (least, few), (most, many) = made
    assert many <= 4.5 * few + 10_000
    assert most <= 10 * max(least, 0.1)  # quadratic would be 16 times


def test_a_table_of_few_filled_cells_stays_aligned():
    rows = [["x" if (r * 7) % 40 == c else "" for c in range(40)] for r in range(40)]
    page = "<table>" + "".join("<tr>" + "".join(f"<td>{x}</td>" for x in row) for row in rows)
    lines = visible_text(page).split("\n")
    assert len({line.index("x") for line in lines if line}) > 30


@pytest.mark.parametrize(
    "page, text",
    [
        ("<ol reversed><li>a<li>b<li hidden>c</ol>", "2. a\n1. b"),
        ("<ol start=4><li>a<li value=9>b<li>c</ol>", "4. a\n9. b\n10. c"),
        ("<ol type=a start=26><li>x<li>y</ol>", "z. x\naa. y"),
        ("<ol type=I start=1994><li>x</ol>", "MCMXCIV. x"),
        ("<ol type=i><li>x<li type=A>y</ol>", "i. x\nB. y"),
        ("<ol type=I start=0><li>x</ol>", "0. x"),
        ("<ruby>k<rp>(</rp><rt>r</rt><rp>)</rp></ruby>", "kr"),
        ("a<progress>half</progress> <meter>full</meter>b", "a b"),
        ("<plaintext><b>x</b></plaintext>", "<b>x</b></plaintext>"),
        ("<select multiple><optgroup label=G><option>o<option>p</select>", "G o p"),
        ("<select><optgroup label=G><option>o<option>p</select>", "o"),
    ],
)
def test_as_browsers_show_it(page, text):
    assert visible_text(page) == text
