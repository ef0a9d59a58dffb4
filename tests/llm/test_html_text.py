"""Pages and their text as a browser would lay it out in plain lines."""

import random
import re
import time

import pytest

from strata.llm.html_text import extract, visible_text

CASES = [
    ("", ""),
    ("plain  text\n here", "plain text here"),
    ("<p>One<p>Two", "One\n\nTwo"),
    ("a<br>b<br/>c</br>d", "a\nb\nc\nd"),
    ("a<br><br>b", "a\n\nb"),
    ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("<b>a</b><i>b</i> <u>c</u>", "ab c"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
    ("<ul><li>a<p>b</ul>c", "- a\n\n  b\n\nc"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\nd\nu\ne"),
    ("<table><tr><th>Name<th>N<tr><td>alpha<td>1</table>", "Name  | N\nalpha | 1"),
    ("<table><tr><td colspan=2>long head<tr><td>a<td>b</table>", "long head\na | b"),
    ("<table><caption>C</caption><tr><td>a<br>b<td>c</table>d", "C\na | c\nb |\n\nd"),
    ("<table><td>a<td><table><tr><td>x<td>y</table></table>", "a | x | y"),
    ("<td>no table</td>", "no table"),
    ("<pre>\n a\n\n  b</pre>c", " a\n\n  b\n\nc"),
    ("<p hidden>x</p><p style='display: none'>y<b>z</b></p><p style=visibility:hidden>w</p>ok", "ok"),
    ("<script>a<b></script><style>p{}</style><noscript>n</noscript><template>t</template>v", "v"),
    ("<head><title>T</title></head><body>b", "b"),
    ("<!-- a --> b <!doctype html> c <![CDATA[d]]> e", "b c e"),
    ("&lt;b&gt; &amp;amp; &eacute;&#65;&nbsp;x", "<b> &amp; éA\xa0x"),
    ("1 < 2 <3 a<b>c", "1 < 2 <3 ac"),
    ("<a title=\"x>y\" href='a>b'>t</a>", "t"),
    ("<p>a</div>b</p>c</p>", "ab\n\nc"),
    ("<textarea> a <b> </textarea>", "a <b>"),
    ("<p", ""),
    ("<b>unclosed", "unclosed"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("<p>a<table><tr><td>b</table>", "a\n\nb"),
    ("<h1>H</h1>x<hr>y", "H\n\nx\n\ny"),
    ("a <svg>no<title>t</title><desc>d</desc><defs/><g><text>one <tspan>two</tspan></text><text>three</text></g></svg> b", "a one two three b"),
    ("<svg><style/><title/><path d='M0'/><foreignObject><p>in</p></foreignObject><text><![CDATA[<c>]]></text></svg>d", "in\n\n<c> d"),
    ("<svg><defs><text>no</text></defs><text>yes</text><p>out", "yes\n\nout"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math>.", "x=1."),
    ("a<!-->b<!--->c<!-- d --!>e<!-- > -->f", "abcef"),
    ("<desc>d</desc><text>t</text>", "dt"),
    ("<html><head><title>T</title><p>Hello</p><div>All</div>", "Hello\n\nAll"),
    ("<head><meta charset=x><link><style>a{}</style>text <b>bold</b>", "text bold"),
    ("<head><title>T</title><script>s</script> \n <body>b", "b"),
    ("<head>\n<template><p>no</p></template><h1>H</h1>", "H"),
    ("<body>a<head><title>t</title>b", "ab"),
    ("<p style='backface-visibility:hidden'>shown", "shown"),
    ("<p style='color:red; VISIBILITY : hidden'>no<b style='visibility:visible'>yes</b></p>", "yes"),
    ("<p style='display:none'>no<b style='visibility:visible'>no</b></p>ok", "ok"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("<details>no<p>no</p><summary>S</summary><summary>no</summary>no</details>after", "S\nafter"),
    ("<details open><summary>S</summary>yes</details>", "S\nyes"),
    ("<details>no<details open><summary>no</summary></details></details>x", "x"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
    ("<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a | b | c\nd |   | e\nf |   | g"),
    ("<table><tr><td>a<td>b<tr><td colspan=1000>long line here<tr><td>c<td>d</table>", "a | b\nlong line here\nc | d"),
    ("<ol><li>a<li value=7>b<li>c</ol>", "1. a\n7. b\n8. c"),
    ("<ol start=0><li>a</ol>", "0. a"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_text(page, text):
    assert visible_text(page) == text


def test_depth_and_open_quotes_are_no_problem():
    assert visible_text("<div>" * 50_000 + "x") == "x"
    assert visible_text("<ul><li>" * 300 + "x").endswith("- x")
    visible_text('<a b="' * 5_000)
    visible_text("<" * 20_000)


def test_wide_cells_wrap_and_lose_nothing():
    words = [f"w{k}" for k in range(4_000)]
    page = f"<table><tr><td>{' '.join(words)}<td>x</table>" + "<table>" + "<tr><td>a<td>b" * 5 + "</table>"
    text = visible_text(page)
    assert [w for w in text.split() if w.startswith("w")] == words
    assert max(map(len, text.split("\n"))) <= 84 and len(text) < 2 * len(page)


@pytest.mark.parametrize(
    "page",
    [
        "<table><tr><td>" + "x" * 20_000 + "<tr><td>a<td>b" * 1_000 + "</table>",
        "<table>" + "<tr><td>a<td colspan=1000>b" * 1_000 + "</table>",
        "<table><tr>" + "<td>a" * 5_000 + "<td>" + "word " * 20_000 + "</table>",
        "<table>" + "<tr><td rowspan=65534 colspan=1000>a" * 1_000 + "</table>",
        "<table><tr><td>" + "word " * 20_000 + "<td>a" * 100 + "<tr><td>a<td>b" * 1_000 + "</table>",
    ],
)
def test_texts_of_tables_are_not_much_longer_than_their_pages(page):
    start = time.process_time()
    assert len(visible_text(page)) < 12 * len(page)
    assert time.process_time() - start < 5


@pytest.mark.parametrize("page", ["<span>" * 20_000 + "<li>x" * 20_000, "<table><tr>" + "<td><b>" * 20_000, "<p><i>" * 20_000 + "</p>" * 20_000, "<div>" * 50_000 + "</b>" * 50_000])
def test_deep_pages_take_time_in_proportion(page):
    start = time.process_time()
    visible_text(page)
    assert time.process_time() - start < 5


class Pages:
    """Pages made at random of words whose visibility is known from how they were made."""

    def __init__(self, seed):
        self.rng, self.shown, self.n = random.Random(seed), [], 0

    def word(self, shows):
        self.n += 1
        word = f"w{self.n}w"
        if shows:
            self.shown.append(word)
        return word

    def inline(self, shows, depth):
        kind = self.rng.randrange(7)
        if depth <= 0 or kind < 2:
            return f" {self.word(shows)} "
        if kind == 2:
            return f"<!-- {self.word(False)} --><script>{self.word(False)}</script>"
        if kind == 3:
            return f"<span hidden>{self.inline(False, depth - 1)}</span>"
        if kind == 4:
            return f"<b style='top:0;display:none'>{self.inline(False, depth - 1)}</b>"
        if kind == 5:
            return f"<i style='overflow-visibility:hidden'>{self.inline(shows, depth - 1)}</i>"
        return f"<em>{self.inline(shows, depth - 1)}<br>{self.inline(shows, depth - 1)}</em>"

    def block(self, shows, depth):
        if depth <= 0:
            return f"<p>{self.inline(shows, 2)}" + self.rng.choice(["", "</p>"])
        inner = lambda s=shows: self.block(s, depth - 1)
        kind = self.rng.randrange(9)
        if kind == 0:
            return f"<div>{inner()}{inner()}</div>"
        if kind == 1:
            return "<ul>" + "".join(f"<li>{inner()}" for _ in range(3)) + "</ul>"
        if kind == 2:
            return "<table>" + "".join(f"<tr><td>{inner()}<td>{self.inline(shows, 1)}" for _ in range(2)) + "</table>"
        if kind == 3:
            return f"<details>{inner(False)}<summary>{self.inline(shows, 1)}</summary>{inner(False)}</details>"
        if kind == 4:
            return f"<dialog>{inner(False)}</dialog><details open><summary>{self.inline(shows, 1)}</summary>{inner()}</details>"
        if kind == 5:
            return f"<blockquote style='display:none'>{inner(False)}</blockquote>"
        if kind == 6:
            return f"<h2>{self.inline(shows, 2)}</h2><template>{inner(False)}</template>"
        if kind == 7:
            return f"<dl><dt>{self.inline(shows, 1)}<dd>{inner()}<dt>{self.inline(shows, 1)}</dl>"
        return f"<pre>{self.inline(shows, 0)}</pre>{inner()}"

    def page(self):
        head = self.rng.choice(["", "<head><title>{0}</title>", "<html><head><style>{0}</style></head><body>", "<head><meta x><script>{0}</script>"])
        return head.format(self.word(False)) + "".join(self.block(True, 3) for _ in range(4))


@pytest.mark.parametrize("seed", range(150))
def test_pages_made_of_known_words(seed):
    made = Pages(seed)
    text = visible_text(made.page())
    found = re.findall(r"w\d+w", text)
    assert sorted(found) == sorted(made.shown)
    if "|" not in text:
        assert found == made.shown


def test_extract(spark):
    pages = spark.createDataFrame([(1, "<p>a", "t"), (2, None, "t"), (2, None, "t"), (None, "", "t")], "page_id long, html string, text string")
    assert sorted(map(tuple, extract(pages).collect()), key=str) == sorted([(1, "a"), (2, None), (2, None), (None, "")], key=str)
    assert extract(pages.limit(0)).collect() == []
