"""Rendered pages: layout cases, repairs, visibility, and every visible word of the given pages."""

import html
import re
import time
from collections import Counter

import pytest
from pyspark.sql import Row

from tessera.llm.html_text import extract_text, page_text

CASES = [
    ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b", "a\n\nb"), ("<p>a</p>b<p>c</p>", "a\n\nb\n\nc"),
    ("<div>a</div><div>b</div>", "a\nb"), ("a<br>b<br/>c", "a\nb\nc"), ("x <b>y</b>z <i> w</i>", "x yz w"),
    ("<ul><li>a<li>b<ul><li>c</li></ul></ul>d", "- a\n- b\n  - c\n\nd"),
    ("<ol start=3><li>a</li><li value=9>b</li><li>c</li></ol>", "3. a\n9. b\n10. c"),
    ("<table><tr><th>n<th>long name<tr><td>wide cell<td>2</table>", "n          long name\nwide cell  2"),
    ("<table><td>a<td colspan=2>bcd<tr><td>1<td>2<td>3</table>", "a  bcd\n1  2  3"),
    ("<table><caption>T</caption><tr><td><p>a</p><p>b</p></td><td>c</td></tr></table>", "T\na  c\n\nb"),
    ("<pre>  a\n   b</pre>", "  a\n   b"), ("<script>x<p></script>a<style>b</style>", "a"),
    ("<head><title>t</title></head><body>b", "b"), ("<title>t</title><p>b", "b"),
    ("<p hidden>a</p><p style='color:red; display: none'>b</p><p style='visibility:hidden'>c<b>d</b></p><p>e", "e"),
    ("<details><summary>s</summary>x</details><details open><summary>t</summary>y</details>", "s\nt\ny"),
    ("a<!-- b -->c &amp; &lt;d&gt; &copy;", "ac & <d> ©"), ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\n    b\nc\n    d"),
    ("<td>a<td>b", "a b"), ("</p>a</div>b</span>", "ab"), ("<h1>a</h1><p>b</p><hr>c", "a\n\nb\n\nc"),
    ("<ul><li><p>a</p><p>b</p></li></ul>", "- a\n\n  b"), ("<template>a</template><noscript>b</noscript>c", "c"),
    ("<div style='visibility:hidden'>no<span style='visibility:visible'>yes</span>no</div>", "yes"),
    ("<div style='display:none'>no<span style='display:block;visibility:visible'>no</span></div>a", "a"),
    ("<p style='display:none;display:block'>a<p style='display:none!important;display:block'>b<p hidden style='display:block'>c", "a\n\nc"),
    ("<ul style='visibility:hidden'><li>a<li style='visibility:visible'>b</ul>", "- b"),
    ("<textarea>one<b>x</b>\n two &amp; three</textarea>", "one<b>x</b>\n two & three"), ("<title><p>t</title>a", "a"),
    ("<iframe><p>x</iframe>a<noscript>b</noscript><xmp><b>c</xmp>d", "a<b>cd"), ("<script>a</scripty>b</SCRIPT >c", "c"),
    ("<table><tr><td rowspan=2>A<td>B<td>C<tr><td>D<td>E</table>", "A  B  C\n   D  E"),
    ("<table><tr><td>A<td rowspan=3 colspan=2>B<td>C<tr><td>D<td>E<tr><td>F<td>G</table>", "A  B  C\nD     E\nF     G"),
    ("<table><tbody><tr><td rowspan=0>A<td>B<tr><td>C<tbody><tr><td>D<td>E</table>", "A  B\n   C\nD  E"),
    ("<!-->a<!--->b<!--x--!>c<!-- > -->d<!x>e<?y?>f</ g>h</>i<1<j", "abcdefhi<1"), ("a < b <3 c", "a < b <3 c"),
    ("<p title='a>b' x=\"c>\" y=d/e>f", "f"), ("a<b title='", "a"), ("&#" + "0" * 5000 + "65;&#" + "9" * 5000 + ";", "A\ufffd"),
    ("<p>a<table><tr><td>b</table>c", "a\n\nb\n\nc"), ("<select><option>a<option>b</select>", "a\nb"),
]


@pytest.mark.parametrize("markup,want", CASES)
def test_layout(markup, want):
    assert page_text(markup) == want


def test_deep_and_broken_markup():
    assert page_text("<div>" * 5000 + "x" + "</div>" * 5000 + "y").split() == ["x", "y"]
    assert page_text("<li>" * 2000 + "z").split()[-1] == "z"
    assert "a" in page_text("<table>" * 300 + "<td>a")
    for junk in ("<", "<a", "<a href='", "&#x110000;", "&#0;", "<!doctype", "<![CDATA[x]]>", "<?x ?>", "</", "<p/", "\0"):
        page_text(junk)


DEEP = [
    ("a<script>x</script><style>y</style><template>z</template><p hidden>h</p><p style='display:none'>i<b>j</b></p>b", "ab"),
    ("<table><tr><th>n<th>long name<tr><td>wide cell<td>2</table>", "n          long name\nwide cell  2"),
    ("<ul><li>a<li>b<ul><li>c</li></ul></ul>d", "- a\n- b\n  - c\n\nd"),
    ("<div>a<div>b</div>c</div>d", "a\nb\nc\nd"), ("<details><summary>s</summary>x</details>y", "s\ny"),
]


@pytest.mark.parametrize("markup,want", DEEP)
@pytest.mark.parametrize("depth", [0, 149, 200, 20_000])
def test_layout_below_unclosed_inline_tags(markup, want, depth):
    assert page_text("<span>" * depth + markup) == page_text("<font><b>" * depth + markup) == page_text(markup)
    assert page_text(markup).split() == want.split() or "<p hidden>" in markup and page_text(markup).split() == ["a", "b"]


def test_an_end_tag_closes_its_own_element_at_any_depth():
    assert page_text("<div hidden>" + "<b>" * 300 + "<div>x</div>y</div>z") == "z"
    assert page_text("<pre>" + "<i>" * 300 + "<div> a  b</div>  c</pre>d  e") == " a  b\n  c\n\nd e"


HOSTILE = {
    "tags": "<a " * 333_000, "quotes": '<a x="' * 170_000, "comments": "<!--" * 250_000, "ends": "</a " * 250_000, "signs": "<" * 10**6,
    "tables": "<table>" * 5000 + "<td>a", "cells": "<table><tr><td>x<td>" * 50_000, "lists": "<ul><li>x" * 100_000,
    "number": "&#" + "9" * 10**6, "line": "word " * 200_000, "style": "<b style='" + "a;" * 500_000 + "'>x",
    "spans": "<table><tr>" + "<td rowspan=9999 colspan=99>x" * 20_000 + "<tr><td>y" * 40_000,
    "blanks": "<a " + "x" + " " * 10**6, "wide": "<table><tr><td>" + "w" * 400_000 + "<td>b" + "<tr><td><td>x" * 40_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_a_hostile_page_of_a_megabyte_takes_seconds_and_bounded_space(name):
    start = time.process_time()
    text = page_text(HOSTILE[name])
    assert time.process_time() - start < 20
    assert len(text) < 50 * len(HOSTILE[name])


def test_tables_nested_deeper_than_the_layout_keep_their_text():
    for depth in (3, 16, 17, 40):
        page = "".join(f"<table><tr><td>a{i}<td>b{i}<td hidden>no<td>" for i in range(depth)) + "<p>end" + "</table>z" * depth
        assert Counter(page_text(page).split()) == Counter([f"{c}{i}" for i in range(depth) for c in "ab"] + ["end"] + ["z"] * depth)


def test_visibility_against_a_plain_rule():
    """Random trees: a word shows if nothing above it is out of the layout and the nearest set visibility is not hidden."""
    import random
    rng = random.Random(5)
    for trial in range(200):
        want, page = [], []

        def grow(depth, out, seen):
            for _ in range(rng.randint(1, 3)):
                style, gone, sight = rng.choice([("", False, None), ("hidden", True, None), ("style='display:none'", True, None),
                                                 ("style='visibility:hidden'", False, False), ("style=visibility:visible", False, True)])
                tag = rng.choice(["div", "span", "ul", "section", "b"])
                inner_out, inner_seen = out or gone, seen if sight is None else sight
                word = f"w{len(page)}"
                page.append(f"<{tag} {style}>{word} ")
                if not inner_out and inner_seen:
                    want.append(word)
                if depth < 4:
                    grow(depth + 1, inner_out, inner_seen)
                page.append(f"</{tag}>")
        grow(0, False, True)
        assert page_text("".join(page)).split() == want


def test_every_visible_word_of_the_pages(spark, sf001):
    pages = spark.read.parquet(f"{sf001}/pages.parquet")
    raw = {r.page_id: r.html for r in pages.select("page_id", "html").collect()}
    got = {r.page_id: r.text for r in extract_text(pages).collect()}
    assert set(got) == set(raw)
    for i, h in raw.items():
        h = re.sub(r"(?is)<head\b.*?</head>|<script\b.*?</script>|<style\b.*?</style>|<noscript\b.*?</noscript>|<!--.*?-->", " ", h)
        if re.search(r"(?i)hidden|display\s*:\s*none|<template|<svg|<details|<iframe", h):
            continue
        inline = re.sub(r"(?i)</?(?:a|b|i|em|strong|span|code|small|sub|sup|u)\b[^>]*>", "", h)
        words = Counter(html.unescape(re.sub(r"(?s)<[^>]*>", " ", inline)).split())
        shown = Counter(got[i].split())
        for mark in [w for w in shown if re.fullmatch(r"-|\d+\.", w)]:
            shown[mark] = words[mark]
        assert +shown == +words


def test_rows(spark):
    rows = [Row(1, None, "x"), Row(1, "", "x"), Row(None, "<p>a", "x"), Row(2, "<b>" + "word " * 200_000, "x"), Row(2, "<b>b", "x")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = extract_text(df)
    assert out.columns == ["page_id", "text"]
    got = sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0] or 0, r[1] or ""))
    assert got == [(None, "a"), (1, None), (1, ""), (2, "b"), (2, "word " * 199_999 + "word")]
    assert extract_text(df.where("false")).count() == 0
