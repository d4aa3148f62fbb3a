import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnlens.llm.common import prepare
from txnlens.llm.layout import op7_layout_text, render_pages, visible_text

CASES = {
    "implied paragraph ends": ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
    "inline white space": ("<p> a \n <b> b</b>c <i>d</i> </p>", "a bc d"),
    "line breaks": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "head is not shown": ("<title>T</title><style>p{}</style><script>var t='</p>';</script><body>x", "x"),
    "text ends the head": ("<head><meta charset=x>visible", "visible"),
    "hidden by attribute and style": ('<p hidden>a</p><p style="DISPLAY : none">b</p><p style="visibility:hidden">c<b style="visibility:visible">d</b></p>', "d"),
    "hidden by sheet": ("<style>/* x */ .ad, #no {display:none} aside{visibility:hidden} p .q{display:none}</style><div class='big ad'>a</div><div id=no>b</div><aside>c</aside><p class=q>d", "d"),
    "own style wins over sheet": ("<style>.x{display:none}</style><p class=x style='display:block'>a", "a"),
    "lists": ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li></ul>z", "- a\n- b\n  3. c\n  4. d\n-\n\nz"),
    "definitions": ("<dl><dt>t<dd>d1<dd>d2<dt>u</dl>", "t\n  d1\n  d2\nu"),
    "table": ("<table><caption>cap</caption><tr><th>name<th>n<tr><td>long one<td>1<tr><td colspan=2>wide<tr><td rowspan=2>r<td>2<tr><td>3</table>",
              "cap\nname     | n\nlong one | 1\nwide     |\nr        | 2\n         | 3"),
    "cell without row": ("<table><td>a<td>b</table>c", "a | b\n\nc"),
    "nested table": ("<table><tr><td><table><tr><td>x<td>y</table><td>z</table>", "x | y | z"),
    "preformatted": ("<pre>\n a\n   b\n\nc</pre>d", " a\n   b\n\nc\n\nd"),
    "character references": ("<p>&lt;b&gt; &amp; &copy;&nbsp;x &xyzzy; 1 < 2 <3", "<b> & ©\xa0x &xyzzy; 1 < 2 <3"),
    "comments": ("a<!-- <p>x</p> -->b<!bogus>c<?php x?>d</ >e", "abcde"),
    "unclosed comment": ("a<!-- b", "a"),
    "cut off tag": ("a <b class='x", "a"),
    "stray ends": ("a</div></p>b</br>c</li>", "a\n\nb\nc"),
    "details and dialog": ("<details><summary>s</summary>x</details><details open><summary>t</summary>y</details><dialog>no</dialog><dialog open>yes</dialog>", "s\nt\ny\nyes"),
    "forms": ("<input type=hidden value=a><input type=submit value=Go><select><option>p<option selected>q</select><textarea>t <b></textarea>", "Go q t <b>"),
    "headings": ("<h1>a<h2>b</h2>c", "a\n\nb\n\nc"),
    "quoted bracket": ('<a title="x > y">link</a>', "link"),
    "tags in capitals": ("<DIV>a</DIV><P>b</p>", "a\n\nb"),
    "plain text": ("just words\n here", "just words here"),
    "unclosed raw text": ("a<script>b", "a"),
}


@pytest.mark.parametrize("name", CASES)
def test_case(name):
    html, want = CASES[name]
    got = visible_text(html)
    if name == "preformatted":
        assert got == want
    else:
        assert got.strip() == want


def test_empty_pages():
    assert [visible_text(x) for x in (None, "", "  ", "<p></p><div> </div>")] == [""] * 4


def test_deep_and_hostile_pages_take_linear_time():
    started = time.monotonic()
    for page in ("<div>" * 100_000 + "x", "<a href=\"" * 50_000, "<" * 200_000, "<!--" * 50_000, "<td>" * 20_000 + "x", "<ul><li>" * 3000 + "x", "</p" * 50_000, "<script>" * 20_000, "&" * 100_000):
        visible_text(page)
    assert visible_text("<div>" * 5000 + "x") == "x"
    assert time.monotonic() - started < 30


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<ul>", "<li>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "<div>", "</div>", "<br>", "<h1>", "</h1>", "word", " ", "\n", "<!-- c -->", "<ol>", "</ol>", "<dd>", "<pre>", "</pre>"]), max_size=40))
def test_every_word_is_shown_in_order(parts):
    marked = [f"w{i}" if p == "word" else p for i, p in enumerate(parts)]
    assert re.findall(r"w\d+", visible_text(" ".join(marked))) == [m for m in marked if re.fullmatch(r"w\d+", m)]


def test_rows(spark):
    prepare(spark)
    rows = [(1, "<p>a<p>b"), (1, "<p>a<p>b"), (2, None), (None, "x"), (3, "y " * 500_000)]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))
    got = sorted(((r.page_id, r.n_chars, r.n_lines) for r in render_pages(pages).collect()), key=repr)
    assert got == sorted([(1, 4, 3), (1, 4, 3), (2, 0, 0), (None, 1, 1), (3, 999_999, 1)], key=repr)
    assert render_pages(pages.limit(0)).collect() == []


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = op7_layout_text(spark, folder).collect()
    assert len(found) == len(pages)
    for r in found:
        body = re.sub(r"(?s)<(script|style|title).*?</\1>|<!--.*?-->", " ", pages[r.page_id])
        import html

        words = html.unescape(re.sub(r"<[^>]*>", " ", body)).split()
        assert [w for w in r.text.split() if w != "-"] == [w for w in words if w != "-"]


@pytest.mark.parametrize(
    "html, want",
    [
        ('<a href="x"">text</a> rest', "text rest"),
        ('<p class=x">Hello</p> all else', "Hello\n\nall else"),
        ('<a href="x"">text</a><p class="y">more</p> end', "text\n\nmore\n\nend"),
        ("<img alt=5'>Don't stop", "Don't stop"),
        ("<b '>a</b '><i \"x>b</i>c", "abc"),
        ("<i a= >b</i><i =\">c</i><i a=b/>d</i><br/>e", "bcd\ne"),
        ("<i a = 'x > y'b=\">\">c</i>d", "cd"),
        ("<p class='a'hidden>no</p><p id=x\"y hidden>no</p>yes", "yes"),
        ("a <b c=d\" e='f>g", "a"),
        ("a <b c=", "a"),
    ],
)
def test_stray_quotes_are_plain_characters(html, want):
    assert visible_text(html).strip() == want


def test_unclosed_tags_take_linear_time():
    started = time.monotonic()
    for page in ("<" + "a" * 500_000, "<a " + "b=" * 300_000, "<a" + " b" * 300_000, "<a b" + " " * 500_000, "<a b='" + "\"" * 500_000):
        assert visible_text("x" + page) == "x"
    assert time.monotonic() - started < 10


@pytest.mark.parametrize(
    "sheet, shown",
    [
        ("@media print{nav, .x{display:none}}", True),
        ("@media (max-width:600px){.x{display:none}}", True),
        ("@media screen and (max-width: 40em){.x{display:none}}", True),
        ("@media (400px <= width < 700px){.x{display:none}}", True),
        ("@media (width >= 3000px), print{.x{display:none}}", True),
        ("@media not screen{.x{display:none}}", True),
        ("@media not all and (min-width:600px){.x{display:none}}", True),
        ("@media (orientation:portrait){.x{display:none}}", True),
        ("@media (unheard-of: 1) {.x{display:none}}", True),
        ("@media not (unheard-of) {.x{display:none}}", True),
        ("@media screen{@media print{.x{display:none}}}", True),
        ("@supports not (display:grid){.x{display:none}}", True),
        ("@container side (max-width: 300px){.x{display:none}}", True),
        (".x{color:red; @media print{display:none}}", True),
        ("@media print{.y{a:b}}.x{display:block}", True),
        ("@keyframes k{from{display:none} .x{display:none}}", True),
        ("@media screen{.x{display:none}}", False),
        ("@media only screen and (min-width:600px){.x{display:none}}", False),
        ("@media print, (min-width:600px){.x{display:none}}", False),
        ("@media not print{.x{display:none}}", False),
        ("@media not all and (max-width:600px){.x{display:none}}", False),
        ("@media (max-width:600px) or (hover){.x{display:none}}", False),
        ("@MEDIA(width>=600px){.x{display:none}}", False),
        ("@media (min-aspect-ratio: 1/1) and (not (max-width:600px)){.x{display:none}}", False),
        ("@media screen{@supports (display:grid){@layer a{.x{display:none}}}}", False),
        ("@media print{.x{display:block}}.x{display:none}", False),
        ("@import url(a;b.css); @media print{.y{a:b}} .x{display:none}", False),
        (".y{content:'}'}.x{display:none}", False),
    ],
)
def test_conditional_blocks(sheet, shown):
    assert visible_text(f"<style>{sheet}</style><p class=x>a</p><p>b") == ("a\n\nb" if shown else "b")


def test_sheets_for_other_media():
    assert visible_text("<style media=print>p{display:none}</style><style media='screen'>b{display:none}</style><p>a<b>c</b>") == "a"


def test_hostile_sheets_take_linear_time():
    started = time.monotonic()
    for sheet in ("@media screen{" * 50_000, "@media " + "(" * 100_000 + "{", "a{" * 100_000, "'" * 100_000, "@media " + "not " * 100_000 + "{a{}}", "@media " + "screen," * 50_000 + "{"):
        assert visible_text(f"<style>{sheet}</style>x") == "x"
    assert time.monotonic() - started < 10


@pytest.mark.parametrize("comment", ["<!-->", "<!--->", "<!---->", "<!-- x -->", "<!-- x --!>", "<!-- > x-- >-->", "<!--x-->"])
def test_comments_end_where_browsers_end_them(comment):
    assert visible_text(f"<p>a</p>{comment}<p>b</p><!-- x --><p>c</p>") == visible_text("<p>a</p><p>b</p><p>c</p>")


def test_important_rules_win_over_later_plain_ones():
    sheet = "<style>p{display:none !important}</style>"
    assert visible_text(f"{sheet}<p style='display:block'>a</p><div>b</div>") == visible_text("<div>b</div>")
    assert visible_text(f"{sheet}<p style='display:block !  important'>a</p>") == visible_text("<p>a</p>")
    assert visible_text("<style>.x{display:block!important} #y{display:none}</style><p class=x id=y>a</p>") == visible_text("<p>a</p>")
    assert visible_text("<style>p{display:none!important} p{display:block}</style><p>a</p>") == ""
