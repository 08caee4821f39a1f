import pytest

from gridloom.llm.html_text import extract, parse, render


def text(html):
    return render(parse(html))


@pytest.mark.parametrize("html, want", [
    ("", ""), ("plain  text\n here", "plain text here"), ("<p>one<p>two", "one\n\ntwo"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("x <b>bold</b> y<i> z</i>", "x bold y z"), ("<h1>T</h1><p>a</p>b", "T\n\na\n\nb"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"), ("<ol start=3><li>a<li>b</ol>", "3. a\n4. b"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"), ("<pre>\n a\n  b</pre>c", " a\n  b\n\nc"), ("<blockquote>q</blockquote>", "  q"),
    ("<head><title>t</title></head>b", "b"), ("<title>t</title>b", "b"), ("<script>var a='</p>';</script>x<style>p{}</style>", "x"),
    ("<p hidden>a</p>b<p style='color:red; display : none'>c</p><span style=\"visibility:hidden\">d</span>", "b"),
    ("<p style='display:block'>a", "a"), ("&lt;p&gt; &amp;eacute; &eacute;&nbsp;x", "<p> &eacute; é\xa0x"), ("a < b and 1<2", "a < b and 1<2"),
    ("<!-- <p>no</p> -->a<!doctype html>b<?php x ?>c", "abc"), ("<!-- open", ""), ("</p>x</b></div>", "x"), ("<a title='x>y' href=\"q>r\">link</a>", "link"),
    ("<textarea>a <b> c</textarea>", "a <b> c"), ("<select><option>a<option>b</select>", "a\nb"), ("<img alt='pic'> t <img src=x>", "pic t"),
    ("<input type=hidden value=h><input type=submit value=Go>", "Go"), ("<noscript>n</noscript>a<template>t</template>", "a"), ("<b><p>x</b>y</p>z", "xy\n\nz"),
    ("<plaintext><b>a", "<b>a"), ("<div", ""), ("<p a='1>2", "2"), ("<body class=x><p>a</body></html> b", "a b"), ("<meta x><link y> <p>z", "z"), ("x<script>never closed", "x"),
])
def test_text(html, want):
    assert text(html) == want


def test_tables_are_aligned():
    html = "<table><caption>C</caption><tr><th>name<th>n<tr><td>a long one<td>1<td>x<tr><td>b<td>22</table>after"
    assert text(html) == "C\nname       | n\na long one | 1  | x\nb          | 22\n\nafter"
    assert text("<table><tr><td colspan=2>wide cell<td>c<tr><td>a<td>b<td>d</table>") == "wide cell | c\na | b | d"
    assert text("<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>").split("\n")[0].startswith("a")
    assert text("<table><tr><td>one<br>two<td>x</table>") == "one | x\ntwo |"
    wide = "w" * 100
    assert text(f"<table><tr><td>{wide}<td>b<tr><td>c<td>d</table>").split("\n")[1].startswith("c" + " " * 39 + " | d")


def test_deep_and_long_pages():
    assert text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert text("<ul><li>" * 3000 + "x").endswith("x")
    assert len(text("<p>word " * 50_000).split()) == 50_000
    assert text("<a b=\"" * 2000 + "x") == text("<a b=\"" * 2000 + "x")
    assert "x" in text("<table>" * 700 + "<tr><td>x")


def test_pages_lose_no_visible_word(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = {r.page_id: r.html for r in pages.collect()}
    out = extract(pages).collect()
    assert len(out) == len(rows) and all(r.title for r in out)
    import re
    from html import unescape

    for r in out:
        bare = re.sub(r"(?is)<head>.*?</head>|<!--.*?-->|<(script|style)\b.*?</\1>", " ", rows[r.page_id])
        words = [unescape(w) for w in re.sub(r"<[^<>]*>", " ", bare).split()]
        got = re.sub(r"[|\s]+", " ", r.text)
        missing = [w for w in words if re.sub(r"[|\s]+", " ", w).strip() not in got]
        assert not missing, (r.page_id, missing[:5])


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "<p>a", "y"), (2, "", "z")], "page_id long, html string, text string")
    assert sorted(((r.page_id, r.title, r.text) for r in extract(df).collect()), key=repr) == sorted([(1, None, None)] * 2 + [(None, None, "a"), (2, None, "")], key=repr)
    assert extract(df.limit(0)).collect() == []
