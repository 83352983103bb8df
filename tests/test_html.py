"""Elements of nested and malformed pages against hand-made truth."""

import time

import pytest

from vistaframe.functions.html import Rule, attributes, elements
from vistaframe.operators import text as TX

AD = Rule("ad", "div", cls="ad")
LINK = Rule("link", "a", parent="li")
ITEM = Rule("item", "li")
P = Rule("p", "p")


@pytest.mark.parametrize("page, rules, want", [
    ("<div class=ad>x</div>", [AD], [("ad", "x", "x")]),
    ("<DIV id='1' data-x=\"a>b\" CLASS='big ad'>x &amp; <b>y</b>\n z</DIV>", [AD], [("ad", "x &amp; <b>y</b>\n z", "x & y z")]),
    ("<div class='ad'>a<div>b</div>c<div class=ad>d</div></div>e", [AD],
     [("ad", "a<div>b</div>c<div class=ad>d</div>", "abcd"), ("ad", "d", "d")]),
    ("<div class=adx>no</div><div title=ad>no</div><span class=ad>no</span>", [AD], []),
    ("<!-- <div class=ad>no</div> --><div class=ad>yes<!-- </div> --></div>", [AD], [("ad", "yes<!-- </div> -->", "yes")]),
    ("<script>var t = '<div class=ad>no</div>';</script><div class=ad>a<style>p{}</style>b</div>", [AD],
     [("ad", "a<style>p{}</style>b", "ab")]),
    ("<title>a &lt;b> <div class=ad></title>", [AD, Rule("t", "title")], [("t", "a &lt;b> <div class=ad>", "a <b> <div class=ad>")]),
    ("<ul><li><a href=/1>one</a><li><a href=/2>two</a></ul><a href=/3>three</a>", [LINK, ITEM],
     [("item", "<a href=/1>one</a>", "one"), ("link", "one", "one"), ("item", "<a href=/2>two</a>", "two"), ("link", "two", "two")]),
    ("<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul>", [ITEM],
     [("item", "a<ul><li>b<li>c</ul>d", "abcd"), ("item", "b", "b"), ("item", "c", "c"), ("item", "e", "e")]),
    ("<p>a<p>b<div>c</div>d", [P], [("p", "a", "a"), ("p", "b", "b")]),
    ("<p>a<b>b</p>c</b>", [P, Rule("b", "b")], [("p", "a<b>b", "ab"), ("b", "b", "b")]),
    ("<div class=ad>a<br>b<img src=x>c<hr/>d</div>", [AD, Rule("img", "img")],
     [("ad", "a<br>b<img src=x>c<hr/>d", "abcd"), ("img", "", "")]),
    ("</div></p><div class=ad>open", [AD], [("ad", "open", "open")]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", [Rule("td", "td"), Rule("tr", "tr")],
     [("tr", "<td>1<td>2", "12"), ("td", "1", "1"), ("td", "2", "2"), ("tr", "<td>3", "3"), ("td", "3", "3")]),
    ("a < b <3 <div class=ad>x</div> <", [AD], [("ad", "x", "x")]),
    ("<a title=it's>x</a> <a alt='q'>y</a>", [Rule("a", "a")], [("a", "x", "x"), ("a", "y", "y")]),
    ("<div class='ad ad'>x</div>", [AD, Rule("div", "div")], [("ad", "x", "x"), ("div", "x", "x")]),
    ("<!DOCTYPE html><?xml version='1'?><div class=ad></div>", [AD], [("ad", "", "")]),
    ("<div class=ad>a<script>never ends </div>", [AD], [("ad", "a<script>never ends </div>", "a")]),
    ("", [AD], []), ("no tags &copy;", [AD], []),
])
def test_elements(page, rules, want):
    assert elements(page, rules) == want


def test_attributes():
    got = attributes(' a=1 B = "x > y" c=\'&quot;\' d e="" a=2')
    assert got == {"a": "1", "b": "x > y", "c": '"', "d": "", "e": ""}


@pytest.mark.parametrize("page", ["<b>" * 50_000 + "</b>" * 50_000, "<a " * 100_000, "<!--" * 50_000, "<a x='" * 50_000,
                                  "</b>" * 100_000, "<p>" * 50_000, "<" * 200_000])
def test_time_grows_with_the_page(page):
    t = time.perf_counter()
    elements(page, [AD])
    assert time.perf_counter() - t < 5


def test_rows(spark):
    """Kept columns of any type stay; null and empty pages have no rows; long pages are read whole."""
    long = "<li>x</li>" * 30_000
    rows = [(1, [1, 2], None, "k"), (2, [], "", "k"), (3, None, "<div class=ad>a</div><ul><li><a>b</a>", None), (3, [7], long, "ord")]
    df = spark.createDataFrame(rows, "id int, tags array<int>, page string, ord_of string").repartition(3)
    got = TX.select_elements(df, "page", [AD, LINK, ITEM], keep=["id", "tags", "ord_of"])
    assert got.columns == ["id", "tags", "ord_of", "kind", "ord", "element", "text"]
    few = sorted(tuple(r) for r in got.filter("tags is null").select("id", "kind", "ord", "element", "text").collect())
    assert few == [(3, "ad", 0, "a", "a"), (3, "item", 1, "<a>b</a>", "b"), (3, "link", 2, "b", "b")]
    assert got.filter("ord_of = 'ord'").count() == 30_000 and got.count() == 30_003
    assert TX.select_elements(df.limit(0), "page", [AD], keep=["id"]).count() == 0
