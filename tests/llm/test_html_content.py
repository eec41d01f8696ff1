import html
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demandflow.llm import html_content as hc
from demandflow.llm import queries
from demandflow.llm.page_tree import Page, Tree, tree_matching

SF = "/root/testdata/sf0.001"


def words(draw, n):
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(n))


def news(draw, body, extra=""):
    return (
        "<!DOCTYPE html><html><head><title>T</title><script>if (a < b) x = '<p>';</script></head><body>"
        f"<header><h1>Daily</h1></header><nav><a href='/{words(draw, 1)}'>{words(draw, 1)}</a></nav><article><h1>{body[0]}</h1>"
        + "".join(f"<p>{p}" for p in body[1:])
        + f"<div class=x>Read us daily</div>{extra}<section class='comments'><p>{words(draw, 9)}</section></article>"
        f"<aside>{words(draw, 5)}</aside><form>Name <input></form><footer>&copy; {words(draw, 4)}</footer>"
    )


def bare(draw, body, extra=""):
    """No tag or name tells the parts apart; only what is the same on all pages does."""
    return (
        "<div><a href=1>Home</a> <a href=2>About</a></div><div>Welcome to this site</div>"
        f"<div><h2>{body[0]}</h2>" + "".join(f"<p>{p}</p>" for p in body[1:]) + f"{extra}</div><div>All rights of this site are ours</div>"
    )


def named(draw, body, extra=""):
    return (
        f"<div id=top-menu>{words(draw, 6)}</div><div class='cookie-notice'>{words(draw, 6)}</div><div class='post-body'><h1>{body[0]}</h1>"
        + "".join(f"<p>{p}</p>" for p in body[1:]) + f"{extra}</div><div class=sideBar>{words(draw, 12)}</div>"
        f"<ul id=comments><li>{words(draw, 8)}</li></ul><div class='ad'>{words(draw, 12)}</div>"
    )


def made(template, count=30, seed=1):
    draw = random.Random(seed)
    out = []
    for k in range(count):
        body = [words(draw, draw.randint(3, 30)) for _ in range(draw.randint(2, 12))]
        out.append((f"http://{template.__name__}.example.com/{k}", template(draw, body), " ".join(body)))
    return out


@pytest.mark.parametrize("fan_in", [64, 2])
def test_content_of_three_templates(spark, monkeypatch, fan_in):
    monkeypatch.setattr(hc, "FAN_IN", fan_in)
    pages = [p for template in (news, bare, named) for p in made(template)]
    rows = spark.createDataFrame([(k, u, h, "x", 3) for k, (u, h, _) in enumerate(pages)], "page_id long, url string, html string, host string, n_chars int")
    got = {r.id: (r.text, r.n_chars) for r in hc.extract_text(rows.repartition(5)).collect()}
    for k, (url, _, want) in enumerate(pages):
        assert got[k] == (want, len(want)), url


def plain(source):
    """Text of the article by cutting the page at its tags."""
    inside = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|br)>", inside)
    texts = (" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks)
    return " ".join(t for t in texts if t)


def test_registered_query_on_the_given_pages(spark):
    given_pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op13_html(spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(given_pages)
    for r in rows:
        want = plain(given_pages[r.page_id].html)
        assert (r.text, r.n_chars, r.url) == (want, len(want), given_pages[r.page_id].url)


@pytest.mark.parametrize("name, gone", [
    ("main-content with-sidebar", False), ("article-sidebar", True), ("sidebarLeft", True), ("sideBar", True), ("page-header", True),
    ("post-header", False), ("commentlist", True), ("commentary", False), ("reader-comments", True), ("topnav", True), ("main-menu", True),
    ("ad", True), ("ads-box", True), ("download threads", False), ("cookie-banner", True), ("notice", True), ("site-footer", True),
    ("footnotes", False), ("entry-content", False), ("newsletterBox", True), ("search-form", True), ("related-posts", True), ("loaded shadow", False),
])
def test_names_of_parts(name, gone):
    source = f"<div class='{name}'>A part.</div><div>The text of the page.</div>"
    assert Page(source).blocks[0][0].dropped == gone
    assert hc.main_text(source, None) == ("The text of the page." if gone else "A part. The text of the page.")


def test_odd_rows(spark):
    long = "<p>" + "word " * 50_000
    rows = [
        (1, None, None), (2, "", ""), (3, "nonsense", "only text &amp; more&nbsp;text"), (4, "http://a.b/", "<p>one<p>two"),
        (4, "http://a.b/", "<p>one<p>two"), (None, "http://a.b/", "<p>one<p>two"), (5, "HTTP://U@Deep.example:80/x", "<div>" * 3000 + "deep" + "</div>" * 3000),
        (6, "http://long.example/", long), (7, "http://cut.example/", "<p>text</p><div cla"), (8, "http://cut.example/2", "a < b <!-- x > y --> c<br>d <script>e"),
    ]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = [(r.id, r.host, r.text) for r in hc.extract_text(docs).collect()]
    want = [
        (1, "", ""), (2, "", ""), (3, "", "only text & more text"), (4, "a.b", "one two"), (4, "a.b", "one two"), (None, "a.b", "one two"),
        (5, "deep.example", "deep"), (6, "long.example", "word " * 49_999 + "word"), (7, "cut.example", "text"), (8, "cut.example", "a < b c d"),
    ]
    assert sorted(out, key=str) == sorted(want, key=str)


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert hc.extract_text(none).collect() == []


def test_copies_are_no_template(spark):
    draw = random.Random(4)
    body = [words(draw, 20) for _ in range(5)]
    pages = [(k, f"http://copies.example/{k}", news(draw, body)) for k in range(12)]
    pages += [(50 + k, "http://same.example/", pages[0][2]) for k in range(12)]
    rows = hc.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    # what all pages share cannot be told from the article here, so it stays
    assert {r.text for r in rows} == {" ".join(body) + " Read us daily"}


def size(a, b, i=0, j=0):
    if a.labels[i] != b.labels[j]:
        return 0

    def best(x, y):
        if not x or not y:
            return 0
        return max(best(x[1:], y), best(x, y[1:]), size(a, b, x[0], y[0]) + best(x[1:], y[1:]))

    return 1 + best(a.kids[i], b.kids[j])


shapes = st.recursive(st.sampled_from("abc"), lambda inner: st.tuples(st.sampled_from("abc"), st.lists(inner, min_size=1, max_size=4)).map(lambda t: f"{t[0]}({' '.join(t[1])})"), max_leaves=8)


@settings(max_examples=100, deadline=None)
@given(shapes, shapes)
def test_matching_is_the_largest(x, y):
    a, b = Tree(f"r({x})"), Tree(f"r({y})")
    pairs = tree_matching(a, b)
    assert len(pairs) == size(a, b)
    assert all(a.labels[i] == b.labels[j] for i, j in pairs.items())
    assert all(pairs[a.parents[i]] == b.parents[j] for i, j in pairs.items() if i)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<ul><li>", "<li>", "x & y", "<b>", "</b>", "<", "<a href='>'>", "<table><tr><td>", "</table>", "\"'", "<!--", "-->", "<br>"]), max_size=30))
def test_any_markup_can_be_read(parts):
    page = Page("".join(parts))
    assert len(Tree(page.shape).labels) == page.size
    labels = Tree(page.shape).labels
    assert all(labels[node.number] == node.label for node, _, _ in page.blocks)
