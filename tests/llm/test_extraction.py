"""Main text extraction: the table's articles, page shapes, densities against a direct sum, broken markup."""

import html
import math
import random
import re

import pytest

from squall.llm import extraction, queries
from squall.llm.extraction import main_text
from tools.oracle_check import compare, duck

from ..conftest import SF_SMALL

P = "This is a paragraph of the article with quite some words in it, so that it looks like text. " * 3
Q = " ".join(P.split())


def article_of(page):
    inner = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1]
    spaced = re.sub(r"</?(?:p|h1|br)>", " ", inner)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", spaced)).split())


def test_whole_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = queries.op2_html_extraction(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article_of(pages[r.page_id].html) and r.url == pages[r.page_id].url
        assert r.n_chars == len(r.text)


def test_small_table_against_sql(spark):
    name = "op2_html_extraction"
    got = compare(spark, duck(SF_SMALL), name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF_SMALL)
    assert "MATCH" in got, got


@pytest.mark.parametrize(
    "page, want",
    [
        (
            f"<header><h1>Site</h1></header><div id=w><div class='sidebar'><ul><li><a href=x>A</a></ul><p>{P}</div><div "
            f"id=main><section><h2>One</h2><p>{P}<p>Short.</section><section><h2>Two</h2><p>{P}</section></div></div>",
            f"One {Q} Short. Two {Q}",
        ),
        (
            f"<div class='cookie-notice'>{P}</div><article><header><h1>Head</h1></header><p>{P}</p><p>Ok.</p><form><label>N"
            f"</label></form><aside>{P}</aside><section class=comments><p>{P}</p></section><p>End &amp; &eacute;.</p></article>",
            f"Head {Q} Ok. End & é.",
        ),
        (f"<table><tr><td><a href=1>x</a><td><p>{P}<p>Two<table><tr><td>cell</table></table>", f"{Q} Two cell"),
        (f"<div><a href=1>{P}</a><a href=2>{P}</a></div><div><p>{P}</p><p>{P}</p></div>", f"{Q} {Q}"),
        (f"<script>if (a<b) '<p>'</script><style>p{{}}</style><!-- <p>no</p> --><p>{P}<b>bo</b>ld<br>x</p>", f"{Q} bold x"),
        (f"<article><p title='a>b'>{P}</p><p>&lt;p&gt; is &#116;ext</article><p class=ad>buy", f"{Q} <p> is text"),
        ("just text <b>bold</b>ly<br>more", "just text boldly more"),
        ("", ""), ("<p></p>", ""), ("<nav>only menu</nav>", ""), ("<!-- never closed <p>x</p>", ""), ("<p>a < b & c</p>", "a < b & c"),
    ],
)
def test_page_shapes(page, want):
    assert main_text(page) == want
    assert main_text(f"<!DOCTYPE html><html><head><title>t</title></head><body class='has-sidebar'>{page}") == want


def test_thin_parts_of_an_article_stay():
    long, short = "".join(f"<p>{'long ' * 50}</p>" for _ in range(6)), "".join(f"<p>{'thin ' * 20}</p>" for _ in range(6))
    head = f"<h1>{'Head ' * 6}</h1><p>{'lead ' * 32}</p>"
    links = "<ul><li><a href=1>Home of all</a><li><a href=2>Shop of all</a></ul>"
    entry = f"{head}<div class=entry>{long}</div><ul><li>one<li>two</ul>"
    sections = f"<section>{long}</section><section><h2>Two</h2>{short}</section>"

    def words(markup):
        return " ".join(re.sub("<[^>]*>", " ", markup).split())

    for part in (entry, sections):
        for before, after in (("<article>", "</article>"), ("<main>", "</main>"), ("<div id=w>", "</div>"), ("", "")):
            assert main_text(before + part + after) == words(part)
            if before != "":
                assert main_text(links + before + part + after) == words(part)
        assert main_text(f"<div id=w>{links}<div id=c>{part}</div></div>") == words(part)
        assert main_text(f"<article>{part}{links}</article><div>short</div>") == words(part + links)
    assert main_text(f"<article>{long}</article><article>{short}</article>") == words(long + short)


BOX = "<div><div>Weather</div><div>Oslo 12&deg;</div><div>Rome 20&deg;</div></div>"
MANY = "<div>" + "".join(f"<div>Town {i} {i % 30}&deg;</div>" for i in range(90)) + "</div>"
TEASER = "<div><h3>You may like</h3><a href=1>Ten ways to read more</a><p>A short line about it.</p></div>"
STORY = f"<h1>Head</h1><p>{P}</p><p>{P}</p><ul><li>one<li>two</ul>"
WANT = f"Head {Q} {Q} one two"


@pytest.mark.parametrize("before, after", [("<div id=w>", "</div>"), ("<main>", "</main>"), ("<article>", "</article>"), ("<section><div>", "</div></section>")])
def test_unnamed_parts_around_the_article_go(before, after):
    article = before + STORY + after
    for beside in (BOX, MANY, TEASER, "<p>© 2024 The Example. All rights reserved.</p>", "<div>Copyright Example</div>"):
        assert main_text(beside + article) == WANT
        assert main_text(article + beside) == WANT
        assert main_text(f"<div>{beside}{article}{beside}</div>") == WANT
    thread = f"<div id='thread'><p>First! {P}</p><p>No, second. {P}</p></div>"
    assert main_text(article + thread) == main_text(f"<div>{article}{thread}</div>") == WANT


def test_another_story_beside_the_article():
    second = f"<article><h2>Other</h2><p>{P}</p></article>"
    card = "<article><a href=1>Other story</a><p>Short line.</p></article>"
    for other in (second, card):
        assert main_text(f"<main><article>{STORY}</article>{other}</main>") == WANT
        assert main_text(f"<main>{other}<article>{STORY}</article></main>") == WANT
        assert main_text(f"<main>{STORY}{other}</main>") == WANT
        assert main_text(f"<div>{STORY}</div>{other}") == WANT


def test_characters_alone_would_not_do(monkeypatch):
    page = f"{MANY}<div id=w>{STORY}</div>"
    assert main_text(page) == WANT
    inner = extraction.measure

    def by_size(root):
        nodes = inner(root)
        for n in nodes:
            n.density = float(n.chars)
        return nodes

    monkeypatch.setattr(extraction, "measure", by_size)
    assert main_text(page) != WANT


@pytest.mark.parametrize(
    "noise",
    [
        "<p class=notice>x", "<ul><li class=ad>x<li>y</ul>", "<ul><li class=ad>x</ul>", "<dl><dt class=ad>x<dd>y</dl>", "<div><p class=ad>x</div>",
        "<div id=o><span class=ad>x</div>", "<p><span class=ad>x</p>", "<div id=o><div class=ad>x</div>", "<div class=ad>x", "<nav>x", "<aside>x",
        "<span class=ad>x", "<ul><li class=ad>x", "<svg viewBox='0 0 1 1'/>", "<math/>", "<svg><path d=a /><g><text>x</text></g></svg>", "<svg><path>",
        "<table><tr><td class=sidebar>x</table>", "<table><tbody class=ad><tr><td>x<tbody></table>", "<div id=o><aside>x<button>y</div>",
    ],
)
def test_an_article_behind_noise_without_its_end_tag(noise):
    for article in (f"<article><h1>Head</h1><p>{P}<p>Short.</article>", f"<main><div><h1>Head</h1><p>{P}</p>Short.</div></main>"):
        got = main_text(f"<html><body>{noise}{article}")
        assert got in (f"Head {Q} Short.", f"y Head {Q} Short."), got
        assert main_text(f"<html><body>{noise}{article}<footer>x</footer></body></html>") == got
    got = main_text(f"{noise}<div id=content><h1>Head</h1><p>{P}<p>Short.</div>")
    assert got in (f"Head {Q} Short.", f"y Head {Q} Short."), got


def test_noise_ends_where_its_element_ends():
    assert main_text(f"<table><tr><td class=sidebar>x<td><p>{P}</table>") == Q
    assert main_text(f"<table><tr class=ad><td>x<tr><td>{P}</table>") == Q
    assert main_text(f"<html><head><meta charset=a><title>t</title><body><p>{P}") == Q
    assert main_text(f"<article><p>{P}<select><option>a<option>b</select> end<p>Two <svg><g/></svg>ok</article>") == f"{Q} end Two ok"
    assert main_text(f"<article><p>{P}<span class=ad>a<span>b</span>c</span> end</article>") == f"{Q} end"
    assert main_text(f"<aside><article>{P}</article></aside><article>Real text.</article>") == "Real text."
    assert main_text(f"<article><p>{P}</article><div class=comments><p>{P}<p>{P}") == Q
    assert main_text(f"<article>Ab<span class=ad>x<p>{P}</p></span>out</article>") == "About"


def test_sums_against_direct_counts():
    r = random.Random(1)

    def tree(depth):
        if depth == 0 or r.random() < 0.3:
            return "<p>" + " ".join(r.choice(["word", "<a href=x>link</a>", "<b>x</b>"]) for _ in range(r.randint(0, 9))) + "</p>"
        return "<div>" + "".join(tree(depth - 1) for _ in range(r.randint(0, 3))) + "</div>"

    for _ in range(200):
        root = extraction.parse("".join(tree(4) for _ in range(3)))
        nodes = extraction.measure(root)

        def counts(n):
            """Characters, tags, link characters, links: of the text the node holds itself, and in all."""
            inner = [counts(c)[1] for c in n.children()]
            own_text = " ".join(c for c in n.content if isinstance(c, str))
            size = len("".join(own_text.split()))
            total = [size + sum(i[0] for i in inner), n.tags, n.link_chars, n.links]
            return (size, n.tags - sum(i[1] + 1 for i in inner), n.link_chars - sum(i[2] for i in inner), n.links - sum(i[3] for i in inner)), total

        _, (body, _, links, _) = counts(root)

        def density(c, t, lc, lt):
            if not c:
                return 0
            base = math.log(lc * c / max(c - lc, 1) + c * links / max(body, 1) + math.e)
            return c / max(t, 1) * math.log(1 + c / max(lc, 1) * max(t, 1) / max(lt, 1)) / math.log(1 + base)

        for n in nodes:
            own, total = counts(n)
            assert math.isclose(n.density, density(*total), abs_tol=1e-9)
            assert math.isclose(n.sum, density(*own) + sum(density(*counts(c)[1]) for c in n.children()), abs_tol=1e-9)


def test_broken_markup_never_fails():
    r = random.Random(2)
    parts = ["<p>", "</p>", "<div", ">", "<a href='", "'", '"', "</", "<!--", "-->", "<script>", "</script>", "&amp", "&#x;", "x", " ", "<li>",
             "<table>", "</table>", "<td>", "<nav>", "</nav>", "<br/>", "<", "<svg/>", "é", "<article>", "</article>"]
    for _ in range(3000):
        main_text("".join(r.choice(parts) for _ in range(r.randint(0, 40))))
    deep = "<div>" * 20000 + P + "</div>" * 20000
    assert main_text(deep) == Q
    assert main_text(f"<p>{'word ' * 200000}</p>") == " ".join(["word"] * 200000)


def test_nulls_repeats_and_clashing_columns(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    rows = [(1, None, None, "t", 1), (2, "u", "", "t", 1), (None, "u", "<p>a", "t", 1), (3, "v", "<p>b", None, None), (3, "v", "<p>b", None, None)]
    pages = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, extraction.extract(pages).collect()), key=repr)
    assert got == sorted([(1, None, "", 0), (2, "u", "", 0), (None, "u", "a", 1), (3, "v", "b", 1), (3, "v", "b", 1)], key=repr)
    assert extraction.extract(pages.limit(0)).count() == 0
