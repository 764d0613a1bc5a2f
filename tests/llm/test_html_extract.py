"""Operator 9: whole pages against an independent extraction, and page forms."""

import html
import re

import numpy as np
import pytest

from arrears.llm import html_extract as hx
from tests.conftest import MEDIUM


def independent(page):
    """The article element of the test pages, by patterns."""
    body = re.search(r"(?s)<article>(.*?)(</article>|<footer|$)", page)[1]
    blocks = re.sub(r"<[^>]*>", " ", re.sub(r"(?i)</?(p|h1)>", "\0", body)).split("\0")
    return "\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    raw = {r.page_id: r for r in pages.collect()}
    got = hx.page_texts(pages).collect()
    assert len(got) == len(raw)
    for r in got:
        assert r.url == raw[r.page_id].url
        assert r.text == independent(raw[r.page_id].html) and r.n_chars == len(r.text)


LONG = "Some words of a paragraph that is long enough to be told from a menu, and goes on for a while, as texts do."


def test_furniture_is_left_out():
    page = f"""<!doctype html><html><head><title>T</title><script>if (a < b) document.write("<p>x</p>")</script></head><body>
    <header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies</div>
    <main><h1>Title &amp; more</h1><p>{LONG}<p>Short.<ul><li>one<li>two</ul><form><input><button>Go</button></form>
    <div class="ad-box">Buy</div><p>A&nbsp;B<br>C &lt;tag&gt;   &#x41;</p><!-- gone --><style>p{{}}</style>
    <section id="comments"><article class="comment"><p>{LONG}</p></article></section></main>
    <aside>Related</aside><footer>&copy; x</footer></body></html>"""
    assert hx.main_text(page) == f"Title & more\n{LONG}\nShort.\none\ntwo\nA B C <tag> A"


def test_without_article_element():
    menu = "".join(f"<div><a href=/{i}>m{i}</a></div>" for i in range(12))
    body = "".join(f"<p>{LONG}</p>" for _ in range(6))
    assert hx.main_text(f"<html><body>{menu}<div id=text>{body}<p>End.</p><p>{LONG}</p></div>{menu}</body></html>") == "\n".join(
        [LONG] * 6 + ["End.", LONG])


def test_broken_and_odd_pages():
    assert [hx.main_text(x) for x in (None, "", "   ", "<html>", "plain text", "<p>cut <b", "</div></p><p>x</p>", "<p>a</p><script>var")] == [
        "", "", "", "", "plain text", "cut", "x", "a"]
    assert hx.main_text("<article><p>" + "word " * 300_000 + "</p></article>") == ("word " * 300_000).strip()
    assert hx.main_text("<article><p class=notice>gone<p>stays</article>") == "stays"
    assert hx.main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"


def test_clusters():
    assert hx.marked_lines(np.array([1, 1, 1, 400, 380, 420, 1, 1, 1]), np.ones(9)).tolist() == [False] * 3 + [True] * 3 + [False] * 3
    assert hx.marked_lines(np.array([5]), np.array([1])).all() and hx.marked_lines(np.array([5, 5]), np.array([1, 1])).all()


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (1, "u", "<p>a", "x"), (1, "u", "<p>a", "x"), (None, "u", "", None)],
                               "page_id long, url string, html string, main_text string")
    out, name = hx.extract(df)
    assert name == "_main_text" and sorted(r[name] for r in out.collect()) == ["", "", "a", "a"]
    assert hx.page_texts(df.limit(0)).count() == 0


def blocks(lengths):
    return [("w%d " % i + "x" * n)[:n] for i, n in enumerate(lengths)]


def test_edges_of_a_region_stay():
    """Short headings and short first and last paragraphs, without article or main element."""
    menu = "".join(f"<div><a href=/{i}>m{i}</a></div>" for i in range(12))
    for lengths in ((20, 500, 500, 60, 40, 30), (20, 60, 60, 50, 900, 900, 900, 50, 40)):
        lines = blocks(lengths)
        text = "".join(f"<{t}>{x}</{t}>" for t, x in zip(["h2"] + ["p"] * len(lines), lines))
        assert hx.main_text(f"<body>{menu}<div><div><b></b>{text}</div></div>{menu}</body>") == "\n".join(lines)
        assert hx.main_text(f"<body>{menu}{text}{menu}</body>") == "\n".join(lines)


def test_text_of_a_sibling_container_stays():
    one, two = [f"<p>{LONG * 4}</p>" * 12, f"<p>{LONG * 4}</p>"]
    got = hx.main_text(f"<body><ul><li><a href=/>m</a><li><a href=/>n</a></ul><div>{one}</div><div>{two}</div></body>")
    assert got == "\n".join([LONG * 4] * 13)


def test_names_that_hold_a_hint():
    kept = ["<section id='related-work'>", "<div id='search-algorithms'>", "<p class='share-price'>",
            "<section id='social-history'>", "<div class='section-header'>", "<section id=related>"]
    for start in kept:
        end = start[1:].split()[0]
        for outer in ("article", "main", "div"):
            if start.endswith("id=related>") and outer == "div":
                continue
            assert hx.main_text(f"<{outer}><p>{LONG}</p>{start}{LONG}</{end}></{outer}>") == f"{LONG}\n{LONG}", (start, outer)
    for gone in ("<div class='ad-box'>", "<div class='x related'>", "<div class='share-buttons'>", "<div id=sidebar><a href=/>"):
        assert hx.main_text(f"<article><p>{LONG}</p>{gone}Gone</a></div></article>") == LONG, gone


def test_end_tags_left_out():
    table = "<article><table><tr class=ad><td>gone<tr><td>a<td class=sidebar>gone<td>b</table><dl><dt class=ad>gone<dd>c<dt>d<dd class=ad>gone</dl>"
    assert hx.main_text(table + "<ul><li class=ad>gone<ul><li>gone</ul><li>e</ul></article>") == "a\nb\nc\nd\ne"
    assert hx.main_text("<article><table><tr><td class=ad><table><tr><td>gone<td>gone</table>gone<td>a</table></article>") == "a"


WORDS = " ".join(f"word{k}" for k in range(60)) + "."


@pytest.mark.parametrize("page, lost", [
    (f"<body><div><p>{WORDS}</p><ul><li><a href='x'>linked</a></li></ul><p>Tail paragraph.</p></div>", "Tail paragraph."),
    (f"<body><div><h1>A title</h1><p><a href='x'>A linked lead-in</a></p><p>{WORDS}</p><p>{WORDS}</p></div>", "A title"),
    (f"<body><div><p>{WORDS}</p><p><a href='x'>one</a></p><p>Middle.</p><p><a href='y'>two</a></p><p>The end.</p></div>", "The end.")])
def test_unlinked_text_beyond_linked_lines_stays(page, lost):
    got = hx.main_text(page + "<div class='nav'><a href='z'>Home</a></div></body>").split("\n")
    assert lost in got and WORDS in got and "Home" not in got


@pytest.mark.parametrize("name", ["user-comments", "comment-thread", "comments-section", "reader-comments", "main-nav", "page-footer", "google-ad"])
def test_compound_names_of_furniture_go(name):
    page = f"<article><p>{WORDS}</p><section class='{name}'><p>{WORDS.upper()}</p></section><p>After it.</p></article>"
    assert hx.main_text(page) == f"{WORDS}\nAfter it."


@pytest.mark.parametrize("name", ["related-work", "search-algorithms", "share-price", "social-history", "section-header"])
def test_names_of_article_parts_stay(name):
    page = f"<article><p>{WORDS}</p><section class='{name}'><p>{WORDS.upper()}</p></section></article>"
    assert hx.main_text(page) == f"{WORDS}\n{WORDS.upper()}"


def test_deep_nesting_takes_linear_time():
    import time
    times = []
    for depth in (4_000, 16_000):
        page = "<div>" * depth + f"<p>{WORDS}</p>" + "</section></td>" * depth + "<p>End.</p>" + "</div>" * depth
        began = time.perf_counter()
        assert hx.main_text(page) == f"{WORDS}\nEnd."
        times.append(time.perf_counter() - began)
    assert times[1] < 10 * times[0] + 0.2
