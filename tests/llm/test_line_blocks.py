"""Main text of pages: windows, surges and dives, and pages of many makes."""

from __future__ import annotations

import random

import pytest

from loanlens.llm.line_blocks import SURGE, WINDOW, extract, page_lines, passages, query, window_sums

P = "Some words of the article that go on for quite a while so that it has weight."


def brute_passages(weights, window, surge):
    """Every line's windows by definition: runs of lines whose windows are not empty, with a surge."""
    n = len(weights)
    total = {e: sum(weights[max(0, e - window + 1) : e + 1]) for e in range(n + window - 1)}
    least = max(1.0, surge * max(total.values(), default=0))
    heavy = [i for i, w in enumerate(weights) if w > 0]
    runs = []
    for i in heavy:
        # two heavy lines share a run if no window between them is empty
        if runs and all(total[e] > 0 for e in range(runs[-1][1], i + 1)):
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return [(a, b) for a, b in runs if max(total[e] for e in range(a, b + window)) >= least]


def test_passages_equal_their_definition():
    rng = random.Random(3)
    for _ in range(600):
        weights = [rng.choice([0, 0, 0, 1, 5, 40, 200]) for _ in range(rng.randint(0, 30))]
        window, surge = rng.randint(1, 4), rng.choice([0.05, 0.3, 1.0])
        assert passages(weights, window, surge) == brute_passages(weights, window, surge)
    assert window_sums([1, 2, 3, 4], 3) == [1, 3, 6, 9, 7, 4]
    assert (WINDOW, SURGE) == (3, 0.1)


@pytest.mark.parametrize(
    "html, text",
    [
        ("plain &lt;b&gt; text<br>next", "plain <b> text next"),
        ("<p title='a > b'>one</p><p>two", "one two"),
        ('<p title="open>one <b>bold</b></p>', "one bold"),
        ("<p>a<!-- no > --> b<script>if (a</b>) x</script> c</p><!-- never closed <p>x", "a b c"),
        ("<p>cut &am</p><p>R&ampD &#233;&#x41;&nbsp; x</p><p", "cut &am R&D éA x"),
        ("<ul><li><a>Home</a><li><a>News</a><li><a>All</a></ul><div><p>" + P + "</p><p>Short.</div>", P + " Short."),
        (f"<div>{P}</div></div></div><div class='sidebar'>{P}</div><div id=comments><p>{P}</div>", P),
        (f"<nav><ul><li>never closed<article><header><h1>T</h1></header><p>{P}<aside>x</aside></article>", f"T {P}"),
        (f"<main class='with-sidebar'><p>{P}</p><form><label>n</label><p>x</p></form><p>In.</main>", f"{P} In."),
        (f"<article><p>{P}</p><section class='comments'><article>c</article></section></article>", P),
        (f"<header>Site</header><div role=alert>{P}</div><div hidden>{P}</div><p>{P}", P),
        (f"<div class='article-header'><h1>T</h1></div><div>{P}</div><div class=header>x</div>", f"T {P}"),
        (f"<div>{P}{P}{P}{P}{P}</div></div></div></div><div>Copyright 2020</div>", P * 5),
        ("<div class='ad'>all there is</div>", ""),
        ("<script>only()</script>", ""),
    ],
)
def test_pages_of_many_makes(html, text):
    assert extract(html)[0] == text


def test_links_weigh_nothing_outside_an_article():
    lines = page_lines("<p>ab <a>cd</a> e</p><p><a>xyz</a></p>")
    assert [(x.text, x.weight) for x in lines if x.text] == [("ab cd e", 3), ("xyz", 0)]


@pytest.mark.parametrize(
    "html", ["<a '>' " * 60_000, '<p title="' * 60_000, "<b>" * 100_000 + "x", "<" * 200_000, "<!--" * 100_000, "</" * 100_000]
)
def test_broken_pages_take_linear_time(html):
    extract(html)


def test_query_keeps_every_page(spark, sf_dir, pages):
    got = query(spark, sf_dir).collect()
    assert len(got) == pages.count()
    by_id = {r.page_id: r for r in got if r.page_id}
    prose = "Words of an article that go on & on, with a bold one"
    assert by_id[9].text == f"One {prose}. {prose} twice." and by_id[12].text == "R&" and by_id[15].text == ""
    assert by_id[18].text == " ".join(["Long", *[f"{prose} {i}." for i in range(40_000)]])
    assert all(r.n_chars == len(r.text) for r in got)
