"""Content that only the alignment of a host's pages tells, hostile pages, and tree matching."""

from __future__ import annotations

import itertools
import random
import time

import pytest

from alertweave.llm import html_extract
from alertweave.llm.common import prepare


def texts_of(spark, htmls):
    rows = [(i, "http://h.example/", h) for i, h in enumerate(htmls)]
    pages = prepare(spark).createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_text(pages).collect()}
    return [got[i] for i in range(len(rows))]


def story(i, n=3):
    return [f"story {i} part {k} that no other page has" for k in range(n)]


def test_pages_without_article_or_known_names(spark):
    """Anonymous elements: what is template is told by nothing but the other pages."""
    page = (
        "<body><div><ul><li>Home</li><li>Contact us</li></ul></div><div><h2>T{0}</h2>{1}</div>"
        "<div><div class=q7>Read our paper</div>{2}</div><div><b>Imprint</b> and more</div>"
    )
    htmls = []
    for i in range(9):
        paragraphs = "".join(f"<p>{x}</p>" for x in story(i, 1 + i % 4))
        # some pages have one more block, which moves all that follow it
        htmls.append(page.format(i, paragraphs, f"<p>by writer {i}</p>" if i % 3 else ""))
    got = texts_of(spark, htmls)
    for i, text in enumerate(got):
        own = [f"T{i}", *story(i, 1 + i % 4), *[f"by writer {i}"] * (i % 3 > 0)]
        assert text == " ".join(own)


def test_an_element_that_comes_and_goes_does_not_shift_the_rest(spark):
    """By position or path the blocks of these pages would meet others; matched as trees they do not."""
    offer = "<div><p>An offer of the day {0}</p></div>"
    page = "<body>{0}<div><ul><li>Home</li><li>About</li></ul></div><div><h1>{1}</h1><p>{2}</p></div><div><p>All rights</p></div>"
    htmls = [page.format(offer.format(i) if i % 2 else "", f"Title {i}", story(i)[0]) for i in range(8)]
    got = texts_of(spark, htmls)
    for i, text in enumerate(got):
        assert text.endswith(f"Title {i} {story(i)[0]}") and "Home" not in text and "rights" not in text


def test_without_the_wrapper_the_template_stays(spark):
    page = "<body><div><p>Menu of all pages</p><div>{0}</div></div>"
    assert texts_of(spark, [page.format(f"words {i}") for i in range(4)]) == [f"words {i}" for i in range(4)]
    assert texts_of(spark, [page.format("words 0")]) == ["Menu of all pages words 0"]


def test_inline_names_cut_nothing(spark):
    html = "<article><p>Story about the <span class='social'>social</span> widget</p></article>"
    assert texts_of(spark, [html]) == ["Story about the social widget"]


@pytest.mark.parametrize("name", ["user-comments", "site-footer", "reader-replies", "cookie-consent"])
def test_names_on_a_host_that_tells_nothing(spark, name):
    html = f"<body><div><p>Words of the article</p></div><div class='{name}'>left out</div>"
    assert texts_of(spark, [html]) == ["Words of the article"]


def tree_of(rng, depth=3):
    kids = [tree_of(rng, depth - 1) for _ in range(rng.randint(0, 3))] if depth else []
    return [rng.choice("ab"), rng.choice(["", "x"]), 1, kids]


def best_sum(a, b):
    """The largest sum over all order-preserving pairings of children, by trying all."""
    best = 0
    for n in range(min(len(a[3]), len(b[3])) + 1):
        for xs in itertools.combinations(a[3], n):
            for ys in itertools.combinations(b[3], n):
                if all(x[0] == y[0] for x, y in zip(xs, ys, strict=True)):
                    best = max(best, sum(best_sum(x, y) for x, y in zip(xs, ys, strict=True)))
    return 1 + (a[1] == b[1]) + best


def test_tree_matching_is_the_best_one():
    rng = random.Random(4)
    for _ in range(300):
        a, b = tree_of(rng), tree_of(rng)
        found = html_extract.aligned(a, b)
        nodes = {id(n): n for n in html_extract.listed(a)}
        total = sum(1 + (nodes[i][1] == m[1]) for i, m in found.items())
        assert total == best_sum(a, b)
        assert len({id(m) for m in found.values()}) == len(found)


@pytest.mark.parametrize("n", [20, 1_500])
def test_large_trees_are_matched_like_small_ones(n):
    """A node that moved to the other end costs its own pair only, whatever the number of nodes."""
    kids = [["p", f"k{i}", 1, [["i", "", 1, []]] * (i % 2)] for i in range(n)]
    moved = ["p", "moved", 1, []]
    a, b = ["", "", 1, [moved, *kids]], ["", "", 1, [*kids, moved]]
    found = html_extract.aligned(a, b)
    assert all(found.get(id(k)) is k for k in kids) and id(moved) not in found
    # with all neighbours in the other order one pair of children is left
    turned = ["", "", 1, [["p", f"k{i}", 1, []] for i in reversed(range(n))]]
    leaves = ["", "", 1, [["p", f"k{i}", 1, []] for i in range(n)]]
    pairs = html_extract.aligned(leaves, turned)
    # tags agree everywhere, so all are paired, and at most one by name
    assert len(pairs) == n + 1


def test_pages_beyond_any_size_lose_their_template(spark):
    """The menu is found among hundreds of blocks, though a block of its form stands before it."""
    def page(i, n):
        blocks = "".join(f"<div class=b{chr(97 + k % 26)}{chr(97 + k // 26)}q><p>{i}.{k}</p></div>" for k in range(n))
        extra = f"<ul><li>day {i}</li></ul>" if i % 2 else ""
        return f"<body>{extra}{blocks}<ul><li>Home</li></ul></body>"

    for n in (5, 400):
        got = texts_of(spark, [page(i, n) for i in range(6)])
        for i, text in enumerate(got):
            own = [f"day {i}"] * (i % 2) + [f"{i}.{k}" for k in range(n)]
            assert text == " ".join(own), (n, i)


def test_many_shapes_are_merged_in_groups(spark, monkeypatch):
    """More shapes than one task merges; what a third of the pages have alone is no template."""
    monkeypatch.setattr(html_extract, "MERGED", 4)
    htmls = []
    for i in range(40):
        extra = "".join(f"<section class=s{i}-{k}x><p>{i}.{k}</p></section>" for k in range(i % 5))
        htmls.append(f"<body><div><ul><li>Home</li></ul></div>{extra}<div><h1>T{i}</h1><p>{story(i)[0]}</p></div>")
    got = texts_of(spark, htmls)
    for i, text in enumerate(got):
        extra = [f"{i}.{k}" for k in range(i % 5)]
        assert text == " ".join([*extra, f"T{i}", story(i)[0]])


HOSTILE = {
    "tags that never close": lambda n: "<a " * (n // 3) + '"',
    "quotes that never close": lambda n: "<a \"'" * (n // 5),
    "deep": lambda n: "<div><p>x" * (n // 9),
    "ends without starts": lambda n: "<b>" * (n // 8) + "</i>" * (n // 8),
    "a barrier far away": lambda n: "<dt><ul>" + "<b>" * (n // 8) + "<dt></dt>" * (n // 16),
    "wide": lambda n: "<p>x<div>y</div>" * (n // 16),
    "names": lambda n: "".join(f"<div class=c{i}x>a</div>" for i in range(n // 25)),
    "brackets": lambda n: "<" * n,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_time_grows_with_length_only(name):
    def seconds(n):
        html = HOSTILE[name](n)
        start = time.process_time()
        shape, _ = html_extract.node_texts(html)
        html_extract.places(shape, shape)
        html_extract.extract(html, None, frozenset())
        return time.process_time() - start

    assert seconds(1_000_000) < max(1.0, 40 * seconds(100_000))
