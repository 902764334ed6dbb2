"""Main text of pages whose elements have their names, none, or names that mislead."""

import re

import pytest

from cueweave.llm import main_text
from test_queries import rows

NAMES = ("search-index", "related-work", "social-history", "legal-framework")


def hostile(page, k):
    """The article in a section called like boilerplate, and headings and paragraphs with such names."""
    turn = iter(range(10**6))
    page = page.replace("<article>", f'<article><section id="{NAMES[k % 4]}">').replace("</article>", "</section></article>").replace("<h1>", '<h1 id="related-work">')
    return re.sub("<p>", lambda _: ['<p class="share-price">', "<p>", '<p id="comment-theory">', '<p class="menu-engineering">'][next(turn) % 4], page)


@pytest.fixture(scope="module")
def pages():
    return [h for (h,) in rows("select html from '/root/testdata/sf0.01/pages.parquet' order by page_id")]


def measured(pages, weights, change):
    """(precision, recall, whole pages) of the cut and of the blocks' own costs, and how many labels the cut changes."""
    count, own_count, exact, own_exact, flips = [0, 0, 0], [0, 0, 0], 0, 0, 0
    for k, page in enumerate(pages):
        found, elements = main_text.blocks(page)
        want = [elements[b.home].inside for b in found]
        found, elements = main_text.blocks(change(page, k))
        assert len(found) == len(want)
        own = [c > 0 for c in main_text.costs(found, elements, weights)]
        cut = main_text.minimum_cut(*main_text.graph(found, elements, weights))[: len(found)]
        for labels, c in ((cut, count), (own, own_count)):
            for x, y in zip(labels, want, strict=True):
                c[0] += x and y
                c[1] += x and not y
                c[2] += y and not x
        exact, own_exact, flips = exact + (cut == want), own_exact + (own == want), flips + sum(x != y for x, y in zip(cut, own, strict=True))
    rates = lambda c: (c[0] / (c[0] + c[1]), c[0] / (c[0] + c[2]))
    return *rates(count), exact, *rates(own_count), own_exact, flips


def test_pages_with_without_and_with_wrong_names(pages):
    weights = main_text.fit_weights(pages[:125])
    for change in (lambda p, k: p, hostile):
        precision, recall, exact, *_ = measured(pages, weights, change)
        assert (precision, recall, exact) == (1.0, 1.0, 250)
    precision, recall, exact, own_precision, own_recall, own_exact, flips = measured(pages, weights, lambda p, k: main_text.nameless(p))
    assert precision >= 0.99 and recall >= 0.995 and exact >= 210 and flips >= 30
    f1 = lambda p, r: 2 * p * r / (p + r)
    assert f1(precision, recall) > f1(own_precision, own_recall) and exact > own_exact


def test_weights_come_from_labels_and_fall_back(pages):
    fitted = main_text.fit_weights(pages[:60])
    assert fitted == main_text.fit_weights(pages[:60]) != main_text.PRIOR
    assert main_text.fit_weights([]) == main_text.fit_weights(["<p>No article here.</p>"]) == main_text.PRIOR
    assert main_text.nameless('<nav id="x"><p>a <a href="y">b</a></p></nav>') == '<div><div>a <a href="y">b</a></div></div>'


def test_names_say_something_only_as_a_whole():
    said = lambda n, inside=False: main_text._called(n, inside)[0]
    assert [said(n) for n in ("sidebar", "site-footer", "cookie-banner", "newsletter-signup", "relatedPosts", "comment-list", "ad", "share-buttons", "nav_main")] == [False] * 9
    assert [said(n) for n in ("related-work", "share-price", "search-index", "social-history", "legal-framework", "menu-engineering", "x", "")] == [None] * 8
    assert [said(n) for n in ("post-content", "entry-content", "article-body", "main")] == [True] * 4
    assert said("header") is False and said("header", True) is None


PAGE = """<html><body class="sidebar-layout"><div class="cookie-notice"><p>We use cookies to make this site better for all of our readers. Accept them to go on.</p></div>
<header><a href="/">Home</a><h2>The Daily Something</h2></header><form class="search"><label>Find</label><input name=q></form>
<div id="wrapper"><div class="post-content"><article><header><h1 id="search">On search engines</h1></header>
<p>Search engines keep an index of words, and of the pages that hold them, so that a question needs no scan of all pages.</p><p>Short one.</p>
<section id="related-work"><h2>Related work</h2><p>Early systems were built for libraries, where each record was short and had been catalogued by hand.</p></section>
<div class="share-buttons"><a href="#">Tweet</a> <a href="#">Post</a></div><div class="ad"><p>Buy our new engine today, it is cheaper than all of the others.</p></div>
<ul><li>An index maps words to pages.</li><li>A ranking puts the pages in order.</li></ul>
<section class="comments"><h3>2 comments</h3><div class="comment"><p>I have worked on such an engine for years, and this text says it all very well indeed.</p></div><div class="comment"><p>Thanks!</p></div></section>
</article></div><aside><h3>Most read</h3><p>A long teaser text about some other story that is of no interest here, but is well written.</p></aside></div>
<footer>© 2024 The Daily Something. All rights reserved.</footer></body></html>"""


def test_a_page_with_all_sorts_of_boilerplate(pages):
    want = [
        "On search engines", "Search engines keep an index of words, and of the pages that hold them, so that a question needs no scan of all pages.", "Short one.", "Related work",
        "Early systems were built for libraries, where each record was short and had been catalogued by hand.", "An index maps words to pages.", "A ranking puts the pages in order.",
    ]
    for weights in (main_text.PRIOR, main_text.fit_weights(pages[:100])):
        assert main_text.main_text(PAGE, weights).split("\n") == want


def test_a_long_article_outweighs_a_class_but_not_a_tag_or_comments():
    text = "".join(f"<p>This is sentence number {i} of a long article that goes on and on about one thing.</p>" for i in range(60))
    page = lambda begin, end: f"<html><body><nav><a href=/>Home</a></nav><article>{begin}{text}{end}</article></body></html>"
    count = lambda p: main_text.main_text(p).count("sentence")
    assert count(page('<div class="search">', "</div>")) == 60
    assert count(page('<div class="comments">', "</div>")) == count(page("<aside>", "</aside>")) == 0


def test_fit_reads_a_bounded_sample(spark, pages):
    df = spark.createDataFrame([(p,) for p in pages[:40]] + [(None,), ("",), ("<article>" + "x" * 70_000,)], "html string")
    assert len(main_text.fit(df, sample=10)) == len(main_text.FEATURES)
    assert main_text.fit(df.limit(0)) == main_text.PRIOR
