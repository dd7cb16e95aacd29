"""Main text: the block tree, exact marginals and gradients by brute force, held-out pages, awkward rows."""

import itertools

import numpy as np
import pytest

from territory_analytics.llm import extraction
from territory_analytics.llm.dom import Page
from territory_analytics.llm.labelled_pages import labelled_page


def blocks(html):
    page = Page(html)
    return [t for t in page.text if t is not None]


def test_blocks_of_lenient_markup():
    assert blocks("<p>one<p>two<br>\n three<div>four</p>five</div>") == ["one", "two three", "four", "five"]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e") == ["a", "b", "c", "d", "e"]
    assert blocks("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert blocks("<p><b>bold<p>next</b> rest") == ["bold", "next rest"]
    assert blocks("a &amp; b &lt;i&gt; &eacute;&#233;&nbsp;x &unknown; < 3") == ["a & b <i> éé x &unknown; < 3"]
    assert blocks('<script>var t="</p>";</script>x<style>p{}</style><!-- <p>no --><p hidden>y') == ["x", "y"]
    assert blocks("<title>t</title><textarea>no</textarea><button>no</button><select><option>no</select>yes") == ["yes"]
    assert blocks("") == blocks("<<<>>><p></p></div></body>")[:0] == []
    assert blocks("<p>one</section>two</p>") == ["onetwo"]


def test_links_and_names_are_seen():
    page = Page('<div class="mainNav side-bar" style="display: none"><a href="/x">go on</a> now</div>')
    assert set(page.names[1]) == {"main", "nav", "side", "bar", "#hidden"}
    assert page.text[2] == "go on now" and page.linked[2] == 5


def test_deep_and_long_pages():
    deep = "<div>" * 3_000 + "x" + "</div>" * 3_000
    assert blocks(deep) == ["x"]
    model = extraction.Model(np.zeros(extraction.DIMENSIONS), np.zeros((extraction.EDGE_KINDS, 2, 2)))
    long = "<p>" + "word " * 200_000
    found = extraction.page_blocks([deep, long, None], model)
    assert [len(f) for f in found] == [1, 1, 0] and len(found[1][0][0]) == 999_999


def random_model(rng):
    return extraction.Model(rng.normal(0, 1, extraction.DIMENSIONS), rng.normal(0, 1, (extraction.EDGE_KINDS, 2, 2)))


def small_forest():
    pages = ['<div><p>a</p><p data-label="1">b. c</p></div><ul><li>d</ul>', "<p data-label='1'>x", ""]
    return extraction.forest([Page(p) for p in pages])


def score(trees, model, y):
    unary = np.add.reduceat(model.weights[trees.feature], trees.offset)
    edges = sum(model.edges[trees.edge[i], y[p], y[i]] for i, p in enumerate(trees.parent) if p >= 0)
    return float((unary * y).sum() + edges)


def test_marginals_by_enumeration():
    trees, model = small_forest(), random_model(np.random.default_rng(1))
    n = len(trees.parent)
    all_y = [np.array(y) for y in itertools.product((0, 1), repeat=n)]
    p = np.exp([score(trees, model, y) for y in all_y])
    node, pair, log_sum = extraction.marginals(trees, model)
    assert log_sum.sum() == pytest.approx(np.log(p.sum()))
    p /= p.sum()
    assert node[:, 1] == pytest.approx(sum(w * y for w, y in zip(p, all_y)))
    for i, above in enumerate(trees.parent):
        if above >= 0:
            both = sum(w for w, y in zip(p, all_y) if y[i] and y[above])
            assert pair[i, 1, 1] == pytest.approx(both)


def test_gradient_by_differences():
    trees, model = small_forest(), random_model(np.random.default_rng(2))
    value, weights, edges = extraction.likelihood(trees, model)
    assert value == pytest.approx(score(trees, model, trees.label) - extraction.marginals(trees, model)[2].sum())
    for k in list(dict.fromkeys(trees.feature.tolist()))[:12]:
        moved = extraction.Model(model.weights.copy(), model.edges)
        moved.weights[k] += 1e-5
        assert (extraction.likelihood(trees, moved)[0] - value) / 1e-5 == pytest.approx(weights[k], abs=1e-3)
    for k in itertools.product(range(extraction.EDGE_KINDS), (0, 1), (0, 1)):
        moved = extraction.Model(model.weights, model.edges.copy())
        moved.edges[k] += 1e-5
        assert (extraction.likelihood(trees, moved)[0] - value) / 1e-5 == pytest.approx(edges[k], abs=1e-3)


def given_page(k, words=40):
    body = "".join(f"<p>Text {k} of part {j}, with {'more ' * (words * (j % 3))}words.</p>" for j in range(4))
    return (
        f'<html><head><title>t</title><script>var x="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li>'
        f'<li><a href="/b">News</a></li></ul></nav><div class="ad">Buy this now, it is very good.</div>'
        f"<article><h1>Head {k}</h1>{body}</article><footer>&copy; site {k} &middot; Some words here.</footer></body></html>"
    )


def given_text(k, words=40):
    body = [f"Text {k} of part {j}, with {'more ' * (words * (j % 3))}words." for j in range(4)]
    return "\n\n".join([f"Head {k}", *body])


@pytest.fixture(scope="module")
def model(spark):
    pages = spark.createDataFrame([(k, given_page(k)) for k in range(60)], "page_id long, html string")
    return extraction.fit(pages)


def test_held_out_labelled_pages(model):
    trees = extraction.forest([Page(labelled_page(90_000_000 + k)) for k in range(300)])
    found = extraction.marginals(trees, model)[0][trees.leaf, 1] >= extraction.ACCEPT
    assert (found == (trees.label[trees.leaf] == 1)).mean() > 0.985


MODERN = """<!doctype html><html><body>
<a class="skip-link" href="#c">Skip to content</a>
<header class="site-header"><div class="logo"><a href="/">The Daily</a></div>
 <nav class="main-menu"><ul><li><a href="/w">World</a><li><a href="/s">Sport</a><li><a href="/c">Culture</a></ul></nav></header>
<div class="cookie-consent" role="dialog"><p>We use cookies to make this site better. You can change your settings.</p><button>OK</button></div>
<div class="layout"><div class="story-body">
 <h1>River rises after a week of rain</h1>
 <p>The river rose by two metres on Monday, and people in the lower town moved their cars uphill.</p>
 <div class="ad-slot">Sponsored: the best boots for wet weather, now at half price.</div>
 <p>Nobody was hurt.</p>
 <ul><li>Schools stay closed until Wednesday, the town said.</li><li>Buses run as usual.</li></ul>
 <p>By the evening the water had begun to fall again, but more rain is expected later in the week.</p>
</div>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Ten walks by the sea</a><li><a href="/2">Mill burns down</a></ul></aside></div>
<section id="comments"><h2>Comments</h2><div class="comment"><b>Ann</b><p>I live there and it was quite frightening, the water came up to the door.</p></div>
<form class="comment-form"><label>Your comment</label><textarea></textarea></form></section>
<form class="newsletter"><p>Subscribe to our newsletter and never miss a story.</p><input name="mail"></form>
<footer class="site-footer"><p>Copyright The Daily. All rights reserved.</p></footer></body></html>"""


def test_page_with_all_kinds_of_parts(model):
    (found,) = extraction.page_blocks([MODERN], model)
    assert [t for t, p in found if p >= extraction.ACCEPT] == [
        "River rises after a week of rain",
        "The river rose by two metres on Monday, and people in the lower town moved their cars uphill.",
        "Nobody was hurt.",
        "Schools stay closed until Wednesday, the town said.",
        "Buses run as usual.",
        "By the evening the water had begun to fall again, but more rain is expected later in the week.",
    ]


def test_pages_without_any_markup(model):
    found = extraction.page_blocks(["Just a sentence, and one more. " * 5, "<p>One paragraph of words, no more.</p><p>And another one.</p>"], model)
    assert [[p >= extraction.ACCEPT for _, p in page] for page in found] == [[True], [True, True]]


def test_awkward_rows(spark, model):
    rows = [(1, None, "u", "b"), (2, "", "u", "b"), (None, given_page(7), None, "b"), (3, given_page(8), "u", None), (3, given_page(8), "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, blocks string")
    out = extraction.extract(pages, model)
    assert out.columns == ["page_id", "url", "blocks", "text"]
    texts = sorted(((r.page_id, r.text) for r in out.collect()), key=repr)
    assert texts == sorted([(1, ""), (2, ""), (None, given_text(7)), (3, given_text(8)), (3, given_text(8))], key=repr)
    assert extraction.extract(pages.limit(0), model).count() == 0
    empty = extraction.fit(pages.limit(0), written=40)
    assert len(extraction.page_blocks([given_page(1)], empty)[0]) == 9


def test_query_against_the_marked_articles(spark, folder):
    rows = [(k, f"http://x/{k}", given_page(k, k % 5)) for k in range(80)] + [(80, None, None), (81, "u", "")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    got = sorted(tuple(r) for r in extraction.main_text(spark, folder).collect())
    want = [(k, f"http://x/{k}", given_text(k, k % 5)) for k in range(80)] + [(80, None, ""), (81, "u", "")]
    assert got == [(*row, len(row[2])) for row in want]
