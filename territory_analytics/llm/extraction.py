"""Main text of web pages, by a graphical model over their block trees.

The nodes of a page's block tree hold content or not.  A node's potential depends on what it looks like
(element, names, text and link shares, lengths), and the potential of an edge on both its ends, so that a
short paragraph follows its article and a long advert its surroundings.  Messages are summed upward from
the leaves and then downward from the root, which gives exact marginals; blocks whose marginal is at least
one half are the text.  The weights maximise the conditional likelihood of labelled pages, whose gradient
comes from the same marginals.

It is learnt from hand-written labelled pages and from a bounded sample of the given pages that mark their
article by element; these have their telling elements and names hidden at random, so that the model does
not lean on them.
"""

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import small_batches, table
from .dom import CONTAINERS, TEXT_BLOCKS, Page
from .labelled_pages import labelled_page

#: Hand-written labelled pages, and given pages with marked articles, that the model is fitted on.
WRITTEN_PAGES = 400
MARKED_PAGES = 200
#: Longest given page that is fitted on, in characters.
LONGEST_FIT_PAGE = 100_000
ACCEPT = 0.5
SEED = 5
DIMENSIONS = 1 << 13
EDGE_KINDS = 9
PAGES_PER_BATCH = 100

# Beginnings of names, by what elements of that name mostly hold.
STEMS = {
    "content": "article content post entry story main body text prose page blog news single document",
    "menu": "nav menu breadcrumb toc pagin pager skip tab",
    "head": "head masthead top brand logo",
    "foot": "foot bottom colophon legal copyright imprint",
    "side": "side aside rail widget relat recommend trend popular read share social tag",
    "notice": "notice alert cookie consent gdpr popup modal overlay warn paywall disclaim banner",
    "advert": "ad ads adv advert advertis sponsor promo dfp partner",
    "form": "form search login sign newsletter subscri contact poll survey",
    "comment": "comment respon discuss repl disqus feedback thread",
}
_ARTICLES = frozenset(["article", "main"])
_STEM_OF = {stem: kind for kind, stems in STEMS.items() for stem in stems.split()}
NOTICE_WORDS = (
    "©", "copyright", "rights reserved", "cookie", "subscribe", "newsletter", "sign up", "log in",
    "advert", "sponsored", "privacy", "javascript", "datenschutz", "impressum", "werbung", "publicité", "derechos",
)


# --- Nodes and their features ---------------------------------------------------------------------------


def _stem(name: str) -> str | None:
    for size in range(len(name), 1, -1):
        kind = _STEM_OF.get(name[:size])
        if kind and (size > 3 or size == len(name)):
            return kind
    return None


def _bin(value: float, cuts: tuple) -> int:
    return sum(value >= cut for cut in cuts)


def _named(tag: str, names: tuple) -> list[str]:
    out = [f"tag {tag}"]
    for name in dict.fromkeys(names):
        out.append(f"name {name}")
        kind = _stem(name)
        if kind:
            out.append(f"kind {kind}")
    if not names:
        out.append(f"bare {tag}")
    return out


_dimension: dict[str, int] = {}


def _dimensions(names: list[str]) -> list[int]:
    for name in names:
        if name not in _dimension:
            if len(_dimension) > 50_000:
                _dimension.clear()
            _dimension[name] = zlib.crc32(name.encode()) % DIMENSIONS
    return [_dimension[name] for name in names]


@dataclass
class Forest:
    """Trees of several pages: nodes with parents (-1 for roots), depths, kinds of edges and features."""

    parent: np.ndarray
    depth: np.ndarray
    edge: np.ndarray
    feature: np.ndarray
    offset: np.ndarray
    label: np.ndarray
    leaf: np.ndarray
    page: np.ndarray
    text: list[str]


def _rank(tag: str) -> int:
    """0 the page, 1 containers, 2 blocks and runs of text."""
    return 0 if tag == "html" else 2 if tag in TEXT_BLOCKS or tag == "#text" else 1


def _page_features(page: Page) -> tuple[list[list[str]], list[int]]:
    """Features of all nodes, and whether they hold any content, if the page is labelled."""
    n = len(page.tag)
    chars, linked, leaves, good = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if page.text[i] is not None:
            chars[i], linked[i], leaves[i] = len(page.text[i]), page.linked[i], 1
            good[i] = chars[i] if page.label[i] == "1" else 0
        above = page.parent[i]
        if above >= 0:
            for sums in (chars, linked, leaves, good):
                sums[above] += sums[i]
    total, before = max(1, chars[0]), 0
    # Articles in articles are mostly comments, and several in a row are teasers or comments.
    inside, outer = [False] * n, [0] * n
    for i in range(1, n):
        above = page.parent[i]
        inside[i] = inside[above] or page.tag[above] in _ARTICLES
        outer[i] = page.tag[i] in _ARTICLES and not inside[i]
    few = sum(outer) == 1
    features = []
    for i in range(n):
        tag, text = page.tag[i], page.text[i]
        if text is None:
            f = _named(tag, page.names[i])
            f += [
                f"share {_bin(chars[i] / total, (0.02, 0.1, 0.3, 0.6, 0.9))}",
                f"links {_bin(linked[i] / max(1, chars[i]), (0.01, 0.2, 0.5, 0.9))}",
                f"mean {_bin(chars[i] / max(1, leaves[i]), (15, 40, 100, 250))}",
                f"leaves {_bin(leaves[i], (1, 2, 4, 11))}",
            ]
            if outer[i]:
                f.append(f"outer article {few}")
        else:
            words = text.count(" ") + 1
            low = text[:500].lower()
            f = [
                f"in {page.tag[page.parent[i]]}",
                f"words {_bin(words, (2, 4, 8, 16, 41))}",
                f"linked {_bin(linked[i] / chars[i], (0.01, 0.3, 0.8))}",
                f"ends {text[-1] in '.!?…:;'}",
                f"place {_bin(before / total, (0.05, 0.2, 0.8, 0.95))}",
            ]
            if any(word in low for word in NOTICE_WORDS):
                f.append(f"notice {words < 41}")
            before += chars[i]
        features.append(f)
    return features, [int(x > 0) for x in good]


def forest(pages: list[Page]) -> Forest:
    parent, depth, edge, feature, offset, label, leaf, which, texts = [], [], [], [], [], [], [], [], []
    for number, page in enumerate(pages):
        base = len(parent)
        features, labels = _page_features(page)
        for i, tag in enumerate(page.tag):
            above = page.parent[i]
            parent.append(above + base if above >= 0 else -1)
            depth.append(depth[above + base] + 1 if above >= 0 else 0)
            edge.append(_rank(page.tag[above]) * 3 + _rank(tag) if above >= 0 else 0)
            offset.append(len(feature))
            feature += _dimensions(features[i])
            label.append(labels[i])
            if page.text[i] is not None:
                leaf.append(base + i)
                which.append(number)
                texts.append(page.text[i])
    as_int = lambda x: np.array(x, np.int64)
    return Forest(*map(as_int, (parent, depth, edge, feature, offset, label, leaf, which)), texts)


# --- The model --------------------------------------------------------------------------------------------


@dataclass
class Model:
    """Weight of every feature for a node that is content, and potentials of edges [kind, parent, child]."""

    weights: np.ndarray
    edges: np.ndarray


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(trees: Forest, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact marginals of the nodes (n, 2) and of the edges to their parents (n, 2, 2), by two sweeps.

    The third array has the logarithm of every tree's partition sum, at its root.
    """
    n = len(trees.parent)
    below = np.zeros((n, 2))
    if not n:
        return below, np.zeros((0, 2, 2)), np.zeros(0)
    below[:, 1] = np.add.reduceat(model.weights[trees.feature], trees.offset)
    by_depth = np.argsort(trees.depth, kind="stable")
    levels = np.split(by_depth, np.flatnonzero(np.diff(trees.depth[by_depth])) + 1)
    up = np.zeros((n, 2))
    for level in reversed(levels[1:]):
        up[level] = _logsum(model.edges[trees.edge[level]] + below[level][:, None, :], 2)
        # Parents of a level are few and in order, so their children's messages are summed in one go.
        order = np.argsort(trees.parent[level], kind="stable")
        above, first = np.unique(trees.parent[level][order], return_index=True)
        below[above] += np.add.reduceat(up[level][order], first)
    whole, pair = below.copy(), np.zeros((n, 2, 2))
    for level in levels[1:]:
        above = whole[trees.parent[level]] - up[level]
        joint = above[:, :, None] + model.edges[trees.edge[level]] + below[level][:, None, :]
        whole[level] = _logsum(joint, 1)
        pair[level] = np.exp(joint - _logsum(joint.reshape(-1, 4), 1)[:, None, None])
    log_sum = _logsum(whole, 1)
    return np.exp(whole - log_sum[:, None]), pair, np.where(trees.parent < 0, log_sum, 0)


def likelihood(trees: Forest, model: Model) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of the labels, and its gradient: what is seen less what the model expects."""
    node, pair, log_sum = marginals(trees, model)
    inner = np.flatnonzero(trees.parent >= 0)
    y, above = trees.label, trees.label[trees.parent[inner]]
    unary = np.add.reduceat(model.weights[trees.feature], trees.offset)
    value = (unary * y).sum() + model.edges[trees.edge[inner], above, y[inner]].sum() - log_sum.sum()
    counts = np.diff(np.append(trees.offset, len(trees.feature)))
    weights = np.bincount(trees.feature, np.repeat(y - node[:, 1], counts), minlength=len(model.weights))
    cell = trees.edge[inner] * 4 + above * 2 + y[inner]
    seen = np.bincount(cell, minlength=EDGE_KINDS * 4).reshape(-1, 2, 2)
    expected = [np.bincount(trees.edge[inner], pair[inner, a, b], minlength=EDGE_KINDS) for a in (0, 1) for b in (0, 1)]
    return float(value), weights, seen - np.stack(expected, 1).reshape(-1, 2, 2)


def train(trees: Forest, rounds: int = 150, rate: float = 0.2, decay: float = 0.5) -> Model:
    """Maximise the penalised conditional likelihood, which is concave, by Adam on all trees."""
    theta = [np.zeros(DIMENSIONS), np.zeros((EDGE_KINDS, 2, 2))]
    first, second = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    for step in range(1, rounds + 1):
        _, *gradient = likelihood(trees, Model(*theta))
        for k, slope in enumerate(gradient):
            slope = slope - decay * theta[k]
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.99 * second[k] + 0.01 * slope * slope
            theta[k] = theta[k] + rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Model(*theta)


# Parts inside an article that are none of it.
_OTHERS = frozenset(["nav", "aside", "footer", "form", "dialog", "ins"])


def marked_page(html: str, seed: int) -> Page | None:
    """A given page labelled by its own article element, telling elements and names hidden at random.

    None if it has not just one outermost article.
    """
    page = Page(html)
    n = len(page.tag)
    inside, articles = [False] * n, 0
    for i in range(1, n):
        above = inside[page.parent[i]]
        starts = page.tag[i] in _ARTICLES and not above
        articles += starts
        noise = page.tag[i] in _OTHERS or any(_stem(name) not in (None, "content", "head") for name in page.names[i])
        inside[i] = starts or (above and not noise)
    if articles != 1 or not any(inside[i] and page.text[i] is not None for i in range(n)):
        return None
    page.label = ["1" if x else "0" for x in inside]
    rng = random.Random(seed)
    for i in range(1, n):
        if page.tag[i] in CONTAINERS and rng.random() < 0.4:
            page.tag[i] = "div"
        if rng.random() < 0.4:
            page.names[i] = ()
    return page


def fit(pages: DataFrame, html_col: str = "html", written: int = WRITTEN_PAGES, marked: int = MARKED_PAGES, seed: int = SEED) -> Model:
    """Fit on ``written`` labelled pages and on at most ``marked`` of ``pages``, those of the smallest hashes.

    Pages over ``LONGEST_FIT_PAGE`` characters, NULL ones and those without just one marked article are not
    fitted on; repeated pages count once.  An empty table leaves the labelled pages alone.
    """
    html = F.col(html_col)
    named = pages.where(F.length(html) <= LONGEST_FIT_PAGE).select(F.xxhash64(html).alias("name"), html.alias("html"))
    # Names are chosen before any page moves; then each chosen page is fetched once.
    last = named.select("name").distinct().orderBy("name").limit(marked).agg(F.max("name")).first()[0]
    rows = named.where(F.col("name") <= last).groupBy("name").agg(F.min("html").alias("html")).orderBy("name").collect()
    given = [marked_page(row.html, seed + k) for k, row in enumerate(rows)]
    trees = [Page(labelled_page(seed * 100_000 + k)) for k in range(written)]
    return train(forest(trees + [page for page in given if page is not None]))


def page_blocks(htmls: list[str | None], model: Model) -> list[list[tuple[str, float]]]:
    """Of every page its blocks of text in page order, each with the marginal of being content."""
    trees = forest([Page(html or "") for html in htmls])
    node = marginals(trees, model)[0]
    out: list[list[tuple[str, float]]] = [[] for _ in htmls]
    for page, leaf, text in zip(trees.page.tolist(), trees.leaf.tolist(), trees.text, strict=True):
        out[page].append((text, float(node[leaf, 1])))
    return out


# --- On tables ----------------------------------------------------------------------------------------------


def extract(
    pages: DataFrame, model: Model, html_col: str = "html", accept: float = ACCEPT, with_blocks: bool = True
) -> DataFrame:
    """``pages`` with ``blocks`` (text, content; NULL without ``with_blocks``) and ``text`` instead of the html.

    ``text`` joins by an empty line the blocks whose marginal ``content`` is at least ``accept``.  A NULL or
    empty page, and one without content, has an empty text; pages of any length are treated whole; repeated
    rows and NULL ids stay; columns named ``blocks`` or ``text`` of the input are replaced; an empty table
    gives no rows.
    """
    small_batches(pages.sparkSession)
    others = [c for c in pages.columns if c not in (html_col, "blocks", "text")]
    kept = pages.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{html_col}`"))
    block = pa.list_(pa.struct([("text", pa.string()), ("content", pa.float64())]))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1]] + ["blocks array<struct<text: string, content: double>>, text string"])

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, PAGES_PER_BATCH):
                part = batch.slice(first, PAGES_PER_BATCH)
                found = page_blocks(part.column(len(others)).to_pylist(), model)
                blocks = [[{"text": t, "content": p} for t, p in page] if with_blocks else None for page in found]
                texts = ["\n\n".join(t for t, p in page if p >= accept) for page in found]
                columns = [part.column(k) for k in range(len(others))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(blocks, block), pa.array(texts, pa.string())], [*others, "blocks", "text"])

    return kept.mapInArrow(extracted, schema)


def main_text(spark, sf_dir) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    small_batches(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = extract(pages, fit(pages), with_blocks=False)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
