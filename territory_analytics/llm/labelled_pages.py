"""Labelled pages to learn from: hand-written parts of pages, marked as content or not.

Every part stands for a habit of page authors: how articles, menus, headers, footers, sidebars, notices,
adverts, forms and reader comments are marked up, with and without telling tags and names.  Pages are put
together from them by a seeded generator, so that the set can be of any size; a block's label is that of
the nearest element with ``data-label``.
"""

import random
from collections.abc import Callable

# Names that authors give to elements, by what these hold.
CONTENT_NAMES = (
    "article post entry-content story-body main-content content article__body post-text prose text "
    "page-content blog-post news-article body-copy single hentry mw-body document"
).split()
NAV_NAMES = "nav menu navbar main-nav breadcrumb breadcrumbs site-navigation topbar menu-list toc pagination pager skip-links tabs".split()
HEADER_NAMES = "header site-header masthead top branding banner-top page-header logo-area".split()
FOOTER_NAMES = "footer site-footer bottom colophon legal copyright page-footer foot".split()
SIDE_NAMES = "sidebar side aside rail widget related recommended more-stories trending popular most-read tags share social".split()
NOTICE_NAMES = "notice alert cookie cookie-banner consent gdpr popup modal overlay message warning paywall disclaimer banner".split()
AD_NAMES = "ad ads advert advertisement ad-slot sponsored promo promoted sponsor banner-ad dfp partner".split()
FORM_NAMES = "form search search-form login signup newsletter subscribe contact-form comment-form poll survey".split()
COMMENT_NAMES = "comments comment comment-list responses discussion replies reply disqus reader-comments feedback thread".split()

_SYLLABLES = "the an or re ti on er ing ed es la que eau ment vi der sch ung ei ge ción al os ar да но ра то".split()
_MARKS = ["", "", "", ",", "%%%", "***", "&amp;"]


class _Writer:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.junk = self.rng.random() < 0.2

    def word(self) -> str:
        word = "".join(self.rng.choices(_SYLLABLES, k=self.rng.choice([1, 1, 2, 2, 3, 4])))
        return word + (self.rng.choice(_MARKS) if self.junk else "," if self.rng.random() < 0.08 else "")

    def phrase(self, least: int = 1, most: int = 4) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(least, most))).capitalize()

    def prose(self) -> str:
        """A paragraph: mostly some sentences, sometimes a single word."""
        size = self.rng.choice([1, 2, 5, 12, 25, 40, 70, 120, 200])
        sentences = []
        while size > 0:
            n = min(size, self.rng.randint(3, 20))
            sentences.append(self.phrase(n, n) + self.rng.choice("...?!"))
            size -= n
        text = " ".join(sentences)
        if self.rng.random() < 0.15:
            text = text.replace(" ", f' <a href="/x">{self.word()}</a> ', 1)
        return f"<b>{text}</b>" if self.rng.random() < 0.05 else text

    def attrs(self, names: list[str], bare: float) -> str:
        if self.rng.random() < bare:
            return ""
        name = self.rng.choice(names)
        if self.rng.random() < 0.3:
            name += " " + self.rng.choice(["clearfix", "col-8", "row", "wrap", "x1a2b", "is-open", name + "__inner"])
        return f' {self.rng.choice(["class", "class", "class", "id"])}="{name}"'

    def element(self, tags: str, names: list[str], inner: str, label: int | None = None, bare: float = 0.25) -> str:
        tag = self.rng.choice(tags.split())
        # Plain tags without a name would tell nothing apart.
        attrs = self.attrs(names, bare if tag not in ("div", "p", "ul", "ol", "span") else bare / 4)
        mark = "" if label is None else f' data-label="{label}"'
        return f"<{tag}{attrs}{mark}>{inner}</{tag}>"

    def links(self, least: int = 2, most: int = 10, wrap: str = "li") -> str:
        each = [f'<a href="/{k}">{self.phrase(1, self.rng.choice([1, 3, 9]))}</a>' for k in range(self.rng.randint(least, most))]
        if wrap == "li":
            return "<ul>" + "".join(f"<li>{x}</li>" for x in each) + "</ul>"
        return self.rng.choice([" | ", " &middot; ", " "]).join(each)


def _nav(w: _Writer) -> str:
    return w.element("nav nav div div ul", NAV_NAMES, w.links(wrap=w.rng.choice(["li", "li", ""])), 0)


def _header(w: _Writer) -> str:
    inner = w.rng.choice(["<h1>{}</h1>", '<a href="/">{}</a>', "<div>{}</div>", "<p>{}</p>"]).format(w.phrase(1, 3))
    inner += w.rng.choice(["", f"<p>{w.phrase(3, 9)}</p>", _nav(w)])
    return w.element("header header div", HEADER_NAMES, inner, 0)


def _footer(w: _Writer) -> str:
    lines = [f"&copy; {w.phrase()} 2024", f"{w.phrase()} &middot; {w.prose()}", w.prose(), w.links(wrap="")]
    inner = "".join(w.rng.choice(["<p>{}</p>", "{}", "<div>{}</div>"]).format(x) for x in w.rng.sample(lines, w.rng.randint(1, 3)))
    return w.element("footer footer div", FOOTER_NAMES, inner, 0)


def _side(w: _Writer) -> str:
    inner = f"<h3>{w.phrase()}</h3>" + w.rng.choice([w.links(), f"<p>{w.prose()}</p>", f"<p>{w.prose()}</p>{w.links()}"])
    return w.element("aside aside div div section", SIDE_NAMES, inner, 0)


def _notice(w: _Writer) -> str:
    inner = w.rng.choice(["<p>{}</p>", "{}", "<div>{}</div>"]).format(w.prose()) + w.rng.choice(["", '<a href="/ok">OK</a>', "<button>OK</button>"])
    return w.element("div div section dialog aside p", NOTICE_NAMES, inner, 0, bare=0)


def _advert(w: _Writer) -> str:
    inner = w.rng.choice([w.prose(), f'<a href="/buy">{w.prose()}</a>', f"<p>{w.prose()}</p>", f"<span>{w.phrase()}</span><p>{w.prose()}</p>"])
    return w.element("div div aside section ins", AD_NAMES, inner, 0, bare=0)


def _form(w: _Writer) -> str:
    fields = "".join(f"<label>{w.phrase(1, 3)} <input name='{k}'></label>" for k in range(w.rng.randint(1, 4)))
    inner = w.rng.choice(["", f"<p>{w.prose()}</p>", f"<h3>{w.phrase()}</h3>"]) + fields
    return w.element("form form form div", FORM_NAMES, inner, 0, bare=0.4)


def _comments(w: _Writer) -> str:
    one = lambda: w.rng.choice(
        [f"<p>{w.prose()}</p>", f"<b>{w.phrase(1, 2)}</b> {w.prose()}", f"<h4>{w.phrase(1, 2)}</h4><p>{w.prose()}</p><a href='/r'>{w.word()}</a>"]
    )
    many = [w.element("div div div li li li section section article", COMMENT_NAMES, one(), bare=0.3) for _ in range(w.rng.randint(1, 6))]
    inner = w.rng.choice(["", f"<h2>{w.phrase(1, 3)}</h2>", f"<h3>{w.phrase(1, 3)}</h3>"]) + "".join(many) + w.rng.choice(["", _form(w)])
    return w.element("section section div div ol aside", COMMENT_NAMES, inner, 0, bare=0.1)


_NOISE: list[Callable[[_Writer], str]] = [_nav, _side, _notice, _advert, _form]


def _article(w: _Writer) -> str:
    """An article's blocks, at times with other parts among them."""
    blocks = []
    for _ in range(w.rng.choice([1, 2, 4, 8, 15])):
        blocks.append(
            w.rng.choices(
                [
                    lambda: f"<p>{w.prose()}</p>",
                    lambda: f"<p>{w.prose()}",
                    lambda: f"<p><b>{w.prose()}<br>",
                    lambda: f"<div>{w.prose()}</div>",
                    lambda: f"{w.prose()}<br><br>",
                    lambda: f"<h2>{w.phrase()}</h2>",
                    lambda: "<ul>" + "".join(f"<li>{w.phrase(1, 20)}</li>" for _ in range(w.rng.randint(2, 6))) + "</ul>",
                    lambda: f"<blockquote><p>{w.prose()}</p></blockquote>",
                    lambda: f'<figure><img src="x"><figcaption>{w.phrase(2, 12)}</figcaption></figure>',
                    lambda: "<table>" + "".join(f"<tr><td>{w.phrase()}</td><td>{w.rng.randint(1, 999)}</td></tr>" for _ in range(3)) + "</table>",
                    lambda: f"<pre>{w.phrase(3, 20)}</pre>",
                    lambda: f"<section>{f'<h3>{w.phrase()}</h3>'}<p>{w.prose()}</p><p>{w.prose()}</p></section>",
                ],
                [40, 6, 6, 4, 2, 8, 4, 3, 3, 2, 1, 4],
            )[0]()
        )
    if w.rng.random() < 0.35:
        blocks.insert(w.rng.randint(1, len(blocks)), w.rng.choice(_NOISE)(w))
    if w.rng.random() < 0.15:
        blocks.append(_comments(w))
    head = w.rng.choice(["", f"<h1>{w.phrase(2, 10)}</h1>", f"<h1>{w.phrase(2, 10)}</h1>", f"<header><h1>{w.phrase(2, 10)}</h1><p>{w.phrase(2, 5)}</p></header>"])
    return head + "".join(blocks)


def labelled_page(seed: int) -> str:
    """The page of that number, always the same."""
    w = _Writer(seed)
    tags = w.rng.choice(["article", "article", "main", "div", "div", "section", "td"])
    bare = w.rng.random() < 0.08
    if bare:
        body = w.rng.choice([_article, _article, lambda w: f"<div>{_article(w)}</div>", _Writer.prose])(w)
    else:
        article = w.element(tags, CONTENT_NAMES, _article(w), 1)
        if tags == "td":
            article = f"<table><tr>{article}</tr></table>"
        if w.rng.random() < 0.25:
            article = w.element("main div section", CONTENT_NAMES + ["wrapper", "container", "page"], article + w.rng.choice(["", _side(w)]))
        before = [part(w) for part in (_notice, _header, _nav, _advert) if w.rng.random() < 0.45]
        after = [part(w) for part in (_comments, _side, _form, _advert, _footer, _notice) if w.rng.random() < 0.4]
        w.rng.shuffle(before)
        body = "".join([*before, article, *after])
        if w.rng.random() < 0.3:
            body = w.element("div main", ["wrapper", "container", "page", "layout", "site"], body)
    return f'<html><head><title>{w.phrase()}</title></head><body data-label="{int(bare)}">{body}</body></html>'
