"""Block tree of a web page: block elements and, as leaves, the runs of text they hold.

The tree is as lenient as browsers are: end tags may be missing or wrong, paragraphs, list items and
cells end where the next one begins, and what scripts, styles and controls hold is no text.
"""

import re
from html.parser import HTMLParser

# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style title noscript template svg math iframe object canvas audio video "
    "button select textarea datalist".split()
)
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre figcaption caption summary legend blockquote address".split())
CONTAINERS = frozenset(
    "html body main article section nav aside header footer div form fieldset table thead tbody tfoot tr "
    "ul ol dl figure details dialog menu hgroup center search ins".split()
)
BLOCKS = TEXT_BLOCKS | CONTAINERS
#: An open element of the first kind ends where one of the second begins, unless one of the third is between.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
}
_PARAGRAPH = (frozenset(["p"]), BLOCKS - {"p"})
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page(HTMLParser):
    """Nodes of one page, parents before children: ``parent``, ``tag``, ``names``, ``text`` (None: no leaf), ``linked``.

    Node 0 is the page itself.  ``names`` are the words of an element's class, id and role, and of the
    attributes that hide it; ``linked`` counts the characters of a leaf inside links.  ``label`` is what the
    nearest ``data-label`` of a labelled page says.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.names = [-1], ["html"], [()]
        self.text, self.linked, self.label = [None], [0], [None]
        self._open: list[tuple[str, int]] = [("html", 0)]
        self._pieces: list[str] = []
        self._in_links, self._links, self._silent = 0, 0, None
        self.feed(html)
        self.close()
        self._flush()

    def _add(self, tag: str, names: tuple, text: str | None, linked: int, label: str | None) -> int:
        above = self._open[-1][1]
        self.parent.append(above)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.linked.append(linked)
        self.label.append(self.label[above] if label is None else label)
        return len(self.tag) - 1

    def _flush(self) -> None:
        if self._pieces:
            text = " ".join("".join(self._pieces).split())
            if text:
                self._add("#text", (), text, min(self._links, len(text)), None)
            self._pieces, self._links = [], 0

    def _end(self, kinds: frozenset, walls: frozenset) -> None:
        for at in range(len(self._open) - 1, 0, -1):
            tag = self._open[at][0]
            if tag in kinds:
                self._flush()
                self._close(at)
                return
            if tag in walls:
                return

    def _close(self, at: int) -> None:
        self._in_links -= sum(tag == "a" for tag, _ in self._open[at:])
        del self._open[at:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self._silent:
            return
        if tag in SILENT:
            self._silent = tag
            return
        if tag == "br":
            self._pieces.append(" ")
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        if tag not in BLOCKS and "-" not in tag:
            if tag == "a":
                self._end(frozenset("a"), BLOCKS)
                self._in_links += 1
            self._open.append((tag, self._open[-1][1]))
            return
        self._end(*_PARAGRAPH)
        if tag in ENDS:
            self._end(*ENDS[tag])
        self._flush()
        if tag in ("html", "body"):
            self.label[0] = dict(attrs).get("data-label", self.label[0])
            return
        names, label = [], None
        for key, value in attrs:
            if key in ("class", "id", "role", "itemprop", "aria-label"):
                names += [name.lower() for name in _NAMES.findall(value or "")[:12]]
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and _HIDDEN.search(value or "")):
                names.append("#hidden")
            elif key == "data-label":
                label = value
        self._open.append((tag, self._add(tag, tuple(names), None, 0, label)))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash in a start tag means nothing

    def handle_endtag(self, tag: str) -> None:
        if self._silent:
            if tag == self._silent:
                self._silent = None
            return
        if tag in ("html", "body") or tag in VOID:
            return
        block = tag in BLOCKS or "-" in tag
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at][0] == tag:
                if block:
                    self._flush()
                self._close(at)
                return
            # An end tag of a phrase does not reach beyond its block, one of a paragraph not beyond its container.
            if self._open[at][0] in BLOCKS and (not block or (tag in TEXT_BLOCKS and self._open[at][0] in CONTAINERS)):
                break
        if tag == "p":
            self._flush()  # browsers put an empty paragraph there

    def handle_data(self, data: str) -> None:
        if self._silent:
            return
        self._pieces.append(data)
        if self._in_links:
            self._links += len(data)
