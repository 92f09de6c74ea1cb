"""Main text of web pages by text-to-tag ratios.

A page goes once through the standard library's event parser. The events give *lines*, one per block of
running text (pages need not hold line feeds), each with its characters, its tags and the element it lies
in. Elements that say what they are (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, comments of readers) take their lines out. Then

1. each line has a ratio of characters to tags;
2. the ratios are smoothed by a Gaussian over neighbouring lines;
3. lines whose smoothed ratio reaches one standard deviation of all of them, or the mean where that is
   less, form clusters;
4. the smallest element that holds nearly all characters of the clusters (an article where there is one) is
   the content region, and all its lines are the text, short ones too, but for lists made of links only.

The task holds one page at a time beside its Arrow batch; the work of a page grows with its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines on each side that smoothing takes in, and its standard deviation.
RADIUS, SIGMA = 2, 1.0
#: Elements nested deeper than this stand beside each other, as in browsers, so that the work of a page stays linear.
DEPTH = 512
#: Share of the clusters' characters that the content region must hold.
SHARE = 0.8

_words = lambda text: frozenset(text.split())
_VOID = _words("area base br col embed hr img input link meta param source track wbr")
#: Elements that do not break a line of text.
_INLINE = _words(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output picture progress q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mo mn mrow msup msub"
)
#: Elements without running text, and parts of a page that are not its article.
_NO_TEXT = _words(
    "script style noscript template head title iframe object embed svg canvas audio video map select option optgroup "
    "datalist textarea button input form fieldset dialog nav footer aside menu"
)
#: What classes, ids and roles call such parts.
_HINTS = _words(
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar sidebar sidebars aside complementary "
    "header masthead topbar footer banner contentinfo ad ads adv advert adverts advertisement advertisements advertising "
    "sponsor sponsors sponsored promo promotion promoted cookie cookies consent gdpr notice notices notification disclaimer "
    "newsletter subscribe subscription signup login register search form popup popover modal overlay share sharing social "
    "related recommended recommendations teaser teasers comment comments disqus respond replies reply feedback widget widgets"
)
#: What they call the part that holds the article; such an element is not taken for another part.
_CONTENT = _words("content contents main article articles post posts entry story body page wrapper wrap container layout has with no text")
_LAYOUT = _words("html body main h1 h2 h3 h4 h5 h6")
_ARTICLE = _words("article main")
_HEADINGS = _words("h1 h2 h3 h4 h5 h6")
#: Elements that may be a content region.
_REGIONS = _words("html body div section article main center td table tbody tr blockquote form fieldset")
#: A start tag in the key's group ends an open element of the value's group, up to one of the third.
_ENDS = {
    **{tag: (_words("p"), _words("table td th caption button object")) for tag in _words(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
        "header hgroup hr main menu nav ol p pre section table ul")},
    "li": (_words("li"), _words("ul ol menu dir table")),
    **{tag: (_words("dt dd"), _words("dl table")) for tag in ("dt", "dd")},
    "tr": (_words("tr td th"), _words("table")),
    **{tag: (_words("td th"), _words("tr table")) for tag in ("td", "th")},
    **{tag: (_words("tr td th tbody thead tfoot"), _words("table")) for tag in ("tbody", "thead", "tfoot")},
    **{tag: (_words("option"), _words("select datalist")) for tag in ("option", "optgroup")},
}
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_CUT_TAG = re.compile(r"<[a-zA-Z/!?]")


class _Element:
    """An open element. ``drop``: its lines are not of the article; ``sure``: by its tag, not by its name."""

    __slots__ = ("tag", "parent", "depth", "drop", "sure", "mass", "own", "heads", "text", "linked", "items")

    def __init__(self, tag: str, parent: _Element | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.drop = self.sure = False
        self.mass = self.own = 0  # characters of clusters below it, and of those in no smaller region
        self.heads = 0  # headings below it
        self.text = self.linked = self.items = 0  # characters of a list, those in links, its lines

    def above(self) -> Iterator[_Element]:
        at = self
        while at is not None:
            yield at
            at = at.parent

    def dropped(self) -> bool:
        return any(e.drop for e in self.above())


def _named(attrs: dict[str, str | None]) -> frozenset[str]:
    names = " ".join(v for k in ("class", "id", "role") if (v := attrs.get(k)))
    return frozenset(_SPLIT.split(_CAMEL.sub(" ", names).lower())) if names else frozenset()


def _hidden(attrs: dict[str, str | None]) -> bool:
    style = re.sub(r"\s", "", (attrs.get("style") or "").lower())
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style


class _Lines(HTMLParser):
    """Lines of a page: ``texts``, ``owners`` (elements), ``tags`` (of the line and just before it), ``links`` (characters)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open = _Element("#page", None)
        self.texts: list[str] = []
        self.owners: list[_Element] = []
        self.tags: list[int] = []
        self.links: list[int] = []
        self.parts: list[str] = []
        self.n_tags = self.linked = self.in_link = 0

    def page(self, html: str) -> None:
        self.feed(html)
        # A tag that the end of the page cuts is no text.
        if not _CUT_TAG.match(self.rawdata):
            self.close()
        self.line()

    def line(self) -> None:
        """End the line of text that is being gathered."""
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                self.texts.append(text)
                self.owners.append(self.open)
                self.tags.append(self.n_tags)
                self.links.append(min(self.linked, len(text)))
                self.n_tags = 0
            self.linked = 0

    def up_to(self, element: _Element) -> None:
        """Close ``element`` and all that is open below it."""
        for e in self.open.above():
            if e.tag == "a":
                self.in_link = max(0, self.in_link - 1)
            if e is element:
                break
        self.open = element.parent

    def handle_starttag(self, tag: str, pairs: list[tuple[str, str | None]]) -> None:
        if tag not in _INLINE and tag != "br":
            self.line()
        self.n_tags += 1
        if tag in _VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        if tag in _ENDS:
            ended, scope = _ENDS[tag]
            while found := self.within(ended, scope):
                self.up_to(found)
        attrs = dict(pairs)
        if tag in _ARTICLE:
            self.begin_article()
        if self.open.depth >= DEPTH:
            self.up_to(self.open)
        new = _Element(tag, self.open)
        self.open = new
        if tag == "a":
            self.in_link += 1
        if tag in _NO_TEXT or _hidden(attrs):
            new.drop = new.sure = True
        elif tag == "header":
            # The header of an article is part of it.
            new.drop = not any(e.tag == "article" for e in new.above())
        elif tag not in _LAYOUT and (names := _named(attrs)) and names & _HINTS:
            whole = {name.lower() for name in (attrs.get("class") or "").split()}
            new.drop = bool(whole & _HINTS) if tag == "article" else not names & _CONTENT or bool(whole & _HINTS)

    def handle_startendtag(self, tag: str, pairs: list[tuple[str, str | None]]) -> None:
        # A slash closes nothing in HTML.
        self.handle_starttag(tag, pairs)

    def begin_article(self) -> None:
        """What holds an article is neither a form nor a part that its name suggests; menus do not hold any."""
        for e in self.open.above():
            if e.tag in ("nav", "menu", "head", "title"):
                self.up_to(e)
            elif e.tag in ("form", "fieldset") or not e.sure and not (e.tag == "header"):
                e.drop = False

    def within(self, tags: frozenset[str], scope: frozenset[str]) -> _Element | None:
        """The innermost open element of ``tags``, unless one of ``scope`` lies between."""
        for e in self.open.above():
            if e.tag in tags:
                return e
            if e.tag in scope:
                return None
        return None

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.parts.append(" ")
        if tag in _VOID:
            return
        if tag not in _INLINE:
            self.line()
        self.n_tags += 1
        for e in self.open.above():
            if e.tag == tag:
                self.up_to(e)
                return
            # An inline end tag belongs to the block it stands in.
            if tag in _INLINE and e.tag not in _INLINE:
                return

    def handle_data(self, data: str) -> None:
        if self.open.tag in ("script", "style"):
            return
        self.parts.append(data)
        if self.in_link:
            self.linked += len(data.strip())

    def unknown_decl(self, data: str) -> None:
        """CDATA sections are no text in HTML."""


def ratios(chars: list[int], tags: list[int]) -> np.ndarray:
    """Characters per tag of each line, smoothed over its neighbours; lines outside the page do not count."""
    raw = np.array(chars, dtype=float) / np.maximum(tags, 1)
    weights = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    total = np.convolve(raw, weights)[RADIUS : RADIUS + len(raw)]
    held = np.convolve(np.ones(len(raw)), weights)[RADIUS : RADIUS + len(raw)]
    return total / held


def clusters(smoothed: np.ndarray) -> np.ndarray:
    """Which lines lie in a cluster of high ratios."""
    return smoothed >= min(smoothed.std(), smoothed.mean()) if len(smoothed) else np.zeros(0, bool)


def _link_lists(owners: list[_Element], texts: list[str], links: list[int]) -> set[_Element]:
    """Lists of two or more lines all of which are links."""
    lists = []
    for owner, text, linked in zip(owners, texts, links, strict=True):
        for e in owner.above():
            if e.tag in ("ul", "ol", "dl"):
                e.items += 1
                e.text += len(text)
                e.linked += linked
                lists.append(e)
    # White space between links of a line belongs to none.
    return {e for e in lists if e.items > 1 and e.linked >= 0.9 * e.text}


def _region(owners: list[_Element], chars: list[int], high: list[bool]) -> _Element:
    """The element that holds the clusters and the headings above them."""
    below: dict[_Element, dict[_Element, None]] = {}
    total = 0
    for owner, n, inside in zip(owners, chars, high, strict=True):
        mass = n if inside else 0
        total += mass
        head = any(e.tag in ("h1", "h2") for e in owner.above())
        under = None
        for e in owner.above():
            if e.tag in _REGIONS or e.parent is None:
                e.mass += mass
                if under is None:
                    e.own += mass
                e.heads += head
                if under is not None:
                    below.setdefault(e, {})[under] = None
                under = e
    at = next(e for e in owners[0].above() if e.parent is None)
    # Text of the clusters that lies in an element itself, and not in a smaller one, keeps all of the element.
    while at.tag != "article" and not at.own:
        inner = [e for e in below.get(at, ()) if e.mass >= SHARE * total]
        # A heading beside the inner element belongs to the text; the page's own headings do not hold an article back.
        if not inner or (inner[0].heads < at.heads and inner[0].tag not in _ARTICLE and at.tag not in ("#page", "html")):
            break
        at = inner[0]
    return at


def extract(html: str) -> str:
    """The main text of one page; empty where there is none."""
    page = _Lines()
    page.page(html)
    taken = [k for k, owner in enumerate(page.owners) if not owner.dropped()]
    if not taken:
        return ""
    chars = [len(t) for t in page.texts]
    # Clusters come from the ratios of all lines, as the page has them.
    high = clusters(ratios(chars, page.tags))
    pick = lambda values: [values[k] for k in taken]
    owners, texts = pick(page.owners), pick(page.texts)
    inside = pick(high.tolist())
    if not any(inside):
        inside = [True] * len(taken)
    region = _region(owners, pick(chars), inside)
    menus = _link_lists(owners, texts, pick(page.links))
    out = []
    for owner, text in zip(owners, texts, strict=True):
        above = list(owner.above())
        if region in above and not menus.intersection(above):
            out.append(text)
    return " ".join(out)


def main_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``, the main text of each row's ``html``, and ``n_chars``, its code points.

    Columns of these names in ``pages`` are replaced, all others stay. Null and empty pages, and pages
    without an article, have an empty text. Each row stands for itself, so repeated rows get equal results;
    there is no shuffle. Pages are read whole whatever their length. Broken markup is read as browsers do
    for missing end tags; what follows a tag or comment that never ends is no text.
    """
    kept = [c for c in pages.columns if c.lower() not in (out.lower(), "n_chars")]
    hidden = "__html"
    schema = pages.select(*kept, F.lit("").alias(out), F.lit(0).cast("bigint").alias("n_chars")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            found = [extract(value.as_py() or "") for value in column]
            columns = [*batch.columns[:-1], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], out, "n_chars"])

    return pages.select(*kept, F.col(html).cast("string").alias(hidden)).mapInArrow(run, schema)
