"""Operator 7: main text of web pages by smoothed text-to-tag ratios.

The standard library's streaming parser gives events; block elements cut
them into lines, each with its text length, tag count and the path of elements
it stands in.  A line's ratio of text to tags is smoothed over its neighbours
with a Gaussian; lines above a threshold found by two-means clustering
are content lines.  The content region is the smallest container that holds
nearly all of their text (an article or main element if there is one); every line of the region
belongs to the result, however short.  Elements whose tag, role or class says
menu, header, footer, sidebar, notice, advert, form, script, style or comments
are left out wherever they stand.  Inside an article or main element a class or
id counts on block containers only, and from a shorter list, so that neither its
header nor words of its sentences and code go; elsewhere none counts on inline
elements of a paragraph, a heading or code.

Defined results: null or empty html, or a page without content = empty
text; broken markup closes what it must (an end tag without a start is ignored,
an article inside an open menu ends the menu); repeated rows each get a row;
only page_id, url and html are read.
"""

from __future__ import annotations

from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wikisift.llm.common import bounded_batches

SIGMA = 2.0
#: Share of the content lines' text that a container must hold.
HOLDS = 0.8

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold article text.
SKIP_TAGS = frozenset("script style noscript template head title iframe object svg canvas nav footer aside form button select textarea menu dialog".split())
#: Names in class or id that mark what is not the article.
SKIP_NAMES = frozenset(
    "ad adbox ads adsense adslot advert adverts alert alerts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer "
    "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup "
    "promo promotion recommended related replies respond search share sharing sidebar signup skyscraper social sponsor sponsored subscribe teaser toolbar topbar widget".split()
)
#: The names that count on an article element itself (it may well be "with-sidebar").
SKIP_ARTICLES = frozenset("ad ads advert advertisement comment comments promo related reply sponsored teaser".split())
#: The names that count inside an article or main element, and on what: as the
#: first or last word of a class name, or as the whole id (headings make ids too).
SKIP_INSIDE = frozenset(
    "ad adbox ads adsense adslot advert advertisement advertising adverts breadcrumb breadcrumbs comments cookie cookies disqus gdpr menu nav navbar "
    "newsletter pager pagination popup promo related respond share sharing sidebar signup skyscraper sponsored subscribe teaser".split()
)
INSIDE_BLOCKS = frozenset("div section aside ul".split())
#: First words of class names that only say what else the page has; a layout
#: also ends in "sidebar".
LAYOUT = frozenset("with without has no".split())
#: Last words of class names that begin with one of ``SKIP_NAMES`` and name a part of the page.
PARTS = frozenset("area bar block bottom box button column container content element footer form group header holder inner item items left link links list main panel right row section slot top unit widget wrap wrapper zone".split())
#: Elements whose inline parts are words of their text.
PROSE = frozenset("p pre code h1 h2 h3 h4 h5 h6".split())
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu form".split())
CONTAINERS = frozenset("html body main article section div center table tbody tr td".split())
WHOLE = frozenset(("article", "main"))
#: A start tag that ends an open element of the same kind (end tag left out).
ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Elements that such an implied end does not reach beyond.
SCOPE = frozenset("ul ol dl table div section article main body td th blockquote".split())


def _names(value: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in value).lower().split()


def _names_inside(value: str) -> bool:
    """Whether a class attribute inside an article says that it is not the article."""
    for name in value.split():
        w = _names(name)
        if w and (w[0] in SKIP_INSIDE or w[-1] in SKIP_INSIDE and w[-1] != "sidebar" and w[0] not in LAYOUT):
            return True
    return False


def _names_outside(value: str, container: bool) -> bool:
    """Whether a class or id attribute outside an article says that it is not the
    article: a name that is one of ``SKIP_NAMES``, on a container also one that ends in one
    ("site-header") or puts one before a part of a page ("search-form", not "search-engines")."""
    for name in value.split():
        w = _names(name)
        if not w or len(w) > 1 and not container:
            continue
        if len(w) == 1 and w[0] in SKIP_NAMES or len(w) > 1 and w[0] not in LAYOUT and (w[-1] in SKIP_NAMES or w[0] in SKIP_NAMES and w[-1] in PARTS):
            return True
    return False


class Lines(HTMLParser):
    """Collects (text, tags, skipped, path) of the blocks of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple[int, ...]]] = []
        self.open: list[tuple[str, int, bool, bool]] = []  # tag, node, skip, in an article
        self.tags_of: list[str] = []
        self.parts: list[str] = []
        self.tags = 0

    def _flush(self):
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                self.lines.append((text, self.tags, tuple(n for _, n, _, _ in self.open)))
                self.tags = 0

    def _named(self, tag, key, value, inside) -> bool:
        if tag == "article":
            return not SKIP_ARTICLES.isdisjoint(_names(value))
        if inside:
            return tag in INSIDE_BLOCKS and (value.strip().lower() in SKIP_INSIDE if key == "id" else _names_inside(value))
        return _names_outside(value, tag in CONTAINERS or tag in INSIDE_BLOCKS) and (tag in BLOCKS or not any(x[0] in PROSE for x in self.open))

    def _skipped(self, tag, attrs, inside) -> bool:
        if tag in SKIP_TAGS or tag == "header" and not inside:
            return True
        if tag in ("html", "body", "main"):
            return False
        for key, value in attrs:
            if key in ("class", "id") and value and self._named(tag, key, value, inside):
                return True
            if key == "role" and value and value.lower() in SKIP_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
                return True
            if key == "style" and value and "display:none" in value.replace(" ", "").lower():
                return True
        return False

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._flush()
            heads = ENDS.get(tag) or (("p",) if tag not in ("body", "html", "head") else ())
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] in heads:
                    del self.open[k:]
                    break
                if self.open[k][0] in SCOPE:
                    break
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        if tag in WHOLE and not (self.open and self.open[-1][3]) and self.open and self.open[-1][2]:
            # the article ends a menu or header that was never closed
            first = next(k for k, x in enumerate(self.open) if x[2])
            if self.open[first][0] not in ("script", "style", "template", "noscript"):
                del self.open[first:]
        inside = bool(self.open and self.open[-1][3])
        skip = bool(self.open and self.open[-1][2]) or self._skipped(tag, attrs, inside)
        if tag == "body" and self.open and self.open[-1][2]:
            self.open, skip = [], False  # a head without its end
        self.tags_of.append(tag)
        self.open.append((tag, len(self.tags_of) - 1, skip, inside or tag in WHOLE and not skip))

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._flush()
        self.tags += 1
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        if not (self.open and self.open[-1][2]):
            self.parts.append(data)

    def close(self):
        super().close()
        self._flush()


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; the kernel is normalised at the edges."""
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    spread = lambda v: np.convolve(np.pad(v, reach), kernel, "valid")
    return spread(values) / spread(np.ones_like(values))


def threshold(values: np.ndarray) -> float:
    """Border of the two clusters (two-means) of the smoothed ratios."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        border = (low + high) / 2
        up = values > border
        if up.all() or not up.any():
            break
        new = float(values[~up].mean()), float(values[up].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def main_text(html: str) -> str:
    """The article of a page: its blocks' texts, joined by line feeds."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    ratio = smooth(np.array([len(t) / (1 + tags) for t, tags, _ in lines]))
    content = ratio >= threshold(ratio)
    # text of the content lines below every element
    held: dict[int, int] = {}
    total = 0
    for (text, _, path), yes in zip(lines, content.tolist()):
        if yes:
            total += len(text)
            for node in path:
                held[node] = held.get(node, 0) + len(text)
    region, path_of = None, {n: path[: k + 1] for _, _, path in lines for k, n in enumerate(path)}
    for node in sorted(held, key=lambda n: len(path_of[n])):
        tag = parser.tags_of[node]
        if tag not in CONTAINERS or held[node] < HOLDS * total:
            continue
        region = node
        if tag in WHOLE:
            break
    if region is None:
        return "\n".join(t for t, _, _ in lines)
    whole = {n for n in path_of if parser.tags_of[n] in WHOLE}
    if parser.tags_of[region] in WHOLE or sum(len(t) for (t, _, path), yes in zip(lines, content.tolist()) if yes and not whole.isdisjoint(path)) >= HOLDS * total:
        # articles and main elements, however many: each is an article's text
        return "\n".join(t for t, _, path in lines if not whole.isdisjoint(path))
    return "\n".join(t for (t, _, path), yes in zip(lines, content.tolist()) if region in path or yes)


@F.arrow_udf(T.StringType())
def main_text_udf(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(x or "") for x in pages.to_pylist()], pa.string())


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    bounded_batches(pages.sparkSession)
    return pages.select("page_id", "url", main_text_udf(F.col("html").cast("string")).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
