"""Main text of web pages by text-to-tag ratio (operator 9).

The standard library's streaming parser turns a page into lines: one line per
block element, with its text, the number of tags seen since the line before,
and the containers around it. Elements that are never article text (menus,
forms, scripts, adverts, comments and so on, by element or by the names in
class, id and role) give no lines. A name counts if all its parts are known
('ad-box', not 'share-price'). Inside article or main an id alone drops an
element only if half its text is links or if it holds articles of its own.

Of the remaining lines the text-to-tag ratios are smoothed with a Gaussian and
split into two clusters at the threshold of least variance. The lines above it
mark the content; lines that are half links are never marked. The content region
is an article or main element that holds nearly all marked text, whole, or else
the innermost container that holds all of it. There the lines from the first to
the last marked one are kept, and those before and after up to the first line
that is half links. In between no line is dropped, however short.

Defined results
- NULL, empty or textless page: empty text.
- White space: runs of any Unicode white space inside a block become one space;
  a line-break element counts as white space.
- Broken markup: an end tag without a start is ignored, a missing end tag ends
  with its parent, a cut tag at the end of the page gives no text.
- Very long pages are parsed whole, repeated rows each on their own; an empty
  table gives no rows; other columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import fresh

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre
section summary table tbody td tfoot th thead title tr ul""".split())
CONTAINERS = frozenset("article body center div main section table td".split())   # what a region can be
WHOLE = frozenset(("article", "main"))
NEVER_TEXT = frozenset("""aside audio button canvas datalist dialog embed fieldset footer form frame frameset header
iframe input map math menu nav noembed noframes noscript object option optgroup output script select style svg template
textarea title video""".split())
EMPTY = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
# Words of class, id or role that mark what is not the article.
HINTS = frozenset("""ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment
comments complementary consent contentinfo cookie cookies disqus footer gdpr header masthead menu modal nav navbar
navigation newsletter notice notices notification pagination pager popup promo promotion related replies search share
sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget""".split())
HINTED = frozenset("a b center dd details div dl dt figure li ol p section span strong table tbody td tr ul".split())
# Further parts of a name such as 'ad-box' that say nothing of the content.
PARTS = frozenset("""area articles bar block bottom box btn button buttons col column container content outer inner
item items left link links list overlay panel post posts right row sidebar site slot stories text top unit wrap wrapper
zone""".split())
# A name that ends with one of these is of that kind, whatever stands before it (main-nav, google-ad);
# one that begins with a word for comments is about them (comment-thread, comments-section).
KINDS = frozenset("ad ads advert adverts breadcrumbs comments cookies footer nav newsletter replies sidebar".split())
COMMENTS = frozenset("comment comments disqus replies".split())
CLOSED_BY_BLOCK = frozenset(("p",))
# What a start tag ends when the end tag was left out, and what it does not look beyond.
_CELLS, _ROWS, _LISTS = ("td", "th"), ("tr", "td", "th"), ("ul", "ol", "menu", "dir")
_GROUPS = (*_ROWS, "tbody", "thead", "tfoot")
SIBLINGS = {"td": (_CELLS, ("table",)), "th": (_CELLS, ("table",)), "tr": (_ROWS, ("table",)),
            "tbody": (_GROUPS, ("table",)), "thead": (_GROUPS, ("table",)), "tfoot": (_GROUPS, ("table",)),
            "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "li": (("li",), _LISTS)}
SCOPES = frozenset(("dl", *_LISTS))
LINKED = 0.5               # of a line's or element's text, from which on it is furniture
SIGMA = 1.0
RADIUS = 2
SHARE = 0.9                # of the marked text that an article or main element holds

_WORD = re.compile(r"[a-z]+")


def hinted(value: str | None) -> bool:
    """Whether a class, id or role has a name of what is not the article."""
    for name in (value or "").lower().split():
        parts = _WORD.findall(name)
        if parts and (parts[-1] in KINDS or parts[0] in COMMENTS):
            return True
        if not HINTS.isdisjoint(parts) and all(p in HINTS or p in PARTS for p in parts):
            return True
    return False


class Lines(HTMLParser):
    """Collects (text, tags, innermost container, linked characters) of the lines of a page.

    Containers are numbered as they begin, and each knows its parent, so deep nesting costs no more than flat markup.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # tag, starts what is never text, container or -1, first line if that is in doubt or -1
        self.open: list[tuple[str, bool, int, int]] = []
        self.dropped = 0
        self.whole = 0                                  # open articles and main elements
        self.count: Counter = Counter()                 # open elements by tag
        self.inner = -1
        self.kinds: list[str] = []
        self.parent: list[int] = []
        self.pieces: list[str] = []
        self.tags = 0
        self.link = False
        self.linked = 0
        self.articles: list[int] = []                   # lines found when an article began
        self.found: list[tuple[str, int, int, int]] = []

    def flush(self):
        text = " ".join("".join(self.pieces).split())
        self.pieces = []
        if text:
            self.found.append((text, self.tags, self.inner, self.linked))
            self.tags = 0
        self.linked = 0

    def push(self, tag: str, drop: bool, doubt: bool = False):
        at = -1
        if tag in CONTAINERS and not drop:
            at = len(self.kinds)
            self.kinds.append(tag)
            self.parent.append(self.inner)
            self.inner = at
        self.count[tag] += 1
        self.whole += at >= 0 and tag in WHOLE
        self.open.append((tag, drop, at, len(self.found) if doubt else -1))
        self.dropped += drop

    def pop(self):
        tag, drop, at, since = self.open.pop()
        self.dropped -= drop
        self.count[tag] -= 1
        if at >= 0:
            self.inner = self.parent[at]
            self.whole -= tag in WHOLE
        if since >= 0:
            self.flush()
            here = self.found[since:]
            own = any(a >= since for a in self.articles)
            if own or sum(x[3] for x in here) >= LINKED * sum(len(x[0]) for x in here):
                del self.found[since:]

    def close_siblings(self, tag: str):
        closes, scope = SIBLINGS[tag]
        if not any(self.count[c] for c in closes):
            return
        to = len(self.open)
        for back in range(len(self.open) - 1, -1, -1):
            if self.open[back][0] in scope:
                break
            if self.open[back][0] in closes:
                to = back
        while len(self.open) > to:
            self.pop()

    def handle_starttag(self, tag, attrs):
        block = tag in BLOCKS
        if block:
            self.flush()
            while self.open and self.open[-1][0] in CLOSED_BY_BLOCK:
                self.pop()
            if tag in SIBLINGS:
                self.close_siblings(tag)
        elif tag == "br":
            self.pieces.append(" ")
        if not self.dropped:
            self.tags += 1
        if tag in EMPTY:
            return
        if tag == "a":
            self.link = True
        names = {name for name, value in attrs if name in ("class", "id", "role") and hinted(value)} if tag in HINTED else ()
        doubt = not self.dropped and names == {"id"} and self.whole > 0
        drop = tag in NEVER_TEXT or bool(names) and not doubt
        if drop or doubt or tag in CONTAINERS or tag in SCOPES:
            self.flush()
            if tag == "article" and not self.dropped:
                self.articles.append(len(self.found))
            self.push(tag, drop, doubt)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in EMPTY and self.open and self.open[-1][0] == tag:
            self.pop()

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        if not self.dropped:
            self.tags += 1
        if tag == "a":
            self.link = False
        if not self.count[tag]:
            return
        for back in range(len(self.open) - 1, -1, -1):
            if self.open[back][0] == tag:
                self.flush()
                while len(self.open) > back:
                    self.pop()
                break

    def handle_data(self, data):
        if not self.dropped:
            self.pieces.append(data)
            if self.link:
                self.linked += len(" ".join(data.split()))


def marked_lines(lengths: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Which lines stand out: smoothed text-to-tag ratios above the two-cluster threshold."""
    ratio = lengths / np.maximum(tags, 1)
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel, "full")[RADIUS:-RADIUS]
    smooth = np.convolve(ratio, kernel, "full")[RADIUS:-RADIUS] / weight
    order = np.sort(smooth)
    n = np.arange(1, len(order))
    low, total = np.cumsum(order)[:-1], order.sum()
    if not len(n) or order[0] == order[-1]:
        return np.ones(len(ratio), bool)
    between = n * (len(order) - n) * (low / n - (total - low) / (len(order) - n)) ** 2
    return smooth > order[int(between.argmax())]


def main_text(html: str | None) -> str:
    page = Lines()
    page.feed(html or "")
    if page.rawdata.startswith("<"):       # a tag cut off by the end of the page is no text
        page.rawdata = ""
    page.close()
    page.flush()
    lines = page.found
    if not lines:
        return ""
    lengths = np.array([len(x[0]) for x in lines])
    furniture = np.array([x[3] for x in lines]) >= LINKED * lengths
    marked = marked_lines(lengths, np.array([x[1] for x in lines]))
    if (marked & ~furniture).any():
        marked &= ~furniture
    inner = np.array([x[2] for x in lines])
    parent, kinds = page.parent, page.kinds
    weight = np.bincount(inner[marked & (inner >= 0)], lengths[marked & (inner >= 0)], minlength=len(kinds))
    for c in range(len(kinds) - 1, -1, -1):            # a parent has a lower number
        if parent[c] >= 0:
            weight[parent[c]] += weight[c]
    whole = lengths[marked].sum()

    def within(region: int) -> np.ndarray:
        """Which lines lie in the container."""
        holds = np.zeros(len(kinds) + 1, bool)         # the last: no container
        for c in range(max(region, 0), len(kinds)):
            holds[c] = c == region or parent[c] >= 0 and holds[parent[c]]
        return holds[inner]

    best = max((c for c in range(len(kinds)) if kinds[c] in WHOLE and weight[c] >= SHARE * whole), default=-1)
    if best >= 0:                          # an outer one, if there are several, holds it too
        c = best
        while (c := parent[c]) >= 0:
            best = c if kinds[c] in WHOLE else best
        return "\n".join(lines[i][0] for i in np.flatnonzero(within(best)))
    region = max((c for c in range(len(kinds)) if weight[c] == whole), default=-1)        # containers are numbered inward
    inside = np.flatnonzero(within(region)) if region >= 0 else np.arange(len(lines))
    at = np.flatnonzero(marked[inside])
    # all unlinked text in the containers of marked lines, and what is next to it
    free = ~furniture[inside]
    own = np.isin(inner[inside], inner[inside][at])
    reached = np.append(at, np.flatnonzero(free & own))
    first, last = int(reached.min()), int(reached.max())
    while first > 0 and free[first - 1]:
        first -= 1
    while last < len(inside) - 1 and free[last + 1]:
        last += 1
    return "\n".join(lines[i][0] for i in inside[first:last + 1])


def extract(pages: DataFrame, *, html_col="html") -> tuple[DataFrame, str]:
    """`pages` with the main text, and the name of that column."""
    @F.pandas_udf("string")
    def text_of(htmls: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in htmls], dtype=object)

    name = fresh(pages, "main_text")
    return pages.withColumn(name, text_of(F.coalesce(pages[html_col], F.lit("")))), name


def page_texts(pages: DataFrame, *, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    narrow = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    found, name = extract(narrow)
    return found.select("page_id", "url", F.col(name).alias("text"), F.length(name).cast("long").alias("n_chars"))
