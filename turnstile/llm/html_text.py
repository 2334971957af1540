"""HTML extraction: composite text density (Sun, Song and Liao, 2011).

A page is parsed to a tree (browsers' rules for void elements and implied end tags).  What is never text goes first: elements by
kind (scripts, styles, forms, ...) and hidden ones.  For every node that stays, with C characters, T tags, LC characters
and LT tags of links in its subtree (0 counts as 1 in a divisor, b: the body):

    density = C/T * log(C/LC * T/LT) / log(ln(C/(C-LC) * LC + LCb/Cb * C + e))

(on a page without links the divisor is 1).  A node's density sum adds up its children's.  The
node with the largest sum is the article's core; the least density on its path up to the body is the
threshold.  From the body down, every node of at least that density has the largest-sum node
of its subtree marked.  A mark within an ``article`` or ``main`` extends to all of it.

Density can't tell an article from other dense prose (reader comments, a notice, a long footer), so what it marked is then rid of page
furniture, known by kind (navigation, footers, asides), by role, and by class or id words (adverts, sidebars, notices, comments, ...)
unless it holds the article itself.  The text left in the marked subtrees, in page order, is the result.

Text: character references are decoded, white space within a block becomes one space, blocks are
joined by one space.  Null or empty html, or none left: empty text.  Equal rows are all kept; a column named text is replaced, others are
kept as asked.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from turnstile.llm.rows import map_texts

# Kinds of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td tfoot th thead tr ul video audio iframe textarea title".split())
#: Starting one of these ends an open paragraph.
ENDS_P = BLOCK - {"br", "body", "html", "option", "optgroup", "select", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "title"}
#: Starting the key ends an open element of the values, up to the nearest element of the last entry.
ENDS = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
        "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr")),
        "tbody": (("tr", "td", "th", "thead", "tbody"), ("table",)), "tfoot": (("tr", "td", "th", "thead", "tbody"), ("table",)),
        "option": (("option",), ("select", "datalist"))}
DROPPED = frozenset(
    "script style noscript template head title nav footer aside form button select option textarea input label fieldset iframe object embed "
    "svg canvas video audio map menu dialog search datalist".split())
#: Of these, page furniture: its text counts in the densities.
FURNITURE = frozenset("nav footer aside menu search".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|newsletter|subscri\w*|signup|"
    r"login|sidebar|side|widgets?|menu|nav|navbar|navigation|breadcrumbs?|masthead|footer|foot|comments?|commentlist|respond|replies|reply|disqus|"
    r"share|sharing|social|related|recommend\w*|popup|modal|overlay|toolbar|pagination|pager|skip)(?:$|[\s_-])", re.I)
IN_HEAD = frozenset("base link meta noscript script style template title head".split())
#: Dropped by a hint or kind only outside of the article: an article has a header of its own.
HEADER = re.compile(r"(?:^|[\s_-])(?:header|head|topbar)(?:$|[\s_-])", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

FIELDS = [T.StructField("text", T.StringType())]


class Tree(HTMLParser):
    """Nodes by number: tag, parent, hint; the page's text with the node it stands in, -1 between blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.hint = [""], [-1], [0]
        self.open = [0]
        self.n_open: Counter[str] = Counter()  # of open elements by tag: most look-ups end here
        self.texts: list[tuple[int, str]] = []
        self.seen: set[str] = set()

    def _close_to(self, depth: int) -> None:
        for i in self.open[depth:]:
            self.n_open[self.tag[i]] -= 1
        del self.open[depth:]

    def _close_open(self, tags, until) -> None:
        """Ends the outermost open element of ``tags`` above the nearest of ``until``."""
        if not any(self.n_open[t] for t in tags):
            return
        found = 0
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[depth]]
            if tag in tags:
                found = depth
            elif tag in until:
                break
        if found:
            self._close_to(found)

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_P:
            self._close_open(("p",), ("td", "th", "table", "button", "article", "div", "section", "body", "li", "blockquote"))
        if tag in ENDS:
            self._close_open(*ENDS[tag])
        if tag in ("body", "html"):
            if tag in self.seen:
                return
            self.seen.add(tag)
        if tag not in IN_HEAD and self.n_open["head"]:
            for depth, i in enumerate(self.open):
                if self.tag[i] == "head":
                    self._close_to(depth)
                    break
        if tag in BLOCK:
            self.texts.append((-1, " "))
        at = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.hint.append(self._hint(tag, attrs))
        if tag not in VOID:
            self.open.append(at)
            self.n_open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "path", "use") and self.open[-1] == len(self.tag) - 1:
            self._close_to(len(self.open) - 1)

    @staticmethod
    def _hint(tag: str, attrs) -> int:
        """2: can't be the article; 1: looks like page furniture; 3: a header."""
        if tag in DROPPED:
            return 2
        names = ""
        for key, value in attrs:
            value = value or ""
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and HIDDEN.search(value):
                return 2
            if key == "role" and value.lower() in ROLES:
                return 1
            if key in ("class", "id"):
                names += " " + value
        if names and HINT.search(names):
            return 1
        return 3 if tag == "header" or names and HEADER.search(names) else 0

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.texts.append((-1, " "))
        if not self.n_open[tag]:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[depth]] == tag:
                self._close_to(depth)
                return
            if self.tag[self.open[depth]] in ("table", "article", "body") and tag in ("b", "i", "em", "strong", "span", "a", "p"):
                return

    def handle_data(self, data):
        self.texts.append((self.open[-1], data))


def _density(c: int, t: int, lc: int, lt: int, share: float) -> float:
    if not c:
        return 0.0
    ratio = c / max(lc, 1) * max(t, 1) / max(lt, 1)
    base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
    return c / max(t, 1) * math.log(max(ratio, 1.0)) / (math.log(base) if base > 1 + 1e-12 else 1.0)


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    tree.close()
    return _select(tree, by_hint=True) or _select(tree, by_hint=False)


def _never(tree: Tree) -> list[bool]:
    """What is no text of the page: elements by kind, hidden ones, and all below them."""
    out = [False] * len(tree.tag)
    for i in range(1, len(out)):
        out[i] = out[tree.parent[i]] or tree.hint[i] == 2 and tree.tag[i] not in FURNITURE
    return out


def _furniture(tree: Tree, by_hint: bool) -> list[bool]:
    """What is not the article's, with all below it."""
    tag, parent, n = tree.tag, tree.parent, len(tree.tag)
    article = [tag[i] in ("article", "main") and tree.hint[i] == 0 for i in range(n)]
    # an element with the article in it, or with a headline and a paragraph, is no furniture
    holds, head, para = [False] * n, [x == "h1" for x in tag], [x == "p" for x in tag]
    within = [False] * n
    for i in range(n - 1, 0, -1):
        up = parent[i]
        holds[up] |= holds[i] or article[i]
        head[up] |= head[i]
        para[up] |= para[i]
    gone = [False] * n
    for i in range(1, n):
        within[i] = within[parent[i]] or article[i]
        spared = tag[i] in ("html", "body") or holds[i] or head[i] and para[i] and tag[i] != "h1"
        hint = tree.hint[i] if by_hint or tree.hint[i] == 2 else 0
        gone[i] = gone[parent[i]] or hint == 2 or not spared and (hint == 1 or hint == 3 and not within[i])
    return gone


def densities(tree: Tree, gone: list[bool]) -> tuple[list[int], list[float], list[float]]:
    """Characters, composite density and density sum of every node."""
    tag, parent, n = tree.tag, tree.parent, len(tree.tag)
    own = [0] * n
    for at, data in tree.texts:
        if at >= 0:
            own[at] += len(" ".join(data.split()))
    inside = [False] * n  # in a link
    c, t, lc, lt = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(1, n):
        inside[i] = inside[parent[i]] or tag[i] == "a"
    for i in range(n - 1, -1, -1):
        if gone[i]:
            continue
        c[i] += own[i]
        lc[i] += own[i] if inside[i] else 0
        if i:
            up = parent[i]
            c[up] += c[i]
            lc[up] += lc[i]
            t[up] += t[i] + 1
            lt[up] += lt[i] + (tag[i] == "a")
    share = lc[0] / c[0] if c[0] else 0.0
    density = [0.0 if gone[i] else _density(c[i], t[i], lc[i], lt[i], share) for i in range(n)]
    sums = [0.0] * n
    for i in range(n - 1, 0, -1):
        sums[parent[i]] += density[i]
    return c, density, sums


def _marks(tree: Tree, gone: list[bool]) -> list[bool]:
    """The subtrees of largest density sums over the body path's threshold."""
    tag, parent, n = tree.tag, tree.parent, len(tree.tag)
    c, density, sums = densities(tree, gone)
    best = list(range(n))
    for i in range(n - 1, 0, -1):  # the first of the largest sum in each subtree
        up = parent[i]
        if sums[best[i]] > sums[best[up]] or sums[best[i]] == sums[best[up]] and best[up] != up and best[i] < best[up]:
            best[up] = best[i]
    least, i = math.inf, best[0]
    while i > 0:
        if tag[i] != "html":
            least = min(least, density[i])
        i = parent[i]
    least = 0.0 if least is math.inf else least
    article = [0] * n  # the outermost article or main around each node, itself included
    for i in range(1, n):
        article[i] = article[parent[i]] or (i if tag[i] in ("article", "main") else 0)
    marked = [False] * n
    reached = [True] + [False] * (n - 1)
    for i in range(n):
        if i:
            reached[i] = reached[parent[i]] and not gone[i] and (density[i] >= least or tag[i] in ("html", "body"))
        if reached[i] and (density[i] >= least or i == 0) and c[best[i]]:
            marked[article[best[i]] or best[i]] = True
    for i in range(1, n):
        marked[i] = (marked[i] or marked[parent[i]]) and not gone[i]
    return marked


def _select(tree: Tree, by_hint: bool) -> str:
    marked, gone = _marks(tree, _never(tree)), _furniture(tree, by_hint)
    return " ".join("".join(data for at, data in tree.texts if at < 0 or marked[at] and not gone[at]).split())


def _extract(texts: pa.Array) -> list:
    return [pa.array([main_text(x) for x in texts.to_pylist()], pa.string())]


def extract_text(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns but the html by default) plus text.  A column named text is replaced."""
    keep = [c for c in pages.columns if c != html_col] if keep is None else keep
    return map_texts(pages, FIELDS, _extract, keep=keep, text_col=html_col)
