"""Main text of web pages: flat text blocks, classified by a decision tree.

A page becomes a flat sequence of text blocks, cut at block elements; of the markup only two things are kept for
each block: its nearest telling container (article or main against menu, footer, comments, advert and the like) and
whether it is a heading, a paragraph or part of a list. The tree sees word count, link density, those two of the
blocks before and after, and these two. It is trained on the small labelled table below.

A container that a name, a form or a page's header tells to be boilerplate counts as such at any length, but only
if most of the page is outside of it: one that holds half of the words in articles (of all words, if there is no
article) is taken for a wrapper, and so is a container of comments that holds nearly all of them.

Cases: null or empty html has an empty text. Scripts, styles, comments, the head, forms' controls and
markup never reach a block. Unclosed and stray tags are tolerated, and a page may be cut off anywhere: the head
ends at the first thing that cannot stand in one, and what is not shown (`SILENT`) but never closed ends with its
parent or at the next block element; only a script, style or template without an end goes on. A
tag that is cut off is markup. White space in a block is what `str.split` takes for it. Every row has a
result, repeated rows too. Columns of the input whose names the result uses are replaced. An empty table
gives an empty table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML's element names by their role here.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
SILENT = frozenset("script style noscript template svg math textarea select option button iframe object canvas audio video head title map".split())
IN_HEAD = frozenset("html head title meta link base style script noscript template object".split())
BLOCK = frozenset(
    "address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td th tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILER = frozenset("nav aside footer dialog menu".split())
CONTENT = frozenset("article main".split())
# Whole names in a class, id or role that tell a container.
BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "sidebar sidenav aside widget widgets nav navbar navigation menu breadcrumb breadcrumbs footer masthead toolbar pagination pager "
    "comment comments commentlist respond reply replies discussion disqus related recommended recommendations share sharing social newsletter subscribe subscription signup login search "
    "contentinfo complementary tags tagcloud copyright legal disclaimer skip "
    "ad-banner ad-container ad-slot ad-unit ad-wrapper cookie-banner cookie-bar cookie-consent cookie-notice site-footer page-footer main-footer site-nav main-nav top-nav nav-bar nav-menu main-menu side-bar "
    "comment-list comments-area comment-section post-comments related-posts related-articles related-content share-buttons share-bar social-links social-share newsletter-signup skip-link tag-list "
    "sidebar-widget widget-area breadcrumb-nav search-form login-form site-search".split()
)
COMMENT_NAMES = frozenset(
    "comment comments commentlist comment-list comments-area comment-section post-comments respond reply replies discussion disqus".split()
)
CONTENT_NAMES = frozenset(
    "article articlebody post entry story maincontent postcontent content main body text article-body article-content article-text post-content post-body entry-content main-content page-content story-body content-body".split()
)

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(?:[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*?)(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z))""", re.S)
LINK = re.compile(r"<(/?)a(?=[\s/>])", re.I)
HINT = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PLAIN_RAW = frozenset("textarea title iframe noscript".split())  # without an end tag before the next of their kind these end at the next tag
MAYBE_OPEN = re.compile(rf"<(?:{'|'.join(sorted(SILENT - {'head', 'template', 'script', 'style'} - PLAIN_RAW))})\b", re.I)
RAW_END = {name: re.compile(rf"</{name}\s*>" + (rf"|<({name})[\s/>]" if name in PLAIN_RAW else ""), re.I) for name in ("script", "style", *sorted(PLAIN_RAW))}


HALF, NEARLY_ALL = 0.5, 0.95  # of the words: so much makes a named container, or one of comments, a wrapper
MAIN, ARTICLE, PLAIN, NAMED, COMMENTS, HEADER, ELEMENT = "main", "article", "", "named", "comments", "header", "element"
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_LISTS = frozenset("li ul ol dl dt dd td th tr table".split())


@dataclass
class Block:
    text: str
    words: int
    links: int  # words inside links
    node: int  # the nearest telling container, -1 for none
    kind: int  # 2 a heading, 1 a paragraph, 0 in a list or table
    place: int = 0  # -2 in a boilerplate element, -1 in another container of boilerplate, 1 in an article, 0 elsewhere


def _tells(name: str, attributes: str) -> str:
    """What an element tells about the text in it."""
    if name == "main":
        return MAIN
    if name in BOILER:
        return ELEMENT
    if name in ("body", "html"):
        return PLAIN
    names = {w.replace("_", "-") for m in HINT.finditer(attributes) for w in (m[1] or m[2] or m[3] or "").lower().split()} if attributes else set()
    if names & BOILER_NAMES:
        return COMMENTS if names & COMMENT_NAMES else NAMED
    if name in CONTENT:
        return ARTICLE
    if name in ("form", "fieldset"):
        return NAMED
    if name == "header":
        return HEADER
    return ARTICLE if names & CONTENT_NAMES and name in ("section", "div", "ul", "ol", "table") else PLAIN


def _set_places(found: list[Block], nodes: list[tuple[int, str]]) -> None:
    """Settles which containers are boilerplate, from the top down; `nodes` are (parent, what it tells)."""
    words, in_articles, page, articles = [0] * len(nodes), [0] * len(nodes), 0, 0
    for block in found:
        chain, k = [], block.node
        while k >= 0:
            chain.append(k)
            k = nodes[k][0]
        kinds = {nodes[k][1] for k in chain}
        in_article = block.words if kinds & {ARTICLE, MAIN} and ELEMENT not in kinds else 0
        page, articles = page + block.words, articles + in_article
        for k in chain:
            words[k] += block.words
            in_articles[k] += in_article
    places: list[int] = []
    for k, (parent, tells) in enumerate(nodes):
        around = places[parent] if parent >= 0 else 0
        share = in_articles[k] / articles if articles else words[k] / max(page, 1)
        if tells == MAIN:  # cannot stand in a boilerplate element, so that one has no end tag
            places.append(1)
        elif tells == ELEMENT or around == -2:
            places.append(-2)
        elif tells == ARTICLE:
            places.append(1 if around >= 0 else around)
        elif tells == HEADER and around == 1:  # the heading of an article
            places.append(1)
        else:
            places.append(around if share >= (NEARLY_ALL if tells == COMMENTS else HALF) else -1)
    for block in found:
        block.place = places[block.node] if block.node >= 0 else 0


def _raw_end(name: str, page: str, at: int) -> int:
    """Where an element of plain characters ends whose start tag ends at `at`."""
    stop = RAW_END[name].search(page, at)
    if stop and not (name in PLAIN_RAW and stop[1]):  # one of its kind begins first
        return stop.end()
    after = page.find("<", at) if name in PLAIN_RAW else -1
    return len(page) if after < 0 else after


def _never_closed(page: str) -> set[int]:
    """Where the silent elements begin that have no end tag."""
    opened: dict[str, list[int]] = {}
    at = 0
    while found := TOKEN.search(page, at):
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if name not in SILENT:
            continue
        if found[1] or found[4]:
            if opened.get(name):
                opened[name].pop()
        elif name in RAW_END:
            at = _raw_end(name, page, at)
        elif not found[0].endswith("/>") and name != "template":
            opened.setdefault(name, []).append(found.start())
    return {k for starts in opened.values() for k in starts}


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    nodes: list[tuple[int, str]] = []  # containers that tell something
    stack: list[tuple[str, int, bool, bool]] = []  # open elements with their container, whether they are silent, and whether they have no end tag
    unclosed = _never_closed(page) if MAYBE_OPEN.search(page) else ()
    text, link_text, links = [], [], 0  # links: 1 in a link, 2 in one without an end tag, which the block ends
    node, silent, at, end = -1, False, 0, len(page)

    def kind() -> int:
        for name, *_rest in reversed(stack):
            if name in IN_LISTS:
                return 0
            if name in CONTENT:
                break
        return 2 if stack and stack[-1][0] in HEADINGS else 1

    def close_block() -> None:
        words = "".join(text).split()
        if words:
            out.append(Block(" ".join(words), len(words), min(len("".join(link_text).split()), len(words)), node, kind()))
        text.clear()
        link_text.clear()

    def cut_at(k: int) -> None:
        nonlocal node, silent
        del stack[k:]
        node, silent = (stack[-1][1], stack[-1][2]) if stack else (-1, False)

    def take(part: str) -> None:
        if silent and stack[-1][0] == "head" and part.strip():
            cut_at(-1)
        if part and not silent:
            part = html.unescape(part)
            text.append(part)
            if links:
                link_text.append(part + " ")

    while at < end:
        found = TOKEN.search(page, at)
        if not found:
            take(page[at:])
            break
        take(page[at : found.start()])
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        closing = bool(found[1] or found[4])
        if silent and not closing:
            if stack[-1][0] == "head" and name not in IN_HEAD:
                cut_at(-1)
            while name in BLOCK and silent:
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in SILENT), -1)
                if not stack[k][3]:
                    break
                cut_at(k)
        if name in INLINE:
            if name == "a":
                after = None if closing else LINK.search(page, at)
                links = 0 if closing else 1 if after and after[1] else 2
            elif name in ("br", "wbr", "img") and not silent:
                text.append(" " if name == "br" else "")
            elif name == "span" and not silent:
                pass
            continue
        close_block()
        links = 0 if links == 2 else links
        if closing:
            names = [e[0] for e in stack]
            if name in names:
                cut_at(len(names) - 1 - names[::-1].index(name))
            if name in BOILER or name in CONTENT:
                links = 0
            continue
        if name in RAW_END:
            at = _raw_end(name, page, at)
            continue
        if name in VOID or found[0].endswith("/>"):
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
            cut_at(-1)  # these end where the next one begins
        tells = _tells(name, found[3] or "")
        if tells:
            nodes.append((node, tells))
            node = len(nodes) - 1
        silent = silent or name in SILENT
        stack.append((name, node, silent, found.start() in unclosed))
    close_block()
    _set_places(out, nodes)
    return out


FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "place", "kind")


def features(found: list[Block]) -> np.ndarray:
    """A row for each block; beyond the page's ends there are no words."""
    rows = np.zeros((len(found), len(FEATURES)))
    words = np.array([b.words for b in found], float)
    density = np.array([b.links / b.words for b in found], float)
    rows[:, 0], rows[:, 1] = words, density
    rows[1:, 2], rows[1:, 3] = words[:-1], density[:-1]
    rows[:-1, 4], rows[:-1, 5] = words[1:], density[1:]
    rows[:, 6], rows[:, 7] = [b.place for b in found], [b.kind for b in found]
    return rows


# Labelled blocks, hand-made: the features but for the kind, then 1 for main text and 0 for the rest.
SEEN = np.array(
    [
        # menus, footers, adverts, notices and comments in containers with names that say so
        [1, 1.0, 0, 0, 1, 1, -1, 0], [2, 1.0, 1, 1, 3, 1, -1, 0], [1, 1.0, 2, 1, 9, 0, -1, 0],
        [9, 0, 1, 1, 14, 0, -1, 0], [30, 0, 2, 1, 12, 0, -1, 0], [14, 0.1, 80, 0, 0, 0, -1, 0],
        [60, 0, 40, 0, 25, 0, -1, 0], [120, 0, 90, 0, 60, 0, -1, 0], [4, 0, 150, 0, 20, 0, -1, 0],
        [200, 0, 3, 0, 100, 0, -1, 0], [8, 0.5, 60, 0, 0, 0, -1, 0], [3, 0, 0, 0, 2, 0, -1, 0],
        [60, 0, 2, 1, 70, 0, -1, 0], [12, 0, 1, 1, 90, 0, -1, 0], [35, 0, 30, 0, 200, 0, -1, 0],
        [80, 0, 70, 0, 60, 0, -1, 0], [15, 0, 60, 0, 45, 0, -1, 0], [50, 0, 50, 0, 3, 0, -1, 0],
        [3, 0, 20, 0, 55, 0, -1, 0], [20, 1.0, 4, 1, 110, 0, -1, 0], [90, 0.1, 6, 0, 33, 0, -1, 0],
        [25, 0, 4, 0, 30, 0, -1, 0], [45, 0.05, 2, 0, 50, 0, -1, 0], [1, 0, 0, 0, 0, 0, -1, 0],
        # in elements that are boilerplate by themselves
        [60, 0, 40, 0, 25, 0, -2, 0], [120, 0, 90, 0, 60, 0, -2, 0], [200, 0, 3, 0, 100, 0, -2, 0], [45, 0.05, 2, 0, 50, 0, -2, 0],
        [35, 0, 0, 0, 0, 0, -2, 0], [80, 0, 70, 0, 60, 0, -2, 0], [400, 0, 120, 0, 0, 0, -2, 0], [50, 0.2, 50, 0, 3, 0, -2, 0],
        [3, 0, 120, 0, 4, 0, -2, 0], [1, 1.0, 0, 0, 1, 1, -2, 0], [12, 0, 60, 0, 0, 0, -2, 0], [25, 0, 30, 0, 30, 0, -2, 0],
        [10, 0.3, 5, 0.5, 20, 0, -1, 0], [12, 0.4, 40, 0, 30, 0, -2, 0], [6, 0.5, 1, 1, 14, 0, -1, 0], [15, 0.25, 30, 0, 40, 0, -1, 0], [20, 0.3, 60, 0, 50, 0, -2, 0], [25, 0.2, 40, 0, 30, 0, -1, 0],
        # lists of links in articles
        [4, 1.0, 5, 1, 6, 1, 1, 0], [12, 0.9, 10, 0.9, 11, 1, 1, 0], [6, 1.0, 60, 0, 7, 1, 1, 0], [8, 0.9, 9, 0.8, 0, 0, 1, 0],
        [40, 0.95, 80, 0, 30, 0.9, 1, 0], [10, 0.8, 90, 0, 70, 0, 1, 0], [60, 0.75, 20, 0.9, 40, 0, 1, 0], [15, 1.0, 100, 0, 0, 0, 1, 0],
        # the text of articles, headings and short paragraphs included
        [8, 0, 12, 0, 60, 0, 1, 1], [2, 0, 70, 0, 9, 0, 1, 1], [1, 0, 0, 0, 0, 0, 1, 1],
        [75, 0.02, 8, 0, 40, 0, 1, 1], [160, 0, 75, 0, 3, 0, 1, 1], [3, 0, 160, 0, 90, 0, 1, 1],
        [22, 0.3, 60, 0, 10, 0, 1, 1], [12, 0, 22, 0.3, 25, 0.1, 1, 1], [40, 0, 3, 0, 15, 0.1, 1, 1],
        [5, 1.0, 40, 0, 50, 0, 1, 0], [4, 0, 1, 1, 12, 0, 1, 1], [18, 0, 1, 1, 1, 1, 1, 1],
        [3, 0, 5, 0, 2, 0, 1, 1], [6, 0, 4, 0, 0, 0, 1, 1], [2, 0, 9, 0, 4, 0, 1, 1], [10, 0, 2, 0, 6, 0, 1, 1],
        [4, 0.9, 3, 0, 2, 0, 1, 0], [7, 0.5, 1, 1, 5, 1, 1, 0], [2, 1.0, 1, 1, 0, 0, 1, 0], [1, 0, 6, 0, 3, 0, 1, 1],
        [5, 0, 0, 0, 1, 1, 1, 1], [8, 0, 2, 1, 6, 0.5, 1, 1], [1, 1.0, 1, 1, 1, 1, 1, 0], [3, 1.0, 20, 0, 3, 1, 1, 0],
        [600, 0, 18, 0, 0, 0, 1, 1], [9, 0.6, 30, 0, 30, 0, 1, 1], [50, 0, 10, 0, 9, 0.9, 1, 1],
        # pages without such containers: long blocks with few links, and short ones between them
        [40, 0, 1, 1, 50, 0, 0, 1], [55, 0.05, 40, 0, 70, 0, 0, 1], [120, 0, 55, 0, 3, 0, 0, 1],
        [25, 0, 30, 0, 45, 0, 0, 1], [18, 0, 60, 0, 40, 0, 0, 1], [12, 0, 90, 0, 60, 0, 0, 1],
        [6, 0, 50, 0, 70, 0, 0, 1], [9, 0, 4, 0, 80, 0, 0, 1], [30, 0.1, 20, 0, 0, 0, 0, 1],
        [40, 0, 50, 0, 2, 0, 0, 1], [60, 0, 2, 0, 3, 0, 0, 1], [35, 0, 5, 0, 0, 0, 0, 1], [45, 0, 1, 1, 1, 1, 0, 1],
        [70, 0.02, 0, 0, 0, 0, 0, 1], [33, 0.1, 2, 1, 4, 0.5, 0, 1], [28, 0, 6, 0, 9, 0, 0, 1],
        [60, 0.25, 50, 0.2, 70, 0.1, 0, 1], [45, 0.3, 40, 0.1, 50, 0.2, 0, 1], [80, 0.2, 60, 0, 30, 0, 0, 1], [50, 0.35, 30, 0.1, 3, 0, 0, 1],
        [2, 0, 40, 0, 60, 0, 0, 1], [4, 0, 60, 0, 45, 0, 0, 1], [1, 1.0, 2, 1, 50, 0, 0, 0], [2, 1.0, 1, 1, 70, 0, 0, 0],
        [3, 0, 80, 0, 60, 0, 0, 1], [22, 0, 7, 0, 28, 0, 0, 1], [85, 0.1, 1, 1, 2, 1, 0, 1],
        [1, 1.0, 0, 0, 2, 1, 0, 0], [2, 1.0, 1, 1, 1, 1, 0, 0], [3, 1.0, 60, 0, 2, 1, 0, 0],
        [6, 0.8, 2, 1, 5, 0.9, 0, 0], [4, 0, 1, 1, 2, 1, 0, 0], [5, 0, 3, 0, 4, 0.5, 0, 0],
        [7, 0.3, 4, 0, 0, 0, 0, 0], [2, 0, 0, 0, 1, 1, 0, 0], [10, 0.9, 40, 0, 8, 0.9, 0, 0],
        [14, 0.5, 3, 1, 9, 0.6, 0, 0], [9, 0, 6, 0.5, 0, 0, 0, 0], [3, 0, 5, 0, 2, 0, 0, 0],
        [11, 0.4, 70, 0, 0, 0, 0, 0], [25, 0.7, 4, 1, 20, 0.8, 0, 0], [1, 0, 2, 0, 1, 1, 0, 0],
    ]
)


def _labelled() -> np.ndarray:
    """The labelled blocks as headings, paragraphs and parts of lists. In an article a heading or a paragraph is
    text though it is one link."""
    parts = []
    for kind in (0, 1, 2):
        label = np.where((SEEN[:, 6] == 1) & (kind > 0), 1, SEEN[:, -1])
        parts.append(np.column_stack([SEEN[:, :-1], np.full(len(SEEN), kind), label]))
    return np.concatenate(parts)


LABELLED = _labelled()


@dataclass
class Tree:
    """A binary decision tree: `feature` <= `limit` goes left. A leaf has a share of main text."""

    share: float
    feature: int = -1
    limit: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.share >= 0.5)
        low = rows[:, self.feature] <= self.limit
        out = np.empty(len(rows), bool)
        out[low], out[~low] = self.left.predict(rows[low]), self.right.predict(rows[~low])
        return out


def train_tree(table: np.ndarray = LABELLED, depth: int = 7, least: int = 2) -> Tree:
    """Grows a tree by Gini impurity; `least` rows in a leaf at least."""
    rows, labels = table[:, :-1], table[:, -1]
    tree = Tree(float(labels.mean()) if len(labels) else 0.0)
    if not depth or len(labels) < 2 * least or tree.share in (0.0, 1.0):
        return tree
    best = (2 * tree.share * (1 - tree.share) - 1e-9, -1, 0.0)
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= limit
            n = int(low.sum())
            if min(n, len(low) - n) < least:
                continue
            a, b = labels[low].mean(), labels[~low].mean()
            impurity = (n * 2 * a * (1 - a) + (len(low) - n) * 2 * b * (1 - b)) / len(low)
            if impurity < best[0]:
                best = (impurity, feature, float(limit))
    if best[1] < 0:
        return tree
    tree.feature, tree.limit = best[1], best[2]
    low = rows[:, tree.feature] <= tree.limit
    tree.left, tree.right = train_tree(table[low], depth - 1, least), train_tree(table[~low], depth - 1, least)
    return tree


def main_text(page: str | None, tree: Tree) -> str:
    """The blocks that the tree takes for main text, with an empty line between them."""
    found = blocks(page or "")
    if not found:
        return ""
    return "\n\n".join(b.text for b, keep in zip(found, tree.predict(features(found)).tolist()) if keep)


def extract_text(pages: DataFrame, tree: Tree | None = None, html_col: str = "html") -> DataFrame:
    """`pages` without the html, with `text` and `n_chars`, its code points."""
    tree = tree or train_tree()
    others = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    rows = pages.select(*others, F.col(html_col).cast("string").alias("html_"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, tree) for page in batch.column(len(others)).to_pylist()]
            columns = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*others, "text", "n_chars"])

    return rows.mapInArrow(read, pages.select(*others).schema.add("text", "string").add("n_chars", "long"))
