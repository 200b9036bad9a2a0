"""The main text of web pages.

A page is read as a flat sequence of text blocks. Each block has its number of
words, its link density, both of the blocks before and after it, and where it
stands: inside or outside the page's article, in an element that says it is
something else, in a heading. A decision tree, grown from the small table
``LABELLED``, keeps or drops each block. Kept blocks are joined in page order.

Inside a block, character references are decoded and white space becomes one
space; a line break tag is white space. Scripts, styles, markup comments, drawings,
controls and stand-ins for what is not shown never become text; formulas do.

* null or empty html: an empty text. Broken markup is read leniently: unknown end
  tags are ignored, elements left open end with their parent. A drawing left open
  ends where a block begins; only text-only elements (scripts and the like) run to
  their end tag or to the end of the page, as in a browser.
* null or repeated page_id or url: carried through, one row for each input row.
* an empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element and attribute names of HTML.
RAW = "script style textarea title iframe".split()
UNREAD = set("noscript template svg object select button option canvas audio video annotation annotation-xml".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
             "sub sup time tt u var wbr "
             "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub "
             "msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
#: Elements that end an open drawing.
BLOCKS = set("address article aside blockquote body center dd div dl dt footer h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
OTHER_PARTS = set("nav footer aside form dialog menu fieldset".split())
MAIN_PARTS = {"article", "main"}
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
HINTS = set("ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner cookie cookies "
            "consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup paywall social share sharing sidebar "
            "related recommend recommended recommendations nav navbar navigation menu breadcrumb breadcrumbs footer masthead comment comments "
            "disqus reply replies respond widget login toolbar pagination pager skip copyright disclaimer teaser outbrain taboola".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:=\s*+(?:\"[^\"]*\"|'[^']*')|[^>])*+)>|<[!?][^>]*>|</[^>]*>", re.S)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: A class of this form tells what the page has or shows elsewhere, as in "has-sidebar" or "nav-open".
STATE = re.compile(r"(?:no|has|have|with|without|is|hide|show)[-_].*|.*[-_](?:open|opened|closed|collapsed|expanded|enabled|disabled|active)", re.I)
#: Elements that often wrap a whole page: what is inside counts as something else only beside other text.
WRAPPERS = {"form", "dialog"}
WRAPPER_ROLES = {"form", "dialog", "alertdialog"}
#: How sure it is that an element is something else.
NOT, WRAPPED, OTHER = 0, 1, 2

COLUMNS = ("words", "links", "words_before", "links_before", "words_after", "links_after", "place", "other", "heading")

#: Hand-labelled blocks: ``COLUMNS``, then 1 for main text. place: 1 inside the article, 0 page without one, -1 outside.
LABELLED = (
    # article paragraphs and headings, long and short, beside text, links and page ends
    (60, 0.0, 45, 0.0, 70, 0.0, 1, 0, 0, 1), (120, 0.05, 60, 0.0, 30, 0.0, 1, 0, 0, 1), (35, 0.1, 8, 0.0, 120, 0.0, 1, 0, 0, 1),
    (1, 0.0, 80, 0.0, 60, 0.0, 1, 0, 0, 1), (2, 0.0, 1, 0.0, 1, 0.0, 1, 0, 0, 1), (5, 0.0, 9, 0.0, 12, 0.0, 1, 0, 0, 1),
    (9, 0.0, 12, 0.0, 80, 0.0, 1, 0, 1, 1), (3, 0.0, 6, 1.0, 1, 0.0, 1, 0, 1, 1), (6, 0.0, 0, 0.0, 40, 0.0, 1, 0, 1, 1),
    (1, 0.0, 10, 0.0, 8, 0.0, 1, 0, 0, 1), (14, 0.5, 60, 0.0, 50, 0.0, 1, 0, 0, 1), (4, 1.0, 50, 0.0, 40, 0.0, 1, 0, 0, 1),
    (3, 1.0, 3, 1.0, 4, 1.0, 1, 0, 0, 1), (80, 0.0, 3, 1.0, 6, 0.2, 1, 0, 0, 1), (2, 0.0, 6, 0.0, 0, 0.0, 1, 0, 0, 1),
    (7, 1.0, 2, 0.0, 60, 0.0, 1, 0, 1, 1), (300, 0.0, 4, 1.0, 5, 0.6, 1, 0, 0, 1),
    # adverts, notices, forms, comments inside the article
    (12, 0.0, 60, 0.0, 70, 0.0, 1, 1, 0, 0), (40, 0.0, 60, 0.0, 30, 0.0, 1, 1, 0, 0), (4, 1.0, 30, 0.0, 5, 1.0, 1, 1, 0, 0),
    (3, 0.0, 70, 0.0, 90, 0.0, 1, 1, 1, 0), (90, 0.0, 20, 0.0, 15, 0.0, 1, 1, 0, 0), (1, 0.0, 4, 1.0, 0, 0.0, 1, 1, 0, 0),
    (5, 1.0, 40, 0.0, 60, 0.0, 1, 1, 1, 0), (200, 0.0, 5, 0.0, 0, 0.0, 1, 1, 0, 0),
    # outside the article of a page that has one
    (1, 1.0, 0, 0.0, 1, 1.0, -1, 1, 0, 0), (2, 1.0, 1, 1.0, 2, 1.0, -1, 1, 0, 0), (10, 0.0, 1, 1.0, 9, 0.0, -1, 1, 0, 0),
    (12, 0.0, 60, 0.0, 0, 0.0, -1, 1, 0, 0), (50, 0.0, 3, 1.0, 8, 0.0, -1, 1, 0, 0), (6, 0.0, 0, 0.0, 2, 1.0, -1, 0, 1, 0),
    (8, 0.0, 2, 1.0, 40, 0.0, -1, 0, 0, 0), (45, 0.0, 10, 0.0, 30, 0.0, -1, 0, 0, 0), (3, 1.0, 80, 0.0, 4, 1.0, -1, 0, 0, 0),
    (120, 0.0, 60, 0.0, 70, 0.0, -1, 0, 0, 0), (20, 0.0, 70, 0.0, 0, 0.0, -1, 0, 0, 0), (2, 0.0, 0, 0.0, 1, 1.0, -1, 0, 1, 0),
    # pages without an article element: text
    (70, 0.0, 50, 0.0, 60, 0.0, 0, 0, 0, 1), (25, 0.0, 5, 0.0, 80, 0.0, 0, 0, 0, 1), (40, 0.2, 6, 1.0, 60, 0.0, 0, 0, 0, 1),
    (6, 0.0, 45, 0.0, 50, 0.0, 0, 0, 0, 1), (3, 0.0, 60, 0.0, 70, 0.0, 0, 0, 1, 1), (8, 0.0, 4, 1.0, 50, 0.0, 0, 0, 1, 1),
    (2, 0.0, 30, 0.0, 40, 0.0, 0, 0, 0, 1), (150, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 1), (30, 0.0, 3, 1.0, 4, 1.0, 0, 0, 0, 1),
    (12, 0.0, 30, 0.0, 25, 0.0, 0, 0, 0, 1), (15, 0.0, 8, 0.0, 20, 0.0, 0, 0, 0, 1), (5, 0.0, 15, 0.0, 18, 0.0, 0, 0, 0, 1),
    # pages without an article element: the rest
    (2, 1.0, 0, 0.0, 3, 1.0, 0, 0, 0, 0), (3, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), (6, 0.9, 3, 1.0, 60, 0.0, 0, 0, 0, 0),
    (4, 1.0, 70, 0.0, 5, 1.0, 0, 0, 0, 0), (10, 0.8, 50, 0.0, 4, 1.0, 0, 0, 0, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0),
    (12, 0.7, 5, 1.0, 6, 1.0, 0, 0, 0, 0), (20, 0.9, 3, 1.0, 8, 1.0, 0, 0, 0, 0), (5, 0.6, 2, 1.0, 0, 0.0, 0, 0, 0, 0),
    (70, 0.0, 50, 0.0, 60, 0.0, 0, 1, 0, 0), (12, 0.0, 5, 0.0, 60, 0.0, 0, 1, 0, 0), (3, 0.0, 60, 0.0, 0, 0.0, 0, 1, 1, 0),
    (30, 0.0, 4, 1.0, 5, 0.0, 0, 1, 0, 0), (2, 1.0, 3, 1.0, 1, 1.0, 0, 1, 0, 0), (3, 0.0, 2, 1.0, 4, 1.0, 0, 0, 1, 0),
)


# -- decision tree -----------------------------------------------------------

@dataclass
class Node:
    keep: bool
    column: int = -1
    cut: float = 0.0
    below: Node | None = None
    above: Node | None = None

    def __call__(self, row) -> bool:
        node = self
        while node.below is not None:
            node = node.below if row[node.column] <= node.cut else node.above
        return node.keep


def impurity(y: np.ndarray) -> float:
    p = y.mean() if len(y) else 0.0
    return len(y) * p * (1 - p)


def grow(x: np.ndarray, y: np.ndarray, leaf: int = 2, depth: int = 6) -> Node:
    """A binary tree by Gini impurity. Ties go to the first column and the lowest cut."""
    node = Node(bool(y.mean() >= 0.5))
    if depth == 0 or impurity(y) == 0:
        return node
    best = (impurity(y) - 1e-9, -1, 0.0)
    for column in range(x.shape[1]):
        values = np.unique(x[:, column])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, column] <= cut
            if min(low.sum(), (~low).sum()) >= leaf:
                best = min(best, (impurity(y[low]) + impurity(y[~low]), column, float(cut)))
    if best[1] >= 0:
        low = x[:, best[1]] <= best[2]
        node.column, node.cut = best[1], best[2]
        node.below, node.above = grow(x[low], y[low], leaf, depth - 1), grow(x[~low], y[~low], leaf, depth - 1)
    return node


def trained(table=LABELLED) -> Node:
    rows = np.array(table, float)
    return grow(rows[:, :-1], rows[:, -1])


# -- blocks ------------------------------------------------------------------

@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    words: int = 0
    linked: int = 0
    inside: bool = False
    other: int = 0
    heading: bool = False

    @property
    def links(self) -> float:
        return self.linked / self.words if self.words else 0.0


def hinted(name: str, attributes: str, in_main: bool) -> int:
    """Whether an element says that it is no main text.

    Classes of html and body tell about the page; those of an article or main element only count
    as whole words, so that "post has-comments" or "share-42" is an article and "comment" is none.
    """
    if name in WRAPPERS:
        sure = WRAPPED
    elif name in OTHER_PARTS or (name == "header" and not in_main):
        return OTHER
    else:
        sure = NOT
    if not attributes or name in ("html", "body"):
        return sure
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id"):
            for token in value.split():
                parts = [token] if name in MAIN_PARTS else [] if STATE.fullmatch(token) else PART.findall(token)
                if any(p.lower() in HINTS for p in parts):
                    return OTHER
        elif key == "role" and value.lower() in WRAPPER_ROLES:
            sure = WRAPPED
        elif key == "role" and value.lower() in ROLES:
            return OTHER
        elif key == "hidden" and not value or key == "aria-hidden" and value.lower() == "true":
            return OTHER
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return OTHER
    return sure


def blocks_of(page: str) -> tuple[list[Block], bool]:
    """The text blocks of a page, and whether it has an article."""
    found, has_main = [], False
    stack: list[tuple[str, bool, int, bool]] = []  # open elements: name, is in an article, is something else, is not read
    count: Counter[str] = Counter()                 # and how many there are of each name
    links = 0
    now = Block()

    def close():
        nonlocal now
        if now.words:
            found.append(now)
        now = Block()

    def cut(at: int):
        nonlocal links
        for e in stack[at:]:
            count[e[0]] -= 1
            links -= e[0] == "a"
        del stack[at:]

    def text(piece: str):
        if stack and stack[-1][3]:
            return
        if not piece or piece.isspace():
            if piece:
                now.parts.append(" ")
            return
        piece = html.unescape(piece)
        n = len(piece.split())
        if n and not now.words:
            now.inside, now.other = (stack[-1][1], stack[-1][2]) if stack else (False, NOT)
            now.heading = any(e[0] in ("h1", "h2", "h3", "h4", "h5", "h6") for e in stack[-3:])
        now.parts.append(piece)
        now.words += n
        now.linked += n if links else 0

    at = 0
    while m := TOKEN.search(page, at):
        text(page[at:m.start()])
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        if name in RAW_END and not m["end"]:
            # In drawings and formulas such an element can be self-closed.
            if not (m["rest"].endswith("/") and (count["svg"] or count["math"])):
                over = RAW_END[name].search(page, at)
                at = over.end() if over else len(page)
            continue
        if name == "br":
            now.parts.append(" ")
            continue
        unread = bool(stack) and stack[-1][3]
        if unread and count["svg"] and name in BLOCKS and not m["end"]:
            drawing = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in ("svg", "foreignobject") or not stack[i][3]), None)
            if drawing is not None and stack[drawing][0] == "svg":
                cut(drawing)
                unread = bool(stack) and stack[-1][3]
        if name not in INLINE and name not in UNREAD and not unread:
            close()
        if name in VOID:
            continue
        if m["end"]:
            if count[name]:
                cut(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
        elif not m["rest"].endswith("/"):
            if name not in INLINE and name not in UNREAD and not unread and stack and stack[-1][0] in INLINE:
                # Inline elements left open end where a block begins.
                while stack and stack[-1][0] in INLINE:
                    cut(len(stack) - 1)
            if name in ("p", "option") and stack and stack[-1][0] == name:
                cut(len(stack) - 1)
            inside, other, unread = stack[-1][1:] if stack else (False, NOT, False)
            if name in MAIN_PARTS and not unread:
                inside = has_main = True
                other = OTHER if other == OTHER else NOT  # an article in a wrapper is an article
            stack.append((name, inside, max(other, hinted(name, m["rest"], inside)), unread or name in UNREAD))
            count[name] += 1
            links += name == "a"
    text(page[at:])
    close()
    # Where all text stands in wrappers, they hold the page.
    alone = all(b.other for b in found)
    for b in found:
        b.other = b.other == OTHER or (b.other == WRAPPED and not alone)
    return found, has_main


def main_text(page: str | None, tree: Node) -> str:
    found, has_main = blocks_of(page or "")
    empty = Block()
    kept = []
    for before, block, after in zip([empty, *found], found, [*found[1:], empty]):
        place = (1 if block.inside else -1) if has_main else 0
        row = (block.words, block.links, before.words, before.links, after.words, after.links, place, block.other, block.heading)
        if tree(row):
            kept.append(" ".join("".join(block.parts).split()))
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""
    tree = trained()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), tree) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
            .mapInArrow(rows, "page_id long, url string, text string, n_chars long"))
