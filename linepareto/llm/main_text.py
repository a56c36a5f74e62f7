"""The main text of web pages: flat text blocks, classified by a small decision tree.

A page is cut into blocks at block-level tags. A block is described by its words and link density,
those of the blocks before and after, and by where it stands. The tree is grown from the labelled
blocks below, when first needed; pages are read whole, each by itself.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")

# Element names of HTML.
UNSEEN = frozenset("script style noscript template title svg math iframe object audio video canvas textarea select button".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
HOLDERS = frozenset("article aside body center details dialog div dl fieldset figure footer form header main menu nav ol section "
                    "table tbody td th thead tr ul".split())
ASIDE = frozenset("aside dialog fieldset footer form header menu nav".split())
ARTICLE = frozenset("article main".split())
# Words in class, id and role that name something beside the article.
BESIDE = frozenset("ad ads advert advertisement adverts alert alertdialog banner breadcrumb breadcrumbs byline comment commentlist comments "
                   "complementary consent contentinfo cookie cookies copyright dialog disqus footer gdpr header hint legal login "
                   "masthead menu message modal nav navbar navigation newsletter notice pager pagination popup promo promoted "
                   "promotion related replies reply responses reviews search share sharing sidebar signup skip social sponsor sponsored "
                   "subscribe tags toolbar widget".split())
# Of those, the ones that name parts of an article too: inside of one its blocks' words and links decide.
OF_ARTICLES = frozenset("dialog hint legal menu message".split())
# Words that may stand beside those in one name: 'sidebar-left' is a sidebar, 'no-sidebar' and 'comments-open' are not.
NEUTRAL = frozenset("area bar block bottom box container form inner item items left links list main mobile page posts primary right "
                    "secondary section site slot sticky title top user wrap wrapper".split())
# Never beside by their names.
WHOLE = frozenset("html body main article".split())


class Block(NamedTuple):
    text: str
    words: int
    links: float  # share of the characters that are link text
    beside: int  # stands in an element that names something beside the article
    inside: int  # stands in an article or main element
    heading: int


class Labelled(NamedTuple):
    """A block of the training table."""

    words: int
    links: float
    words_before: int
    links_before: float
    words_after: int
    links_after: float
    beside: int
    inside: int
    heading: int
    main: int


# Blocks of hand-made pages, labelled by hand.
TABLE = [Labelled(*row) for row in (
    # menus, link lists, crumbs
    (1, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (2, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0), (1, 1.0, 2, 1.0, 8, 0.0, 1, 0, 0, 0),
    (1, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (3, 1.0, 1, 1.0, 9, 0.0, 0, 0, 0, 0), (6, 0.9, 4, 1.0, 5, 1.0, 0, 0, 0, 0),
    (2, 1.0, 1, 1.0, 45, 0.0, 0, 0, 0, 0), (1, 1.0, 2, 1.0, 80, 0.0, 0, 0, 0, 0), (5, 0.9, 60, 0.0, 70, 0.0, 0, 0, 0, 0),
    (3, 1.0, 60, 0.0, 50, 0.0, 0, 1, 0, 0), (1, 1.0, 0, 0.0, 20, 0.0, 0, 0, 0, 0), (16, 0.9, 30, 0.0, 40, 0.0, 0, 1, 0, 0),
    (4, 1.0, 60, 0.0, 4, 1.0, 0, 1, 0, 0), (5, 0.8, 4, 1.0, 0, 0.0, 0, 1, 0, 0), (12, 0.9, 80, 0.0, 10, 0.9, 0, 0, 0, 0),
    # adverts, notices, sidebars, forms, comments, whatever their length
    (9, 0.0, 1, 1.0, 7, 0.0, 1, 0, 0, 0), (25, 0.1, 40, 0.0, 6, 0.0, 1, 0, 0, 0), (60, 0.0, 30, 0.0, 55, 0.0, 1, 0, 0, 0),
    (14, 0.0, 70, 0.0, 40, 0.0, 1, 1, 0, 0), (45, 0.0, 50, 0.0, 12, 0.0, 1, 1, 0, 0), (3, 0.0, 40, 0.0, 30, 0.0, 1, 1, 1, 0),
    (2, 0.0, 5, 1.0, 4, 1.0, 1, 0, 1, 0), (5, 0.0, 0, 0.0, 1, 1.0, 1, 0, 1, 0), (33, 0.0, 8, 0.0, 0, 0.0, 1, 0, 0, 0),
    # footers and lone lines outside an article
    (10, 0.0, 40, 0.0, 0, 0.0, 1, 0, 0, 0), (6, 0.3, 30, 0.0, 0, 0.0, 1, 0, 0, 0), (4, 0.0, 3, 1.0, 1, 1.0, 0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (5, 0.0, 25, 1.0, 0, 0.0, 0, 0, 0, 0), (7, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0),
    (2, 0.0, 1, 1.0, 2, 1.0, 0, 0, 1, 0),
    # titles and paragraphs of articles, long and short
    (9, 0.0, 8, 0.0, 40, 0.0, 0, 1, 1, 1), (1, 0.0, 1, 1.0, 12, 0.0, 0, 1, 1, 1), (4, 0.0, 90, 0.0, 50, 0.0, 0, 1, 1, 1),
    (80, 0.0, 9, 0.0, 60, 0.0, 0, 1, 0, 1), (120, 0.1, 70, 0.0, 30, 0.0, 0, 1, 0, 1), (5, 0.0, 80, 0.0, 60, 0.0, 0, 1, 0, 1),
    (1, 0.0, 40, 0.0, 12, 0.0, 0, 1, 0, 1), (3, 0.0, 5, 0.0, 10, 0.0, 0, 1, 0, 1), (18, 0.3, 60, 0.0, 45, 0.0, 0, 1, 0, 1),
    (7, 0.0, 2, 0.0, 0, 0.0, 0, 1, 0, 1), (30, 0.0, 20, 0.0, 5, 1.0, 0, 1, 0, 1), (2, 0.0, 1, 0.0, 2, 0.0, 0, 1, 0, 1),
    (12, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (3, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (8, 0.0, 0, 0.0, 30, 0.0, 0, 1, 1, 1),
    (18, 0.0, 18, 1.0, 0, 0.0, 0, 1, 0, 1), (25, 0.0, 20, 1.0, 30, 0.0, 0, 1, 0, 1), (14, 0.0, 40, 1.0, 9, 0.0, 0, 1, 0, 1),
    (20, 0.0, 9, 0.0, 4, 1.0, 0, 1, 0, 1), (5, 0.0, 60, 0.0, 3, 1.0, 0, 1, 0, 1), (4, 0.0, 3, 1.0, 2, 1.0, 0, 1, 0, 1),
    (2, 0.0, 2, 1.0, 0, 0.0, 0, 1, 0, 1), (3, 0.0, 0, 0.0, 1, 1.0, 0, 1, 1, 1), (6, 0.4, 0, 0.0, 2, 0.0, 0, 1, 0, 1),
    # the same where no element names the article
    (50, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (40, 0.0, 0, 0.0, 60, 0.0, 0, 0, 0, 1), (35, 0.0, 0, 0.0, 3, 1.0, 0, 0, 0, 1),
    (6, 0.0, 0, 0.0, 50, 0.0, 0, 0, 1, 1), (30, 0.0, 1, 1.0, 0, 0.0, 0, 0, 0, 1), (9, 0.0, 20, 0.0, 0, 0.0, 0, 0, 0, 1),
    (70, 0.0, 8, 0.0, 65, 0.0, 0, 0, 0, 1), (40, 0.1, 60, 0.0, 35, 0.0, 0, 0, 0, 1), (22, 0.0, 30, 0.0, 50, 0.0, 0, 0, 0, 1),
    (8, 0.0, 60, 0.0, 45, 0.0, 0, 0, 0, 1), (6, 0.0, 9, 0.0, 70, 0.0, 0, 0, 1, 1), (5, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1, 1),
    # short notes without a link near
    (2, 0.0, 0, 0.0, 2, 0.0, 0, 0, 1, 1), (2, 0.0, 2, 0.0, 2, 0.0, 0, 0, 0, 1), (3, 0.0, 2, 0.0, 4, 0.0, 0, 0, 0, 1),
    (2, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 1), (4, 0.0, 3, 0.0, 0, 0.0, 0, 0, 0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0),
    (90, 0.2, 5, 0.0, 3, 1.0, 0, 0, 0, 1), (26, 0.0, 4, 1.0, 40, 0.0, 0, 0, 0, 1), (15, 0.0, 44, 0.0, 3, 1.0, 0, 0, 0, 1),
)]


def grow(x: np.ndarray, y: np.ndarray) -> tuple | int:
    """A decision tree by Gini impurity: (feature, threshold, at or below, above) or a label."""
    if len(set(y.tolist())) == 1:
        return int(y[0])
    best = None
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = x[:, feature] <= threshold
            impurity = sum(part.mean() * (1 - part.mean()) * len(part) for part in (y[low], y[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, feature, float(threshold), low
    if best is None:
        return int(y.mean() >= 0.5)
    _, feature, threshold, low = best
    return feature, threshold, grow(x[low], y[low]), grow(x[~low], y[~low])


_tree: list = []


def tree() -> tuple | int:
    if not _tree:
        table = np.array(TABLE, float)
        _tree.append(grow(table[:, :-1], table[:, -1]))
    return _tree[0]


def _named_beside(attributes: str, in_article: bool) -> bool:
    """Whether a whole class, id or role names something beside the article; an article's or page's header is its own."""
    if "=" not in attributes:
        return False
    for token in " ".join(a or b or c for a, b, c in _NAMED.findall(attributes)).lower().split():
        parts = set(_WORD.findall(token))
        found = parts - NEUTRAL
        own = found == {"header"} and (in_article or "page" in parts)  # holds the title
        if found and found <= BESIDE and not own and not (in_article and found <= OF_ARTICLES):
            return True
    return False


def _is_aside(tag: str, in_article: bool) -> bool:
    return tag in ASIDE and not (tag == "header" and in_article)


def blocks(page: str, names: bool = True) -> list[Block]:
    """The text blocks of a page in order; blocks without text are left out.

    With `names`, class, id and role tell what stands beside the article, but never of an element that
    holds the body, the main element or the first article.
    """
    overruled: set[int] = set()
    while (out := _blocks(page, names, overruled)) is None:
        pass
    return out


def _blocks(page: str, names: bool, overruled: set[int]) -> list[Block] | None:
    """None once an element in `overruled` (by the place of its tag) is new; each name of WHOLE ends at most one call."""
    out: list[Block] = []
    text: list[str] = []
    holders: list[tuple[str, bool, bool, int]] = []  # open elements: name, beside, in an article, place if named beside or -1
    met: set[str] = set()
    link, linked, heading, at = False, 0, 0, 0
    last = page.rfind(">") + 1  # no tag ends behind it; a search never looks further, so it is linear
    open_names: Counter[str] = Counter()
    beside = inside = alone = False  # alone: the element of this block itself names something beside the article

    def flush():
        nonlocal linked, alone
        words = html.unescape("".join(text)).split()
        if words:
            joined = " ".join(words)
            out.append(Block(joined, len(words), min(1.0, linked / len(joined)), int(beside or alone), int(inside), heading))
        text.clear()
        linked, alone = 0, False

    while True:
        m = _TAG.search(page, at, last)
        piece = page[at:m.start()] if m else page[at:].partition("<!--")[0]
        if piece:
            text.append(piece)
            if link:
                linked += len(" ".join(html.unescape(piece).split()))
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                break  # an open comment takes the rest
            continue
        name, closing, attributes = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in UNSEEN:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at, last)
                at = end.end() if end else len(page)
            text.append(" ")
            continue
        if name == "a":
            link = not closing
        if name in INLINE:
            if name == "br":
                text.append(" ")
            continue
        flush()
        link = False
        if len(name) == 2 and name[0] == "h" and name[1] in "123456":
            heading = int(not closing)
        else:
            heading = 0
        if name in HOLDERS:
            if not closing:
                named = names and at not in overruled and _named_beside(attributes, inside)
                if name in WHOLE and not named and name not in met:
                    met.add(name)
                    if new := {place for *_, place in holders if place >= 0}:
                        overruled |= new
                        return None
                named = named and name not in WHOLE
                beside = beside or named or _is_aside(name, inside)
                inside = inside or name in ARTICLE
                holders.append((name, beside, inside, at if named else -1))
                open_names[name] += 1
            else:
                while open_names[name]:
                    closed = holders.pop()[0]
                    open_names[closed] -= 1
                    if closed == name:
                        break
                _, beside, inside, _ = holders[-1] if holders else ("", False, False, -1)
        elif not closing:
            alone = _is_aside(name, inside) or names and name not in WHOLE and _named_beside(attributes, inside)
    flush()
    return out


def main_blocks(found: list[Block]) -> list[Block]:
    """The blocks that the tree takes for main text."""
    out = []
    for k, b in enumerate(found):
        before = (found[k - 1].words, found[k - 1].links) if k else (0, 0.0)
        after = (found[k + 1].words, found[k + 1].links) if k + 1 < len(found) else (0, 0.0)
        row, node = (b.words, b.links, *before, *after, b.beside, b.inside, b.heading), tree()
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        if node:
            out.append(b)
    return out


def main_text(page: str | None) -> str:
    """Where names leave nothing, word and link densities alone decide."""
    page = page or ""
    return "\n\n".join(b.text for b in main_blocks(blocks(page)) or main_blocks(blocks(page, names=False)))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of `pages`.

    Null html is empty, and a page without main text gives an empty text. Repeated rows stay; an empty
    table gives no rows. Other columns are not read.
    """
    def run(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                some = batch.slice(part, 500)
                found = [main_text(p) for p in some.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column("page_id"), some.column("url"), pa.array(found, pa.string()),
                                                  pa.array([len(t) for t in found], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
