"""Main text of web pages from flat text blocks.

A page is read once, front to back, into text blocks (runs of text between
block-level tags). Each block has its word count and link density, those of
its two neighbours, and whether it lies inside content or boilerplate
containers. A decision tree, trained here on the small labelled table below,
says which blocks are main text; they are joined in page order by one space.

The scan is linear in the page's length, whatever its markup: unclosed tags,
quotes, comments and raw-text elements run to the end of the page, and any
depth of nesting is a counter, not recursion.

Rows: one output row per page row, repeated rows included. Null html is empty
and gives empty text; null url and page_id are passed on. Extra columns are
ignored.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from webloom.llm.common import require

# HTML element classes and the usual names of boilerplate parts.
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p
pre section select summary table tbody td tfoot th thead title tr ul""".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript template svg math object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset(["article", "main"])
BOILERPLATE = frozenset("nav header footer aside form menu dialog button select fieldset head".split())
NAMES = frozenset("""ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie
cookies disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices pagination
popup promo promotion related respond search share sharing sidebar social sponsor sponsored subscribe toolbar widget
alert complementary contentinfo dialog""".split())
HEADER = frozenset(["header", "banner", "masthead"])

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\shidden(?=[\s=/>]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_CLOSERS = {n: re.compile(rf"</{n}(?=[\s/>]|$)", re.I) for n in RAW}


def _tag_end(page: str, at: int) -> int:
    """Index of the '>' that ends the tag at ``at``; the page's length if none.
    A quote counts only after '='."""
    while True:
        m = _STOP.search(page, at)
        if not m:
            return len(page)
        if m[0] == ">":
            return m.start()
        at = m.end()
        if page[max(0, m.start() - 20):m.start()].rstrip()[-1:] == "=":
            at = page.find(m[0], at) + 1
            if not at:
                return len(page)


def _is_boilerplate(name: str, attributes: str, inside: bool) -> bool:
    if name in BOILERPLATE and not (name == "header" and inside):
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    if _HIDDEN.search(attributes):
        return True
    for m in _ATTRIBUTE.finditer(attributes):
        found = NAMES.intersection(re.split(r"[^a-z]+", (m[2] or m[3] or m[4] or "").lower()))
        if found and not (inside and found <= HEADER):
            return True
    return False


def blocks(page: str) -> list[tuple[str, int, int, bool, bool]]:
    """(text, words, words in links, in boilerplate, in content) of each block."""
    out: list[tuple[str, int, int, bool, bool]] = []
    text: list[str] = []
    stack: list[tuple[str, bool]] = []
    depth: dict[str, int] = {}
    boiler = content = links = linked = 0
    at, n = 0, len(page)

    def flush():
        nonlocal linked
        if text:
            words = "".join(text).split()
            if words:
                out.append((" ".join(words), len(words), min(linked, len(words)), boiler > 0, content > 0))
            text.clear()
        linked = 0

    while at < n:
        lt = page.find("<", at)
        if lt != at:
            piece = page[at:lt if lt >= 0 else n]
            if "&" in piece:
                piece = entities.unescape(piece)
            text.append(piece)
            if links:
                linked += len(piece.split())
            if lt < 0:
                break
        following = page[lt + 1:lt + 2]
        if following == "!" or following == "?":
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        closing = following == "/"
        m = _NAME.match(page, lt + 1 + closing)
        if not m:
            if closing:  # a bogus comment
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:  # an ordinary character
                text.append("<")
                at = lt + 1
            continue
        name = m[0].lower()
        end = _tag_end(page, m.end())
        attributes = page[m.end():end]
        at = end + 1
        if name in BLOCK:
            flush()
        elif name == "br":
            text.append(" ")
        if closing:
            if depth.get(name):
                while True:
                    top, is_boiler = stack.pop()
                    depth[top] -= 1
                    boiler -= is_boiler
                    content -= top in CONTENT
                    links -= top == "a"
                    if top == name:
                        break
            continue
        if name in RAW:
            if attributes.endswith("/") and name in ("svg", "math"):
                continue
            m = _CLOSERS[name].search(page, at)
            at = n if not m else min(n, _tag_end(page, m.end()) + 1)
            continue
        if name in VOID or at > n:
            continue
        is_boiler = _is_boilerplate(name, attributes, content > 0)
        stack.append((name, is_boiler))
        depth[name] = depth.get(name, 0) + 1
        boiler += is_boiler
        content += name in CONTENT
        links += name == "a"
    flush()
    return out


FEATURES = ("words", "link density", "words before", "link density before", "words after", "link density after",
            "in boilerplate", "in content", "outside the page's content")

#: Labelled blocks: the features in the order of FEATURES, then 1 for main text.
LABELLED = [
    # inside the article of a page that marks it
    (12, 0.0, 6, 1.0, 40, 0.0, 0, 1, 0, 1), (45, 0.0, 12, 0.0, 60, 0.1, 0, 1, 0, 1), (1, 0.0, 50, 0.0, 40, 0.0, 0, 1, 0, 1),
    (3, 0.0, 2, 0.0, 0, 0.0, 0, 1, 0, 1), (5, 1.0, 60, 0.0, 44, 0.0, 0, 1, 0, 1), (80, 0.3, 0, 0.0, 9, 0.0, 0, 1, 0, 1),
    (2, 0.5, 30, 0.0, 3, 1.0, 0, 1, 0, 1), (200, 0.0, 90, 0.0, 0, 0.0, 0, 1, 0, 1), (7, 0.0, 1, 1.0, 1, 0.0, 0, 1, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 1), (3, 1.0, 4, 1.0, 2, 1.0, 0, 1, 0, 1), (25, 0.8, 3, 1.0, 12, 0.6, 0, 1, 0, 1),
    (6, 0.0, 0, 0.0, 2, 1.0, 0, 1, 0, 1), (9, 1.0, 150, 0.0, 5, 0.0, 0, 1, 0, 1), (33, 0.0, 33, 0.0, 33, 0.0, 0, 1, 0, 1),
    # boilerplate parts, also inside articles
    (30, 0.0, 80, 0.0, 5, 1.0, 1, 1, 0, 0), (4, 1.0, 30, 0.0, 30, 0.0, 1, 1, 0, 0), (9, 0.0, 40, 0.0, 70, 0.0, 1, 1, 0, 0),
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 1, 0), (6, 0.0, 1, 1.0, 12, 0.0, 1, 0, 1, 0), (120, 0.0, 3, 0.0, 2, 0.0, 1, 0, 1, 0),
    (15, 0.0, 40, 0.0, 0, 0.0, 1, 0, 1, 0), (20, 0.0, 30, 0.0, 4, 0.0, 1, 0, 0, 0), (4, 0.0, 2, 1.0, 9, 0.0, 1, 0, 0, 0),
    (60, 0.0, 8, 0.0, 5, 0.0, 1, 0, 0, 0), (2, 1.0, 1, 1.0, 30, 0.0, 1, 0, 0, 0), (35, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 0),
    (200, 0.1, 70, 0.0, 90, 0.0, 1, 1, 0, 0), (45, 0.0, 50, 0.0, 41, 0.0, 1, 0, 0, 0), (75, 0.0, 44, 0.0, 1, 0.0, 1, 1, 0, 0),
    # beside the article of a page that marks it
    (8, 0.0, 2, 1.0, 11, 0.0, 0, 0, 1, 0), (40, 0.0, 60, 0.0, 3, 1.0, 0, 0, 1, 0), (3, 1.0, 2, 1.0, 14, 0.0, 0, 0, 1, 0),
    (25, 0.2, 0, 0.0, 70, 0.0, 0, 0, 1, 0), (90, 0.0, 5, 0.0, 4, 0.0, 0, 0, 1, 0), (1, 0.0, 0, 0.0, 50, 0.0, 0, 0, 1, 0),
    (150, 0.0, 80, 0.0, 95, 0.0, 0, 0, 1, 0), (12, 0.0, 44, 0.0, 38, 0.0, 0, 0, 1, 0), (55, 0.1, 62, 0.0, 0, 0.0, 0, 0, 1, 0),
    (20, 0.0, 20, 0.0, 20, 0.0, 0, 0, 1, 0), (70, 0.0, 1, 0.0, 33, 0.0, 0, 0, 1, 0), (5, 0.0, 160, 0.0, 4, 1.0, 0, 0, 1, 0),
    # pages that do not mark it
    (40, 0.0, 8, 0.0, 55, 0.0, 0, 0, 0, 1), (9, 0.0, 4, 1.0, 60, 0.0, 0, 0, 0, 1), (70, 0.1, 45, 0.0, 33, 0.0, 0, 0, 0, 1),
    (14, 0.0, 50, 0.0, 6, 0.0, 0, 0, 0, 1), (6, 0.0, 33, 0.0, 41, 0.0, 0, 0, 0, 1), (110, 0.2, 3, 1.0, 2, 1.0, 0, 0, 0, 1),
    (22, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (3, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (17, 0.25, 60, 0.0, 20, 0.0, 0, 0, 0, 1),
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0), (5, 1.0, 40, 0.0, 3, 1.0, 0, 0, 0, 0), (12, 0.8, 1, 1.0, 7, 0.9, 0, 0, 0, 0),
    (30, 0.7, 4, 1.0, 60, 0.0, 0, 0, 0, 0), (1, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (8, 0.6, 50, 0.0, 5, 1.0, 0, 0, 0, 0),
]


def train_tree(rows: list[tuple]):
    """A binary decision tree by Gini impurity, grown until its leaves are
    pure: (feature, threshold, tree at or below, tree above) or a label. Ties
    go to the first feature and the lowest threshold."""
    y = np.array([r[-1] for r in rows])
    if y.min() == y.max():
        return int(y[0])
    x = np.array([r[:-1] for r in rows], dtype=float)
    best = (np.inf, 0, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= t
            gini = sum(len(p) * p.mean() * (1 - p.mean()) for p in (y[low], y[~low]))
            if gini < best[0] - 1e-12:
                best = (gini, f, float(t))
    if not np.isfinite(best[0]):
        return int(y.mean() >= 0.5)
    _, f, t = best
    return (f, t, train_tree([r for r in rows if r[f] <= t]), train_tree([r for r in rows if r[f] > t]))


def classify(tree, features: tuple) -> int:
    while isinstance(tree, tuple):
        f, t, low, high = tree
        tree = low if features[f] <= t else high
    return tree


def main_text(page: str | None, tree) -> str:
    found = blocks(page or "")
    has_content = any(b[4] for b in found)
    shape = [(0, 0.0), *((w, l / w) for _, w, l, _, _ in found), (0, 0.0)]
    kept = []
    for i, (text, _, _, boiler, content) in enumerate(found, 1):
        if classify(tree, (*shape[i], *shape[i - 1], *shape[i + 1], boiler, content,
                           has_content and not content)):
            kept.append(text)
    return " ".join(kept)


def extract(pages: DataFrame, labelled: list[tuple] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; no shuffle. ``labelled``
    replaces the training table."""
    require(pages, "page_id", "url", "html")
    tree = train_tree(labelled or LABELLED)
    part = pages.select("page_id", "url", "html")
    kinds = [f.dataType.simpleString() for f in part.schema]

    def run(batches):
        for batch in batches:
            texts = [main_text(p, tree) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return part.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
