"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into flat blocks at block-level tags. A block is described by its words and link
density, those of its neighbours, and the kind of container it stands in. A decision tree, grown
here from a small labelled table, tells the article from the rest.
"""

from __future__ import annotations

import heapq
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<(?:/?[a-zA-Z!?][^<>]*)?\Z", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label|style|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
# Elements whose content is no text of the page.
_RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "select", "option", "button", "object", "canvas")
_INLINE = frozenset(
    "a abbr b bdi bdo big cite code del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong"
    " sub sup time tt u var wbr br".split()
)
# Of these, what holds no markup ends with the page if it is not closed.
_TO_THE_END = frozenset("script style textarea iframe".split())
_CONTAINERS = frozenset("nav header footer aside article main section div form ul ol dl table figure dialog menu fieldset".split())
_AROUND = frozenset("nav footer aside form dialog menu fieldset".split())
_HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe"
    r"|sidebar|widget|menu|nav\w*|navbar|breadcrumbs?|toolbar|masthead|site-?header|site-?footer|footer|related|recommend\w*|share|social"
    r"|comments?|replies|respond|disqus|login|signup|search|copyright|pagination|pager|skip)(?:$|[\s_-])", re.I
)
_ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu")
# A name with such a word in front tells of the layout, not of the element.
_LAYOUT = re.compile(r"(?:^|(?<=[\s_-]))(?:has|no|with|without)[_-][^\s]*", re.I)
# Names that also wrappers of whole pages have. The others seldom do.
_WRAPPER = re.compile(
    r"(?:^|[\s_-])(?:notice|overlay|widget|nav\w*|navbar|toolbar|masthead|share|social|search|login|signup|skip)(?:$|[\s_-])", re.I
)
# How a container that may surround the article is marked.
MAYBE, LIKELY, HIDDEN = range(3)
# A marked container is taken for a wrapper of the article if it has so many times the text of all
# that is not marked, and so many words, links not counted.
_WRAPS = {MAYBE: (2, 0), LIKELY: (9, 50)}


def _mark(name: str, attributes: dict[str, str], in_main: bool) -> int | None:
    """Whether and how the container is marked as surrounding the article."""
    if "hidden" in attributes or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return HIDDEN
    role = attributes.get("role", "").lower()
    if (name in _AROUND and name not in ("form", "fieldset")) or (name == "header" and not in_main):
        return LIKELY
    if role in _ROLES and role not in ("form", "search"):
        return LIKELY
    named = _LAYOUT.sub(" ", " ".join(attributes.get(a, "") for a in ("class", "id")))
    hint = name not in ("article", "main") and bool(_HINT.search(named))
    if hint and _HINT.search(_WRAPPER.sub(" ", named)):
        return LIKELY
    return MAYBE if hint or role in _ROLES or name in ("form", "fieldset") else None


def _pairs(page: str, name: str) -> dict[int, int]:
    """Where elements of this name end, by where they start; those without an end tag are missing."""
    out, opened = {}, []
    for m in re.compile(rf"<(/?){name}(?![\w:-])", re.I).finditer(page):
        if m.group(1):
            if opened:
                out[opened.pop()] = page.find(">", m.end()) + 1 or len(page)
        elif not ((tag := _TAG.match(page, m.start())) and (tag.group(3) or "").rstrip().endswith("/")):
            opened.append(m.start())
    return out


def _after_raw(page: str, name: str, tag: re.Match, pairs: dict[str, dict[int, int]]) -> int:
    """Where the page goes on after an element of ``_RAW`` that starts with ``tag``. One without an end
    tag ends at the next tag, if markup can stand in it."""
    if name in _TO_THE_END:
        end = re.compile(rf"</{name}\s*>", re.I).search(page, tag.end())
        return end.end() if end else len(page)
    if name not in pairs:
        pairs[name] = _pairs(page, name)
    if tag.start() in pairs[name]:
        return pairs[name][tag.start()]
    following = _TAG.search(page, tag.end())
    return following.start() if following else len(page)


def _wrappers(marks: list[tuple[int, int]], direct: list[float], rest: float) -> list[bool]:
    """Which marked containers wrap the article. ``marks`` are (mark, next marked one around or -1), ``direct`` is how many words stand next below each, ``rest`` how many below none."""
    held = list(direct)
    inner: list[list[int]] = [[] for _ in marks]
    outer = []
    for k in range(len(marks) - 1, -1, -1):
        if (up := marks[k][1]) >= 0:
            held[up] += held[k]
            inner[up].append(k)
        else:
            outer.append(k)
    lifted = [False] * len(marks)
    queue = [(marks[k][0], -held[k], k) for k in outer]
    heapq.heapify(queue)
    while queue:
        mark, words, k = heapq.heappop(queue)
        if mark == HIDDEN:
            continue
        times, least = _WRAPS[mark]
        if -words > times * rest and -words >= least:
            lifted[k] = True
            rest += direct[k]
            for x in inner[k]:
                heapq.heappush(queue, (marks[x][0], -held[x], x))
    return lifted


def _kept_marks(marks: list[tuple[int, int]], at: int, name: str) -> int:
    """The innermost mark of those that hold for an article or main element below the mark ``at``: what
    is hidden stays so, and an article in an aside, a footer or a list of related ones is not the page's."""
    holds = (HIDDEN,) if name == "main" else (HIDDEN, LIKELY)
    around = []
    out = at
    while out >= 0:
        around.append(marks[out][0])
        out = marks[out][1]
    kept = [mark for mark in around if mark in holds]
    if len(kept) == len(around):
        return at
    for mark in reversed(kept):
        marks.append((mark, out))
        out = len(marks) - 1
    return out


def blocks(page: str) -> list[tuple[str, int, float, int, int]]:
    """Flat blocks in page order: text, words, link density, whether it stands in a container that
    surrounds the article, and whether in an article or main element.

    A container is marked by its element, role or name. An article or main element that stands in no
    other one ends the marks of wrappers around it, and so does the amount of text.
    """
    found: list[tuple[str, int, float, int, int]] = []
    marks: list[tuple[int, int]] = []  # of marked containers: how, and the next one around
    pairs: dict[str, dict[int, int]] = {}
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # name, innermost mark or -1, in main
    in_link = 0
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal parts, linked
        words = html.unescape("".join(parts)).split()
        if words:
            links = len(html.unescape(" ".join(linked)).split())
            mark, in_main = stack[-1][1:] if stack else (-1, False)
            found.append((" ".join(words), len(words), min(1.0, links / len(words)), mark, int(in_main)))
        parts, linked = [], []

    while at < n:
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else n]
        if text:
            parts.append(text)
            if in_link:
                linked.append(text)
        if not m:
            break
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        closing = bool(m.group(1))
        if name in _RAW:
            if not closing and not m.group(3).rstrip().endswith("/"):
                at = _after_raw(page, name, m, pairs)
            continue
        if name in _INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            elif name == "br":
                parts.append(" ")
            continue
        flush()
        if name not in _CONTAINERS and name not in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "blockquote", "pre", "dd", "dt"):
            continue
        in_link = 0
        if name not in _CONTAINERS:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
        else:
            attributes = {a.lower(): x or y or z or "" for a, x, y, z in _ATTRIBUTE.findall(m.group(3))} if m.group(3) else {}
            mark, in_main = stack[-1][1:] if stack else (-1, False)
            opens = name in ("article", "main") and not in_main
            if opens:
                mark = _kept_marks(marks, mark, name)
            if (own := _mark(name, attributes, in_main)) is not None:
                marks.append((own, mark))
                mark = len(marks) - 1
            stack.append((name, mark, in_main or opens))
    flush()
    direct, rest = [0.0] * len(marks), 0.0
    for _, words, links, mark, _ in found:
        if mark >= 0:
            direct[mark] += words * (1 - links)
        else:
            rest += words * (1 - links)
    around: list[int] = []  # whether the mark or one around it holds
    for (_, up), lifted in zip(marks, _wrappers(marks, direct, rest), strict=True):
        around.append(int(not lifted or (up >= 0 and around[up])))
    return [(text, words, links, around[mark] if mark >= 0 else 0, inside) for text, words, links, mark, inside in found]


# Labelled blocks: words, link density, words and link density of the block before and of the one
# after, in a surrounding container, in an article or main element; last whether it is main text.
LABELLED = np.array([
    # Paragraphs and headings of articles, long and short, also as the only block.
    (86, .00, 12, .00, 64, .00, 0, 1, 1), (64, .02, 86, .00, 41, .00, 0, 1, 1), (9, .00, 6, 1.0, 70, .00, 0, 1, 1),
    (1, .00, 55, .00, 38, .00, 0, 1, 1), (3, .00, 0, .00, 120, .00, 0, 1, 1), (210, .05, 8, .00, 15, .00, 0, 1, 1),
    (24, .25, 90, .00, 77, .00, 0, 1, 1), (5, .00, 4, .00, 6, .00, 0, 1, 1), (2, .00, 1, .00, 1, 1.0, 0, 1, 1),
    (47, .00, 1, 1.0, 9, .00, 0, 1, 1), (15, .00, 0, .00, 0, .00, 0, 1, 1), (33, .60, 40, .00, 52, .00, 0, 1, 1),
    (4, 1.0, 61, .00, 58, .00, 0, 1, 1), (12, .00, 9, .00, 14, 1.0, 0, 1, 1), (400, .00, 11, .00, 9, .00, 0, 1, 1),
    # Menus, adverts, notices, side columns, forms, comments and footers, also inside an article.
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0), (2, 1.0, 0, .00, 1, 1.0, 1, 0, 0), (6, .00, 1, 1.0, 12, .00, 1, 0, 0),
    (30, .00, 9, .00, 22, .00, 1, 0, 0), (18, .10, 75, .00, 0, .00, 1, 0, 0), (55, .00, 60, .00, 48, .00, 1, 1, 0),
    (8, .00, 90, .00, 70, .00, 1, 1, 0), (120, .00, 35, .00, 44, .00, 1, 0, 0), (14, .50, 3, 1.0, 3, 1.0, 1, 1, 0),
    (3, .00, 44, .00, 0, .00, 1, 0, 0), (70, .02, 64, .00, 50, .00, 1, 0, 0), (5, 1.0, 80, .00, 5, 1.0, 1, 1, 0),
    # Pages without such elements: long blocks with few links, and short ones between them, are text.
    (95, .00, 7, .00, 80, .00, 0, 0, 1), (60, .04, 95, .00, 3, 1.0, 0, 0, 1), (7, .00, 2, 1.0, 95, .00, 0, 0, 1),
    (18, .00, 60, .00, 72, .00, 0, 0, 1), (30, .00, 0, .00, 45, .00, 0, 0, 1), (9, .00, 88, .00, 40, .00, 0, 0, 1),
    (44, .10, 1, 1.0, 1, 1.0, 0, 0, 1), (25, .00, 25, .00, 25, .00, 0, 0, 1), (150, .00, 0, .00, 0, .00, 0, 0, 1),
    # There, link lists and short lines among link lists are not.
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0), (4, 1.0, 5, 1.0, 3, 1.0, 0, 0, 0), (3, .00, 2, 1.0, 2, 1.0, 0, 0, 0),
    (6, .90, 3, .00, 8, 1.0, 0, 0, 0), (20, .80, 2, 1.0, 4, 1.0, 0, 0, 0), (4, .00, 3, .00, 2, 1.0, 0, 0, 0),
    (5, .00, 6, 1.0, 0, .00, 0, 0, 0), (35, .85, 60, .00, 2, 1.0, 0, 0, 0), (8, 1.0, 90, .00, 6, 1.0, 0, 0, 0),
    (1, 1.0, 1, 1.0, 50, .00, 0, 0, 0), (3, 1.0, 2, 1.0, 80, .00, 0, 0, 0), (2, 1.0, 70, .00, 90, .00, 0, 0, 0),
    # Short lines with few links beside text, or among other such lines, are text: headings, list items,
    # table cells, one-line paragraphs.
    (1, .00, 45, .00, 60, .00, 0, 0, 1), (2, .00, 0, .00, 50, .00, 0, 0, 1), (3, .00, 2, 1.0, 70, .00, 0, 0, 1),
    (6, .00, 80, .00, 0, .00, 0, 0, 1), (4, .00, 64, .00, 2, 1.0, 0, 0, 1), (2, .00, 3, .00, 3, .00, 0, 0, 1),
    (1, .00, 1, .00, 2, .00, 0, 0, 1), (6, .00, 5, .00, 40, .00, 0, 0, 1), (3, .00, 52, .00, 4, .00, 0, 0, 1),
    (2, .00, 1, 1.0, 3, .00, 0, 0, 1), (5, .20, 33, .00, 28, .05, 0, 0, 1), (3, .00, 0, .00, 0, .00, 0, 0, 1),
    (1, .00, 20, .00, 1, 1.0, 0, 0, 1), (5, .00, 24, .00, 6, 1.0, 0, 0, 1), (4, .00, 3, .00, 0, .00, 0, 0, 1),
    # Captions of link lists and lines between them are not.
    (2, .00, 1, 1.0, 3, 1.0, 0, 0, 0), (1, .00, 4, 1.0, 1, 1.0, 0, 0, 0), (6, .00, 2, 1.0, 5, 1.0, 0, 0, 0),
    (3, .00, 0, .00, 1, 1.0, 0, 0, 0), (2, .00, 1, .00, 2, 1.0, 0, 0, 0), (4, .00, 1, 1.0, 0, .00, 0, 0, 0),
    (5, .00, 5, .90, 4, .80, 0, 0, 0), (2, .40, 3, 1.0, 2, 1.0, 0, 0, 0), (1, .00, 2, .00, 6, 1.0, 0, 0, 0),
    # Longer ones are text between any neighbours, and so is all in an article.
    (7, .00, 2, 1.0, 2, 1.0, 0, 0, 1), (8, .00, 1, 1.0, 0, .00, 0, 0, 1), (7, .00, 0, .00, 3, 1.0, 0, 0, 1),
    (9, .20, 3, .00, 1, 1.0, 0, 0, 1), (12, .00, 4, 1.0, 5, 1.0, 0, 0, 1), (20, .10, 2, .00, 6, 1.0, 0, 0, 1),
    (16, .60, 30, .00, 2, 1.0, 0, 0, 1), (11, .50, 40, .00, 35, .00, 0, 0, 1), (28, .65, 2, 1.0, 40, .00, 0, 0, 1),
    (10, .30, 1, 1.0, 1, .00, 0, 0, 1), (7, .00, 5, 1.0, 1, .00, 0, 0, 1), (14, .00, 2, 1.0, 0, .00, 0, 0, 1),
    (2, .00, 1, 1.0, 0, .00, 0, 1, 1), (3, .00, 2, 1.0, 4, 1.0, 0, 1, 1), (1, .00, 1, .00, 1, 1.0, 0, 1, 1),
    (2, 1.0, 5, .00, 2, 1.0, 0, 1, 1), (4, .50, 0, .00, 3, 1.0, 0, 1, 1), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 1),
    (6, 1.0, 20, .00, 30, .00, 0, 1, 1), (30, .90, 3, .00, 0, .00, 0, 1, 1), (8, .80, 2, 1.0, 9, .00, 0, 1, 1),
    (5, .00, 2, 1.0, 70, .00, 0, 0, 1), (4, .00, 3, 1.0, 9, .00, 0, 0, 1), (6, .00, 1, 1.0, 4, .00, 0, 0, 1),
    (6, .00, 4, 1.0, 30, .00, 0, 0, 1), (5, .00, 1, 1.0, 0, .00, 0, 1, 1), (4, .00, 6, 1.0, 1, .00, 0, 1, 1),
    # Outside one, blocks of links are none, between any neighbours.
    (4, 1.0, 40, .00, 35, .00, 0, 0, 0), (12, .75, 3, .00, 4, .00, 0, 0, 0), (7, 1.0, 0, .00, 0, .00, 0, 0, 0),
    (15, .90, 50, .00, 0, .00, 0, 0, 0), (5, .80, 2, .00, 60, .00, 0, 0, 0), (9, 1.0, 3, 1.0, 25, .00, 0, 0, 0),
    (40, .95, 80, .00, 70, .00, 0, 0, 0), (6, 1.0, 1, .00, 1, .00, 0, 0, 0), (22, 1.0, 30, .00, 3, 1.0, 0, 0, 0),
    (2, .00, 2, 1.0, 0, .00, 0, 0, 0), (3, .00, 5, 1.0, 0, .00, 0, 0, 0), (1, .00, 1, 1.0, 0, .00, 0, 0, 0),
    # Nor is what surrounds the article, inside it too.
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 1, 0), (3, 1.0, 2, .00, 4, 1.0, 1, 1, 0), (2, 1.0, 40, .00, 0, .00, 1, 1, 0),
    (6, .80, 0, .00, 9, .00, 1, 1, 0), (20, 1.0, 3, 1.0, 30, .00, 1, 1, 0), (4, .90, 12, .00, 7, .00, 1, 1, 0),
    (3, .00, 12, .00, 9, .00, 1, 1, 0), (40, .00, 30, .00, 60, .00, 1, 1, 0), (5, .00, 2, .00, 3, .00, 1, 0, 0),
    (25, .00, 6, .00, 7, .00, 1, 0, 0), (9, .00, 2, 1.0, 4, .00, 1, 0, 0), (60, .00, 0, .00, 80, .00, 1, 0, 0),
])


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> tuple:
    """A binary tree that splits at the largest drop of Gini impurity; ties go to the first feature
    and the lowest cut. A leaf is (share of label 1,), a node (feature, cut, left, right)."""
    if depth == 0 or y.min() == y.max():
        return (float(y.mean()),)
    best = None
    for f in range(x.shape[1]):
        for low, high in zip(values := np.unique(x[:, f]), values[1:], strict=False):
            left = y[x[:, f] <= (low + high) / 2]
            right = y[x[:, f] > (low + high) / 2]
            impurity = sum(len(p) * p.mean() * (1 - p.mean()) for p in (left, right))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, (low + high) / 2)
    if best is None:
        return (float(y.mean()),)
    _, f, cut = best
    side = x[:, f] <= cut
    return (f, cut, grow(x[side], y[side], depth - 1), grow(x[~side], y[~side], depth - 1))


TREE = grow(LABELLED[:, :-1], LABELLED[:, -1])


def is_main(row: tuple, tree: tuple = TREE) -> bool:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0] >= 0.5


def main_text(page: str, tree: tuple = TREE) -> str:
    """The blocks of the main text, joined by line feeds."""
    found = blocks(page)
    kept = []
    for k, (text, words, links, around, inside) in enumerate(found):
        before = found[k - 1][1:3] if k else (0, 0.0)
        after = found[k + 1][1:3] if k + 1 < len(found) else (0, 0.0)
        if is_main((words, links, *before, *after, around, inside), tree):
            kept.append((text, inside))
    # A page keeps to its articles if they have at least as much text as all outside them.
    inner = sum(len(text.split()) for text, inside in kept if inside)
    if inner and 2 * inner >= sum(len(text.split()) for text, _ in kept):
        kept = [x for x in kept if x[1]]
    return "\n".join(text for text, _ in kept)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per page: the ``keep`` columns and ``text``. A null, empty or text-free page has an
    empty text; a page cut off in a tag, comment or script loses just that. Rows are never merged."""
    keep_fields = [pages.schema[c] for c in keep]
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py() or "") for v in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*keep, "text"])

    schema = StructType([*keep_fields, StructField("text", StringType())])
    return pages.select(*keep, html_col).mapInArrow(run, schema)
