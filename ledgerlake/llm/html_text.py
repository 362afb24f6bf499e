"""Main text of web pages by a minimum cut between content and boilerplate.

A page is cut into blocks of text. Each block gets a log-odds of being content from its tags, names,
links and text, by a classifier that learns from pages that mark their article. The odds are capacities from the source or to the sink; blocks next to each other,
and next children of one element, are joined by edges. The cheapest cut that parts source from sink
labels all blocks at once: a short line keeps the label of its surroundings.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of raw text; they and comments run to the end of the page if they are not closed.
_RAW = "script style textarea title iframe".split()
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I) for name in _RAW}
_TAG = re.compile(
    r"<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<rest>(?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|(?P<plain></?[a-z][^>]*+>)|<!--|<[!?/][^>]*+>",
    re.S | re.I,
)
_UNQUOTED = re.compile(
    r"<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<rest>[^>]*+)>|(?P<plain></?[a-z][^>]*+>)|<!--|<[!?/][^>]*+>", re.S | re.I
)
# Tags whose quotes never close, after which quotes count no more in a page.
MOST_OPEN_QUOTES = 16
# Elements that are left out with all they hold if they are closed, those of them that cannot be
# inside their like, and elements whose end closes those inside.
_HIDDEN = frozenset("noscript template select svg object canvas audio video".split())
_SINGLE = frozenset("noscript select audio video".split())
_NESTED = _HIDDEN | {"article", "main", "body"}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output picture"
    " progress q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split()
)
_LINE = frozenset("p br hr h1 h2 h3 h4 h5 h6 pre dt dd tr td th thead tbody tfoot caption input embed area link meta base col".split())
_BOILER_TAGS = frozenset("nav header footer aside form menu dialog button fieldset".split())
_CONTENT_TAGS = frozenset(["article", "main"])
_BOILER_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|adsense|banner|promo(?:tion)?s?|sponsor(?:ed|s)?|nav(?:bar|igation)?"
    r"|menus?|footer|header|masthead|side-?bar|aside|cookies?|consent|gdpr|notices?|alert|pop-?up|modal|overlay|newsletter"
    r"|subscribe|subscription|sign-?up|log-?in|share|sharing|social|related|recommend(?:ed|ations)?|trending|more-?from"
    r"|bread-?crumbs?|pagination|pager|comments?|replies|reply|respond|discussion|disqus|widgets?|toolbar|search|forms?"
    r"|complementary|contentinfo|copyright|legal|disclaimer|skip(?:-?link)?|outbrain|taboola)(?:$|[\s_-]|\d)",
    re.I,
)
_CONTENT_NAME = re.compile(
    r"(?:^|[\s_-])(?:article|content|post|entry|story|main|text|body)(?:$|[\s_-])", re.I
)
# Names of elements that hold articles of their own, such as comments and teasers.
_OTHERS_NAME = re.compile(
    r"(?:^|[\s_-])(?:related|recommend(?:ed|ations)?|trending|more-?from|comments?|replies|reply|respond|discussion|disqus"
    r"|widgets?|promo(?:tion)?s?|sponsor(?:ed|s)?|outbrain|taboola)(?:$|[\s_-]|\d)",
    re.I,
)
_STATE_NAME = re.compile(r"(?<![^\s])(?:has|no|with|without|hide|show)[-_]\S+", re.I)
_WRAPPER_TAGS = frozenset(["form", "fieldset"])
# What the marks of an element add to the log-odds of its blocks, and what it takes from all blocks
# of a page that some are marked.
CONTENT_TAG, CONTENT_NAME, MARKED = 6.0, 2.0, -1.5
PER_CHAR, MOST_CHARS = 1 / 60, 2.5


class Weights(NamedTuple):
    """Weights of the classifier: log-odds of any block, of boilerplate elements around it (two at
    most count), its share of links, its length and its end of a sentence. The values here are what
    holds before any page is seen; `fit` moves them."""

    base: float = 0.5
    boiler: float = -9.0
    links: float = -4.0
    size: float = 1.0
    sentence: float = 0.5


PRIOR = Weights()
# Pages that the classifier is fitted to, blocks of one page, and how far the weights may move: the
# variance around `PRIOR`.
SAMPLE_PAGES, PAGE_BLOCKS, VARIANCE = 2000, 200, 0.25
NEXT_INSIDE, NEXT_ACROSS, SIBLING = 0.7, 0.3, 0.5


class Block(NamedTuple):
    """`marked` is the log-odds by content elements, `signs` what `Weights` weigh."""

    text: str
    parent: int
    marked: float
    signs: tuple[float, ...]


class _Element(NamedTuple):
    name: str
    number: int
    above: int
    names: str


def _scan(html: str) -> Iterator[tuple[int, int, re.Match | None]]:
    """Begin, end and match of each tag in one forward pass; a comment and an element of raw text are
    one tag without a match. No tag begins behind the last `>`, but a comment may."""
    last, at, pattern, open_quotes = html.rfind(">") + 1, 0, _TAG, 0
    while tag := pattern.search(html, at, last):
        begin, at = tag.span()
        if tag["name"]:
            name = tag["name"].lower()
            if name not in _RAW_END or tag["end"]:
                yield begin, at, tag
                continue
            if not tag["rest"].endswith("/"):
                closed = _RAW_END[name].search(html, at, last)
                at = closed.end() if closed else len(html)
        elif tag["plain"]:
            open_quotes += 1
            if open_quotes > MOST_OPEN_QUOTES:
                pattern = _UNQUOTED
        elif html.startswith("<!--", begin):
            at = html.find("-->", at) + 3
            if at < 3:
                at = len(html)
        yield begin, at, None
    tail = html.find("<!--", max(at, last))
    if tail >= 0:
        yield tail, len(html), None


def hidden(html: str) -> dict[int, int]:
    """Where closed elements that are left out begin and end. The end of an element around it, or
    the start of its like if they cannot nest, tells that one is not closed."""
    found: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for begin, end, tag in _scan(html):
        name = tag["name"].lower() if tag else ""
        if name not in _NESTED:
            continue
        own = opened.setdefault(name, [])
        if not tag["end"]:
            if name in _SINGLE:
                own.clear()
            if not tag["rest"].endswith("/"):
                own.append(begin)
        elif own:
            start = own.pop()
            for other in opened.values():
                while other and other[-1] > start:
                    other.pop()
            if name in _HIDDEN:
                found[start] = end
    return found


def _tags(html: str) -> Iterator[tuple[int, int, re.Match | None]]:
    """As `_scan`, where a hidden element is one tag without a match too."""
    skipped, at = hidden(html), 0
    for begin, end, tag in _scan(html):
        if begin >= at:
            at = skipped.get(begin, end)
            yield begin, at, None if begin in skipped else tag


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in order. Character references are decoded, white space is one blank."""
    found: list[tuple[str, int, float]] = []  # text, element, share of links
    elements = [_Element("", 0, 0, "")]
    stack = elements[:]
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked = link_depth = at = 0

    def close() -> None:
        nonlocal linked
        raw = "".join(parts)
        parts.clear()
        text = " ".join((unescape(raw) if "&" in raw else raw).split())
        if text:
            found.append((text, stack[-1].number, min(1.0, linked / len(text))))
        linked = 0

    for begin, end, tag in _tags(html):
        if begin > at:
            parts.append(html[at:begin])
            if link_depth:
                linked += begin - at
        at = end
        if tag is None:
            continue
        name, ends = tag["name"].lower(), bool(tag["end"])
        if name in _HIDDEN:
            continue
        if name == "a":
            link_depth = 0 if ends else 1
        if name in _INLINE:
            continue
        close()
        if name in _LINE:
            link_depth = 0
            continue
        if ends:
            while opened[name]:
                closed = stack.pop().name
                opened[closed] -= 1
                if closed == name:
                    break
            continue
        if name == "li" and stack[-1].name == "li":
            opened[stack.pop().name] -= 1
        rest = tag["rest"]
        names = " ".join("".join(found) for found in _NAMES.findall(rest)) if "=" in rest else ""
        elements.append(_Element(name, len(elements), stack[-1].number, names))
        if not rest.endswith("/"):
            stack.append(elements[-1])
            opened[name] += 1
    if at < len(html):
        parts.append(html[at:])
    close()
    sizes = [0] * len(elements)
    for text, number, _ in found:
        sizes[number] += len(text)
    wrappers, inside = _wrappers(elements, sizes), [(0.0, 0)]
    for element in elements[1:]:
        inside.append(_inside(element, *inside[element.above], element.number in wrappers))
    blocks = []
    for text, number, share in found:
        content, boiler = inside[number]
        size = min(MOST_CHARS, len(text) * (1 - share) * PER_CHAR)
        signs = (1.0, float(min(boiler, 2)), share, size, float(text[-1] in ".!?…:;\"”"))
        blocks.append(Block(text, number, content, signs))
    return blocks


def odds_of(blocks: list[Block], weights: Weights = PRIOR) -> list[float]:
    """Log-odds of being content. In a page that marks no content an unmarked block is likelier to be."""
    page = MARKED if any(b.marked for b in blocks) else 0.0
    return [page + b.marked + sum(w * x for w, x in zip(weights, b.signs, strict=True)) for b in blocks]


def _wrappers(elements: list[_Element], sizes: list[int]) -> set[int]:
    """Elements around the longest article or main, whose own tag and names tell nothing about what
    they hold, and those like them that hold one too. A wrapper that is named for something else
    (an aside, comments, teasers) has to hold most of the page's text. `sizes` has the characters
    right inside each element."""
    if not any(e.name in _CONTENT_TAGS for e in elements):
        return set()
    sizes, holds = sizes[:], [False] * len(elements)
    for e in reversed(elements[1:]):
        sizes[e.above] += sizes[e.number]
        holds[e.above] |= holds[e.number] or e.name in _CONTENT_TAGS
    found: set[int] = set()
    for name in _CONTENT_TAGS:
        own = [e for e in elements if e.name == name]
        at = elements[max(own, key=lambda e: sizes[e.number]).above].number if own else 0
        while at:
            e = elements[at]
            other = e.name in _BOILER_TAGS - _WRAPPER_TAGS or _OTHERS_NAME.search(_STATE_NAME.sub("", e.names))
            if not other or 2 * sizes[at] > sizes[0]:
                found.add(at)
            at = e.above
    like = {(elements[i].name, elements[i].names) for i in found}
    return found | {e.number for e in elements if holds[e.number] and (e.name, e.names) in like}


def _inside(element: _Element, content: float, boiler: int, wrapper: bool) -> tuple[float, int]:
    """Content and boilerplate of an element, from those of the one around it."""
    name, names = element.name, element.names
    if name in ("html", "body"):
        return content, boiler
    if name in _CONTENT_TAGS:
        return CONTENT_TAG, boiler + (bool(_BOILER_NAME.search(names)) and "comment" in names.lower() and not wrapper)
    named = bool(names and _BOILER_NAME.search(names))
    if names and _CONTENT_NAME.search(names) and name not in _BOILER_TAGS and not named:
        return max(content, CONTENT_NAME), boiler
    if wrapper:
        return content, boiler
    own = name in _BOILER_TAGS and not (name == "header" and content >= CONTENT_TAG)
    return content, boiler + (own or named)


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Neighbours in the page, and in the element they are in."""
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            inside = block.parent == blocks[i - 1].parent
            edges.append((i - 1, i, NEXT_INSIDE if inside else NEXT_ACROSS))
        if last.get(block.parent, i - 1) != i - 1:
            edges.append((last[block.parent], i, SIBLING))
        last[block.parent] = i
    return edges


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut; a node at odds of zero that no edge
    pulls is on the sink's side.

    A node whose own capacity is over that of all its edges is on the side of its capacity, which
    then pulls its neighbours; that settles most nodes. Maximum flow settles the rest.
    """
    near: list[list[tuple[int, float]]] = [[] for _ in odds]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    pull, left = list(odds), [sum(w for _, w in n) for n in near]
    side: list[bool | None] = [None] * len(odds)
    waiting = deque(range(len(odds)))
    while waiting:
        i = waiting.popleft()
        if side[i] is None and abs(pull[i]) > left[i]:
            side[i] = pull[i] > 0
            for j, w in near[i]:
                if side[j] is None:
                    pull[j] += w if side[i] else -w
                    left[j] -= w
                    waiting.append(j)
    rest = [i for i, s in enumerate(side) if s is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        inner = [(place[a], place[b], w) for a, b, w in edges if side[a] is None and side[b] is None]
        for i, own in zip(rest, _max_flow_side([pull[i] for i in rest], inner), strict=True):
            side[i] = own
    return [bool(s) for s in side]


def _max_flow_side(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Dinic's algorithm; the nodes that the source still reaches."""
    n = len(odds)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def join(a: int, b: int, forth: float, back: float) -> None:
        for x, y, w in ((a, b, forth), (b, a, back)):
            graph[x].append(len(to))
            to.append(y)
            room.append(w)

    for i, w in enumerate(odds):
        join(source, i, max(w, 0.0), 0.0) if w > 0 else join(i, sink, max(-w, 0.0), 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            x = queue.popleft()
            for e in graph[x]:
                if room[e] > 1e-9 and to[e] not in level:
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        if sink not in level:
            return [i in level for i in range(n)]
        following = [0] * (n + 2)
        path: list[int] = []
        x = source
        while True:
            if x == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                x = to[path[cut] ^ 1]
                del path[cut:]
            while following[x] < len(graph[x]):
                e = graph[x][following[x]]
                if room[e] > 1e-9 and level.get(to[e]) == level[x] + 1:
                    break
                following[x] += 1
            if following[x] < len(graph[x]):
                path.append(e)
                x = to[e]
            elif path:
                x = to[path.pop() ^ 1]
                following[x] += 1
            else:
                break


def main_text(html: str | None, weights: Weights = PRIOR) -> str:
    blocks = blocks_of(html or "")
    content = minimum_cut(odds_of(blocks, weights), edges_of(blocks))
    return " ".join(b.text for b, own in zip(blocks, content, strict=True) if own)


def labelled_blocks(html: str | None) -> Iterator[tuple[int, tuple[float, ...]]]:
    """(label, signs) of blocks of a page that has an article or main: content is what it holds, and
    boilerplate all else. Marked boilerplate inside it tells nothing. Of a page with more than
    `PAGE_BLOCKS` blocks evenly spaced ones are taken."""
    blocks = blocks_of(html or "")
    if any(b.marked >= CONTENT_TAG for b in blocks):
        for b in blocks[:: -(-len(blocks) // PAGE_BLOCKS)]:
            inside = b.marked >= CONTENT_TAG
            if not inside or not b.signs[1]:
                yield int(inside), b.signs


def most_likely(x: np.ndarray, y: np.ndarray, count: np.ndarray, prior: Weights = PRIOR) -> Weights:
    """The weights of a logistic classifier, normally distributed around `prior` with `VARIANCE`,
    that are likeliest after rows `x` with labels `y`. Both labels count alike, as 200 rows each."""
    start = np.array(prior)
    total = np.array([count[y == label].sum() for label in (0, 1)])
    if not total.all():
        return prior
    count = count * 200 / total[y]
    w = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (count * (y - p)) - (w - start) / VARIANCE
        step = np.linalg.solve((x * (count * p * (1 - p))[:, None]).T @ x + np.eye(len(w)) / VARIANCE, slope)
        w += step * min(1.0, 1 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return Weights(*w.tolist())


def fit(pages: DataFrame, html_col: str = "html") -> Weights:
    """The weights learnt from pages that label their own blocks by an article or main, at most
    `SAMPLE_PAGES` of them chosen by the hash of their html; `PRIOR` if there are none."""
    rows = pages.select(F.col(html_col).cast("string").alias("html")).where(F.lower("html").rlike("<(article|main)[\\s/>]"))
    sample = rows.groupBy(F.xxhash64("html").alias("h")).agg(F.lit(1).alias("one")).orderBy("h").limit(SAMPLE_PAGES)
    rows = rows.withColumn("h", F.xxhash64("html")).join(F.broadcast(sample), "h", "left_semi").groupBy("h")
    rows = rows.agg(F.min("html").alias("html"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found = Counter(b for cell in batch.column(0) for b in labelled_blocks(cell.as_py()))
            y, x = zip(*found, strict=True) if found else ((), ())
            arrays = [pa.array(y, pa.int32()), pa.array(x, pa.list_(pa.float64())), pa.array(found.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["y", "x", "n"])

    found = rows.select("html").mapInArrow(batches, "y int, x array<double>, n long")
    found = found.groupBy("y", "x").agg(F.sum("n").alias("n")).orderBy("y", "x").collect()
    if not found:
        return PRIOR
    y, x, n = (np.array([r[c] for r in found]) for c in ("y", "x", "n"))
    return most_likely(x, y, n.astype(float))


def extract(pages: DataFrame, keep: list[str], html_col: str = "html", weights: Weights = PRIOR) -> DataFrame:
    """Each row of `pages`: the columns `keep` as a struct `row`, the main `text`, and `n_chars`, its
    code points. A null or empty page and one of nothing but boilerplate have an empty text.
    Very long pages are taken whole, in time that grows with their length. `keep` may name any column. Repeated rows stay; an empty table
    gives no rows."""
    rows = pages.select(
        F.col(html_col).cast("string").alias("html"), F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row")
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found = [main_text(cell.as_py(), weights) for cell in batch.column(0)]
            arrays = [batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "text", "n_chars"])

    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(batches, f"row {row}, text string, n_chars long")
