"""Main text of web pages by tag-path ratios.

A page is cut into blocks, each with the tag path from the root to it. Text length,
punctuation and link text are summed per path; length and punctuation per block, damped by
the share of link text, are smoothed over neighbouring paths of the page and fused into one
score. Paths are chosen by thresholds: their blocks score well against the text of the page,
or hold a good share of its score together. The text is all blocks of chosen paths and what
belongs to them: the whole article or main element around one, other text between two of
them or in the element that holds one, paragraphs beside one or beside what is around it, and
headings before one. Subtrees whose tag makes them page furniture are left out first; so are
those with a name of furniture in class, id or role, unless they hold the article or, without
one, most of the text; and comments by their heading.

Pages are independent: one pass, no shuffle. A null or empty page has an empty text,
broken or unclosed markup is read as far as it goes, repeated rows are repeated, other
columns are not read, and an empty table gives an empty table.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SHARE = 0.3  # of the score of typical text that a block of a chosen path must have, or
PATH_SHARE = 0.1  # of the page's score that all blocks of a chosen path must hold
SPREAD = 1.0  # of the smoothing over neighbouring paths, in paths

# What HTML itself says about its elements.
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas")
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "label",
}
# An opening tag closes an open one of these, up to the container that holds both.
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "option": {"option"},
}
FURNITURE = {
    "head", "nav", "footer", "aside", "form", "button", "select", "textarea", "dialog", "menu",
}
TOP = {"", "html", "body"}  # hold everything, furniture without a name, too
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
TEXT = HEADINGS | {"p", "pre", "blockquote", "li", "dt", "dd", "figcaption", "caption"}
# Names of page furniture, in class, id or role. A word of these is a plain name; a word with one
# of them as a part (``site-header``) is a hint. Inside an article, where names of content look
# alike (``share-price``, ``related-work``), only some hints count and a header is the article's.
COMMENT_NAMES = {"comment", "comments", "disqus", "reply", "replies", "respond"}
SURE_NAMES = COMMENT_NAMES | {
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored",
    "newsletter", "social", "cookie", "cookies",
}
HEADER_NAMES = {"header", "masthead"}
NAMES = SURE_NAMES | HEADER_NAMES | {
    "promo", "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb",
    "breadcrumbs", "footer", "sidebar", "side-bar", "widget", "consent", "notice", "popup",
    "modal", "overlay", "share", "sharing", "related", "recommended", "subscribe", "signup",
    "login", "search", "pagination", "pager", "contentinfo", "complementary", "hidden",
}
LARGE = 0.5  # of a page without an article: a named part that holds as much is its content
DEEPEST = 512  # elements in each other that are told apart, as in browsers

_OPEN = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
# A quote opens a value only after an equals sign.
_ATTRIBUTES = re.compile(r"((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_HIDDEN = re.compile(r"\shidden(?:\s|=|$)|display\s*:\s*none|\sdata-ads?(?:-|\s|=|$)", re.IGNORECASE)
_COMMENTS = re.compile(
    r"(?:\d+\s+|reader\s+|user\s+|leave\s+a\s+|post\s+a\s+)*comments?(?:\s*\(\d+\))?\W*", re.IGNORECASE
)
_MARKS = re.compile(r"[.,;:!?…。、،؟।]")


class _Node:
    """An element. ``furniture`` is sure by its tag, ``plain`` and ``hints`` are its names."""

    __slots__ = ("furniture", "hints", "holds", "inside", "parent", "path", "plain", "tag")

    def __init__(self, tag: str, parent: _Node | None, path: int, attributes: str = ""):
        self.tag, self.parent, self.path = tag, parent, path
        self.plain, self.hints = _names(tag, attributes)
        comment = bool(self.plain & COMMENT_NAMES)
        above = parent.inside if parent else False
        # In an article or main element; ``holds`` says that one is below.
        self.inside = above or (tag in ("article", "main") and not comment)
        self.holds = False
        if self.inside and not above:
            for node in _above(parent):
                if node.holds:
                    break
                node.holds = True
        self.furniture = bool(parent and parent.furniture) or (
            tag in FURNITURE
            or (tag == "header" and not above)
            or (bool(attributes) and tag not in ("html", "body") and bool(_HIDDEN.search(attributes)))
        )


def _names(tag: str, attributes: str) -> tuple[set[str], set[str]]:
    """The names of furniture that an element has, and those that are parts of its names."""
    if not attributes or tag in ("html", "body"):
        return set(), set()
    words = {w for m in _NAMED.findall(attributes.lower()) for w in m.strip("\"' ").split()}
    parts = {part for word in words for part in re.split("[-_]", word)}
    return words & NAMES, parts & NAMES


def _tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Tags in order: start, end, whether it closes, name, attributes. Comments, declarations
    and raw elements have no name.

    Each character is looked at a bounded number of times. A tag that its quotes leave open
    ends at the next ``>``, as do all after it; what has none is left out to the end.
    """
    at, quotes = 0, True
    while (m := _OPEN.search(page, at)) is not None:
        start = m.start()
        if m[2] is None:
            stop = {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0], ">")
            end = page.find(stop, m.end())
            at = len(page) if end < 0 else end + len(stop)
            yield start, at, False, "", ""
            continue
        rest = _ATTRIBUTES.match(page, m.end()) if quotes else None
        if rest is not None:
            attributes, at = rest[1], rest.end()
        else:
            quotes = False
            end = page.find(">", m.end())
            if end < 0:
                yield start, len(page), False, "", ""
                return
            attributes, at = page[m.end() : end], end + 1
        tag = m[2].lower()
        if tag in _RAW_END and not m[1]:
            closed = _RAW_END[tag].search(page, at)
            at = closed.end() if closed else len(page)
            yield start, at, False, "", ""
        else:
            yield start, at, bool(m[1]), tag, attributes


def blocks(page: str) -> Iterator[tuple[_Node, str, int]]:
    """Blocks in page order: their node, their text, and how much of it is link text."""
    paths: dict[tuple[int, str], int] = {}  # a tag path is its last tag and the path before
    stack = [_Node("", None, 0)]
    parts: list[str] = []
    links = inside_link = 0
    at = 0

    def flush():
        nonlocal links
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        found, links = (stack[-1], text, min(links, len(text))), 0
        return found if text else None

    for start, end, closing, tag, attributes in _tags(page):
        if start > at:
            parts.append(page[at:start])
            links += inside_link and start - at
        at = end
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
        if tag in INLINE:
            if tag == "a":
                inside_link = int(not closing)
            if not (attributes and not closing and tag == "span" and _HIDDEN.search(attributes)):
                continue
        if tag in VOID and tag != "hr":
            continue
        if block := flush():
            yield block
        inside_link = 0
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag == "hr" or attributes.rstrip().endswith("/"):
            continue
        if stack[-1].tag in CLOSES.get(tag, {"p"}):
            stack.pop()
            while stack[-1].tag in CLOSES.get(tag, ()):
                stack.pop()
        if len(stack) > DEEPEST:
            stack.pop()
        above = stack[-1]
        path = paths.setdefault((above.path, tag), len(paths) + 1)
        stack.append(_Node(tag, above, path, attributes))
    parts.append(page[at:])
    if block := flush():
        yield block


def _scores(found: list[tuple[_Node, str, int]]) -> dict[int, tuple[float, float]]:
    """Score of a block of each tag path, in page order, and of all its blocks together."""
    sums: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0, 0.0])
    for node, text, linked in found:
        own = sums[node.path]
        for k, x in enumerate((len(text), len(_MARKS.findall(text)), linked, 1)):
            own[k] += x
    raw = []
    for length, marks, linked, n in sums.values():
        text_ratio, mark_ratio = length / n, marks / n
        raw.append((1 - linked / length) * math.sqrt(text_ratio * (1 + mark_ratio)))
    kernel = [math.exp(-(d**2) / (2 * SPREAD**2)) for d in range(3)]
    smooth = {}
    for k, (path, own) in enumerate(sums.items()):
        near = range(max(0, k - 2), min(len(raw), k + 3))
        weight = [kernel[abs(k - j)] for j in near]
        mean = sum(w * raw[j] for w, j in zip(weight, near, strict=True)) / sum(weight)
        smooth[path] = (math.sqrt(raw[k] * mean), math.sqrt(raw[k] * mean) * own[3])
    return smooth


def _chosen(found: list[tuple[_Node, str, int]]) -> list[bool]:
    """Whether the tag path of each block scores high enough, by the block or all together."""
    by_path = _scores(found)
    letters = sum(len(text) for _, text, _ in found)
    typical = sum(by_path[node.path][0] * len(text) for node, text, _ in found) / letters
    total = sum(together for _, together in by_path.values())
    if not total:
        return [True] * len(found)  # nothing but links
    high = {
        path
        for path, (each, together) in by_path.items()
        if each >= SHARE * typical or together >= PATH_SHARE * total
    }
    return [node.path in high for node, _, _ in found]


def _above(node: _Node | None) -> Iterator[_Node]:
    while node is not None:
        yield node
        node = node.parent


def _named_furniture(found: list[tuple[_Node, str, int]]) -> set[_Node]:
    """Elements that their names make furniture.

    A name around an article says nothing about it. Outside of one, where there is one, any
    name counts; without one, names count for parts that hold little of the text. Inside,
    plain names count but a header's, and of hints the sure ones.
    """
    sizes: dict[_Node, int] = defaultdict(int)
    for node, text, _ in found:
        for above in _above(node):
            if above.hints or above.plain:
                sizes[above] += len(text)
    letters = sum(len(text) for _, text, _ in found)
    article = any(node.inside for node, _, _ in found)
    gone = set()
    for node, size in sizes.items():
        comment = node.tag in ("article", "main")
        if node.holds:
            continue
        if comment:
            named = bool(node.plain & COMMENT_NAMES)
        elif node.inside:
            named = bool(node.plain - HEADER_NAMES or node.hints & SURE_NAMES)
            named = named and size < LARGE * letters
        else:
            named = article or size < LARGE * letters
        if named:
            gone.add(node)
    return gone


def _without_comments(found: list[tuple[_Node, str, int]]) -> list[tuple[_Node, str, int]]:
    """The blocks without parts that a heading calls comments: the element that holds the
    heading, or, where that is the article or the page, what follows in it."""
    around: dict[_Node, int] = {}  # of the first heading in each
    for k, (node, text, _) in enumerate(found):
        if node.tag in HEADINGS and len(text) <= 60 and _COMMENTS.fullmatch(text):
            around.setdefault(node.parent, k)
    sizes: dict[_Node, int] = defaultdict(int)
    for node, text, _ in found if around else ():
        for above in _above(node):
            if above in around:
                sizes[above] += len(text)
    letters = sum(len(text) for _, text, _ in found)
    gone, after = set(), {}
    for holder, k in around.items():
        if holder.tag in TOP or holder.tag in ("article", "main") or holder.holds:
            after[holder] = k
        elif sizes[holder] < LARGE * letters:
            gone.add(holder)
    if not gone and not after:
        return found
    return [
        (node, text, linked)
        for k, (node, text, linked) in enumerate(found)
        if not any(n in gone or after.get(n, k + 1) <= k for n in _above(node))
    ]


def main_text(page: str) -> str:
    """The blocks of the chosen tag paths and what belongs to them, one per line."""
    found = [b for b in blocks(page) if not b[0].furniture]
    named = _named_furniture(found)
    if named:
        found = [b for b in found if not any(n in named for n in _above(b[0]))]
    found = _without_comments(found)
    if not found:
        return ""
    chosen = _chosen(found)
    articles: set[_Node] = set()
    containers: set[_Node] = set()
    around: set[_Node] = set()
    for (node, _, _), high in zip(found, chosen, strict=True):
        if high:
            articles.update(n for n in _above(node) if n.tag in ("article", "main"))
            around.update(_above(node.parent))
            if node.parent is not None and node.parent.tag not in TOP:
                containers.add(node.parent)
    # A main element around an article may hold more than the text.
    articles -= {n for a in articles if a.tag == "article" for n in _above(a.parent) if n.tag == "main"}
    first = chosen.index(True)
    kept: list[str] = []
    after: set[_Node] = set()  # the next chosen block and all around it
    for k in range(len(found) - 1, -1, -1):
        node, text, linked = found[k]
        if chosen[k]:
            after = set(_above(node))
            kept.append(text)
            continue
        inside = set(_above(node))
        between = k > first and bool(after)
        beside = node.tag in TEXT and node.parent in around
        if (
            inside & articles
            or (node.tag in HEADINGS and node.parent in after)
            or (linked <= len(text) / 2 and (between or beside or inside & containers))
        ):
            kept.append(text)
    return "\n".join(reversed(kept))


def extract(pages: DataFrame) -> DataFrame:
    """Text and its length for each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py() or "") for p in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    schema = "page_id bigint, url string, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
