"""Main text of web pages by tag-path ratios (operator 1).

A page is cut into text nodes with their root-to-leaf tag path (tags and first classes). Each path
sums up text length and punctuation over all its nodes. Three measures, length a node, punctuation a
node and share of text outside links, are smoothed over neighbouring text nodes of the page, fused
into one weight and compared with a share of the page's mean. Paths below it go. Paths through
menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles go in
any case.

A page may mark its article. If that holds a fair share of the page's text, nothing else is taken, and inside it only what
is plainly no article goes: elements for other things, names for menus, adverts, sharing and reader
comments, and links in lists or in blocks next to each other. Its own header, single
linked blocks and sections of any other name stay.

Kept nodes become blocks at block tags; white space inside a block is one space. ``br`` ends no
block. Unclosed tags end with what holds them, a ``p`` with the next block tag. Null, empty and
text-less pages have an empty text. A page is held by one task as a whole.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: HTML's fixed sets of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre search section select summary table"
    " tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
CLOSES_P = BLOCK - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot"}

#: Elements, and words in class, id or role, that hold no main text.
NOT_CONTENT = frozenset(
    "head script style noscript template iframe object svg math canvas audio video nav header footer aside form button select"
    " textarea option menu dialog".split()
)
NOT_CONTENT_WORD = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|nav\w*|menu\w*|header|masthead|footer\w*|foot|side|sidebar\w*|"
    r"rail|widget\w*|cookie\w*|consent|gdpr|notice\w*|popup|modal|overlay|newsletter|subscri\w*|sign-?up|login|share|sharing|"
    r"social\w*|related|recommend\w*|breadcrumb\w*|crumbs?|pagination|pager|comment\w*|disqus|repl(?:y|ies)|discussion|skip\w*|toolbar|"
    r"search\w*|legal|copyright|disclaimer|contentinfo|navigation|complementary|tags|meta|byline)(?=$|[\s_-])",
    re.IGNORECASE,
)
#: The words that do so inside a marked article.
NOT_ARTICLE_WORD = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|nav\w*|menu\w*|sidebar\w*|widget\w*|cookie\w*|consent|gdpr|"
    r"popup|modal|overlay|newsletter|subscri\w*|sign-?up|login|share|sharing|social\w*|related|recommend\w*|breadcrumb\w*|pagination|"
    r"pager|comment\w*|disqus|repl(?:y|ies)|toolbar|navigation|complementary)(?=$|[\s_-])",
    re.IGNORECASE,
)
#: Layout words that say what stands beside the element, not in it.
WITH = re.compile(r"\b(?:has|with|without|no)[-_][\w-]+", re.IGNORECASE)
MARKED = frozenset(("article", "main"))
#: A marked article is taken for the page's if it has this share of the text that nothing bars.
FAIR_SHARE = 0.25

#: A quote opens a value only behind an equals sign.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*+)(?:>|\Z)",
    re.DOTALL,
)
NAMES = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
WHITE = re.compile(r"[\s\x00]+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")


@dataclass
class Element:
    tag: str
    path: int
    barred: bool
    marked: bool
    linked: bool


@dataclass
class Node:
    text: str
    path: int
    block: int
    barred: bool
    marked: bool
    linked: bool
    listed: bool  # in a list


@dataclass
class Path:
    nodes: int = 0
    chars: int = 0
    marks: int = 0
    linked: int = 0
    weight: float = 0.0
    at: list[int] = field(default_factory=list)


def opened(tag: str, attributes: str, parent: Element | None, paths: dict[tuple[int, str], int], in_article: bool) -> Element:
    """paths: numbers of the paths so far, by the number of the path above and the last step."""
    inside = parent.marked if parent else False
    names, barred = "", tag in NOT_CONTENT and not (in_article and tag == "header")
    words = NOT_ARTICLE_WORD if inside else NOT_CONTENT_WORD
    if attributes.strip():
        for name, value in NAMES.findall(attributes):
            name, value = name.lower(), WITH.sub(" ", value.strip("\"'"))
            if name in ("class", "id", "role"):
                barred |= bool(words.search(value)) and tag not in ("html", "body")
                if name == "class" and value:
                    names = "." + value.split()[0] if value.split() else ""
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                barred = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                barred = True
    return Element(
        tag,
        paths.setdefault((parent.path if parent else 0, tag + names), len(paths) + 1),
        barred or (parent.barred if parent else False),
        tag in MARKED or 'role="main"' in attributes or inside,
        tag == "a" or (parent.linked if parent else False),
    )


def text_nodes(page: str) -> list[Node]:
    """Text nodes in page order; nodes of one block have the same block number."""
    nodes: list[Node] = []
    stack: list[Element] = []
    held: Counter[str] = Counter()  # open elements by tag
    paths: dict[tuple[int, str], int] = {}
    block, at, end = 0, 0, len(page)

    def close_down_to(depth: int) -> None:
        while len(stack) > depth:
            held[stack.pop().tag] -= 1

    def text(piece: str) -> None:
        if piece:
            top = stack[-1] if stack else Element("", 0, False, False, False)
            nodes.append(Node(html.unescape(piece), top.path, block, top.barred, top.marked, top.linked, held["li"] > 0))

    while at < end:
        token = TOKEN.search(page, at)
        if not token:
            text(page[at:])
            break
        text(page[at : token.start()])
        at = token.end()
        if token[2] is None:
            if token[0].startswith("<![CDATA["):
                text(html.escape(token[0][9:-3] if token[0].endswith("]]>") else token[0][9:]))
            continue
        tag = token[2].lower()
        if tag in BLOCK:
            block += 1
        if token[1]:
            if held[tag]:
                while stack[-1].tag != tag:
                    close_down_to(len(stack) - 1)
                close_down_to(len(stack) - 1)
            continue
        if tag in CLOSES_P and held["p"]:
            # A paragraph ends here, with the inline elements still open in it. Blocks end paragraphs, so none is inside.
            depth = len(stack) - 1
            while stack[depth].tag not in BLOCK:
                depth -= 1
            if stack[depth].tag == "p":
                close_down_to(depth)
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1].tag == tag:
            close_down_to(len(stack) - 1)
        if tag in VOID:
            if tag == "br" and nodes:
                text(" ")
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = close.end() if close else end
            continue
        if not token[3].endswith("/"):
            stack.append(opened(tag, token[3], stack[-1] if stack else None, paths, held["article"] > 0))
            held[tag] += 1
    return nodes


def smoothed(values: np.ndarray, width: int = 1) -> np.ndarray:
    """Means over ``width`` neighbours on each side."""
    sums = np.concatenate([[0.0], np.cumsum(values)])
    low = np.maximum(0, np.arange(len(values)) - width)
    high = np.minimum(len(values), np.arange(len(values)) + width + 1)
    return (sums[high] - sums[low]) / (high - low)


def content_paths(nodes: list[Node], share: float) -> set[int]:
    """Paths that have weight, and at least a share of the page's mean."""
    paths: dict[int, Path] = defaultdict(Path)
    for k, node in enumerate(nodes):
        size = len(node.text.strip())
        if size:
            path = paths[node.path]
            path.nodes += 1
            path.chars += size
            path.marks += len(PUNCTUATION.findall(node.text))
            path.linked += size if node.linked else 0
            path.at.append(k)
    if not paths:
        return set()
    length, marks = np.zeros(len(nodes)), np.zeros(len(nodes))
    for path in paths.values():
        length[path.at] = path.chars / path.nodes
        marks[path.at] = path.marks / path.nodes
    filled = [k for path in paths.values() for k in path.at]
    filled.sort()
    length, marks = smoothed(length[filled]), smoothed(marks[filled])
    place = {k: i for i, k in enumerate(filled)}
    fused = np.sqrt(length * (1 + marks))
    for path in paths.values():
        path.weight = float(fused[[place[k] for k in path.at]].mean()) * (1 - path.linked / path.chars)
    total = sum(p.chars for p in paths.values())
    mean = sum(p.weight * p.chars for p in paths.values()) / total
    return {name for name, p in paths.items() if p.weight > 0 and p.weight >= share * mean}


def link_lists(nodes: list[Node]) -> set[int]:
    """Blocks of links only that are in a list or stand next to another such block."""
    plain, listed = {}, set()
    for x in nodes:
        if x.text.strip():
            plain[x.block] = plain.get(x.block, False) or not x.linked
            listed |= {x.block} if x.listed else set()
    order = sorted(plain)
    links = [False, *[not plain[k] for k in order], False]
    return {k for i, k in enumerate(order, 1) if links[i] and (k in listed or links[i - 1] or links[i + 1])}


def main_text(page: str | None, share: float = 0.2) -> str:
    """The blocks of a page's content nodes, joined by an empty line."""
    nodes = [x for x in text_nodes(page or "") if not x.barred]
    size = lambda some: sum(len(x.text.strip()) for x in some)
    marked = [x for x in nodes if x.marked]
    if 0 < size(marked) >= FAIR_SHARE * size(nodes):
        lists = link_lists(marked)
        kept = [x for x in marked if x.block not in lists]
    else:
        good = content_paths(nodes, share)
        in_text = {x.block for x in nodes if x.path in good and x.text.strip()}
        kept = [x for x in nodes if x.block in in_text]
    blocks: dict[int, list[str]] = defaultdict(list)
    for x in kept:
        blocks[x.block].append(x.text)
    joined = (WHITE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return "\n\n".join(x for x in joined if x)


def extract_main_text(pages: DataFrame, share: float = 0.2) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text``, ``n_chars``. Other columns are not read."""

    def extracted(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in frames:
            yield column.map(lambda page: main_text(page, share), na_action=None).astype(object)

    text = F.pandas_udf(extracted, "string")
    return pages.select("page_id", "url", text(F.col("html")).alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
