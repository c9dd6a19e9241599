"""HTML extraction (5): content and boilerplate blocks apart by a minimum cut.

A page is parsed into blocks: runs of text between boundaries of block elements. Signs of content or boilerplate (elements and
class names around a block, density of links, length) add up to a cost; its absolute value is the capacity between the block
and the source (content) or the sink (boilerplate). Neighbouring blocks, and blocks with the same parent, are tied by
capacities that fall with their distance in the tree. The minimum cut gives the labelling of least total cost.

Character references are decoded, white space inside a block becomes one space, blocks are joined by line feeds in page order. Null,
empty and text-free pages give the empty text. Repeated rows give a row each, an empty table an empty result. Markup may be
broken: what cannot be a tag is text, open elements end with the page. Only page_id, url and html are read.
"""

from __future__ import annotations

import html
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from speedloom.llm.common import slices, strings

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WHITE = re.compile(r"\s+")
#: Elements whose inside is not text of the page.
RAW = frozenset("script style template iframe svg textarea noscript object math canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that end an open one of the same group.
CLOSES = {"p": ("p",), "li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table article section main div body td th tr nav aside header footer form select blockquote".split())
#: Signs in the elements around a block: of boilerplate (below 0) and of content.
ELEMENTS = {"nav": -8, "footer": -8, "aside": -8, "form": -8, "button": -8, "select": -8, "dialog": -8, "menu": -8, "header": -8, "head": -99, "title": -99, "fieldset": -6, "label": -4, "article": 4, "main": 3, "p": 0.5, "h1": 0.5, "blockquote": 0.5, "pre": 0.5}
BAD_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs byline captcha comment comments consent cookie cookies disqus footer gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination paywall popup promo promoted recommended related reply replies respond rss share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar widget".split()
)
GOOD_NAMES = frozenset("article articlebody body content entry main post story text".split())
NAME, GOOD_NAME, HIDDEN = -8.0, 2.0, -99.0
#: Cost of a block without signs; per word up to WORDS; of a block that is all links.
PLAIN, PER_WORD, WORDS, LINKS = -1.5, 0.12, 25, -5.0
#: Capacity between neighbouring blocks, divided by one more than their distance in the tree; and of blocks one apart under one parent.
ADJACENT, PARENT = 2.0, 0.75
UNIT = 1000


class Element:
    __slots__ = ("tag", "parent", "depth", "bad", "good", "link", "in_content")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        own = ELEMENTS.get(tag, 0)
        if tag == "header" and parent and parent.in_content:
            own = 0  # the heading of the article itself
        bad, good = min(own, 0), max(own, 0)
        if attributes:
            for m in ATTRIBUTE.finditer(attributes):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name in ("class", "id", "role", "itemprop"):
                    names = set(re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()))
                    if names & BAD_NAMES and tag not in ("body", "html"):
                        bad = min(bad, NAME)
                    elif names & GOOD_NAMES:
                        good = max(good, GOOD_NAME)
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                    bad = HIDDEN
        self.bad = min(bad, parent.bad) if parent else bad
        self.good = good + (parent.good if parent else 0)
        self.link = tag == "a" or bool(parent and parent.link)
        self.in_content = tag in ("article", "main") or bool(parent and parent.in_content)


def blocks_of(page: str) -> list[tuple[str, float, Element]]:
    """Text, share of links and innermost block element of each block."""
    root = Element("html", "", None)
    here, parts, out = root, [], []
    holder = root

    def text(raw: str) -> None:
        if raw:
            parts.append((html.unescape(raw), here.link))

    def close() -> None:
        nonlocal parts
        if parts:
            whole = WHITE.sub(" ", "".join(x for x, _ in parts)).strip()
            if whole:
                linked = sum(len(x.strip()) for x, link in parts if link)
                out.append((whole, linked / len(whole), holder))
            parts = []

    def innermost(element: Element) -> Element:
        while element.parent and element.tag not in BLOCK:
            element = element.parent
        return element

    at = 0
    while match := TAG.search(page, at):
        text(page[at : match.start()])
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        ending, attributes = match[1] or match[4], match[3] or match[6] or ""
        if tag == "br":
            parts.append((" ", here.link))
            continue
        if tag in BLOCK or tag in RAW:
            close()
        if tag in RAW and not ending and not attributes.endswith("/"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif ending:
            element = here
            while element is not root and element.tag != tag:
                element = element.parent
            if element is not root:
                here = element.parent
        elif tag not in VOID and tag not in ("html",) and not (attributes.endswith("/") and tag not in BLOCK):
            if tag in CLOSES:
                element = here
                while element is not root and element.tag not in CLOSES[tag] and element.tag not in SCOPES - {"td", "th", "tr"}:
                    element = element.parent
                if element is not root and element.tag in CLOSES[tag]:
                    here = element.parent
            elif tag in BLOCK:  # a paragraph ends where a block begins
                element = here
                while element is not root and element.tag != "p" and element.tag not in SCOPES:
                    element = element.parent
                if element.tag == "p":
                    here = element.parent
            here = Element(tag, attributes, here)
        if tag in BLOCK or tag in RAW:
            holder = innermost(here)
    text(page[at:])
    close()
    return out


def distance(a: Element, b: Element) -> int:
    """Steps from one element to the other in the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def cost(text: str, links: float, holder: Element) -> float:
    """Above 0 for content, below for boilerplate."""
    words = min(WORDS, text.count(" ") + 1)
    return PLAIN + PER_WORD * words + holder.good + holder.bad + (LINKS * links if links > 0.5 else 0.0)


def minimum_cut(costs: list[int], ties: dict[tuple[int, int], int]) -> list[bool]:
    """Which nodes lie on the source's side of a minimum cut: costs above 0 tie a node to the source, below to the sink."""
    n = len(costs)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for (i, j), c in ties.items():
        near[i][j] = near[i].get(j, 0) + c
        near[j][i] = near[j].get(i, 0) + c
    side: list[bool | None] = [None] * n
    free = list(costs)
    todo = deque(range(n))
    while todo:  # a node that its own cost outweighs all ties is settled; its ties become costs of its neighbours
        i = todo.popleft()
        if side[i] is None and abs(free[i]) >= sum(near[i].values()) and (free[i] or not near[i]):
            side[i] = free[i] > 0
            for j, c in near[i].items():
                free[j] += c if side[i] else -c
                del near[j][i]
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        reached = source_side(rest, free, near)
        for i in rest:
            side[i] = i in reached
    return [bool(x) for x in side]


def source_side(rest: list[int], free: list[int], near: list[dict[int, int]]) -> set[int]:
    """Nodes that the source still reaches after a maximum flow along shortest augmenting paths (Dinic)."""
    source, sink = -1, -2
    room: dict[int, dict[int, int]] = {i: dict(near[i]) for i in rest}
    room[source], room[sink] = {}, {}
    for i in rest:
        if free[i] > 0:
            room[source][i], room[i][source] = free[i], 0
        elif free[i] < 0:
            room[i][sink], room[sink][i] = -free[i], 0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            i = queue.popleft()
            for j, c in room[i].items():
                if c > 0 and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if sink not in level:
            return set(level) - {source}
        onward = {i: iter([j for j in room[i] if level.get(j) == level[i] + 1]) for i in level}
        path = [source]
        while path:
            i = path[-1]
            if i == sink:
                flow = min(room[a][b] for a, b in zip(path, path[1:]))
                cut = len(path)
                for k, (a, b) in enumerate(zip(path, path[1:])):
                    room[a][b] -= flow
                    room[b][a] += flow
                    if not room[a][b] and k < cut:
                        cut = k
                path = path[: cut + 1]
                continue
            for j in onward[i]:
                if room[i][j] > 0:
                    path.append(j)
                    break
            else:
                path.pop()
                if path:
                    continue


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    costs = [round(UNIT * cost(*x)) for x in blocks]
    ties: dict[tuple[int, int], int] = {}
    for i in range(1, len(blocks)):
        ties[i - 1, i] = round(UNIT * ADJACENT / (1 + distance(blocks[i - 1][2], blocks[i][2])))
        if i > 1 and blocks[i][2].parent is blocks[i - 2][2].parent:
            ties[i - 2, i] = round(UNIT * PARENT)
    return "\n".join(x[0] for x, keep in zip(blocks, minimum_cut(costs, ties)) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(x) if x else "" for x in strings(part, "html")]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(rows, "page_id long, url string, text string, n_chars long")
