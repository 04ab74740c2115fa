"""Main-text extraction by minimum-cut labelling of a page's blocks.

A page becomes a sequence of text blocks with their place in the DOM. A naive
Bayes classifier gives every block a cost for either label; the costs are the
capacities from the source (content) and to the sink (boilerplate). Blocks
that follow each other, and consecutive blocks of one parent, are tied by
smoothness edges that weaken with their distance in the DOM. The minimum cut,
by max-flow, is the labelling with the least total cost.

The classifier is trained on the pages themselves: blocks under tags that say
what they hold (``article``, ``nav``, ``footer`` ...) are examples from which
it learns shape, position and class names, hashed into a table of fixed size.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements, by what they do to the text.
SKIPPED = frozenset("script style noscript template head title svg iframe object select option button textarea "
                    "canvas audio video".split())
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary "
                  "table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCK - {"body", "html"}
BOILER_TAGS = frozenset("nav footer aside form menu dialog".split())
CONTENT_TAGS = frozenset("article main".split())
#: words of class, id and role that name a boilerplate part
BOILER_NAMES = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies "
                         "consent copyright disqus footer gdpr header legal login masthead menu modal nav navbar navigation "
                         "newsletter notice pager pagination popup promo related reply replies respond search share sharing "
                         "sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split())

#: hashed feature slots of the classifier; pseudo-count of each
SLOTS, SMOOTH = 1 << 12, 1.0
#: log odds of one feature at most, so that a site's fixed layout doesn't decide alone
CLIP = 2.0
#: what a telling tag or name adds to a cost, per label decision
SAYS = 6.0
#: smoothness: full strength between blocks of one parent, divided by the DOM distance elsewhere
ADJACENT, SIBLING = 2.5, 1.5
#: distances beyond it count as it; class names of the nearest ancestors that count
FAR, NAMES = 12, 40
#: capacities are whole numbers: costs times this
SCALE = 1000
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*(?:>|$)|<\?[^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)"
                    "((?:[^>\"'=]++|=\\s*+(?:\"[^\"]*+\"|'[^']*+')|[=\"'])*+)(?:>|$)|[^<]+|<", re.S)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z]+")


@dataclass
class Node:
    tag: str
    parent: "Node | None"
    names: tuple[str, ...] = ()  # its own and its ancestors'
    depth: int = 0
    #: inside or itself: a boilerplate tag, or an element named as boilerplate (known once the page is read); a content tag
    boiler: bool = False
    content: bool = False
    named: bool = False
    chars: int = 0


@dataclass
class Block:
    text: str
    node: Node
    link_chars: int
    features: tuple[int, ...] = ()


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0


def _flush(page: _Page, node: Node) -> None:
    text = " ".join(html.unescape("".join(page.parts)).split())
    if text:
        page.blocks.append(Block(text, node, min(page.link_chars, len(text))))
    page.parts, page.link_chars = [], 0


def _open(tag: str, attributes: str, parent: Node) -> Node:
    names = tuple(n for m in _NAMES.finditer(attributes) for n in _SPLIT.split((m[1] or m[2] or m[3] or "").lower()) if n) \
        if "=" in attributes else ()
    inside = parent.content
    boiler = tag in BOILER_TAGS or (tag == "header" and not inside)
    named = tag not in ("html", "body") and any(n in BOILER_NAMES for n in names)  # the page itself is no part of it
    names = (names + parent.names)[:NAMES] if names else parent.names
    return Node(tag, parent, names, parent.depth + 1, boiler, inside or tag in CONTENT_TAGS, named)


def _settle(blocks: list[Block], nodes: list[Node]) -> None:
    """Hand boilerplate down to what an element holds.

    A name does not count on the content element with most text and on the
    elements around it: a layout named after its sidebar still holds the article.
    """
    for b in blocks:
        b.node.chars += len(b.text)
    for node in reversed(nodes):  # children come after their parents
        node.parent.chars += node.chars
    main = max((x for x in nodes if x.tag in CONTENT_TAGS), key=lambda x: x.chars, default=None)
    while main is not None:
        main.named, main = False, main.parent
    for node in nodes:
        node.boiler = node.boiler or node.named or node.parent.boiler


def blocks_of(page_html: str | None) -> list[Block]:
    """The text blocks of a page in order. Broken and unfinished markup is taken as far as it goes."""
    page = _Page()
    node = root = Node("#page", None)
    nodes: list[Node] = []
    open_tags: Counter[str] = Counter()
    unended: set[str] = set()  # skipped elements of which no end tag is left
    text = page_html or ""
    at, n = 0, len(text)
    while at < n:
        m = _TOKEN.match(text, at)
        if m is None:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                page.parts.append(piece)
                if node.tag == "a" or (node.parent is not None and node.parent.tag == "a"):
                    page.link_chars += len(piece.strip())
            continue
        tag = tag.lower()
        if tag == "br" or tag == "hr" or tag == "img" or tag == "wbr":
            page.parts.append(" ")
            continue
        if m[1]:  # an end tag closes the nearest open element of its name; without one it is ignored
            if open_tags[tag]:
                if tag in BLOCK:
                    _flush(page, node)
                while True:
                    open_tags[node.tag] -= 1
                    closed, node = node.tag, node.parent
                    if closed == tag:
                        break
            continue
        if tag in SKIPPED:
            # leave it out with all it holds
            end = None if tag in unended else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(text, at)
            if end is None:
                unended.add(tag)
            if tag == "head" and end is None:
                end = re.compile(r"<body\b", re.I).search(text, at)
                at = end.start() if end else n
            else:
                at = end.end() if end else (n if tag in RAW else at)
            page.parts.append(" ")
            continue
        if tag in BLOCK:
            _flush(page, node)
            if tag in CLOSES_P or tag == "li":  # a new block ends an open paragraph, an item the item before it
                up = node
                while up is not root and up.tag not in BLOCK:
                    up = up.parent
                if up.tag == "p" or (tag == up.tag and tag in ("li", "dt", "dd", "tr", "td", "th")):
                    while node is not up.parent:
                        open_tags[node.tag] -= 1
                        node = node.parent
        if tag not in VOID and not m[3].rstrip().endswith("/"):
            node = _open(tag, m[3], node)
            nodes.append(node)
            open_tags[tag] += 1
    _flush(page, node)
    _settle(page.blocks, nodes)
    return page.blocks


def _slot(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature) % SLOTS


_slot = lru_cache(maxsize=1 << 16)(_slot)


def describe(blocks: list[Block]) -> None:
    """Give every block its hashed features: shape, links, punctuation, place and class names."""
    n = len(blocks)
    for i, b in enumerate(blocks):
        size = len(b.text)
        tag = "heading" if b.node.tag in HEADINGS else b.node.tag
        stops = sum(map(b.text.count, ".!?,;"))
        b.features = tuple(map(_slot, (
            f"size={min(12, size.bit_length())}", f"links={10 * b.link_chars // size}",
            f"stops={min(8, 200 * stops // size)}", f"tag={tag}", f"ends={b.text[-1] in '.!?:'}",
            f"from_start={min(i, 6)}", f"from_end={min(n - 1 - i, 6)}", f"sign={b.text[0] in '©|»#'}",
            *(f"name={x}" for x in b.node.names))))


def told(block: Block) -> int:
    """1 or 0 where the tags around a block say what it is, else -1."""
    return 0 if block.node.boiler else 1 if block.node.content else -1


def _distance(a: Node, b: Node) -> int:
    """Steps between two elements in the DOM, FAR at most; none between children of one parent."""
    steps = 0
    if a.parent is b.parent:
        return 0
    while a is not b and steps < FAR:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def min_cut(content: list[int], boiler: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """True for the blocks on the content side of a minimum cut.

    Labelling block i as boilerplate costs content[i], as content boiler[i]; an
    edge (i, j, w) costs w if its ends differ. Of equal cuts, the one with
    fewest content blocks. Augments along shortest paths.
    """
    n = len(content)
    # flow through one block alone is pushed first: what is left over is a surplus on one side
    supply = [max(0, c - b) for c, b in zip(content, boiler)]
    demand = [max(0, b - c) for c, b in zip(content, boiler)]
    near: list[list[int]] = [[] for _ in range(n)]
    to, room = [], []
    for i, j, w in edges:
        near[i].append(len(to))
        near[j].append(len(to) + 1)
        to += [j, i]
        room += [w, w]
    sources = deque(i for i in range(n) if supply[i])
    cut_off = bytearray(n)  # blocks from which no demand can be reached any more
    while sources:
        s = sources[0]
        if cut_off[s]:
            sources.popleft()
            continue
        came = {s: -1}
        queue = deque([s])
        end = -1
        while queue:
            u = queue.popleft()
            if demand[u]:
                end = u
                break
            for e in near[u]:
                if room[e] and to[e] not in came and not cut_off[to[e]]:
                    came[to[e]] = e
                    queue.append(to[e])
        if end < 0:  # no demand within reach: no path leaves what it reaches, now or later
            for u in came:
                cut_off[u] = 1
            continue
        flow, u = min(supply[s], demand[end]), end
        while u != s:
            flow = min(flow, room[came[u]])
            u = to[came[u] ^ 1]
        u = end
        while u != s:
            room[came[u]] -= flow
            room[came[u] ^ 1] += flow
            u = to[came[u] ^ 1]
        supply[s] -= flow
        demand[end] -= flow
        if not supply[s]:
            sources.popleft()
    side = [s > 0 for s in supply]
    queue = deque(i for i in range(n) if side[i])
    while queue:
        u = queue.popleft()
        for e in near[u]:
            if room[e] and not side[to[e]]:
                side[to[e]] = True
                queue.append(to[e])
    return side


@dataclass
class BlockClassifier:
    """Log odds of content per feature slot, and the prior's."""

    odds: np.ndarray
    prior: float

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> "BlockClassifier":
        """From examples per [label, slot]; the last slot counts the blocks. Without examples of a label nothing is learned."""
        rows = counts[:, -1]
        if not rows.all():
            return cls(np.zeros(SLOTS), 0.0)
        share = (counts[:, :-1] + SMOOTH) / (rows[:, None] + 2 * SMOOTH)
        return cls(np.clip(np.log(share[1] / share[0]), -CLIP, CLIP), math.log(rows[1] / rows[0]))

    def costs(self, block: Block) -> tuple[int, int]:
        """(cost of calling it boilerplate, cost of calling it content)."""
        odds = max(-20.0, min(20.0, self.prior + float(self.odds[list(block.features)].sum()) / 2))
        said = told(block)
        odds += 0 if said < 0 else SAYS if said else -2 * SAYS
        return round(SCALE * math.log1p(math.exp(odds))), round(SCALE * math.log1p(math.exp(-odds)))

    def extract(self, page_html: str | None) -> list[str]:
        """The content blocks of a page in order."""
        blocks = blocks_of(page_html)
        if not blocks:
            return []
        describe(blocks)
        costs = [self.costs(b) for b in blocks]
        edges, last = [], {}
        for i, b in enumerate(blocks):
            if i:
                before = blocks[i - 1].node
                tie = ADJACENT * (2 if before.tag in HEADINGS else 1)  # a heading goes with what follows
                edges.append((i - 1, i, round(SCALE * tie / (1 + _distance(before, b.node)))))
            near = last.get(id(b.node.parent))
            if near is not None and blocks[near].node.tag == b.node.tag:
                edges.append((near, i, round(SCALE * SIBLING)))
            last[id(b.node.parent)] = i
        side = min_cut([c for c, _ in costs], [b for _, b in costs], edges)
        return [b.text for b, content in zip(blocks, side) if content]


def fit(pages: DataFrame, html_col: str = "html") -> BlockClassifier:
    """Count features over the blocks of all pages whose tags tell their label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, SLOTS + 1), np.int64)
        for b in batches:
            for page in b.column(0):
                blocks = blocks_of(page.as_py())
                describe(blocks)
                found: tuple[Counter, Counter] = (Counter(), Counter())
                for block in blocks:
                    label = told(block)
                    if label >= 0:
                        found[label].update({*block.features, SLOTS})
                for label in (0, 1):
                    if found[label]:
                        counts[label, list(found[label])] += list(found[label].values())
        flat = counts.ravel()
        cell = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(flat[cell], pa.int64())], ["cell", "n"])

    cells = pages.select(html_col).mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros(2 * (SLOTS + 1))  # the result has at most this many cells
    flat[np.asarray(cells["cell"])] = np.asarray(cells["n"])
    return BlockClassifier.from_counts(flat.reshape(2, SLOTS + 1))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      with_blocks: bool = True) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars and, if asked, the blocks.

    Null and empty pages, and pages without content blocks, give an empty
    text. Repeated ids are separate rows; other columns are ignored. An empty
    table gives an empty result.
    """
    model = fit(pages, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [model.extract(page.as_py()) for page in b.column(2)]
            texts = [" ".join(x) for x in found]
            cols = [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            if with_blocks:
                cols.append(pa.array(found, pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(cols, ["page_id", "url", "text", "n_chars", "blocks"][:len(cols)])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    schema = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint"
    return rows.mapInArrow(run, schema + ", blocks array<string>" * with_blocks)
