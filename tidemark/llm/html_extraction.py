"""Main-text extraction by a tree-structured graphical model over a page's block elements.

Every block element is a node that is content or not. Potentials of a node come from its tag, the words of its class, id
and role, its text's length and the share of links in it; potentials of an edge say how a parent's label goes with its
child's, by kind of child. Sum-product messages go up and down the tree and give each node's content marginal; the weights
are fitted by the likelihood of labelled pages, whose gradient needs the same marginals. A batch of pages is one forest,
and its messages go level by level for all pages at once. Pages are read whole, in one pass without a shuffle.

Defined results: null or empty html gives an empty text; markup that is never closed is closed at the end; a page
without content nodes has an empty text; the url is passed on as it is; repeated pages give equal texts; other columns are
ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.llm.labelled_pages import filled

# Element names of HTML by how they behave.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("head script style textarea title iframe noembed noframes xmp noscript template svg math select option "
                   "button object canvas audio video map datalist".split())
#: Elements that a start tag closes, up to the nearest of the elements behind the colon.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"})}
KINDS = {**dict.fromkeys(["p", "pre", "blockquote", "dd", "dt", "figcaption", "td", "th"], 1),
         **dict.fromkeys(["h1", "h2", "h3", "h4", "h5", "h6"], 2),
         **dict.fromkeys(["ul", "ol", "dl", "li", "table", "tr", "tbody", "figure"], 3),
         **dict.fromkeys(["article", "main", "section", "div"], 4)}  # any other kind: 0
N_KINDS = 5
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|data-main|data-skip)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """A page's block elements in order of their start tags, and its blocks of text in page order."""
    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    depths: list[int] = field(default_factory=list)
    tokens: list[tuple[str, ...]] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)  # of labelled pages: 1 main, -1 skip, 0 as the parent
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters in links


def parse(source: str) -> Page:
    page, stack, unseen, link = Page(), [], 0, 0
    chunks: list[tuple[str, int]] = []

    def close_block() -> None:
        nonlocal link
        if chunks:
            text = " ".join("".join(c for c, _ in chunks).split())
            if text and not unseen:
                page.blocks.append((stack[-1] if stack else open_node("body", ""), text,
                                    sum(len(c) for c, linked in chunks if linked)))
            chunks.clear()

    def open_node(tag: str, attributes: str) -> int:
        nonlocal unseen
        node = len(page.tags)
        tokens, mark = [], 0
        for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
            if name.lower() == "data-main":
                mark = 1
            elif name.lower() == "data-skip":
                mark = -1
            else:
                tokens += [t.lower() for v in values for t in _TOKEN.findall(v)]
        page.tags.append(tag)
        page.parents.append(stack[-1] if stack else -1)
        page.depths.append(len(stack))
        page.tokens.append(tuple(dict.fromkeys(tokens)))
        page.marks.append(mark)
        stack.append(node)
        unseen += tag in UNSEEN
        return node

    def pop() -> None:
        nonlocal unseen, link
        unseen -= page.tags[stack.pop()] in UNSEEN
        link = 0

    def pop_to(wanted: set[str], limits: set[str]) -> None:
        for back in range(len(stack) - 1, -1, -1):
            tag = page.tags[stack[back]]
            if tag in wanted:
                while len(stack) > back:
                    pop()
                return
            if tag in limits:
                return

    at, end = 0, len(source)
    while at < end:
        found = _MARKUP.search(source, at)
        text = source[at:found.start() if found else end]
        if text:
            chunks.append((html.unescape(text) if "&" in text else text, link))
        if not found:
            break
        at = found.end()
        if found[2] is None:
            continue
        tag, closing = found[2].lower(), bool(found[1])
        if tag == "br":
            chunks.append((" ", 0))
        elif tag in INLINE:
            link = (0 if closing else 1) if tag == "a" else link
        elif tag in VOID:
            if tag == "hr":
                close_block()
        elif tag in RAW and not closing:
            stop = _END[tag].search(source, at)
            at = stop.start() if stop else end
            ending = source.find(">", at)
            at = end if ending < 0 else ending + 1
        elif closing:
            close_block()
            pop_to({tag}, set())
        else:
            close_block()
            pop_to({"p"}, {"td", "th", "table", "button", "object"} if tag == "table" else {"td", "th", "button", "object"})
            if tag in CLOSES:
                pop_to(*CLOSES[tag])
            open_node(tag, found[3])
            if found[3].endswith("/") and tag in UNSEEN:
                pop()
    close_block()
    return page


def _bin(value: float, edges: Sequence[float]) -> int:
    return sum(value >= e for e in edges)


def features(page: Page) -> list[list[str]]:
    """Names of the features that hold at each node."""
    n = len(page.tags)
    own, linked, under, under_linked = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text, link in page.blocks:
        own[node] += len(text)
        linked[node] += link
    for node in range(n - 1, -1, -1):
        under[node] += own[node]
        under_linked[node] += linked[node]
        if page.parents[node] >= 0:
            under[page.parents[node]] += under[node]
            under_linked[page.parents[node]] += under_linked[node]
    rows = []
    total = max(1, sum(own))
    for node, tag in enumerate(page.tags):
        size = _bin(own[node], (1, 20, 80, 250))
        share = _bin(under_linked[node] / under[node] if under[node] else 0, (0.01, 0.4, 0.8))
        rows.append(["bias", f"tag {tag}", f"tag {tag} {size}", f"own {size}", f"links {share}", f"kind {KINDS.get(tag, 0)} {size}",
                     f"under {_bin(under[node], (1, 100, 500))}", *(f"word {t}" for t in page.tokens[node])])
        if not own[node]:  # an element around others: how much of the page's text it holds
            rows[-1].append(f"part {tag} {_bin(under[node] / total, (0.1, 0.4, 0.7))}")
    return rows


class Forest:
    """The nodes of many pages, level by level, for messages of all pages at once."""

    def __init__(self, pages: Sequence[Page], index: dict[str, int]):
        parents, depths, kinds, at, feature, node = [], [], [], 0, [], []
        for page in pages:
            parents += [p + at if p >= 0 else -1 for p in page.parents]
            depths += page.depths
            kinds += [KINDS.get(t, 0) for t in page.tags]
            for n, names in enumerate(features(page), at):
                known = [index[f] for f in names if f in index]
                feature += known
                node += [n] * len(known)
            at += len(page.tags)
        self.n = at
        self.parents, self.kinds = np.array(parents, np.int64), np.array(kinds, np.int64)
        self.feature, self.node = np.array(feature, np.int64), np.array(node, np.int64)
        depths = np.array(depths, np.int64)
        order = np.argsort(depths, kind="stable")
        edges = np.flatnonzero(np.diff(depths[order])) + 1
        self.levels = np.split(order, edges) if at else []

    def marginals(self, weights: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Content marginal of each node, and of each node with its parent the joint of (parent's, own) label."""
        inner = np.zeros((self.n, 2))
        np.add.at(inner[:, 1], self.node, weights[self.feature])
        up = np.zeros((self.n, 2))
        for level in reversed(self.levels[1:]):
            up[level] = np.logaddexp.reduce(edge[self.kinds[level]] + inner[level][:, None, :], axis=2)
            np.add.at(inner, self.parents[level], up[level])
        belief, joint = inner.copy(), np.zeros((self.n, 2, 2))
        for level in self.levels[1:]:
            rest = belief[self.parents[level]] - up[level]
            both = edge[self.kinds[level]] + rest[:, :, None] + inner[level][:, None, :]
            belief[level] = np.logaddexp.reduce(both, axis=1)
            joint[level] = np.exp(both - np.logaddexp.reduce(both, axis=(1, 2))[:, None, None])
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), joint


@dataclass
class ContentModel:
    index: dict[str, int]
    weights: np.ndarray
    edge: np.ndarray

    def content(self, pages: Sequence[Page]) -> np.ndarray:
        forest = Forest(pages, self.index)
        return forest.marginals(self.weights, self.edge)[0]

    def texts(self, sources: Sequence[str]) -> list[str]:
        pages = [parse(s) for s in sources]
        content = self.content(pages)
        out, at = [], 0
        for page in pages:
            keep = content[at:at + len(page.tags)] >= 0.5
            out.append(" ".join(text for node, text, _ in page.blocks if keep[node]))
            at += len(page.tags)
        return out


def node_labels(page: Page) -> list[int]:
    labels: list[int] = []
    for mark, parent in zip(page.marks, page.parents):
        labels.append(1 if mark > 0 else 0 if mark < 0 or parent < 0 else labels[parent])
    return labels


def trained(sources: Sequence[str], steps: int = 300, rate: float = 0.1, decay: float = 0.003) -> ContentModel:
    """The weights of most likelihood of labelled pages, by Adam with weight decay; always the same for the same pages."""
    pages = [parse(s) for s in sources]
    index: dict[str, int] = {}
    for page in pages:
        for names in features(page):
            for name in names:
                index.setdefault(name, len(index))
    forest = Forest(pages, index)
    y = np.array([label for page in pages for label in node_labels(page)])
    has_parent = forest.parents >= 0
    seen_edges = np.zeros((N_KINDS, 2, 2))
    np.add.at(seen_edges, (forest.kinds[has_parent], y[forest.parents[has_parent]], y[has_parent]), 1)
    seen = np.bincount(forest.feature, y[forest.node], len(index))
    values = [np.zeros(len(index)), np.zeros((N_KINDS, 2, 2))]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1):
        content, joint = forest.marginals(*values)
        edges = np.zeros_like(seen_edges)
        np.add.at(edges, forest.kinds[has_parent], joint[has_parent])
        gains = [seen - np.bincount(forest.feature, content[forest.node], len(index)), seen_edges - edges]
        for k, gain in enumerate(gains):
            gain = gain / len(pages) - decay * values[k]
            first[k] = 0.9 * first[k] + 0.1 * gain
            second[k] = 0.99 * second[k] + 0.01 * gain * gain
            values[k] = values[k] + rate * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return ContentModel(index, *values)


def extracted(pages: DataFrame, model: ContentModel | None = None, id_column: str = "page_id", url_column: str = "url",
              html_column: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars. Without a model, the one of the labelled pages is trained first."""
    shared = pages.sparkSession.sparkContext.broadcast(model or trained(filled()))  # a few hundred weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 100):
            texts = shared.value.texts([s or "" for s in batch.column("html").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    chosen = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"),
                          F.col(html_column).alias("html"))
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")
