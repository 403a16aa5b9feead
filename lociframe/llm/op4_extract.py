"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements.  Each node is content or not;
log-linear node potentials read its tag, its class and id, its own text and
links, and parent-child potentials by kind of child connect it to its parent.
Sum-product messages upward and downward over the tree give each node's exact
marginal, and text whose node is content with more than one half is kept.  The
weights are trained on labelled pages by the same messages (gradient of the
exact likelihood).

Text: character references are decoded, white space in a block becomes one
space, blocks are joined in page order by one space.  Scripts, styles, titles,
form controls and markup hold no text.

Cases: null and empty html give an empty text; unclosed and cut-off markup is
read as far as it goes; pages without tags are one block; a node with a
marginal of just one half is no content; repeated rows, empty tables and
further columns change nothing; nothing is cut or capped, and a page of any
length or depth is parsed in time in proportion to its length.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare
from .op4_pages import MARK, labelled

# Element names by their part in a page.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style title noscript textarea select option button svg math iframe object template canvas audio video datalist head".split())
RAW = frozenset("script style title textarea noscript iframe".split())
CLOSES_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"tr", "td", "th", "thead", "tbody"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
P_SCOPES = "td th li div article section body button".split()
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}}
KINDS = ("p", "h1", "h2 h3 h4 h5 h6", "li", "ul ol dl menu dt dd", "table tr td th thead tbody", "nav", "header", "footer", "aside", "form fieldset dialog", "article", "main", "section", "div", "blockquote pre figure figcaption", "body html")
GOOD = re.compile(r"content|article|post|entry|story|main|body|text|blog", re.I)
BAD = re.compile(r"\bnav|menu|foot|header|head\b|side-?bar|aside|\bad\b|\bads|advert|promo|sponsor|banner|comment|repl(?:y|ies)|disqus|cookie|notice|consent|popup|modal|alert|share|social|relat|recommend|breadcrumb|pagina|widget|newsletter|subscri|login|sign-?up|search|copyright|legal|disclaim|\btags?\b|toolbar", re.I)
KIND_OF = {t: i for i, ts in enumerate(KINDS) for t in ts.split()}
PLAIN = 0, 14, 5, 13  # kinds of child with potentials of their own: p, div, table parts, section
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>", re.S)
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
FEATURES = len(KINDS) + 14
STEPS, RATE = 150, 0.08


class Page:
    """Block tree of a page: parent, kind, names and text runs of each node."""

    def __init__(self, source: str):
        self.parent, self.kind, self.good, self.bad = [-1], [KIND_OF["body"]], [0], [0]
        self.runs: list[tuple[int, str]] = []  # (node, raw text) in page order
        self.chars, self.linked, self.depth = [0], [0], [0]
        stack: list[tuple[str, int]] = [("html", 0)]
        where: dict[str, list[int]] = {}  # places in the stack of the open elements of each name
        silent = links = 0
        buffer: list[str] = []

        def flush() -> None:
            if buffer:
                self.runs.append((stack[-1][1], "".join(buffer)))
                buffer.clear()

        def text(piece: str) -> None:
            if not silent and piece:
                node, size = stack[-1][1], len(piece)
                buffer.append(piece)
                self.chars[node] += size
                self.linked[node] += size if links else 0

        def drop(index: int) -> None:
            nonlocal silent
            flush()
            for name, _ in stack[index:]:
                silent -= name in SILENT
                where[name].pop()
            del stack[index:]

        def innermost(names) -> int:
            return max((where[n][-1] for n in names if where.get(n)), default=0)

        at, end = 0, len(source)
        while at < end:
            lt = source.find("<", at)
            if lt < 0:
                text(source[at:])
                break
            text(source[at:lt])
            m = TAG.match(source, lt)
            if not m:
                if re.match(r"</?[a-zA-Z]", source[lt : lt + 3]):  # a tag without its end: to the next > or the page's end
                    gt = source.find(">", lt)
                    at = end if gt < 0 else gt + 1
                else:
                    text("<")
                    at = lt + 1
                continue
            at = m.end()
            name = m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                if name == "a":
                    links = 0
                elif name not in INLINE:
                    if where.get(name):
                        drop(where[name][-1])
                    links = 0 if name in CLOSES_P else links
                continue
            if name in RAW:
                close = re.compile(rf"</{name}[\s/>]", re.I).search(source, at)
                at = end if close is None else (source.find(">", close.start()) + 1 or end)
                continue
            if name == "br" or name == "hr":
                text(" ")
                if name == "br":
                    continue
            if name in VOID:
                continue
            if name in INLINE and not (name == "ins" and "ads" in m[3]):
                links = 1 if name == "a" else links
                continue
            if name in ("html", "body"):
                continue
            links = 0
            if name in CLOSES_P:
                if where.get("p") and where["p"][-1] > innermost(P_SCOPES):
                    drop(where["p"][-1])
            if name in SIBLINGS:
                scope = innermost(SCOPES[name])
                open_ = [where[n] for n in SIBLINGS[name] if where.get(n) and where[n][-1] > scope]
                if open_:  # the outermost one in the scope
                    drop(min(at_[bisect_right(at_, scope)] for at_ in open_))
            flush()
            names = " ".join(x.strip("\"'") for x in NAMED.findall(m[3])) if m[3] else ""
            self.parent.append(stack[-1][1])
            self.depth.append(self.depth[stack[-1][1]] + 1)
            self.kind.append(KIND_OF.get(name, KIND_OF["div"]))
            self.good.append(1 if names and GOOD.search(names) else 0)
            self.bad.append(1 if names and BAD.search(names) or name == "ins" else 0)
            self.chars.append(0)
            self.linked.append(0)
            if m[3].endswith("/") and name in SILENT:
                continue
            where.setdefault(name, []).append(len(stack))
            stack.append((name, len(self.parent) - 1))
            silent += name in SILENT
        flush()


class Forest:
    """The nodes of several pages with their features, levels and kinds of child."""

    def __init__(self, pages: list[Page]):
        sizes = [len(p.parent) for p in pages]
        self.start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        join = lambda name: np.concatenate([np.asarray(getattr(p, name), np.int64) for p in pages]) if pages else np.empty(0, np.int64)
        parent, kind, good, bad, chars, linked = (join(n) for n in ("parent", "kind", "good", "bad", "chars", "linked"))
        root = parent < 0
        self.parent = np.where(root, -1, parent + np.repeat(self.start[:-1], sizes))
        n = len(parent)
        depth, inside_good, inside_bad = join("depth"), good.copy(), bad.copy()
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth))[:-1]) if n else [order]
        for now in self.levels[1:]:
            inside_good[now] |= inside_good[self.parent[now]]
            inside_bad[now] |= inside_bad[self.parent[now]]
        x = np.zeros((n, FEATURES))
        x[np.arange(n), kind] = 1
        k = len(KINDS)
        density = linked / np.maximum(chars, 1)
        in_kind = lambda i: self._inherit(kind == i)
        columns = [np.ones(n), good, bad, inside_bad, inside_good, np.log1p(chars) / 5, (chars == 0), (chars > 0) & (chars < 30), chars > 200, density, (density > 0.6), in_kind(KIND_OF["article"]) | in_kind(KIND_OF["main"]), np.minimum(depth, 10) / 10, in_kind(KIND_OF["nav"]) | in_kind(KIND_OF["footer"]) | in_kind(KIND_OF["aside"]) | in_kind(KIND_OF["header"]) | in_kind(KIND_OF["form"])]
        for i, c in enumerate(columns):
            x[:, k + i] = c
        self.x = x
        self.link = np.full(n, len(PLAIN))
        for i, p in enumerate(PLAIN):
            self.link[(kind == p) & (bad == 0)] = i

    def _inherit(self, own: np.ndarray) -> np.ndarray:
        out = own.copy()
        for nodes in self.levels[1:]:
            out[nodes] |= out[self.parent[nodes]]
        return out

    def marginals(self, weights: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(content) of each node and the joint of (parent, child) for each node but roots."""
        n = len(self.parent)
        node = np.zeros((n, 2))
        node[:, 1] = self.x @ weights
        up = np.zeros((n, 2))  # message to the parent
        belief = node.copy()
        for nodes in self.levels[:0:-1]:
            m = belief[nodes][:, None, :] + pairs[self.link[nodes]]  # parent state, child state
            up[nodes] = np.logaddexp(m[:, :, 0], m[:, :, 1])
            np.add.at(belief, self.parent[nodes], up[nodes])
        joint = np.zeros((n, 2, 2))
        down = np.zeros((n, 2))
        for nodes in self.levels[1:]:
            p = self.parent[nodes]
            m = (belief[p] + down[p] - up[nodes])[:, :, None] + pairs[self.link[nodes]]
            down[nodes] = np.logaddexp(m[:, 0], m[:, 1])
            j = m + belief[nodes][:, None, :]
            j = np.exp(j - j.max((1, 2), keepdims=True))
            joint[nodes] = j / j.sum((1, 2), keepdims=True)
        total = belief + down
        return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500))), joint


def train(pages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Node and pair weights of greatest (regularised) likelihood on pages whose content text has MARK before it."""
    parsed = [Page(p) for p in pages]
    truth = []
    for p in parsed:
        own = np.zeros(len(p.parent), np.int64)
        for node, text in p.runs:
            own[node] |= MARK in text
        for i in range(len(own) - 1, 0, -1):  # what holds content and no other text is content too
            if own[i] and p.chars[p.parent[i]] == 0 and p.parent[i] > 0:
                own[p.parent[i]] = 1
        truth.append(own)
    forest, y = Forest(parsed), np.concatenate(truth)
    weights, pairs = np.zeros(FEATURES), np.zeros((len(PLAIN) + 1, 2, 2))
    inner = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros_like(pairs)
    np.add.at(seen, (forest.link[inner], y[forest.parent[inner]], y[inner]), 1)
    state = [np.zeros(FEATURES), np.zeros_like(pairs), np.zeros(FEATURES), np.zeros_like(pairs)]
    for t in range(1, STEPS + 1):
        p, joint = forest.marginals(weights, pairs)
        expected = np.zeros_like(pairs)
        np.add.at(expected, forest.link[inner], joint[inner])
        for k, (value, grad) in enumerate(((weights, forest.x.T @ (y - p) / len(pages) - 0.01 * weights), (pairs, (seen - expected) / len(pages) - 0.01 * pairs))):
            state[k] = 0.9 * state[k] + 0.1 * grad
            state[k + 2] = 0.99 * state[k + 2] + 0.01 * grad * grad
            value += RATE * (state[k] / (1 - 0.9**t)) / (np.sqrt(state[k + 2] / (1 - 0.99**t)) + 1e-8)
    return weights, pairs


@lru_cache(maxsize=1)
def model() -> tuple[np.ndarray, np.ndarray]:
    return train(labelled())


def main_texts(sources: list[str | None], weights: np.ndarray, pairs: np.ndarray) -> list[str]:
    """Main text of each page."""
    pages = [Page(s or "") for s in sources]
    if not pages:
        return []
    forest = Forest(pages)
    content = forest.marginals(weights, pairs)[0] > 0.5
    out = []
    for page, base in zip(pages, forest.start[:-1].tolist(), strict=True):
        blocks = (" ".join(entities.unescape(t).split()) for node, t in page.runs if content[base + node])
        out.append(" ".join(b for b in blocks if b))
    return out


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in ``keep``, text and n_chars of every page."""
    prepare(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model())
    schema = ", ".join(f"`{c}` {t}" for c, t in pages.select(*keep).dtypes) + ", text string, n_chars long"

    def run(batches):
        for batch in batches:
            sources, texts = batch.column(len(keep)).to_pylist(), []
            for i in range(0, len(sources), 200):
                texts += main_texts(sources[i : i + 200], *shared.value)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    return pages.select(*keep, F.col("html").alias("_html")).mapInArrow(run, schema)
