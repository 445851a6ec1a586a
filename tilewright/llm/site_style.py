"""Main text of web pages by site style trees.

The pages of a host are merged into one tree. A node is the path of element names
with their class and id; each page gives a node presentation features (the tags of
its children, runs of equal tags once) and content features (hashes of its own
text, its links and images). A node's importance rises with the entropy of the
presentation among pages and with that of its content: a feature that m_i of the
node's m pages share has entropy log m_i / log m, so text on every page is worth
nothing, text on one page everything. Importance is composed from the leaves up,
each part by its share of the text, a share DAMP going to a node's own presentation
where that varies more than the content.

A branch is removed from the pages of a host if its importance, by that of the whole
tree, falls below a half as far as it is known: what a branch lacks counts by the
share of the host's pages that have it, by m / (m + DOUBT), and by the whole tree's
importance if that is below TOLD. So a branch on few pages, and any branch of a host
with one page, stays; and so do pages that are copies of each other, whose tree tells
nothing. Only branches on half of the pages or more can fall below a half, which bounds a
host's tree by the paths of two mean pages.

Elements whose name or class says that they are page furniture (menus, adverts,
forms, ...) have little importance from the start, on any host: their text often
differs from page to page, which entropy alone takes for content. A name counts only
as a whole class, id or role, and says nothing of html and body or of an element whose
child elements hold most of the page's text; the same goes for forms, and for any
element around an article that holds most of it. The header of an article is part of
it. Where articles (article or main) hold half of the text that is left or more, only
they are put out; otherwise all of it is.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import configure, cut, lower_ascii

#: Share of a node's own presentation in its importance; importance below which a branch goes;
#: pages of which half of what they say is believed; importance of a tree from which all of it is.
DAMP, THRESHOLD, DOUBT, TOLD = 0.1, 0.5, 2.0, 0.2
#: Up to so many removed paths (8 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_PATHS = 500_000

# Fixed values of HTML: elements without content, with raw content, and that end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp svg math select object".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody"
    " td tfoot th thead title tr ul".split()
)
#: Elements that are furniture by name; words of class, id or role that say so.
FURNITURE = frozenset("nav header footer aside form button input select menu dialog head".split()) | RAW
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies footer"
    " disclaimer header login menu nav navbar navigation newsletter notice notices pager pagination popup promo related"
    " share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)""",
    re.S,
)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_DIGITS = re.compile(r"[0-9]+")
#: What an opening tag closes if it is open in the same block (fixed values of HTML).
_CLOSES = {t: {"p"} for t in BLOCKS} | {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
#: Elements that such closing doesn't go beyond.
_WALLS = frozenset("html body div article section main aside nav header footer form ul ol dl table td th blockquote".split())


@dataclass
class Node:
    """An element of a page."""

    path: int
    tag: str
    furniture: bool
    surely: bool  # furniture by its element, whatever it holds
    parent: "Node | None" = None
    items: list = field(default_factory=list)  # nodes, and texts as str
    links: list = field(default_factory=list)
    own: int = 0  # characters of its texts, without white space
    order: list = field(default_factory=list)  # of a root: all nodes, parents first


@lru_cache(maxsize=100_000)
def _path(parent: int, label: str) -> int:
    h = xxhash.xxh64_intdigest(f"{parent}/{label}")
    return h - (1 << 64) if h >> 63 else h


def parse(page: str | None) -> Node:
    """The element tree of a page; what is open at the end is closed there."""
    root = Node(0, "", False, False)
    here, at, text = root, 0, page or ""
    opened: dict[str, int] = {}  # elements that are open, by tag

    def close(last: Node) -> Node:
        node = here
        while True:
            opened[node.tag] -= 1
            if node is last:
                return node.parent
            node = node.parent

    while at < len(text):
        lt = text.find("<", at)
        if lt < 0:
            here.items.append(text[at:])
            break
        if lt > at:
            here.items.append(text[at:lt])
        m = _TAG.match(text, lt) or _LOOSE.match(text, lt)
        if m is None:
            if re.match(r"</?[a-zA-Z]", text[lt : lt + 3]):
                break  # a tag that never ends
            here.items.append("<")
            at = lt + 1
            continue
        at = m.end()
        if not m[2]:
            continue
        tag, rest = m[2].lower(), m[3]
        if m[1]:
            if opened.get(tag):
                up = here
                while up.tag != tag:
                    up = up.parent
                here = close(up)
            continue
        closed = _CLOSES.get(tag)
        if closed is not None and any(opened.get(t) for t in closed):
            up, last = here, None
            while up is not root:
                if up.tag in closed:
                    last = up
                elif up.tag in _WALLS:
                    break
                up = up.parent
            if last is not None:
                here = close(last)
        given, says, style = {}, "", ""
        if rest and rest != "/":
            for a in _ATTRIBUTE.finditer(rest):
                given.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
            says = f"{given.get('class', '')} {given.get('id', '')} {given.get('role', '')}".lower()
            style = _DIGITS.sub("0", " ".join(sorted(says.split())))  # numbers in names count rows, not styles
        surely = tag in FURNITURE and tag != "form" and not (tag == "header" and (opened.get("article") or opened.get("main")))
        named = tag == "form" or says != "" and not FURNITURE_WORDS.isdisjoint(says.split())
        node = Node(_path(here.path, f"{tag}.{style}"), tag, surely or named and tag not in ("html", "body"), surely, here)
        here.items.append(node)
        if link := given.get("href") or given.get("src"):
            node.links.append(link)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(text, at)
            at = end.end() if end else len(text)
            continue
        if not rest.endswith("/") or tag in BLOCKS:
            here = node
            opened[tag] = opened.get(tag, 0) + 1
    root.order = list(_walk(root))
    for n in root.order:
        n.own = sum([len("".join(i.split())) for i in n.items if isinstance(i, str)])
    if any([n.furniture for n in root.order]):
        _spare(root)
    return root


def _spare(root: Node) -> None:
    """Names say nothing of what holds most of the page's text, elements nothing of what holds an article that does."""
    plain = _amounts(root, bare=True)
    for n in root.order:
        if n.tag in ("article", "main") and 2 * plain[id(n)] >= plain[id(root)] > 0:
            for up in _above(n):
                up.furniture = up.surely = False
            n.furniture = False
    if not any([n.furniture and not n.surely for n in root.order]):
        return
    amount = _amounts(root)
    for n in root.order:
        if n.furniture and not n.surely:
            n.furniture = 2 * sum(amount[id(i)] for i in n.items if isinstance(i, Node)) <= amount[id(root)]


def _amounts(root: Node, removed: set[int] | None = None, bare: bool = False) -> dict[int, int]:
    """Characters of text (no white space) in each node by its id(), without furniture and branches of ``removed``.

    Without ``removed``, furniture by name counts, too; with ``bare`` all of it does.
    """
    amount: dict[int, int] = {}
    for n in reversed(root.order):
        if not bare and (n.surely or removed is not None and (n.furniture or n.path in removed)):
            amount[id(n)] = 0
        else:
            amount[id(n)] = n.own + sum([amount[id(i)] for i in n.items if isinstance(i, Node)])
    return amount


def _walk(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend([i for i in reversed(node.items) if isinstance(i, Node)])


def node_features(page: str | None) -> dict[tuple[int, int, int, int], tuple[int, int]]:
    """(path, parent's path, kind, feature) of a page: kind 0 presentation, 1 content.

    Presentations have the characters of text below their nodes and in them; contents have none.
    """
    h = xxhash.xxh64_intdigest
    root = parse(page)
    amount = _amounts(root, bare=True)
    shown: dict[tuple[int, int], list] = {}  # by path: presentations, characters below and in the nodes
    out: dict[tuple[int, int, int, int], tuple[int, int]] = {}
    for node in root.order:
        tags: list[str] = []
        for c in node.items:
            if isinstance(c, Node) and (not tags or tags[-1] != c.tag):
                tags.append(c.tag)
        above = node.parent.path if node.parent else 0
        of = shown.setdefault((node.path, above), [[], 0, 0])
        texts = [i for i in node.items if isinstance(i, str)]
        of[0].append(" ".join(tags))
        of[1] += amount[id(node)]
        of[2] += node.own
        own = " ".join(" ".join(texts).split())
        for content in [own, *node.links] if own else node.links:
            out[node.path, above, 1, h(content.encode("utf-8", "surrogatepass")) >> 1] = (0, 0)
    for (path, above), (looks, chars, own_chars) in shown.items():
        out[path, above, 0, h("\n".join(looks)) >> 1] = (chars, own_chars)
    return out


def main_text(page: str | None, removed: set[int], names: bool = True) -> str:
    """Text of a page without furniture and the branches of ``removed``; of its articles, if they hold half of it or more.

    Without ``names`` the branches of ``removed`` alone are left out.
    """
    root = parse(page)
    if not names:
        for n in root.order:
            n.furniture = n.surely = False
    articles = [] if not names else [n for n in root.order if n.tag in ("article", "main") and not n.furniture]
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        words = html.unescape("".join(line)).split()
        if words:
            blocks.append(" ".join(words))
        line.clear()

    inside = set(map(id, articles))
    starts = [n for n in articles if not any(id(a) in inside or a.furniture or a.path in removed for a in _above(n))]
    if starts:
        amount = _amounts(root, removed)
        if 2 * sum(amount[id(n)] for n in starts) < amount[id(root)]:
            starts = []
    for start in starts or [root]:
        stack: list[Node | str | None] = [start]
        while stack:
            item = stack.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                line.append(item)
            elif item.tag == "br":
                line.append(" ")
            elif not (item.furniture or item.path in removed):
                if item.tag in BLOCKS or item is start:
                    flush()
                    stack.append(None)
                stack.extend(reversed(item.items))
            elif item.tag in BLOCKS:
                flush()
        flush()
    return "\n".join(blocks)


def _above(node: Node) -> Iterator[Node]:
    while (node := node.parent) is not None:
        yield node


def _host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def low_branches(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host`` and ``paths``: the topmost branches of low importance on each host."""
    configure(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # Rows of a host in a batch are added up before they are shuffled.
            count: dict[tuple, list[int]] = {}
            for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for f, (chars, own) in node_features(page).items():
                    c = count.setdefault((host, *f), [0, 0, 0])
                    c[0] += 1
                    c[1] += chars
                    c[2] += own
            if count:
                host, path, above, kind, feature = zip(*count)
                n, chars, own = zip(*count.values())
                columns = [pa.array(host, pa.string())] + [pa.array(x, pa.int64()) for x in (path, above, kind, feature, n, chars, own)]
                yield pa.RecordBatch.from_arrays(columns, names=["host", "path", "above", "kind", "feature", "n", "chars", "own"])

    slim = pages.select(_host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    rows = slim.mapInArrow(run, "host string, path long, above long, kind long, feature long, n long, chars long, own long")
    each = rows.groupBy("host", "path", "above", "kind", "feature").agg(*[F.sum(c).alias(c) for c in ("n", "chars", "own")])
    # Of a feature that n pages share: n log n and log n are all that the entropies need.
    log = F.log(F.col("n").cast("double"))
    style = F.col("kind") == 0
    summed = each.groupBy("host", "path", "above").agg(
        F.sum(F.when(style, F.col("n"))).alias("m"),
        F.sum("chars").alias("chars"),
        F.sum("own").alias("own"),
        F.sum(F.when(style, F.col("n") * log)).alias("style"),
        F.sum(F.when(~style, log)).alias("content"),
        F.sum(F.when(~style, F.lit(1))).alias("contents"),
    )
    nodes = cut(summed)
    sizes = nodes.where("path = 0").select("host", F.col("m").alias("pages"))
    # Paths on half of the pages or more: as many as two mean pages of the host have.
    common = nodes.join(sizes, "host").where(2 * F.col("m") >= F.col("pages"))
    return cut(common.groupBy("host").applyInPandas(_judge, "host string, paths array<long>"))


def importances(rows: dict[int, object], below: dict[int, list[int]]) -> dict[int, float]:
    """Importance of each path (m, style, content, contents, chars, own), composed from the leaves up."""
    order: list[int] = []
    stack = [0] if 0 in rows else []
    while stack:
        p = stack.pop()
        order.append(p)
        stack.extend(below.get(p, []))
    out: dict[int, float] = {}
    for p in reversed(order):
        r = rows[p]
        if r.m <= 1:
            out[p] = 1.0
            continue
        log_m = np.log(r.m)
        style = min(1.0, max(0.0, 1 - r.style / r.m / log_m))
        has_content = bool(r.contents and r.contents == r.contents)
        content = min(1.0, max(0.0, 1 - r.content / log_m / r.contents)) if has_content else 0.0
        # Parts by their share of the text: own content, children, and what is on few pages, which is important.
        parts = [(content, r.own + 1.0)] if has_content else []
        parts += [(out[c], rows[c].chars + 1.0) for c in below.get(p, [])]
        rest = r.chars - r.own - sum(rows[c].chars for c in below.get(p, []))
        if rest > 0:
            parts.append((1.0, float(rest)))
        whole = sum(w for _, w in parts)
        mean = sum(i * w for i, w in parts) / whole if parts else 0.0
        out[p] = mean + DAMP * max(0.0, style - mean)
    return out


def _judge(nodes: pd.DataFrame) -> pd.DataFrame:
    """Topmost branches of one host that matter little."""
    rows = {r.path: r for r in nodes.itertuples()}
    below: dict[int, list[int]] = {}
    for r in rows.values():
        if r.path and r.above in rows:
            below.setdefault(r.above, []).append(r.path)
    importance = importances(rows, below)
    whole = importance.get(0, 0.0)
    low: list[int] = []
    stack = list(below.get(0, []))
    while stack:
        p = stack.pop()
        r = rows[p]
        lacking = (1 - min(1.0, importance[p] / whole)) * min(1.0, whole / TOLD) if whole > 0 else 0.0
        if 1 - lacking * r.m / r.pages * r.m / (r.m + DOUBT) < THRESHOLD:
            low.append(p)
        else:
            stack.extend(below.get(p, []))
    return pd.DataFrame({"host": [nodes["host"].iloc[0]], "paths": [sorted(low)]})


def site_style_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Id, url, ``text`` (main text) and ``n_chars`` (long) of every row.

    Null or empty html gives an empty text. Null urls and urls without ``://`` are
    one host, the empty one. A host's only page, and pages that are all copies of each
    other, lose furniture only. Repeated rows stay and count as pages of their own; an
    empty table gives an empty table; other columns are not read.
    """
    low = low_branches(pages, url_col, html_col).where(F.size("paths") > 0)
    few = (low.agg(F.sum(F.size("paths") + 8)).first()[0] or 0) <= BROADCAST_PATHS
    kind = pages.schema[id_col].dataType.simpleString()
    keyed = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), _host(F.col(url_col)).alias("host")
    )
    joined = keyed.join(F.broadcast(low) if few else low, "host", "left").select("id", "url", "html", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h, set(p or ())) for h, p in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )

    out = joined.mapInArrow(run, f"id {kind}, url string, text string, n_chars long")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
