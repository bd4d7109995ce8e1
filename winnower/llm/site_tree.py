"""Main text of web pages by site style trees.

The element trees of a site's pages are merged: elements with the same path of tags and classes are one node. A node
is important as far as its pages differ in it: in the children they give it, and in the texts they put there. A page
then adds up the importance of each branch from these nodes, and branches that say the same all over the site, that
are mostly links, or that are named as page furniture go. A name does not count against a branch that holds most of the
page's important text: it wraps the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


@dataclass(frozen=True)
class SiteTree:
    #: Weight of a node's children against its own importance.
    children: float = 0.5
    #: A branch goes if it is less important than this share of the page's most important text.
    share: float = 0.25
    #: A branch without a name goes if more than this share of its letters lies in links.
    links: float = 0.5
    #: A branch named like furniture is a wrapper if it holds more than this share of the page's important text ...
    wraps: float = 0.5
    #: ... and what lies outside of all such branches is at most this share of what it holds.
    beside: float = 0.25
    #: Named articles are the main text if they hold this share of the important text outside of furniture.
    articles: float = 0.5
    #: Elements nested deeper count as their ancestor at this depth.
    depth: int = 24


_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.DOTALL | re.IGNORECASE)
_NAMES = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE)
_TOKENS = re.compile(r"[a-z]+")
_WHITE = re.compile(r"\s+")

#: Elements that begin and end blocks; other tags are part of the text around them.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th
thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag closes if it is the innermost open block.
CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
#: Elements and names that are page furniture, and those that hold the article.
FURNITURE_TAGS = frozenset("nav header footer aside form button select dialog menu search fieldset head option".split())
FURNITURE = frozenset("""nav navbar navigation menu header masthead footer sidebar aside widget ad ads advert adverts advertisement banner promo
sponsor sponsored cookie cookies consent notice alert popup modal overlay newsletter subscribe signup login share sharing social related
recommended teaser teasers comment comments reply replies respond disqus breadcrumb breadcrumbs pagination pager toolbar search form skip copyright legal
complementary contentinfo""".split())
ARTICLE = frozenset("article main story".split())
ARTICLE_TAGS = frozenset("article main".split())
#: Names of readers' comments, which may be longer than the article.
COMMENTS = frozenset("comment comments reply replies respond disqus".split())
#: How far a branch is furniture: not at all, by a part of a name, by a whole name or as a form, by its element.
NOT, PARTLY, NAMED, ALWAYS = range(4)


@dataclass
class Node:
    key: int
    parent: int
    tag: str
    furniture: int = NOT
    article: bool = False
    depth: int = 0
    children: list[int] = field(default_factory=list)
    style: list[str] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)
    letters: int = 0
    linked: int = 0


def _kind(tag: str, names: dict[str, str], inside: bool) -> tuple[int, bool]:
    """How far an element is furniture, and whether it is named as an article; inside: whether it lies in one."""
    if tag in ("html", "body"):
        return NOT, False
    whole = {n.strip("0123456789-_") for v in names.values() for n in v.split()}
    parts = set(_TOKENS.findall(" ".join(names.values())))
    article = tag in ARTICLE_TAGS or bool(parts & ARTICLE)
    if inside:  # an article has a header of its own
        whole, parts = whole - {"header"}, parts - {"header"}
    if tag in FURNITURE_TAGS and not (tag == "header" and inside) and not (tag == "form" and not inside):
        return ALWAYS, article
    if tag == "form" or whole & FURNITURE or parts & COMMENTS:
        return NAMED, article
    return PARTLY if parts & FURNITURE else NOT, article


def parse(page: str, p: SiteTree) -> tuple[list[Node], list[tuple[int, str]]]:
    """The tree of a page's block elements, root first, and its blocks of text, each with its node."""
    nodes = [Node(0, -1, "")]
    blocks: list[tuple[int, str]] = []
    stack, text, links, at = [0], [], 0, 0

    def flush() -> None:
        if text:
            block = _WHITE.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if block:
                nodes[stack[-1]].blocks.append(len(blocks))
                blocks.append((stack[-1], block))

    def add(part: str) -> None:
        if part:
            text.append(part)
            size = len(part)
            nodes[stack[-1]].letters += size
            if links > 0:
                nodes[stack[-1]].linked += size

    for m in _MARKUP.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in BLOCKS:
            if tag == "a":
                links = max(links + (-1 if m["end"] else 1), 0)
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == tag:
                    del stack[k:]
                    break
            links = 0
            continue
        closes = CLOSES.get(tag, {"p"})
        while len(stack) > 1 and nodes[stack[-1]].tag in closes:
            stack.pop()
        names = {k.lower(): v.strip("\"'").lower() for k, v in _NAMES.findall(m["attrs"])}
        parent = nodes[stack[-1]]
        furniture, article = _kind(tag, names, any(nodes[s].article for s in stack))
        # Digits in names number things; without them the elements of different pages meet.
        look = f"{tag}.{re.sub('[0-9]+', '', names.get('class', ''))}"
        key = parent.key if parent.depth >= p.depth else xxhash.xxh3_64_intdigest(f"{parent.key}/{look}") >> 1
        parent.children.append(len(nodes))
        parent.style.append(look)
        nodes.append(Node(key, stack[-1], tag, furniture, article, parent.depth + 1))
        stack.append(len(nodes) - 1)
    if at < len(page) and not page.startswith("<", at):
        add(page[at:])
    flush()
    return nodes, blocks


def _name(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> 1


PARTS = "host string, node long, kind int, feature long"


def _observe(p: SiteTree):
    """What a page gives to its site's tree: each node's children (kind 0) and each different text in it (kind 1)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                seen: list[tuple[str, int, int, int]] = []
                for host, page in zip(batch.column("host").slice(start, 256).to_pylist(), batch.column("html").slice(start, 256).to_pylist(), strict=True):
                    nodes, blocks = parse(page, p)
                    own = {(n.key, 0, _name(" ".join(n.style))) for n in nodes if n.children or not n.blocks}
                    own |= {(nodes[at].key, 1, _name(text)) for at, text in blocks}
                    seen += [(host, *x) for x in own]
                yield pa.record_batch([pa.array([s[k] for s in seen], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int32(), pa.int64()))], names=["host", "node", "kind", "feature"])

    return run


def importances(pages: DataFrame, p: SiteTree) -> DataFrame:
    """host, nodes (array of node, importance) of the merged tree of each host; pages has host and html.

    With m of a feature's total among a node's pages, a presentation's entropy is that of its styles, to the base of
    the number of pages, and a text in n pages has an entropy of log n / log m: one page's text is all its own, a
    text of all pages is none. All of it is sums by key, reduced before each shuffle, so a large host is no large group.
    """
    counted = pages.where("host IS NOT NULL").mapInArrow(_observe(p), PARTS).groupBy("host", "node", "kind", "feature").agg(F.count("*").alias("n"))
    by_kind = counted.groupBy("host", "node", "kind").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    # The sum over features of n log n gives both: the entropy of the styles, and the mean entropy of the texts.
    entropy = F.when(F.col("m") <= 1, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - F.col("nlogn") / (F.col("m") * F.log("m"))))
    node = by_kind.withColumn("value", entropy).groupBy("host", "node").agg(F.max("value").alias("importance"))
    # A node that is missing counts as important, so nodes of one page, which have no bound, are left out.
    node = node.where("importance < 1")
    return node.groupBy("host").agg(F.collect_list(F.struct("node", "importance")).alias("nodes"))


def _furniture(nodes: list[Node], blocks: list[tuple[int, str]], value: list[float], letters: list[int], linked: list[int], p: SiteTree) -> list[bool]:
    """Whether each node lies in furniture. A branch that holds most of the important text and leaves little outside is
    none, though named so; where all of its name or its being a form says so, it also has to hold an article or a first
    heading, or, if a form, its text in paragraphs, and no article may lie outside."""
    mass, prose, size = [0.0] * len(nodes), [0.0] * len(nodes), [0] * len(nodes)
    article, heading = [n.article for n in nodes], [n.tag == "h1" for n in nodes]
    for at, text in blocks:
        size[at] += len(text)
        mass[at] += len(text) * value[at]
        if nodes[at].tag in ("p", "h1"):
            prose[at] += len(text) * value[at]
    within = [n.furniture > NOT for n in nodes]
    for k in range(1, len(nodes)):
        within[k] = within[k] or within[nodes[k].parent]
    outside = sum(m for m, w in zip(mass, within, strict=True) if not w)
    inside = [n.article for n in nodes]
    for k in range(1, len(nodes)):
        inside[k] = inside[k] or inside[nodes[k].parent]
    apart = any(m > 0 and a and not w for m, a, w in zip(mass, inside, within, strict=True))
    for k in range(len(nodes) - 1, 0, -1):
        up = nodes[k].parent
        for part in (mass, prose, size):
            part[up] += part[k]
        article[up], heading[up] = article[up] or article[k], heading[up] or heading[k]
    held = [False] * len(nodes)
    for k in range(1, len(nodes)):
        kind = nodes[k].furniture
        held[k] = held[nodes[k].parent] or kind > NOT
        if held[nodes[k].parent] or kind in (NOT, ALWAYS):
            continue
        most = mass[k] > p.wraps * mass[0] and outside <= p.beside * mass[k]
        if most and mass[k] >= p.share * size[k] and linked[k] <= p.links * letters[k]:
            held[k] = kind == NAMED and (apart or not (article[k] or heading[k] or (nodes[k].tag == "form" and 2 * prose[k] > mass[k])))
    return held


def main_text(page: str, importance: dict[int, float], p: SiteTree) -> str:
    """The blocks of the important branches, in page order. A node that the tree lacks is important."""
    nodes, blocks = parse(page, p)
    value = [importance.get(n.key, 1.0) for n in nodes]
    letters, linked = [n.letters for n in nodes], [n.linked for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):  # children come after their parents
        if nodes[k].children:
            value[k] = (1 - p.children) * value[k] + p.children * sum(value[c] for c in nodes[k].children) / len(nodes[k].children)
        letters[nodes[k].parent] += letters[k]
        linked[nodes[k].parent] += linked[k]
    held = _furniture(nodes, blocks, value, letters, linked, p)
    article = [False] * len(nodes)
    for k in range(1, len(nodes)):
        article[k] = article[nodes[k].parent] or nodes[k].article
    # A branch is noise if nothing in it is important.
    best = value.copy()
    for k in range(len(nodes) - 1, 0, -1):
        best[nodes[k].parent] = max(best[nodes[k].parent], best[k])
    free = [(at, text) for at, text in blocks if not held[at]]
    mass = [len(text) * value[at] for at, text in free]
    some = [m for (at, _), m in zip(free, mass, strict=True) if article[at]]
    if some and sum(some) >= p.articles * sum(mass):
        good = [(at, text) for at, text in free if article[at]]
    else:
        good = [(at, text) for at, text in free if article[at] or linked[at] <= p.links * letters[at]]
    least = p.share * max((best[at] for at, _ in good), default=0.0)
    return "\n".join(text for at, text in good if best[at] >= least)


def host_of(url: Column) -> Column:
    """The host of an address, in lower case without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def _extract(p: SiteTree, carry: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, dict[int, float]] = {}
        for batch in batches:
            hosts, nodes = batch.column("host").to_pylist(), batch.column("nodes")
            for start in range(0, batch.num_rows, 256):
                out = []
                for k, page in enumerate(batch.column("html").slice(start, 256).to_pylist(), start):
                    host = hosts[k]
                    if host not in tables:
                        if len(tables) > 256:
                            tables.clear()
                        tables[host] = {x["node"]: x["importance"] for x in nodes[k].as_py() or ()}
                    out.append(main_text(page, tables[host], p))
                yield pa.record_batch([*(batch.column(c).slice(start, len(out)) for c in carry), pa.array(out, pa.string())], names=[*carry, "text"])

    return run


def extract(pages: DataFrame, p: SiteTree = SiteTree(), carry: tuple[str, ...] = ("page_id", "url"), scratch: Scratch | None = None) -> DataFrame:
    """The carried columns and text for each row of pages (url string, html string).

    The merged trees are written first, so Spark knows their size when it joins them: below its threshold they are
    broadcast and no page moves, beyond it pages meet their tree by host, where skewed hosts are split.

    Null and empty pages have an empty text. Pages without a host are judged alone. Repeated rows count as pages of
    their own. Markup that is never closed ends with the page.
    """
    scratch = scratch or Scratch(pages.sparkSession, "site-tree")
    held = [f"c{k}" for k in range(len(carry))]
    rows = pages.select(*[F.col(c).alias(h) for c, h in zip(carry, held, strict=True)], host_of(F.col("url")).alias("host"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    tree = scratch.table(importances(rows.select("host", "html"), p), "trees")
    joined = rows.join(tree, "host", "left").select(*held, "host", "html", "nodes")
    kinds = dict(rows.dtypes)
    out = joined.mapInArrow(_extract(p, held), ", ".join([*(f"{h} {kinds[h]}" for h in held), "text string"]))
    return out.withColumnsRenamed(dict(zip(held, carry, strict=True)))
