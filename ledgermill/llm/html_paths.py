"""Main text of web pages by paths that the pages of a host agree on.

First pass: every page's containers are scored by the text of their paragraphs, less what is in
links, and named by a generalised path of tags and classes (numbers in class names are one sign).
A container inside an article or main stands for the nearest of these; another one stands for the
highest ancestor with text of its own, such as a title or lead, or, below body, with other blocks of
at least SIBLING of the container's score.
A page gives each of its best containers a vote, its share of the page's best score.  Spark sums
votes by (host, path) and ranks the paths of a host.  Second pass: a page is cut at the first ranked
path that occurs in it and holds text, or at an ancestor with text of its own; without one, at its
own best container.

Inside the container menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out, by tag, role or the words of class and id.  A header or footer inside
an article counts as one of these too, but headings in an article's header stay.  Character
references are decoded, white space inside a block is one space, blocks are joined by \n.

Defined results: null, empty and textless pages give the empty text; a page without any url belongs
to the host ''; equal votes go to the longer, then the alphabetically first path; repeated rows are
extracted each; unclosed and stray tags are repaired as browsers do for paragraphs and list items.
"""

from __future__ import annotations

import html
import re
import sys
import threading

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.common import settle, slices
from ledgermill.llm.urls import host_of

#: Paths of a page that get a vote, and ranked paths of a host that a page tries.
VOTES, RANKED = 3, 8
#: Share of the best container's score from which a block beside it belongs to the article.
SIBLING = 0.2

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|math|select|object)\b"
    r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<bad>/?[a-zA-Z])[^<>]*>|<[!?][^>]*>", re.S | re.I)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr img".split())
_CONTAINERS = frozenset("article main section div td body".split())
_DROPPED = frozenset("nav header footer aside form button dialog menu input".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words in a class or id that mark what is not the article.
_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall "
    "comment comments disqus respond reply replies discussion nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside widget related recommended recommendations share sharing social footer "
    "header masthead toolbar pagination pager login search".split())
_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"))


class Node:
    __slots__ = ("tag", "path", "parts", "dropped", "words", "own", "linked", "link", "heads", "parent", "direct")

    def __init__(self, tag, path, dropped, link, heads, parent=None):
        self.tag, self.path, self.dropped, self.link, self.heads = tag, path, dropped, link, heads
        self.parts: list = []  # strings, and nodes
        self.own = self.linked = self.direct = 0.0
        self.parent = parent


def _boilerplate(tag: str, names: dict[str, str], inside_article: bool) -> bool:
    if tag in _DROPPED:
        return not (tag == "header" and inside_article)
    if names.get("role", "").lower() in _ROLES:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    for key in ("class", "id"):
        value = names.get(key, "")
        if value and not _WORDS.isdisjoint(w.lower() for w in _SPLIT.split(value)):
            return True
    return False


def _step(tag: str, names: dict[str, str]) -> str:
    classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in names.get("class", "").split()})
    return ".".join([tag, *classes])


def parse(page: str) -> Node:
    """The tree of a page's blocks and containers; inline tags leave no node but links."""
    root = Node("", "", False, False, False)
    stack = [root]
    at = 0

    def add(text):
        if text:
            stack[-1].parts.append(text)

    def close(i):
        del stack[i:]

    for m in _TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        name = m.group("name")
        if not name:
            continue
        name = name.lower()
        if name == "br" or name == "wbr":
            add(" " if name == "br" else "")
            continue
        if name in _INLINE and name != "a":
            continue
        if m.group("close"):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    close(i)
                    break
                if name in ("a", "p") and stack[i].tag in _CONTAINERS:
                    break
            continue
        attrs = m.group("attrs")
        if name not in _INLINE:  # a new block ends a paragraph and a link
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ("p", *(_HEADING if name in _CONTAINERS else ())) or (
                        name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[i].tag == name):
                    close(i)
                    break
                if stack[i].tag in _CONTAINERS or stack[i].tag in ("ul", "ol", "table", "dl"):
                    break
        if name in _VOID or attrs.rstrip().endswith("/") and name in ("hr", "img"):
            stack[-1].parts.append(Node(name, "", False, False, False))
            continue
        top = stack[-1]
        names = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _NAMED.findall(attrs)} if attrs else {}
        inside = "/article" in top.path or "/main" in top.path
        dropped = top.dropped or _boilerplate(name, names, inside)
        heads = (top.heads or name == "header" and inside) and name not in _HEADING
        path = f"{top.path}/{_step(name, names)}" if name not in _INLINE else top.path
        node = Node(name, path, dropped, top.link or name == "a", heads, top)
        top.parts.append(node)
        stack.append(node)
    add(page[at:])
    return root


def _score(node: Node, found: dict) -> tuple[float, float]:
    """(text, text in links) below a node; adds each container's score and node by path."""
    text = linked = direct = plain = 0.0
    for part in node.parts:
        if isinstance(part, str):
            n = len(part.strip())
            text += n
            linked += n if node.link else 0
            direct += n
            plain += 0 if node.link else n
        elif not part.dropped:
            t, k = _score(part, found)
            text, linked = text + t, linked + k
            if part.tag not in _CONTAINERS:
                direct += t
                plain += part.direct
            else:
                node.own += 0.5 * part.own
    node.direct = plain
    if node.tag in _CONTAINERS:
        node.own += direct * (1 - linked / text if text else 0)
        score = node.own * (1.2 if node.tag in ("article", "main") else 1.0)
        if score > found.get(node.path, (0.0, None))[0]:
            found[node.path] = score, node
    return text, linked


def _whole(node: Node, siblings: bool) -> Node:
    """The article that a container is a part of; the tree is scored."""
    up, out = node, node
    while up is not None:
        if up.tag in ("article", "main"):
            return up
        up = up.parent
    below, up, least = node, node.parent, SIBLING * node.own
    while up is not None:
        if up.tag in _CONTAINERS:
            if up.direct > 0 or siblings and up.tag != "body" and any(
                    x is not below and x.own >= least for x in _inner(up)):
                out = up
            below = up
        up = up.parent
    return out


def _inner(node: Node) -> list[Node]:
    """The nearest containers below a node, without dropped ones."""
    out, todo = [], [node]
    while todo:
        for part in todo.pop().parts:
            if not isinstance(part, str) and not part.dropped:
                (out if part.tag in _CONTAINERS else todo).append(part)
    return out


def containers(page: str | None) -> list[tuple[str, float]]:
    """The best containers' paths with votes, their share of the best score."""
    if not page:
        return []
    found: dict[str, tuple[float, Node]] = {}
    _deep(_score, parse(page), found)
    best: dict[str, float] = {}
    for path, (score, node) in sorted(found.items(), key=lambda x: (-x[1][0], -len(x[0]), x[0])):
        best.setdefault(_whole(node, True).path, score)
        if len(best) == VOTES:
            break
    return [(path, score / max(best.values())) for path, score in best.items()]


def _blocks(node: Node, out: list[list[str]]):
    if node.tag not in _INLINE:
        out.append([])
    for part in node.parts:
        if isinstance(part, str):
            if not node.heads:
                out[-1].append(part)
        elif not part.dropped:
            _blocks(part, out)
    if node.tag not in _INLINE:
        out.append([])


def text_of(node: Node) -> str:
    out: list[list[str]] = [[]]
    _blocks(node, out)
    lines = (" ".join(html.unescape("".join(b)).split()) for b in out if b)
    return "\n".join(x for x in lines if x)


def _at(node: Node, path: str) -> list[Node]:
    if node.dropped:
        return []
    if node.path == path and node.tag in _CONTAINERS:
        return [node]
    return [x for p in node.parts if not isinstance(p, str) and (
        path.startswith(p.path) or p.tag in _INLINE) for x in _at(p, path)]


def _outermost(nodes: list[Node]) -> list[Node]:
    """The nodes once each, without those inside another."""
    ids, out = {id(n) for n in nodes}, {}
    for n in nodes:
        up = n.parent
        while up is not None and id(up) not in ids:
            up = up.parent
        if up is None:
            out[id(n)] = n
    return list(out.values())


def extract(page: str | None, ranked: list[str]) -> tuple[str, str | None]:
    """(main text, path used) of a page by the host's ranked paths."""
    if not page:
        return "", None
    root = parse(page)
    _deep(_score, root, {})
    own = None
    for path in [*ranked, None]:
        if path is None:
            own = containers(page)
            path = own[0][0] if own else None
            if path is None:
                return _deep(text_of, root), None
        nodes = _outermost([_whole(n, False) for n in _deep(_at, root, path)])
        text = "\n".join(t for t in (_deep(text_of, n) for n in nodes) if t)
        if text:
            return text, path
    return "", None


def _deep(f, *args):
    """Call a function that recurses over a tree; deeply nested pages get the depth they need."""
    try:
        return f(*args)
    except RecursionError:
        old, box = sys.getrecursionlimit(), []
        sys.setrecursionlimit(1_000_000)
        threading.stack_size(512 << 20)
        t = threading.Thread(target=lambda: box.append(f(*args)))
        t.start()
        t.join()
        threading.stack_size(0)
        sys.setrecursionlimit(old)
        return box[0]


def host_paths(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, paths): for each host the RANKED paths with most votes of all its pages."""
    def run(batches):
        for batch in batches:
            hosts = batch.column(0)
            column = batch.column(1)
            for a, b in slices(pc.fill_null(pc.utf8_length(column), 0).to_numpy()):
                total: dict[tuple[str, str], float] = {}
                for host, text in zip(hosts.slice(a, b - a).to_pylist(), column.slice(a, b - a).to_pylist()):
                    for path, vote in containers(text):
                        total[host, path] = total.get((host, path), 0.0) + vote
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h for h, _ in total], pa.string()), pa.array([p for _, p in total], pa.string()),
                     pa.array([round(v * 1e6) for v in total.values()], pa.int64())], ["host", "path", "votes"])

    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(page).alias("page"))
    votes = (rows.mapInArrow(run, "host string, path string, votes long")
             .groupBy("host", "path").agg(F.sum("votes").alias("votes")))
    order = W.partitionBy("host").orderBy(F.desc("votes"), F.desc(F.length("path")), "path")
    top = votes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= RANKED)
    paths = F.array_sort(F.collect_list(F.struct("rank", "path")))
    return top.groupBy("host").agg(F.transform(paths, lambda x: x["path"]).alias("paths"))


def extract_pages(pages: DataFrame, url: str = "url", page: str = "html", out: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all by default), the main text, and `path`, where it was found.

    The paths of all hosts are one row per host with at most RANKED paths; they are settled first,
    so that they are broadcast where small and met by a skew join where not.
    """
    kept = [c for c in (pages.columns if keep is None else keep) if c not in (out, "path")]
    schema = T.StructType([*(pages.schema[c] for c in kept), T.StructField(out, T.StringType()),
                           T.StructField("path", T.StringType())])
    paths = settle(host_paths(pages, url, page), "html-paths").select(
        F.col("host").alias("x1_host"), F.col("paths").alias("x1_paths"))
    source = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(page).alias("x1_page"),
                          host_of(F.col(url)).alias("x1_at"))
    joined = source.join(paths, F.col("x1_at") == F.col("x1_host"), "left").drop("x1_at", "x1_host")

    def run(batches):
        for batch in batches:
            column, rest, ranked = batch.column("x1_page"), batch.select(kept), batch.column("x1_paths")
            for a, b in slices(pc.fill_null(pc.utf8_length(column), 0).to_numpy()):
                got = [extract(t, p or []) for t, p in zip(
                    column.slice(a, b - a).to_pylist(), ranked.slice(a, b - a).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*rest.slice(a, b - a).columns, pa.array([t for t, _ in got], pa.string()),
                     pa.array([p for _, p in got], pa.string())], [*kept, out, "path"])

    return joined.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op1: the main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract_pages(pages, keep=["page_id", "url"]).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")
