"""Main text of web pages by aligning the pages of a host: what recurs is template, what varies is text.

A page is a stream of tags and texts; texts between two block tags are one block, which stands in a path of containers.
All pages of a host are aligned to a wrapper, a union-free expression of block tags, text positions, optional and repeated
groups: pages of one structure at once, structures a few at a time, and then the wrappers of those, until the host has
one. A wrapper counts on how many pages each of its nodes is; nodes on so few that no position could count (see below)
are not carried on, which bounds a wrapper however many pages a host has. Then every page of the host is aligned with
that wrapper, so that its blocks fall on the wrapper's positions, and all pages are counted: in how many distinct ones a
position or a path occurs, and in how many each block of it. A block that at least four in five of the pages with its position or path share (``_CONSTANT``; three
pages at least) is a constant of the template; all others fill slots. A position counts if a quarter of the host's pages
have it (``_OPTIONAL``): an optional part may be on few pages, but a handful of copies is no template. Paths serve what
the wrapper does not cover, such as rare templates of the host.

A page's text is then taken from its slots. Names come second: of the slots, those under navigation, headers, footers,
asides, forms, adverts, notices or comments are left out, and those under an article or main element are preferred.
Without such an element the text is what stands under the deepest container that holds most of the slots' text, each
path weighed by its mean varying text over the host's pages. A page of which nothing varies keeps its text.

``wrappers`` gives the wrapper of a host with inline tags, navigation and constant texts as a regular expression to read.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import pairwise
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from provwatch.llm.blocks import blocks
from provwatch.llm.tables import saved
from provwatch.sources.sinks import work_folder

_AT_ONCE = 8  # wrappers of parts of a host's pages that a task makes one of
# Share of the pages aligned so far under which a node is not carried on, and the same for a host's whole wrapper. A node on
# a quarter of a host's pages (``_OPTIONAL``) loses one in 64 of them at most each time the parts become eight times fewer.
_RARE, _RARE_IN_ALL = (1, 64), (1, 16)
_DIRECT = 1_000_000  # pairs of nodes up to which two lists are compared as a whole
_LEAST_PAGES = 3  # distinct pages from which a path tells anything about its host
_CONSTANT = (4, 5)  # share of a path's pages that a constant block is on
_OPTIONAL = (1, 4)  # share of a host's pages from which a position of the wrapper is judged by itself
_KNOWN = 64  # structures of a host whose places in its wrapper a task remembers
_SENT_BYTES = 32 << 20  # rules of all hosts up to which they are broadcast

# HTML elements by their part in a page.
_SKIPPED = {"script", "style", "noscript", "template", "svg", "iframe", "object", "head", "select", "textarea", "button"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {
    *("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure".split()),
    *("footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre search section".split()),
    *("summary table tbody td tfoot th thead tr ul".split()),
}
_CONTAINER = {
    *("article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav ol search".split()),
    *("section table ul".split()),
}
_TEMPLATE_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "search", "fieldset"}
_TEMPLATE_WORDS = {
    *("ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs byline comment comments consent cookie".split()),
    *("cookies disqus feedback footer gdpr header legal masthead menu modal nav navbar navigation newsletter notice".split()),
    *("notification pagination popup promo promoted promotion recommended related reply replies respond share sharing".split()),
    *("sidebar signup social sponsor sponsored subscribe teaser toolbar widget".split()),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

Token = tuple[str, str, tuple[str, ...]]  # kind (open, close or text), tag key or text, path of containers


def tokens(page: str) -> list[Token]:
    """Tags and texts in page order, each with the containers it stands in. Skipped elements and comments are left out."""
    out: list[Token] = []
    path: list[tuple[str, str]] = []
    at, n = 0, len(page)

    def text(part: str) -> None:
        if part:
            out.append(("text", part, tuple(key for _, key in path)))

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in _SKIPPED and not m["end"]:
            if name == "head":  # its end tag may be missing
                close = re.compile(r"</head\s*>|(?=<body\b)", re.I).search(page, at)
            else:
                close = re.compile(rf"</{re.escape(name)}\s*[^>]*>", re.I).search(page, at)
            at = close.end() if close else n
            continue
        if m["end"]:
            if name in _CONTAINER and any(tag == name for tag, _ in path):
                while path.pop()[0] != name:
                    pass
            out.append(("close", name, tuple(key for _, key in path)))
            continue
        names = " ".join(x for found in _NAMES.findall(m["attrs"] or "") for x in found if x)
        key = f"{name}.{re.sub(r'[0-9]+', '0', names.lower())}" if names else name
        out.append(("open", key, tuple(k for _, k in path)))
        if name in _CONTAINER and not (m["attrs"] or "").endswith("/"):
            path.append((name, key))
    return out


def is_template(key: str) -> bool:
    """Whether an element is navigation, advert, notice, comment or the like by its tag or names."""
    name, _, names = key.partition(".")
    return name in _TEMPLATE_TAGS or (name != "body" and bool(_TEMPLATE_WORDS & set(re.split(r"[^a-z]+", names))))


Node = list  # ["tag", key], ["text", constant or None, path, numbers of blocks if any], ["opt", nodes] or ["rep", nodes]


def _shape(node: Node) -> str:
    """What must be equal for two nodes to be aligned."""
    if node[0] == "tag":
        return node[1]
    if node[0] == "text":
        return "#" + "/".join(node[2])
    return node[0] + "(" + ",".join(map(_shape, node[1])) + ")"


def _fold(nodes: list[Node]) -> list[Node]:
    """Replace immediate repetitions of up to 12 tokens by one repeated group (shortest first)."""
    for width in range(1, 13):
        out: list[Node] = []
        shapes = [_shape(x) for x in nodes]
        i = 0
        while i < len(nodes):
            j = i + width
            if shapes[i][0] not in "/#" or width == 1:
                while j + width <= len(nodes) and shapes[j : j + width] == shapes[i : i + width]:
                    j += width
            if j > i + width and not (width == 1 and nodes[i][0] == "rep"):
                group = nodes[i : i + width]
                for k in range(i + width, j, width):
                    group = [_merged(a, b) for a, b in zip(group, nodes[k : k + width], strict=True)]
                out.append(["rep", group])
                i = j
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def _merged(a: Node, b: Node) -> Node:
    """Two aligned nodes as one: texts that differ become a slot."""
    if a[0] == "text":
        if len(a) > 3 and len(b) > 3:
            a[3].extend(b[3])  # of the same page, which is folded
        return ["text", a[1] if a[1] == b[1] else None, *a[2:]]
    if a[0] in ("rep", "opt"):
        return [a[0], [_merged(x, y) for x, y in zip(a[1], b[1], strict=True)]]
    return a


def _bare(node: Node) -> Node:
    return node[1][0] if node[0] == "opt" and len(node[1]) == 1 else node


def _shared_once(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Places of what occurs once in ``a`` and once in ``b``: the most that are in the same order."""
    in_a, in_b = Counter(a), Counter(b)
    at = {x: j for j, x in enumerate(b) if in_b[x] == 1}
    ends: list[int] = []  # longest rising run of places in b, by patience sorting
    runs: list[tuple[int, int, int]] = []
    last: list[int] = []
    for i, x in enumerate(a):
        if in_a[x] == 1 and x in at:
            k = bisect_left(ends, at[x])
            runs.append((i, at[x], last[k - 1] if k else -1))
            ends[k : k + 1], last[k : k + 1] = [at[x]], [len(runs) - 1]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        i, j, k = runs[k]
        out.append((i, j))
    return out[::-1]


def _matching(a: Sequence, b: Sequence) -> list[tuple[int, int, int]]:
    """Matching runs of two lists as places and lengths, in order.

    Long lists are cut where both have what they have once, and the pieces compared; of long pieces without such places
    frequent elements match beside others only.
    """
    out, left = [], [(0, len(a), 0, len(b))]
    while left:
        i, i_end, j, j_end = left.pop()
        x, y = a[i:i_end], b[j:j_end]
        cuts = [] if len(x) * len(y) <= _DIRECT else _shared_once(x, y)
        if not cuts:
            matcher = SequenceMatcher(None, x, y, autojunk=len(x) * len(y) > _DIRECT)
            out.extend((i + k, j + m, n) for k, m, n in matcher.get_matching_blocks() if n)
            continue
        out.extend((i + k, j + m, 1) for k, m in cuts)
        ends = [(-1, -1), *cuts, (len(x), len(y))]
        left.extend((i + k + 1, i + p, j + m + 1, j + q) for (k, m), (p, q) in pairwise(ends) if k + 1 < p and m + 1 < q)
    return sorted(out)


def _widened(
    wrapper: list[Node], page: list[Node], wrapper_pages: Sequence[int], page_pages: Sequence[int]
) -> tuple[list[Node], list[int]]:
    """``align``, with the number of pages that each node is on."""
    flat_w, flat_p = [_bare(x) for x in wrapper], [_bare(x) for x in page]
    out: list[Node] = []
    on: list[int] = []

    def optional(nodes: list[Node], pages: Sequence[int]) -> None:
        out.extend(x if x[0] == "opt" else ["opt", [x]] for x in nodes)
        on.extend(pages)

    at, to = 0, 0
    for a, c, n in [*_matching([_shape(x) for x in flat_w], [_shape(x) for x in flat_p]), (len(wrapper), len(page), 0)]:
        left, right = (wrapper[at:a], wrapper_pages[at:a]), (page[to:c], page_pages[to:c])
        # a group seen repeatedly on one side and once on the other
        for one, other in ((left, right), (right, left)):
            groups, once = [_bare(x) for x in one[0]], [_bare(x) for x in other[0]]
            if len(groups) == 1 and groups[0][0] == "rep" and [_shape(x) for x in groups[0][1]] == [_shape(x) for x in once]:
                out.append(["rep", [_merged(x, y) for x, y in zip(groups[0][1], once, strict=True)]])
                on.append(one[1][0] + max(other[1]))
                break
        else:
            optional(*left)
            optional(*right)
        for k in range(n):
            both = _merged(flat_w[a + k], flat_p[c + k])
            out.append(["opt", [both]] if "opt" in (wrapper[a + k][0], page[c + k][0]) else both)
            on.append(wrapper_pages[a + k] + page_pages[c + k])
        at, to = a + n, c + n
    return out, on


def align(wrapper: list[Node], page: list[Node]) -> list[Node]:
    """The wrapper widened so that it also matches ``page``, or another wrapper: what only one side has becomes optional.

    A repeated group matches one occurrence of itself in the page as well.
    """
    return _widened(wrapper, page, [1] * len(wrapper), [1] * len(page))[0]


class Aligned(NamedTuple):
    """A wrapper, on how many pages each of its nodes is, and how many pages it is of."""

    nodes: list[Node]
    on: list[int]
    pages: int

    def without(self, rare: tuple[int, int]) -> Aligned:
        part, whole = rare
        kept = [k for k, n in enumerate(self.on) if n * whole >= self.pages * part]
        return Aligned([self.nodes[k] for k in kept], [self.on[k] for k in kept], self.pages)


def unite(parts: Iterable[Aligned]) -> Aligned:
    """One wrapper of several, or of pages; without nodes that are rare on all of their pages."""
    nodes, on, pages = [], [], 0
    for part in parts:
        if nodes and part.nodes:
            nodes, on = _widened(nodes, part.nodes, on, part.on)
        elif part.nodes:
            nodes, on = part.nodes, part.on
        pages += part.pages
    return Aligned(nodes, on, pages).without(_RARE)


def _page_nodes(page: str) -> list[Node]:
    nodes: list[Node] = []
    for kind, value, path in tokens(page):
        if kind == "text":
            value = " ".join(html.unescape(value).split())
            if value:
                nodes.append(["text", value, list(path)])
        else:
            nodes.append(["tag", value if kind == "open" else "/" + value])
    return _fold(nodes)


def _of_pages(pages: Iterable[list[Node]]) -> Aligned:
    return unite(Aligned(nodes, [1] * len(nodes), 1) for nodes in pages)


def infer(pages: list[str]) -> dict:
    """Union-free expression of same-host pages."""
    return {"expression": _text_of(_of_pages(map(_page_nodes, pages)).nodes)}


def _text_of(nodes: list[Node]) -> str:
    """The wrapper as a readable regular expression."""
    out = []
    for x in nodes:
        if x[0] == "tag":
            out.append(f"<{x[1]}>")
        elif x[0] == "text":
            out.append("#" if x[1] is None else x[1][:80])
        else:
            out.append(f"({_text_of(x[1])}){'?' if x[0] == 'opt' else '+'}")
    return "".join(out)


def _number(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


@lru_cache(maxsize=4096)
def _path_number(path: tuple[str, ...]) -> int:
    return _number(*path)


@lru_cache(maxsize=4096)
def _is_slot_path(path: tuple[str, ...]) -> bool:
    return not any(map(is_template, path))


@lru_cache(maxsize=4096)
def _is_named(path: tuple[str, ...]) -> bool:
    return any(key.partition(".")[0] in ("article", "main") for key in path)


def block_nodes(page: str) -> list[Node]:
    """Block tags and numbered blocks of text outside template elements, in page order."""
    out: list[Node] = []
    run: list[str] = []
    at: tuple[str, ...] = ()
    n = 0

    def close() -> None:
        nonlocal n
        block = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if block and _is_slot_path(at):
            out.append(["text", block, at, [n]])
            n += 1

    for kind, value, path in tokens(page):
        if kind == "text":
            run.append(value)
            at = path
        else:
            name = value.partition(".")[0]
            if name in _BLOCK:
                close()
                if _is_slot_path(path) and not is_template(value):
                    out.append(["tag", value if kind == "open" else "/" + value])
            elif name == "br":
                run.append(" ")
    close()
    return out


def page_blocks(nodes: list[Node]) -> list[tuple[tuple[str, ...], str]]:
    """Blocks of text, in page order, each with its path of containers."""
    return [(x[2], x[1]) for x in nodes if x[0] == "text"]


def _short(path: tuple[str, ...]) -> list[str]:
    return [str(_path_number(path))]


def _structure(nodes: list[Node]) -> list[Node]:
    """Folded block nodes, whatever their texts say; paths, which may be long, as numbers."""
    return _fold([["text", None, _short(x[2])] if x[0] == "text" else x for x in nodes])


def _shapes(wrapper: list[Node]) -> list[int]:
    return [_number(_shape(_bare(x))) for x in wrapper]


def _page_number(found: list[tuple[tuple[str, ...], str]]) -> int:
    """Pages of equal blocks are one page, whatever their navigation says."""
    return _number(*(x for path, text in found for x in (*path, text)))


def induce(pages: list[str]) -> list[int]:
    """Wrapper of a few same-host pages by aligning them one after another: its positions' shapes as numbers."""
    return _shapes(_of_pages(_structure(block_nodes(page)) for page in pages).nodes)


def _leaves(node: Node) -> list[Node]:
    if node[0] in ("opt", "rep"):
        return [leaf for x in node[1] for leaf in _leaves(x)]
    return [node] if node[0] == "text" else []


class Positions:
    """Aligns pages with a wrapper."""

    def __init__(self, wrapper: list[int]):
        self.wrapper = wrapper
        self.known: dict[int, list[tuple[int, int, int]]] = {}  # of pages by their structure

    def of(self, nodes: list[Node]) -> dict[int, int]:
        """Position in the wrapper of each block that has one; blocks of a repeated group share theirs."""
        if not self.wrapper:
            return {}
        nodes = _fold([["text", x[1], _short(x[2]), list(x[3])] if x[0] == "text" else x for x in nodes])
        shapes = [_shape(x) for x in nodes]
        structure = _number(*shapes)
        if structure not in self.known:
            if len(self.known) >= _KNOWN:
                self.known.clear()
            self.known[structure] = _matching([_number(x) for x in shapes], self.wrapper)
        out = {}
        for i, j, n in self.known[structure]:
            for k in range(n):
                for leaf, node in enumerate(_leaves(nodes[i + k])):
                    out.update(dict.fromkeys(node[3], _position_number(j + k, leaf)))
        return out


@lru_cache(maxsize=4096)
def _position_number(at: int, leaf: int) -> int:
    return _number("position", str(at), str(leaf))


@lru_cache(maxsize=256)
def _positions(wrapper: tuple[int, ...]) -> Positions:
    return Positions(list(wrapper))


class Wrapper:
    """What all pages of a host tell: the mean varying text of each path, and constant blocks of paths and positions."""

    def __init__(self, paths: list[tuple[int, float, list[int]]], positions: Positions):
        self.mean = {path: mean for path, mean, _ in paths}
        self.constants = {(path, text) for path, _, texts in paths for text in texts}
        self.positions = positions

    def extract(self, page: str) -> str:
        """Blocks of content, in page order."""
        nodes = block_nodes(page)
        found = page_blocks(nodes)
        if self.constants:
            at = self.positions.of(nodes)
            slots = [
                (p, t)
                for k, (p, t) in enumerate(found)
                if not {(_path_number(p), _number(t)), (at.get(k), _number(t))} & self.constants
            ]
            found = slots or found  # a page of which nothing varies keeps its text
        paths = {p for p, _ in found}
        content = {p for p in paths if _is_named(p)}
        if not content:
            own: Counter = Counter()
            for p, t in found:
                own[p] += len(t)
            parts: Counter = Counter()
            for p in paths:
                for k in range(len(p) + 1):
                    parts[p[:k]] += self.mean.get(_path_number(p), own[p])
            best = max((p for p in parts if parts[p] >= 0.6 * parts[()]), key=lambda p: (len(p), parts[p], p), default=())
            content = {p for p in paths if p[: len(best)] == best}
        return "\n".join(t for p, t in found if p in content)


@lru_cache(maxsize=256)
def _wrapper(rules: str | None) -> Wrapper:
    found = json.loads(rules or "{}")
    paths = [(x["path"], x["mean"], x.get("texts") or []) for x in found.get("paths", [])]
    return Wrapper(paths, Positions(found.get("wrapper") or []))


def _host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _structures(read: Callable[[str], tuple[list[Node], int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per page its host, the numbers of its structure and of the page, and its nodes, once in a block for pages of one structure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, column = batch.column("host").to_pylist(), batch.column("html")
            for block in blocks(column):
                rows: list[tuple[str, int, int, str | None]] = []
                told = set()
                n = block.last - block.first
                for host, page in zip(hosts[block.first : block.last], column.slice(block.first, n).to_pylist(), strict=True):
                    nodes, number = read(page or "")
                    text = json.dumps(nodes)
                    structure = _number(text)
                    rows.append((host, structure, number, None if (host, structure) in told else text))
                    told.add((host, structure))
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                    names=["host", "part", "page", "nodes"],
                )

    return run


def _unite_parts(frame: pd.DataFrame) -> pd.DataFrame:
    """One row of the parts of a host that come together; pages of the largest part come first."""
    frame = frame.sort_values(["pages", "part"], ascending=[False, True])
    parts = []
    for text, on, pages in zip(frame["nodes"], frame["on"], frame["pages"], strict=True):
        nodes = json.loads(text)
        parts.append(Aligned(nodes, [int(pages)] * len(nodes) if on is None else [int(n) for n in on], int(pages)))
    found = unite(parts)
    row = {"host": frame["host"].iloc[0], "part": frame["part"].min(), "pages": found.pages, "on": found.on, "nodes": json.dumps(found.nodes)}
    return pd.DataFrame({name: [value] for name, value in row.items()})


def _by_host(pages: DataFrame, read: Callable[[str], tuple[list[Node], int]], least: int, folder: str) -> DataFrame:
    """One row per host of ``least`` pages: host, pages and nodes of the wrapper that all of them are aligned to.

    Structures are dealt by their numbers, so a host of many is aligned in as many tasks; pages of equal numbers are one.
    """
    found = pages.where("html is not null").select(_host(F.col("url")).alias("host"), "html")
    found = found.mapInArrow(_structures(read), "host string, part long, page long, nodes string")
    found = found.groupBy("host", "part", "page").agg(F.max("nodes").alias("nodes"))
    found = found.groupBy("host", "part").agg(F.count("*").alias("pages"), F.lit(None).cast("array<long>").alias("on"), F.max("nodes").alias("nodes"))
    found = saved(found, f"{folder}/structures")
    sizes = found.groupBy("host").agg(F.count("*").alias("n"), F.sum("pages").alias("pages")).where(F.col("pages") >= least)
    most = sizes.agg(F.max("n")).first()[0] or 0
    dealt = 1
    while dealt * _AT_ONCE < most:
        dealt *= _AT_ONCE
    if least > 1:
        found = found.join(sizes.select("host"), "host", "left_semi")
    while dealt:
        to = F.pmod(F.xxhash64("part"), F.lit(dealt)).alias("to")
        found = found.groupBy("host", to).applyInPandas(_unite_parts, "host string, part long, pages long, on array<long>, nodes string")
        found = saved(found, f"{folder}/parts-{dealt}")
        dealt //= _AT_ONCE
    return found.select("host", "pages", "on", "nodes")


def _whole(frame: pd.DataFrame, value: Callable[[list[Node]], object]) -> list:
    """A value of each row's wrapper, without the nodes that are rare on its host."""
    rows = zip(frame["nodes"], frame["on"], frame["pages"], strict=True)
    return [value(Aligned(json.loads(text), list(on), pages).without(_RARE_IN_ALL).nodes) for text, on, pages in rows]


def wrappers(pages: DataFrame) -> DataFrame:
    """One row per host: host, pages (distinct ones, all of them aligned) and expression (of those pages, for reading)."""

    def read(page: str) -> tuple[list[Node], int]:
        return _page_nodes(page), _number(page)

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"host": frame["host"], "pages": frame["pages"], "expression": _whole(frame, _text_of)})

    found = _by_host(pages, read, 1, work_folder(pages.sparkSession, "wrappers"))
    return found.mapInPandas(learn, "host string, pages long, expression string")


def aligned(pages: DataFrame, folder: str) -> DataFrame:
    """One row per host of at least three distinct pages: host (as a number) and the shapes of its wrapper's positions."""

    def read(page: str) -> tuple[list[Node], int]:
        nodes = block_nodes(page)
        return _structure(nodes), _page_number(page_blocks(nodes))

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"host": frame["host"], "wrapper": _whole(frame, _shapes)})

    found = _by_host(pages, read, _LEAST_PAGES, folder).mapInPandas(learn, "host string, wrapper array<long>")
    return found.where(F.size("wrapper") > 0).select(F.xxhash64("host").alias("host"), "wrapper")


def _sent(df: DataFrame, size) -> DataFrame:
    """Marked for broadcast if its ``size`` is small."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= _SENT_BYTES else df


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page each path, each position and block as numbers, with the block's length times its occurrences."""
    for batch in batches:
        hosts, wrappers_, column = batch.column("host").to_pylist(), batch.column("wrapper"), batch.column("html")
        for block in blocks(column):
            n = block.last - block.first
            rows: list[tuple[int, int, bool, int, int, int]] = []
            read = zip(
                hosts[block.first : block.last],
                column.slice(block.first, n).to_pylist(),
                wrappers_.slice(block.first, n).to_pylist(),
                strict=True,
            )
            for host, page, wrapper in read:
                nodes = block_nodes(page or "")
                found = page_blocks(nodes)
                if found:
                    at = _positions(tuple(wrapper or ())).of(nodes)
                    own: Counter = Counter()
                    for k, (path, text) in enumerate(found):
                        own[False, _path_number(path), _number(text)] += len(text)
                        if k in at:
                            own[True, at[k], _number(text)] += len(text)
                    digest = _page_number(found)
                    rows.extend((host, digest, *key, size) for key, size in own.items())
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.bool_() if k == 2 else pa.int64()) for k, c in enumerate(columns)],
                names=["host", "page", "position", "path", "text", "size"],
            )


def rules(pages: DataFrame) -> DataFrame:
    """One row per host (as a number): its wrapper, and its paths and constants, from all of its pages.

    Paths and positions of at least three distinct pages are kept, of the positions those with constants.
    """
    folder = work_folder(pages.sparkSession, "wrappers")
    wrapped = saved(aligned(pages, folder), f"{folder}/aligned")
    seen = pages.where("html is not null").select(F.xxhash64(_host(F.col("url"))).alias("host"), "html")
    seen = seen.join(_sent(wrapped, F.size("wrapper") * 8), "host", "left")
    seen = seen.mapInArrow(_survey, "host long, page long, position boolean, path long, text long, size long")
    seen = saved(seen.dropDuplicates(["host", "page", "position", "path", "text"]), f"{folder}/seen")
    # keys are finer than hosts, so a large host is spread over all tasks
    key = ["host", "position", "path"]
    paths = seen.groupBy(*key, "page").agg(F.sum("size").alias("size")).groupBy(*key)
    paths = saved(paths.agg(F.count("*").alias("pages"), F.sum("size").alias("size")).where(F.col("pages") >= _LEAST_PAGES), f"{folder}/paths")
    texts = seen.groupBy(*key, "text").agg(F.count("*").alias("n"), F.sum("size").alias("fixed")).where(F.col("n") >= _LEAST_PAGES)
    part, whole = _CONSTANT
    fixed = texts.join(paths.drop("size"), key).where(F.col("n") * whole >= F.col("pages") * part)
    fixed = fixed.groupBy(*key).agg(F.sort_array(F.collect_list("text")).alias("texts"), F.sum("fixed").alias("fixed"))
    mean = (F.col("size") - F.coalesce("fixed", F.lit(0))) / F.col("pages")
    entry = F.struct("path", mean.alias("mean"), "texts")
    part, whole = _OPTIONAL
    sizes = seen.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    judged = F.col("texts").isNotNull() & (F.col("pages") * whole >= F.col("host_pages") * part)
    found = paths.join(fixed, key, "left").join(sizes, "host").where(~F.col("position") | judged)
    found = found.groupBy("host").agg(F.sort_array(F.collect_list(entry)).alias("paths"), F.max("position").alias("aligned"))
    found = found.join(wrapped, "host", "left").withColumn("wrapper", F.when(F.col("aligned"), F.col("wrapper")))
    return saved(found.select("host", F.to_json(F.struct("wrapper", "paths")).alias("rules")), f"{folder}/rules")


def extract(pages: DataFrame) -> DataFrame:
    """Every row of ``pages`` with text: its main text, or the empty text if it has none.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by a line feed.
    A null html has no text; pages without a host in their url share one template. Repeated rows give equal texts.
    A column named text is replaced; all others are kept.
    """
    learned = rules(pages).select(F.col("host").alias("_host"), F.col("rules").alias("_rules"))
    learned = _sent(learned, F.length("_rules"))
    pages = pages.drop("text")
    names = pages.columns
    # the caller's columns under names of their own until the end
    inner = pages.select(F.xxhash64(_host(F.col("url"))).alias("_host"), *(F.col(c).alias(f"_in_{c}") for c in names))
    joined = inner.join(learned, "_host", "left").drop("_host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, found_rules = batch.column("_in_html"), batch.column("_rules")
            for block in blocks(column):
                n = block.last - block.first
                found = [
                    _wrapper(r).extract(h) if h else ""
                    for h, r in zip(
                        column.slice(block.first, n).to_pylist(), found_rules.slice(block.first, n).to_pylist(), strict=True
                    )
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(f"_in_{c}").slice(block.first, n) for c in names), pa.array(found, pa.string())],
                    names=[*names, "text"],
                )

    fields = T.StructType(pages.schema.fields)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return joined.mapInArrow(run, f"{ddl}, text string")
