"""HTML extraction (9): wrappers by union-free regular-expression inference.

Every page becomes a stream of tags and texts. The pages of a host are aligned one
after the other into the host's wrapper, a regular expression without unions:
equal tags align; a mismatch becomes a repeated group when it repeats the group
before it, otherwise an optional group; texts that differ become text slots, and
those that agree stay template text. A wrapper is aligned with a wrapper just as
with a page, so each task makes one wrapper per host of its own pages and the
wrappers of a host are then aligned with each other. All pages count; what meets
in one task is a few small wrappers, not a host's pages. A large wrapper loses no
group: those that few pages have and that differ only by class become one (see ``prune``).

A wrapper is matched against each of its host's pages to get the main text:

* The regions are the wrapper's groups of <article> or <main> (or their roles), else
  the group whose slots hold the most text outside links over all pages. A page gives
  what stands at the place of these groups; a page that matches no group is taken as
  a host of its own.
* Inside, groups of menus, headers, footers, sidebars, notices, adverts, forms,
  scripts and comments are left out, by element, role, or a word of class or id. A word is
  a hint only: what holds the page's <main> or <h1> isn't left out for it.
* Without a marked region, text that the wrapper holds as template text of a host
  with ``AGREE`` or more pages is left out too; template text within a marked region is
  kept, as an article may be posted many times.

Blocks are joined by newlines; character references are decoded and white space in
a block becomes one space. A null or empty page gives the empty string. Broken or
cut-off markup closes at the end of the page. Pages that repeat are treated alike. Very
long and very deep pages are read whole: in a wrapper, what lies deeper than ``DEEP``
elements stands side by side there (see ``below``).
"""

from __future__ import annotations

import hashlib
import html as references
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: Pages of a host from which a template text is believed to be one.
AGREE = 4
#: Nodes from which a wrapper's rare groups are joined, least often seen first, once it is aligned.
MOST_NODES = 400
#: Depth from which a wrapper holds what is deeper side by side.
DEEP = 40
#: Longer template texts are held by a digest.
LONG = 40

# Element names and words of class, id and role, as HTML and its common usage define them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas textarea title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
APART = frozenset("nav header footer aside form button select menu dialog head".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
WORDS = re.compile(r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|foot|sidebar|aside|widget|ads?|advert|adverts|advertisement|advertising|banner|promo|promoted|promotion|sponsor|sponsored|cookie|cookies|consent|notice|notification|alert|popup|modal|newsletter|subscribe|subscription|signup|login|comment|comments|disqus|replies|respond|related|recommended|share|sharing|social|toolbar|pagination|pager|skip|hidden)(?:$|[\s_-])", re.I)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
SCOPES = frozenset("html body div article main section table ul ol dl td th blockquote nav aside header footer form fieldset figure details".split())

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|$)|<[a-zA-Z/][^<]*$|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")


class Node:
    """An element or (name '') a text."""

    __slots__ = ("name", "label", "kids", "text", "apart", "region", "hint")

    def __init__(self, name: str, label: str = "", text: str = "", apart: bool = False, region: bool = False):
        self.name, self.label, self.text, self.apart, self.region = name, label, text, apart, region
        self.hint = False  # apart for a word of class or id alone
        self.kids: list[Node] = []


def below(node: Node, depth: int) -> list[Node]:
    """What a wrapper holds in a node at this depth: its kids; at ``DEEP`` all that is deeper as well, but within regions, links and what stands apart."""
    if depth != DEEP:
        return node.kids if depth < DEEP else []
    out, todo = [], node.kids[::-1]
    while todo:
        x = todo.pop()
        out.append(x)
        if not (x.apart or x.region or x.name == "a"):
            todo += x.kids[::-1]
    return out


def parse(page: str) -> Node:
    """The tree of a page. Texts keep their white space; character references are decoded."""
    root = Node("#")
    stack = [root]
    at, n = 0, len(page)
    while at < n:
        m = TOKEN.match(page, at)
        if m is None:
            break
        at = m.end()
        piece = m.group(0)
        name = m.group(2)
        if name is None:
            if piece[0] != "<" or piece == "<":
                stack[-1].kids.append(Node("", text=references.unescape(piece)))
            continue
        name = name.lower()
        if m.group(1):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
                if stack[k].name in SCOPES and name not in SCOPES:
                    break
            continue
        label, apart, region, hint = name, name in APART, name in ("article", "main"), False
        if name in ("h1", "main"):
            for x in stack:
                if x.hint:
                    x.apart = x.hint = False
        if m.group(3) and "=" in m.group(3) or "hidden" in m.group(3):
            found = {a.lower(): b or c or d for a, b, c, d in ATTRIBUTE.findall(m.group(3))}
            words = f"{found.get('class', '')} {found.get('id', '')}"
            role = found.get("role", "").lower()
            label = f"{name}.{found.get('class', '')}"
            apart = apart or role in ROLES or "hidden" in found or found.get("aria-hidden") == "true"
            region = region or role in ("main", "article")
            hint = not (apart or region) and bool(WORDS.search(words)) and name not in ("html", "body", "h1")
            apart = apart or hint
        if name in CLOSES or name == "hr" or name not in INLINE | VOID | RAW:
            shut = CLOSES.get(name, {"p"})
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in shut:
                    del stack[k:]
                    break
                if stack[k].name in SCOPES:
                    break
        if name in ("header", "footer") and any(x.region for x in stack):
            apart = name == "footer" or apart
        node = Node(name, label, apart=apart, region=region)
        node.hint = hint
        stack[-1].kids.append(node)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
        elif name not in VOID and not m.group(3).endswith("/"):
            stack.append(node)
    return root


# A wrapper is a nested list [label, times, pages, repeated, optional, text, kids, kind, mass]:
# times it was seen in all and pages that had it; text holds the template texts, which all
# pages that had it have in it (none for a slot, None if its groups were joined), "" for an element; kind tells regions and what stands apart; mass is the
# length of its own texts outside links, summed over pages.
PLAIN, REGION, APARTNESS, LINK, PARAGRAPH = range(5)


def _key(words: str) -> str:
    """What a template text is held by."""
    return words if len(words) <= LONG else "\1" + hashlib.sha1(words.encode("utf-8", "surrogatepass")).hexdigest()


def wrapper_of(node: Node, depth: int = 0) -> list:
    kids: list[list] = []
    for k in below(node, depth):
        if k.name == "":
            words = SPACE.sub(" ", k.text).strip()
            if words:
                kids.append(["#text", 1, 1, False, False, [_key(words)], [], PLAIN, len(words)])
        elif k.name not in VOID:
            kids.append(wrapper_of(k, depth + 1))
    return [node.label or node.name, 1, 1, False, False, "", fold(kids), _kind(node), 0]


def _kind(node: Node) -> int:
    return APARTNESS if node.apart else REGION if node.region else LINK if node.name == "a" else PARAGRAPH if node.name == "p" or node.name in INLINE else PLAIN


def _any_class(label: str, kind: int) -> str:
    """The label of joined groups of one element name and kind."""
    return f"{label.split('.')[0]}.\0{kind}"


def fold(kids: list[list]) -> list[list]:
    """Neighbours of one label become a repeated group; so do repeated pairs of labels."""
    out: list[list] = []
    for k in kids:
        if out and out[-1][0] == k[0]:
            align(out[-1], k, same_page=True)
            out[-1][3] = True
        elif len(out) >= 3 and out[-2][0] == k[0] and out[-3][0] == out[-1][0]:
            # a b a + b: the second group folds into the first
            align(out[-2], k, same_page=True)
            align(out[-3], out[-1], same_page=True)
            out[-2][3] = out[-3][3] = True
            out.pop()
        else:
            out.append(k)
    return out


def align(into: list, other: list, same_page: bool = False) -> None:
    """Align a wrapper with another of the same label, in place."""
    into[1] += other[1]
    if not same_page:
        into[2] += other[2]
    into[3] = into[3] or other[3]
    into[4] = into[4] or other[4]
    into[8] += other[8]
    if into[0] == "#text":
        if into[5] is None or other[5] is None:
            into[5] = None
        else:
            into[5] = sorted(set(into[5]) | set(other[5]) if same_page else set(into[5]) & set(other[5]))
    into[6] = fold(_merge(into[6], other[6], same_page))


def _merge(a: list[list], b: list[list], same_page: bool) -> list[list]:
    """Align two lists of groups; what has no partner becomes optional."""
    if [x[0] for x in a] == [x[0] for x in b]:
        for x, y in zip(a, b):
            align(x, y, same_page)
        return a
    # what agrees at either end needs no table
    head = tail = 0
    while head < min(len(a), len(b)) and a[head][0] == b[head][0]:
        align(a[head], b[head], same_page)
        head += 1
    while tail < min(len(a), len(b)) - head and a[-1 - tail][0] == b[-1 - tail][0]:
        align(a[-1 - tail], b[-1 - tail], same_page)
        tail += 1
    before, after = a[:head], a[len(a) - tail :]
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = 1 + best[i + 1][j + 1] if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            align(a[i], b[j], same_page)
            out.append(a[i])
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            a[i][4] = True
            out.append(a[i])
            i += 1
        else:
            b[j][4] = True
            out.append(b[j])
            j += 1
    return before + out + after


def nodes(w: list) -> int:
    return 1 + sum(map(nodes, w[6]))


def prune(w: list, most: int = MOST_NODES) -> list:
    """Join the optional groups that the fewest pages have, until ``most`` nodes are left or nothing is to be joined.

    Groups of one parent, element name and kind become one group of any class, with the
    sum of their masses. No group is dropped, so each node of a page has its place in the
    wrapper. What 90 % of the pages have stays as it is.
    """
    while nodes(w) > most:
        least = min((x[2] for x in _walk(w) if x[4] and not _is_joined(x) and x[2] < 0.9 * w[2]), default=None)
        if least is None:
            break
        _join(w, least)
    return w


def _is_joined(x: list) -> bool:
    return not x[5] if x[0] == "#text" else "\0" in x[0]


def _walk(w: list) -> Iterator[list]:
    for x in w[6]:
        yield x
        yield from _walk(x)


def _join(w: list, least: int) -> None:
    held: dict[str, list] = {}
    kids: list[list] = []
    for x in w[6]:
        if x[4] and (x[2] <= least or _is_joined(x)):
            if not _is_joined(x):
                if x[0] != "#text":
                    x[0] = _any_class(x[0], x[7])
                for t in (x, *_walk(x)):
                    if t[0] == "#text":
                        t[5] = None
            if x[0] in held:
                align(held[x[0]], x)
                continue
            held[x[0]] = x
        kids.append(x)
    w[6] = fold(kids)
    for x in w[6]:
        x[2] = min(x[2], w[2])
        _join(x, least)


def expression(w: list) -> str:
    """The wrapper as a regular expression."""
    if w[0] == "#text":
        body = re.escape(w[5][0]) if w[5] and len(w[5]) == 1 else "#TEXT"
    else:
        body = f"<{w[0]}>" + "".join(map(expression, w[6])) + f"</{w[0].split('.')[0]}>"
    return body if not (w[3] or w[4]) else f"({body})" + ("*" if w[3] and w[4] else "+" if w[3] else "?")


class Extractor:
    """A wrapper made ready: where its regions stand, and its template texts."""

    def __init__(self, wrapper: list):
        self.paths: set[tuple[str, ...]] = set()
        self.steps: set[tuple[str, ...]] = set()
        self._find(wrapper, (wrapper[0],))
        self._step(wrapper, (wrapper[0],))
        self.marked = bool(self.paths)
        self.template: set[str] = set()
        if not self.marked:
            at, path = wrapper, (wrapper[0],)
            while True:
                total = _mass(at)
                child = max((k for k in at[6] if k[7] in (PLAIN, REGION) and k[0] != "#text"), key=_mass, default=None)
                if child is None or total == 0 or _mass(child) < 0.6 * total:
                    break
                at, path = child, (*path, child[0])
                if "\0" in child[0]:
                    break  # what is inside has no common shape
            self.paths.add(path)
            if wrapper[2] >= AGREE:
                self.template = {t for x in _walk(wrapper) if x[0] == "#text" and x[5] for t in x[5] if x[2] >= max(AGREE, 0.9 * wrapper[2])}

    def _find(self, w: list, path: tuple[str, ...]) -> bool:
        """Add the outermost regions; <main> gives way to the regions that it holds."""
        if w[7] == APARTNESS:
            return False
        inner = [self._find(k, (*path, k[0])) for k in w[6]] if w[7] != REGION or not w[0].startswith("article") else []
        if w[7] == REGION and not any(inner):
            self.paths.add(path)
            return True
        return any(inner)

    def _step(self, w: list, path: tuple[str, ...]) -> bool:
        """Add the places of joined groups."""
        inner = [self._step(k, (*path, k[0])) for k in w[6]]
        if any(inner) or "\0" in w[0]:
            self.steps |= {(*path, k[0]) for k in w[6]} | {path}
            return True
        return False

    def _place(self, node: Node, path: tuple[str, ...]) -> tuple[str, ...]:
        own = (*path, node.label or node.name)
        if not self.steps or own in self.steps:
            return own
        joined = (*path, _any_class(own[-1], _kind(node)))
        return joined if joined in self.steps else own

    def __call__(self, page: str | None) -> str:
        if not page:
            return ""
        root = parse(page)
        found, todo = [], [(root, (root.name,))]
        while todo:
            x, path = todo.pop()
            if self.marked and "\0" in path[-1]:
                found += _regions(x, len(path) - 1)  # groups of any class: the page tells its own regions
            elif path in self.paths:
                found.append(x)
            else:
                todo += [(k, self._place(k, path)) for k in reversed(below(x, len(path) - 1)) if k.name]
        if not found:
            return Extractor(wrapper_of(root))(page) if self.paths else ""
        blocks: list[str] = []
        for x in found:
            _blocks(x, blocks)
        return "\n".join(b for b in blocks if _key(b) not in self.template)


def _regions(node: Node, depth: int) -> list[Node]:
    """The outermost regions of a page's node, as in a wrapper of its own."""
    if node.apart:
        return []
    is_article = node.region and (node.label or node.name).startswith("article")
    inner = [r for k in below(node, depth) if k.name for r in _regions(k, depth + 1)] if not is_article else []
    return inner or ([node] if node.region else [])


def _mass(w: list) -> int:
    """The length of the texts in a group, without links and what stands apart."""
    return 0 if w[7] in (APARTNESS, LINK) else w[8] + sum(map(_mass, w[6]))


def _blocks(node: Node, out: list[str]) -> None:
    """Append the blocks of a region."""
    run: list[str] = []

    def close() -> None:
        words = SPACE.sub(" ", "".join(run)).strip()
        if words:
            out.append(words)
        run.clear()

    todo: list[tuple] = [(k, False) for k in reversed(node.kids)]
    while todo:
        x, ending = todo.pop()
        if ending:
            close()
        elif x.name == "":
            run.append(x.text)
        elif x.name == "br":
            run.append(" ")
        elif x.apart:
            if x.name not in INLINE:
                close()
        elif x.name in INLINE:
            todo += [(k, False) for k in reversed(x.kids)]
        else:
            close()
            todo.append((x, True))
            todo += [(k, False) for k in reversed(x.kids)]
    close()


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, wrapper) of all pages; the wrapper as JSON."""
    import json

    rows = pages.select(_host(url), F.col(html).alias("html"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if page:
                    w = wrapper_of(parse(page))
                    if host in held:
                        align(held[host], w)
                        if nodes(held[host]) > 4 * MOST_NODES:
                            prune(held[host])
                    else:
                        held[host] = w
            if len(held) > 5000:
                yield _packed(held)
                held = {}
        if held:
            yield _packed(held)

    def _packed(held: dict[str, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([json.dumps(prune(w)) for w in held.values()])], names=["host", "wrapper"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for host, found in shared.runs(batches, "host"):
            whole = None
            for w in map(json.loads, sorted(found.column("wrapper").to_pylist())):
                if whole is None:
                    whole = w
                else:
                    align(whole, w)
            yield pa.RecordBatch.from_arrays([pa.array([host]), pa.array([json.dumps(prune(whole))])], names=["host", "wrapper"])

    shape = "host string, wrapper string"
    found = rows.mapInArrow(local, shape)
    # a host in all tasks gives each a wrapper: they meet in as many groups as the root of the tasks, then those
    groups = math.isqrt(shared.parts(pages.sparkSession, shared.size_in_bytes(pages, html), 64 << 20))
    if groups > 1:
        found = found.repartition("host", F.pmod(F.xxhash64("wrapper"), F.lit(groups))).sortWithinPartitions("host").mapInArrow(joined, shape)
    return found.repartition("host").sortWithinPartitions("host").mapInArrow(joined, shape)


def _host(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), HOST, 1)).alias("host")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", found: DataFrame | None = None) -> DataFrame:
    """page id, url, text and its length in code points, of each page."""
    import json

    hosts = shared.materialize(found if found is not None else wrappers(pages, url, html), "wrappers")
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), _host(url))
    joined = rows.join(hosts, "host", "left").select("page_id", "url", "html", "wrapper")
    out = joined.select("page_id", "url").withColumns({"text": F.lit("").cast("string"), "n_chars": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str | None, Extractor] = {}
        for batch in batches:
            texts = []
            for page, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if w not in read:
                    if len(read) > 1000:
                        read.clear()
                    read[w] = Extractor(json.loads(w)) if w else Extractor(wrapper_of(Node("#")))
                texts.append(read[w](page))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, out)
