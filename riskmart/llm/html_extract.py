"""op3: main text of HTML pages by wrapper induction.

Pages of a host share a template.  Each page becomes a tree of its block elements; trees of a
host are aligned by simple tree matching (the largest order-preserving match of nodes with
equal labels) and merged to one wrapper tree.  Then every page is aligned with its host's
tree, and every text at every node is counted: exactly, by sums that combine map-side.  Pages
count once however often they are repeated: they are told apart by a digest of their texts
outside such containers as below.  A text that stands at a node on most of the distinct pages
that have text there is template; a page loses the blocks whose own text is template, never
what differs from it.

A page's text is what is left, without blocks in containers that are never article text
(navigation, forms, asides, adverts, comments and the like, by element, role or class) and
without blocks that are mostly links.  Inside an ``article`` or ``main`` element, and among
paragraphs, list items and the like, template asks for more pages and a larger share; blocks of
links stay there, unless they are template, and so does an article that is nothing but template.

Trees are merged like any sum: in the task that parses the pages, then by host in groups of
tasks, then by host.  A host with a third of all pages is just more partial trees of a few
kilobytes.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import fresh, materialize, ship, slices, table

# Element kinds.
# Only comments, scripts, styles and textareas run to the end of the page; the others are dropped with an end tag of their own, innermost first.
DROPPED = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style|textarea)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"""
                     r"""|<(noscript|template|svg|iframe|select|title|button)(?=[\s/>])(?:[^<>"']|"[^"]*"|'[^']*')*+(?<!/)>"""
                     r"""[^<]*+(?:<(?!/?\2[\s/>])[^<]*+)*+</\2\s*>""", re.I | re.S)
TOKEN = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|([^<]+|<(?![a-zA-Z/!?]))|<[^>]*>?""")
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
BLOCKS = frozenset("html head body header footer nav main article section aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
                   "form fieldset figure figcaption blockquote pre address details summary center dialog hr caption menu".split())
FOLDED = frozenset("p li tr td th dt dd h2 h3 h4 h5 h6 pre blockquote figure".split())
VOID = frozenset(["hr"])
CLOSED_BY = {"li": ("ul", "ol", "menu"), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "dt": ("dl",), "dd": ("dl",)}
BOILER_TAGS = frozenset("head nav footer aside form fieldset dialog menu".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form".split())
BOILER_WORDS = frozenset("nav navbar navigation menu menus ad ads advert adverts advertisement sponsor sponsored banner cookie cookies consent notice notices "
                         "alert sidebar footer header masthead comment comments reply replies respond share sharing social promo related breadcrumb breadcrumbs "
                         "advertising sponsors newsletter subscribe subscription popup modal overlay widget pagination pager login signup search toolbar copyright".split())
# What a compound name may have before and after such a word: 'site-footer', 'comment-list', but not 'has-sidebar' or 'entry-header'.
BEFORE_WORDS = ("site", "page", "main", "global", "top", "bottom", "left", "right", "primary", "secondary", "social", "widget", "user", "cookie", "ad", "block", "wp", "js")
AFTER_WORDS = ("left", "right", "top", "bottom", "list", "area", "wrapper", "wrap", "container", "box", "bar", "block", "section", "inner", "links", "link", "buttons", "items", "item",
               "posts", "articles", "content", "text", "body", "form", "menu", "widget", "banner", "notice", "primary", "secondary", "slot", "unit", "space")
TITLE_WORDS = frozenset(["header", "masthead"])  # inside an article these hold its title
BOILER_NAME = re.compile(r"(?:(?:{0}|{1})[-_]+)*({1})(?:{2})?(?:[-_]+(?:{1}|{2}))*[-_]*[0-9]*".format(
    *("|".join(sorted(w, key=lambda x: (-len(x), x))) for w in (BEFORE_WORDS, BOILER_WORDS, AFTER_WORDS))))
#: Elements that are boilerplate even if they hold most of a page.
SURE_TAGS = BOILER_TAGS - {"form", "fieldset"}
#: Nodes a wrapper, pages a host needs, and the shares that make template.
MAX_NODES, LEAST_PAGES, SLOT_SHARE, TEXT_SHARE, LINK_SHARE = 2000, 4, 0.6, 0.8, 0.6


class Node:
    """A block element of a page; consecutive list items, paragraphs and the like are one node."""

    __slots__ = ("label", "children", "texts", "boiler", "article", "main", "prose")

    def __init__(self, label: str, boiler: bool, article: bool, main: bool = False):
        self.label, self.boiler, self.article, self.main = label, boiler, article, main
        self.prose = 0  # characters outside links, here and below
        self.children: list[Node] = []
        self.texts: list[str] = []


_LABELS: dict[tuple[str, str, bool], tuple[str, bool]] = {}


def _label(tag: str, attributes: str, article: bool) -> tuple[str, bool]:
    """(label, is boilerplate by itself) of a start tag, inside an article or not."""
    if not attributes.strip():
        return tag, tag in BOILER_TAGS
    found = _LABELS.get((tag, attributes, article))
    if found is None:
        values = {m[0].lower(): " ".join((m[1] or m[2] or m[3]).lower().split()) for m in ATTRIBUTE.findall(attributes)}
        names = map(BOILER_NAME.fullmatch, f"{values.get('class', '')} {values.get('id', '')}".split())
        marks = {m[1] for m in names if m} - (TITLE_WORDS if article else frozenset())
        boiler = tag in BOILER_TAGS or bool(marks) or bool(set(values.get("role", "").split()) & BOILER_ROLES)
        name = values.get("class") or values.get("id") or ""
        found = (f"{tag}.{re.sub('[0-9]+', '#', name)}" if name else tag, boiler and tag not in ("html", "body", "article", "main"))
        if len(_LABELS) > 10_000:
            _LABELS.clear()
        if len(attributes) < 200:
            _LABELS[tag, attributes, article] = found
    return found


def _settle(root: Node) -> None:
    """Boilerplate marks of a tree, from each block's own to inherited ones.

    A name or form around most of a page's text outside links marks nothing, unless the page has
    an article or main element elsewhere.  If every article of the page lies in marked blocks,
    it ends their marks.
    """
    order = [root]
    for node in order:
        order += node.children
    for node in reversed(order):
        node.prose += sum(c.prose for c in node.children)
    articles = {id(root): 0}  # characters in the outermost article and main elements at and below a node
    for node in reversed(order):
        articles[id(node)] = node.prose if node.main else sum(articles[id(c)] for c in node.children)
    for node in order:
        if node.boiler and node.label.split(".")[0] not in SURE_TAGS and 2 * node.prose > root.prose and (node.article or articles[id(node)] == articles[id(root)]):
            node.boiler = False

    unmarked = [root]
    for node in unmarked:
        unmarked += [c for c in node.children if not c.boiler]
    through = any(node.main and node.prose for node in unmarked)
    for node in order:
        for c in node.children:
            c.boiler = c.boiler or (node.boiler and (through or not c.main))


def parse(page: str) -> tuple[Node, list[tuple[Node, str, bool]]]:
    """Tree of block elements, and the text blocks in page order: (node, text, is mostly links)."""
    root = Node("", False, False)
    stack, tags = [root], [""]
    blocks: list[tuple[Node, str, bool]] = []
    held: list[str] = []
    linked, anchors = 0, 0

    def flush() -> None:
        nonlocal linked
        if held:
            raw = "".join(held)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                node = stack[-1]
                links = linked >= LINK_SHARE * max(1, len(raw))
                node.texts.append(text)
                node.prose += 0 if links else len(text)
                blocks.append((node, text, links))
            held.clear()
        linked = 0

    dropped = 1
    while dropped:
        page, dropped = DROPPED.subn(" ", page)
    for close, tag, attributes, text in TOKEN.findall(page):
        if text:
            held.append(text)
            if anchors:
                linked += len(text)
            continue
        if not tag:
            continue
        tag = tag.lower()
        if tag not in BLOCKS:
            if tag == "br":
                held.append(" ")
            elif tag == "a":
                anchors = 0 if close else 1
            continue
        flush()
        anchors = 0
        if close:
            if tag in tags[1:]:
                at = len(tags) - 1 - tags[::-1].index(tag)
                del stack[at:], tags[at:]
            continue
        if tags[-1] == "p" or (tags[-1] == tag and tag in ("h1", "h2", "h3", "h4", "h5", "h6")):
            stack.pop()
            tags.pop()
        if tag in CLOSED_BY:
            stop = CLOSED_BY[tag]
            same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            for at in range(len(tags) - 1, 0, -1):
                if tags[at] in stop:
                    break
                if tags[at] in same:
                    del stack[at:], tags[at:]
                    break
        parent = stack[-1]
        label, boiler = _label(tag, attributes, parent.article)
        if tag == "header":  # a page's header, not an article's
            boiler = not parent.article
        last = parent.children[-1] if parent.children else None
        if last is not None and tag in FOLDED and last.label == label and last.boiler == boiler:
            node = last
        else:
            node = Node(label, boiler, parent.article or tag in ("article", "main"), tag in ("article", "main"))
            parent.children.append(node)
        if tag not in VOID:
            stack.append(node)
            tags.append(tag)
    flush()
    _settle(root)
    return root, blocks


def _mark(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def wrapper_of(node: Node) -> dict:
    """The wrapper of one page: label l, pages n, children c."""
    top = {"l": node.label, "n": 1, "c": []}
    todo = [(node, top)]
    while todo:  # pages may be nested deeper than Python calls
        at, made = todo.pop()
        for child in at.children:
            if not child.boiler:
                made["c"].append({"l": child.label, "n": 1, "c": []})
                todo.append((child, made["c"][-1]))
    return top


def _size(tree: dict) -> int:
    order = [tree]
    for node in order:
        order += node["c"]
    return len(order)


def _label_of(tree) -> str:
    return tree.label if isinstance(tree, Node) else tree["l"]


def _children(tree) -> list:
    return [c for c in tree.children if not c.boiler] if isinstance(tree, Node) else tree["c"]


class Shapes:
    """Numbers of equal subtrees, and how many nodes of two of them match, for one alignment.

    Subtrees of equal labels throughout have one number, so that a match is computed once for each
    pair of unequal shapes, whatever the number of their copies.  Nodes must outlive the object.
    """

    def __init__(self) -> None:
        self._of: dict[int, int] = {}
        self._number: dict[tuple, int] = {}
        self._parts: list[tuple[str, tuple[int, ...]]] = []
        self._sizes: list[int] = []
        self._matched: dict[tuple[int, int], int] = {}

    def of(self, tree) -> int:
        todo = [] if id(tree) in self._of else [(tree, _children(tree))]
        while todo:
            node, children = todo[-1]
            open_ = [c for c in children if id(c) not in self._of]
            if open_:
                todo += [(c, _children(c)) for c in open_]
                continue
            todo.pop()
            parts = (_label_of(node), tuple(self._of[id(c)] for c in children))
            if parts not in self._number:
                self._number[parts] = len(self._parts)
                self._parts.append(parts)
                self._sizes.append(1 + sum(self._sizes[c] for c in parts[1]))
            self._of[id(node)] = self._number[parts]
        return self._of[id(tree)]

    def matched(self, a: int, b: int) -> int:
        """Nodes in the largest match of two shapes; 0 if their roots differ."""
        todo = [(a, b)]
        while todo:
            x, y = todo[-1]
            if (x, y) in self._matched:
                todo.pop()
                continue
            (label, left), (other, right) = self._parts[x], self._parts[y]
            if x == y or label != other:
                self._matched[x, y] = self._sizes[x] if x == y else 0
                continue
            by_label: dict[str, set[int]] = {}
            for c in right:
                by_label.setdefault(self._parts[c][0], set()).add(c)
            open_ = [(c, d) for c in set(left) for d in by_label.get(self._parts[c][0], ()) if c != d and (c, d) not in self._matched]
            if open_:
                todo += open_
                continue
            self._matched[x, y] = 1 + sum(w for _, _, w in self.aligned(left, right))
        return self._matched[a, b]

    def aligned(self, a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int, int]]:
        """The best order-preserving match of two lists of shapes: (i, j, matched nodes)."""
        head = 0
        while head < min(len(a), len(b)) and a[head] == b[head]:  # equal firsts are in a best match
            head += 1
        out = [(i, i, self._sizes[a[i]]) for i in range(head)]
        a, b = a[head:], b[head:]
        if not a or not b:
            return out
        kinds, where = np.unique(np.array(b), return_inverse=True)
        rows: dict[int, np.ndarray] = {}
        for x in set(a):
            label = self._parts[x][0]
            rows[x] = np.array([self.matched(x, int(k)) if self._parts[k][0] == label else 0 for k in kinds], np.int32)[where]
        best = np.zeros((len(a) + 1, len(b) + 1), np.int32)
        for i in range(len(a) - 1, -1, -1):
            weight = rows[a[i]]
            reach = np.maximum(best[i + 1, :-1], np.where(weight > 0, best[i + 1, 1:] + weight, 0))
            best[i, :-1] = np.maximum.accumulate(reach[::-1])[::-1]
        i = j = 0
        while i < len(a) and j < len(b):
            w = int(rows[a[i]][j])
            if w and best[i, j] == best[i + 1, j + 1] + w:
                out.append((head + i, head + j, w))
                i, j = i + 1, j + 1
            elif best[i, j] == best[i + 1, j]:
                i += 1
            else:
                j += 1
        return out


def matching(a, b) -> int:
    """Simple tree matching: nodes in the largest match of two trees with equal root labels."""
    shapes = Shapes()
    return shapes.matched(shapes.of(a), shapes.of(b))


def pairs(a: list, b: list, shapes: Shapes | None = None) -> list[tuple[int, int, int]]:
    """Aligned children (i, j, matched nodes) of the best order-preserving match of two lists.

    Nodes are not counted (0) where labels alone settle the match."""
    if len(a) == len(b) and all(_label_of(x) == _label_of(y) for x, y in zip(a, b)):
        labels = [_label_of(x) for x in a]
        if len(set(labels)) == len(labels):
            return [(i, i, 0) for i in range(len(a))]
    shapes = shapes or Shapes()
    return shapes.aligned([shapes.of(x) for x in a], [shapes.of(y) for y in b])


def merge(a: dict, b: dict) -> dict:
    """One wrapper of two with equal root labels; children of either that match none stay, in order."""
    shapes, top = Shapes(), {"l": a["l"], "n": a["n"] + b["n"], "c": []}
    todo = [(a, b, top["c"])]
    while todo:
        left, right, children = todo.pop()
        x, y, i, j = left["c"], right["c"], 0, 0
        for p, q, _ in pairs(x, y, shapes):
            children += x[i:p] + y[j:q] + [{"l": x[p]["l"], "n": x[p]["n"] + y[q]["n"], "c": []}]
            todo.append((x[p], y[q], children[-1]["c"]))
            i, j = p + 1, q + 1
        children += x[i:] + y[j:]
    return top


def pruned(tree: dict, most: int = MAX_NODES) -> dict:
    """The wrapper without its rarest nodes, if it has over ``most``; what is not in it counts as varying."""
    least = 2
    while _size(tree) > most:
        top = tree | {"c": []}
        todo = [(tree, top["c"])]
        while todo:
            node, children = todo.pop()
            for c in node["c"]:
                if c["n"] >= least:
                    children.append(c | {"c": []})
                    todo.append((c, children[-1]["c"]))
        tree, least = top, least * 2
    return tree


def numbered(tree: dict, texts: dict[int, list[int]] | None = None) -> dict:
    """The wrapper's nodes as label l, number i in page order and children c; with template texts t, if given."""
    count, tops = 0, []
    todo = [(tree, tops)]
    while todo:
        node, siblings = todo.pop()
        out = {"l": node["l"], "i": count}
        if texts and count in texts:
            out["t"] = sorted(texts[count])
        out["c"] = []
        count += 1
        siblings.append(out)
        todo += [(c, out["c"]) for c in reversed(node["c"])]
    return tops[0]


def packed(tree: dict) -> str:
    """A wrapper as JSON that is flat however deep the tree: each node with the number of its children, in page order."""
    out, todo = [], [tree]
    while todo:
        node = todo.pop()
        out.append([{k: v for k, v in node.items() if k != "c"}, len(node["c"])])
        todo += reversed(node["c"])
    return json.dumps(out, separators=(",", ":"))


def unpacked(text: str) -> dict:
    top: list[dict] = []
    open_: list[tuple[list, int]] = [(top, 1)]  # lists of children and how many they will have
    for node, children in json.loads(text):
        while len(open_[-1][0]) == open_[-1][1]:
            open_.pop()
        node["c"] = []
        open_[-1][0].append(node)
        open_.append((node["c"], children))
    return top[0]


def aligned(root: Node, tree: dict) -> list[tuple[Node, dict]]:
    """A page's blocks with their nodes of the wrapper."""
    out, shapes = [(root, tree)], Shapes()
    for node, at in out:
        children = _children(node)
        out += [(children[j], at["c"][i]) for i, j, _ in pairs(at["c"], children, shapes)]
    return out


def article_text(page: str, wrapper: dict | None) -> str:
    """Text of a page: its blocks that are neither boilerplate nor template nor menus."""
    root, blocks = parse(page)
    template = {id(node): set(at["t"]) for node, at in aligned(root, wrapper) if "t" in at} if wrapper else {}
    blocks = [(node, text, id(node) in template and _mark(text) in template[id(node)]) for node, text, links in blocks
              if not node.boiler and (node.article or not links)]
    whole = all(common for node, _, common in blocks if node.article)  # nothing else in it: the article itself
    return "\n".join(text for node, text, common in blocks if not common or (node.article and whole))


def page_texts(page: str, tree: dict) -> tuple[int, list[tuple[int, bool, int | None]]]:
    """Digest of a page's texts, and (node, is strict, text) once for every text at every node of the wrapper and for every node with texts itself (null)."""
    root, blocks = parse(page)
    out = []
    for node, at in aligned(root, tree):
        if node.texts and not node.boiler:
            strict = node.article or node.label.split(".")[0] in FOLDED
            out += [(at["i"], strict, mark) for mark in (None, *sorted({_mark(t) for t in node.texts}))]
    return _mark("\n".join(text for node, text, _ in blocks if not node.boiler)), out


def host_of(url: Column) -> Column:
    """Lower-cased host of a url, with its port; empty for a null url."""
    rest = F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"^[^/?#]*://", "")
    return F.lower(F.regexp_extract(rest, r"^(?:[^/?#]*@)?([^/?#]*)", 1))


def _merged(wrappers: Iterator[tuple[str, int, str]], max_nodes: int) -> dict[str, tuple[int, dict]]:
    found: dict[str, tuple[int, dict]] = {}
    for host, pages, tree in wrappers:
        tree = unpacked(tree) if isinstance(tree, str) else tree
        if host in found:
            n, old = found[host]
            found[host] = (n + pages, pruned(merge(old, tree), max_nodes))
        else:
            found[host] = (pages, tree)
    return found


WRAPPERS = "host string, part int, pages long, wrapper string"


def merged_trees(df: DataFrame, host: Column, html_col: str, group: int, max_nodes: int = MAX_NODES) -> DataFrame:
    """(wrapper_host, wrapper): the merged tree of every host with enough rows."""
    def rows(found: dict, part: int) -> pa.RecordBatch:
        hosts = sorted(found)
        return pa.RecordBatch.from_pydict({
            "host": pa.array(hosts, pa.string()), "part": pa.array([part] * len(hosts), pa.int32()),
            "pages": pa.array([found[h][0] for h in hosts], pa.int64()),
            "wrapper": pa.array([packed(found[h][1]) for h in hosts], pa.string())})

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, tuple[int, dict]] = {}
        part = 0
        for batch in slices(batches):
            part = batch.column(2)[0].as_py() if batch.num_rows else part
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tree = wrapper_of(parse(page or "")[0])
                if host in found:
                    n, old = found[host]
                    found[host] = (n + 1, pruned(merge(old, tree), max_nodes))
                else:
                    found[host] = (1, tree)
            if len(found) > 5000:  # many hosts in a task: hand over, start anew
                yield rows(found, part)
                found = {}
        yield rows(found, part)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[int, dict]] = {}
        for batch in batches:  # sorted by host
            for r in batch.to_pylist():
                if held and r["host"] not in held:
                    yield rows(held, r["part"])
                    held = {}
                held = _merged([*((h, n, t) for h, (n, t) in held.items()), (r["host"], r["pages"], r["wrapper"])], max_nodes)
        yield rows(held, 0)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(r["host"], numbered(unpacked(r["wrapper"]))) for r in batch.to_pylist() if r["pages"] >= LEAST_PAGES]
            yield pa.RecordBatch.from_pydict({"wrapper_host": pa.array([h for h, _ in out], pa.string()),
                                              "wrapper": pa.array([packed(w) for _, w in out], pa.string())})

    partial = df.select(host, html_col, (F.spark_partition_id() / group).cast("int").alias("part")).mapInArrow(learn, WRAPPERS)
    partial = partial.repartition("host", "part").sortWithinPartitions("host", "part", "pages", "wrapper").mapInArrow(gather, WRAPPERS)
    whole = partial.repartition("host").sortWithinPartitions("host", "pages", "wrapper").mapInArrow(gather, WRAPPERS)
    return materialize(whole.mapInArrow(finish, "wrapper_host string, wrapper string"), "html-trees")


def small(wrappers: DataFrame, most: int) -> DataFrame:
    """A broadcast hint for wrappers of at most ``most`` bytes, some kilobytes a host; beyond the bound hosts meet by shuffle."""
    total = wrappers.agg(F.coalesce(F.sum(F.length("wrapper") + F.length("wrapper_host")), F.lit(0))).first()[0]
    return F.broadcast(wrappers) if total <= most else wrappers


def _wrappers_of(column: pa.Array, known: dict[str, dict]) -> list[dict | None]:
    """Wrappers of a batch, parsed once; ``known`` holds those of the batches before."""
    out = []
    for wrapper in column.to_pylist():
        if wrapper is not None and wrapper not in known:
            if len(known) > 2000:
                known.clear()
            known[wrapper] = unpacked(wrapper)
        out.append(known.get(wrapper))
    return out


def induce_wrappers(df: DataFrame, host: Column, html_col: str, group: int = 256, broadcast_bytes: int = 64 << 20,
                    max_nodes: int = MAX_NODES) -> DataFrame:
    """(wrapper_host, wrapper): the merged tree of every host with its template texts, if it has any."""
    ship(df.sparkSession)
    trees = merged_trees(df, host, html_col, group, max_nodes)

    def see(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in slices(batches):
            out = []
            for h, page, tree in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _wrappers_of(batch.column(2), known)):
                digest, found = page_texts(page or "", tree)
                out += [(h, *row, digest) for row in found]
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()))],
                                             names=["host", "node", "strict", "mark", "page"])

    seen = df.select(host.alias("host"), F.col(html_col).alias("html")).join(small(trees, broadcast_bytes), F.col("host") == F.col("wrapper_host")).select(
        "host", "html", "wrapper").mapInArrow(see, "host string, node int, strict boolean, mark long, page long")
    counts = materialize(seen.distinct().groupBy("host", "node", "strict", "mark").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= LEAST_PAGES), "html-counts")
    nodes = counts.where("mark is null").select("host", "node", F.col("pages").alias("all_pages"))
    least = F.when(F.col("strict"), 2 * LEAST_PAGES).otherwise(LEAST_PAGES)
    share = F.when(F.col("strict"), TEXT_SHARE).otherwise(SLOT_SHARE)
    template = counts.where("mark is not null").join(nodes, ["host", "node"]).where(
        (F.col("all_pages") >= least) & (F.col("pages") >= share * F.col("all_pages"))).groupBy("host").agg(
        F.collect_list(F.struct("node", "mark")).alias("template"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, tree, template in zip(*(batch.column(i).to_pylist() for i in range(3))):
                texts: dict[int, list[int]] = {}
                for t in template:
                    texts.setdefault(t["node"], []).append(t["mark"])
                out.append((host, packed(numbered(unpacked(tree), texts))))
            yield pa.RecordBatch.from_pydict({"wrapper_host": pa.array([h for h, _ in out], pa.string()), "wrapper": pa.array([w for _, w in out], pa.string())})

    found = trees.join(template, F.col("wrapper_host") == F.col("host")).select("wrapper_host", "wrapper", "template")
    return materialize(found.mapInArrow(finish, "wrapper_host string, wrapper string"), "html-wrappers")


def extract_text(df: DataFrame, url_col: str = "url", html_col: str = "html", broadcast_bytes: int = 64 << 20,
                 max_nodes: int = MAX_NODES) -> DataFrame:
    """``df`` with text (main text, empty if none) and n_chars; the html column goes.

    A null page is empty, a null url is a host of its own kind.  Repeated pages count as one
    for the template; pages of a host with fewer than four distinct ones are extracted without template.  Columns of the two new
    names are replaced.  Pages may be nested to any depth.  A host's wrapper keeps ``max_nodes``
    nodes: if it has more, those on the fewest pages go first, and their blocks count as text.
    """
    source = df.drop("text", "n_chars")
    wrappers = small(induce_wrappers(source, host_of(F.col(url_col)), html_col, broadcast_bytes=broadcast_bytes, max_nodes=max_nodes), broadcast_bytes)
    host, page = fresh(source, "page_host", "page_html")
    kept = [c for c in source.columns if c != html_col]
    joined = source.withColumn(host, host_of(F.col(url_col))).join(wrappers, F.col(host) == F.col("wrapper_host"), "left").select(
        *kept, F.col("wrapper").alias(fresh(source, "page_wrapper")[0]), F.col(html_col).alias(page))
    schema = source.select(*kept).schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in slices(batches):
            wrappers = _wrappers_of(batch.column(batch.num_columns - 2), known)
            out = [article_text(html or "", wrapper) for wrapper, html in zip(wrappers, batch.column(batch.num_columns - 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                                             names=schema.names)

    return joined.mapInArrow(run, schema)


def op3_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Main text of all ``pages`` by wrapper induction over pages of a host."""
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
