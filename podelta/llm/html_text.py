"""Main text of web pages by wrapper induction (operator 4).

For each host one page is the pivot.  Every page's DOM tree is aligned with its host's pivot by simple tree matching (the
order-preserving matching of children that pairs most nodes).  A pivot node whose aligned text is the same on nearly
all pages of the host that are not copies of the pivot belongs to the template; nodes that vary are slots.  A page's
content is what its slots hold, without the parts whose tag, role or class names them as navigation, advertising and the like,
and within the page's article where it has one.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podelta.llm.common import arrow_schema, batches, spark_schema, stage
from podelta.llm.url_rules import host

#: How HTML elements are read.
RAW_TEXT = frozenset("script style textarea title noscript noframes noembed iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter picture q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr svg math audio video canvas object".split())
CLOSES_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form "
                             "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split())
CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
SCOPES = frozenset("ul ol dl table menu select body html".split())
CELL_SCOPES = SCOPES | {"td", "th"}
#: What is never content, by tag, ARIA role and word of a class or id.
DROP_TAGS = frozenset("head nav footer aside form button select dialog menu template datalist object canvas audio video svg".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
DROP_WORDS = frozenset("ad ads advert adverts advertisement advertising adsbygoogle banner sponsor sponsored promo promotion sidebar side menu nav navbar "
                       "navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup login "
                       "comment comments disqus replies respond related recommended share sharing social widget".split())
CONTENT_TAGS = frozenset(("article", "main"))

MAX_DEPTH = 200  # texts of deeper elements stand in the tree as children of the element at this depth, with their own marks
MAX_CELLS, MAX_KEPT = 250_000, 200_000  # numbers kept while two lists, or two trees, are matched; beyond, they are computed again
COPY_SHARE = 0.5  # a page with more of its article in common is a copy; without an article only one whose whole text is
MIN_PAGES, SAME_SHARE = 3, 0.9  # pages that must tell, and the share of them that makes a node template

_TOKEN = re.compile(r"<!--.*?(?:--!?>|$)|<[!?][^>]*(?:>|$)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|$)|"
                    r"<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|$)|<([a-zA-Z][^\s/>]*)([^>]*)(>|$)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("tag", "children", "text", "drop", "content", "number")

    def __init__(self, tag: str, text: str = "", drop: bool = False, content: bool = False):
        self.tag, self.text, self.drop, self.content = tag, text, drop, content
        self.children: list[Node] = []
        self.number = 0


def _dropped(tag: str, attributes: str, in_content: bool) -> bool:
    if tag in DROP_TAGS or tag == "header" and not in_content:
        return True
    if "=" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = "".join(values).lower()
            if name.lower() == "role":
                if value.strip() in DROP_ROLES:
                    return True
            elif not DROP_WORDS.isdisjoint(_WORD.findall(value)):
                return True
    return False


def parse(page: str | None) -> Node:
    """Block tree of a page: elements that are not inline, with runs of inline content as text leaves.

    Broken markup never fails: unknown end tags are skipped, open elements end with their parent or the page, a tag that
    the page's end cuts off is dropped.
    """
    page = page or ""
    root = Node("html")
    stack = [root]
    places: dict[str, list[int]] = {}  # of the open elements in the stack, by tag
    run: list[str] = []
    at = 0

    def flush():
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if text:
                stack[min(len(stack), MAX_DEPTH) - 1].children.append(Node("#text", text, stack[-1].drop, stack[-1].content))

    def close(count: int):
        flush()
        for node in stack[count:]:
            places[node.tag].pop()
        del stack[count:]

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    while m := _TOKEN.search(page, at):
        if m.start() > at:
            run.append(page[at : m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag in INLINE:
                continue
            if k := last((tag,)):
                close(k)
            continue
        tag, attributes, end = (m[2], m[3], m[4]) if m[2] else (m[5], m[6], m[7])
        if not tag:
            continue
        tag = tag.lower()
        if end != ">":  # cut off by the end of the page
            break
        if tag in RAW_TEXT:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        if tag in INLINE:
            if tag == "br":
                run.append(" ")
            continue
        if tag in VOID:
            flush()
            continue
        if tag in CLOSES_PARAGRAPH:
            k = last(("p",))
            if k and k > last(CELL_SCOPES):
                close(k)
        if tag in CLOSES:
            scope = last(SCOPES)
            inside = [places[t][n] for t in CLOSES[tag] if t in places and (n := bisect_right(places[t], scope)) < len(places[t])]
            if inside:
                close(min(inside))
        flush()
        if tag in ("html", "body"):
            continue
        parent = stack[-1]
        node = Node(tag, "", parent.drop or _dropped(tag, attributes, parent.content), parent.content or tag in CONTENT_TAGS)
        if len(stack) < MAX_DEPTH:
            parent.children.append(node)
        places.setdefault(tag, []).append(len(stack))
        stack.append(node)
    if at < len(page) and not page[at:].startswith("<"):
        run.append(page[at:])
    flush()
    return root


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), 0) >> 1


def encode(root: Node) -> list[dict]:
    """Preorder list of (tag, number of children, text hash); enough to align with."""
    out: list[dict] = []
    todo = [root]
    while todo:
        node = todo.pop()
        out.append({"tag": node.tag, "n": len(node.children), "hash": _hash(node.text) if node.text else 0})
        todo += reversed(node.children)
    return out


def rebuild(skeleton) -> tuple[Node, int]:
    """Tree of an encoded page; a node's number is its place, a leaf's text its hash."""
    at = 0

    def take() -> Node:
        nonlocal at
        row = skeleton[at]
        node = Node(row["tag"], row["hash"])
        node.number = at
        at += 1
        for _ in range(row["n"]):
            node.children.append(take())
        return node

    return take(), len(skeleton)


class _Forms:
    """Distinct subtrees of one page and its pivot, by number.

    A text that the other tree lacks can never be repeated, so all such texts are one form: blocks that differ in them alone are
    the same form, and weights are kept per pair of forms, not per pair of nodes.
    """

    def __init__(self, common: set):
        self.common = common
        self.numbers: dict[tuple, int] = {}
        self.parts: list[tuple[str, tuple[int, ...]]] = []  # tag and forms of the children
        self.full: list[float] = []  # weight against the same form: nodes, and half for each text that both trees hold
        self.plain: list[int] = []  # the form without texts
        self.kept: dict[tuple[int, int], float] = {}

    def _form(self, tag: str, inner) -> int:
        """Number of a text (``inner`` its hash, or None where the other tree lacks it) or of a block (forms of its children)."""
        form = self.numbers.get((tag, inner))
        if form is None:
            text = tag == "#text"
            bare = None if text else tuple([self.plain[c] for c in inner])
            plain = None if inner == bare else self._form(tag, bare)  # a block without texts is its own plain form
            form = self.numbers[tag, inner] = len(self.parts)
            self.parts.append((tag, () if text else inner))
            self.full.append((1.5 if inner is not None else 1.0) if text else 1.0 + sum(self.full[c] for c in inner))
            self.plain.append(form if plain is None else plain)
        return form

    def of(self, root: Node, own: bool) -> dict[int, int]:
        """{id of node: form}; a page's own texts are numbered in ``number``, a pivot's in ``text``."""
        out: dict[int, int] = {}
        todo = [(root, False)]
        while todo:
            node, done = todo.pop()
            if node.tag == "#text":
                mark = node.number if own else node.text
                out[id(node)] = self._form("#text", mark if mark in self.common else None)
            elif done:
                out[id(node)] = self._form(node.tag, tuple([out[id(c)] for c in node.children]))
            else:
                todo.append((node, True))
                todo += [(c, False) for c in node.children]
        return out

    def _texts(self, form: int) -> set[int]:
        """Forms of the texts of a subtree that both trees hold."""
        found, todo = set(), [form]
        while todo:
            at = todo.pop()
            if self.plain[at] != at:  # else it has none
                if self.parts[at][0] == "#text":
                    found.add(at)
                todo += self.parts[at][1]
        return found

    def lines(self, right):
        """Function from a form to its weights against the forms of a list.

        Forms without a common text weigh as their plain forms do, of which there are few; an index finds the others.
        """
        distinct = list(dict.fromkeys(right))
        index = {y: n for n, y in enumerate(distinct)}
        place = np.array([index[y] for y in right])
        kinds, kind = np.unique([self.plain[y] for y in distinct], return_inverse=True)
        holders: dict[int, list[int]] = {}
        for n, y in enumerate(distinct):
            for t in self._texts(y):
                holders.setdefault(t, []).append(n)

        def line(form: int) -> np.ndarray:
            out = np.array([self.weight(self.plain[form], k) for k in kinds.tolist()])[kind]
            for n in {n for t in self._texts(form) for n in holders.get(t, ())}:
                out[n] = self.weight(form, distinct[n])
            return out[place]

        return line

    def weight(self, a: int, b: int) -> float:
        """Most nodes that an order-preserving matching of two subtrees pairs; a repeated text counts half more."""
        if a == b:
            return self.full[a]
        (tag, x), (other, y) = self.parts[a], self.parts[b]
        if tag != other:
            return 0.0
        if not x or not y:  # texts that differ, or a block without children
            return 1.0
        found = self.kept.get((a, b))
        if found is None:
            lo, left, right = _trim(x, y)
            found = 1.0 + sum(self.full[c] for c in x[:lo]) + sum(self.full[c] for c in x[lo + len(left):])
            if left and right:
                found += self._best(left, right)
            if len(self.kept) >= MAX_KEPT:  # only time is lost
                self.kept.clear()
            self.kept[a, b] = found
        return found

    def _best(self, left, right) -> float:
        row = np.zeros(len(right) + 1)
        if len(left) * len(right) > 1000:
            line = self.lines(right)
            for x in left:
                row = _next_row(row, line(x))
            return float(row[-1])
        row = row.tolist()
        for x in left:
            corner, best = 0.0, 0.0
            for j, y in enumerate(right, 1):
                here = row[j]
                w = self.weight(x, y)
                if w and corner + w > best:
                    best = corner + w
                if here > best:
                    best = here
                corner = here
                row[j] = best
        return row[-1]

    def match(self, left, right) -> list[tuple[int, int]]:
        """Places of a best matching of two lists of forms, in memory that follows their length (Hirschberg's halving)."""
        lo, inner, other = _trim(left, right)
        tail = len(left) - lo - len(inner)
        chosen = [(i, i) for i in range(lo)] + [(len(left) - 1 - i, len(right) - 1 - i) for i in range(tail)]
        if not inner or not other:
            return sorted(chosen)
        weigh = self.lines(other)
        lines: dict[int, np.ndarray] = {}

        def line(i: int) -> np.ndarray:
            out = lines.get(inner[i])
            if out is None:
                out = weigh(inner[i])
                if (len(lines) + 1) * len(other) <= MAX_CELLS:  # equal blocks and both halves of a list share their lines
                    lines[inner[i]] = out
            return out

        def last_row(rows, at: int, to: int, backwards: bool) -> np.ndarray:
            row = np.zeros(to - at + 1)
            for i in reversed(rows) if backwards else rows:
                w = line(i)[at:to]
                row = _next_row(row, w[::-1] if backwards else w)
            return row

        todo = [(0, len(inner), 0, len(other))]
        while todo:
            a, b, at, to = todo.pop()
            if a == b or at == to:
                continue
            if b - a == 1:
                w = line(a)[at:to]
                if w.max() > 0:
                    chosen.append((lo + a, lo + at + int(w.argmax())))
                continue
            middle = (a + b) // 2
            cut = int((last_row(range(a, middle), at, to, False) + last_row(range(middle, b), at, to, True)[::-1]).argmax())
            todo += [(a, middle, at, at + cut), (middle, b, at + cut, to)]
        return sorted(chosen)


def _next_row(row: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Best weights after one more node on the left."""
    out = row.copy()
    np.maximum(out[1:], row[:-1] + line, out=out[1:])
    return np.maximum.accumulate(out, out=out)


def _trim(left, right) -> tuple[int, tuple, tuple]:
    """(equal forms in front, rest of both lists without equal ends): no matching gains by leaving equal ends unpaired."""
    least = min(len(left), len(right))
    lo = 0
    while lo < least and left[lo] == right[lo]:
        lo += 1
    tail = 0
    while tail < least - lo and left[-1 - tail] == right[-1 - tail]:
        tail += 1
    return lo, left[lo : len(left) - tail], right[lo : len(right) - tail]


def align(page: Node, pivot: Node) -> list[tuple[Node, Node]]:
    """Pairs of text leaves that simple tree matching aligns; equal texts weigh more among matchings of equal size.

    The page's texts are numbered by their hashes.  One way serves trees of any size: equal subtrees pair leaf by leaf, other
    children by a best matching.
    """
    mine = leaves(page)
    theirs = leaves(pivot)
    forms = _Forms({x.number for x in mine} & {x.text for x in theirs})
    left, right = forms.of(page, True), forms.of(pivot, False)
    out: list[tuple[Node, Node]] = []
    todo = [(page, pivot)]
    while todo:
        a, b = todo.pop()
        if left[id(a)] == right[id(b)]:
            out += zip(leaves(a), leaves(b))
        elif a.tag == "#text":
            out.append((a, b))
        elif a.children and b.children:
            x, y = tuple(left[id(c)] for c in a.children), tuple(right[id(c)] for c in b.children)
            todo += [(a.children[i], b.children[j]) for i, j in forms.match(x, y)]
    return out


def leaves(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag == "#text":
            out.append(node)
        todo += reversed(node.children)
    return out


def _numbered(root: Node) -> list[Node]:
    """Text leaves in page order, each numbered by the hash of its text."""
    out = leaves(root)
    for node in out:
        node.number = _hash(node.text)
    return out


def _content(nodes: list[Node]) -> list[Node]:
    """Leaves that may be content: unmarked ones, within article or main if the page has one with text."""
    free = [x for x in nodes if not x.drop]
    inside = [x for x in free if x.content]
    return inside or free


def evidence(root: Node, pivot: Node) -> list[int] | None:
    """Numbers of the pivot nodes whose text the page repeats; None for a copy of the pivot or no text, which tell nothing."""
    nodes = _numbered(root)
    same = [(a, b) for a, b in align(root, pivot) if a.number == b.text]
    body = _content(nodes)
    size = sum(len(x.text) for x in body)
    held = {id(a) for a, _ in same}
    common = sum(len(x.text) for x in body if id(x) in held)
    if not size or (common > COPY_SHARE * size if body[0].content else common == size):
        return None
    return [b.number for _, b in same]


def extract(root: Node, pivot: Node | None, template: frozenset) -> str:
    """Content blocks joined by one \\n; without a pivot no node is template."""
    nodes = _numbered(root)
    constant = set()
    if pivot is not None and template:
        constant = {id(a) for a, b in align(root, pivot) if a.number == b.text and b.number in template}
    return "\n".join(x.text for x in _content(nodes) if id(x) not in constant)


# --- jobs ---------------------------------------------------------------------
SKELETON = pa.list_(pa.struct([("tag", pa.string()), ("n", pa.int32()), ("hash", pa.int64())]))


def pivots(pages: DataFrame) -> DataFrame:
    """(host, skeleton) of one page per host (columns host, html): of the complete pages the one of least hash."""
    rank = F.struct((~F.contains(F.lower("html"), F.lit("</html>"))).alias("cut"), F.xxhash64("html").alias("hash"))
    ranked = pages.where("host <> ''").select("host", "html", rank.alias("rank"))
    least = stage(ranked.groupBy("host").agg(F.min("rank").alias("rank")), "pivot-ranks")
    chosen = ranked.join(least, ["host", "rank"]).dropDuplicates(["host"]).select("host", "html")
    schema = pa.schema([("host", pa.string()), ("skeleton", SKELETON)])

    def rows(name, page) -> Iterator[tuple]:
        yield name, encode(parse(page))

    return stage(chosen.mapInArrow(batches(rows, schema), spark_schema(schema)), "pivots")


def templates(pages: DataFrame, found: DataFrame) -> DataFrame:
    """(host, skeleton, template): the numbers of the pivot's template nodes, counted over all pages of the host."""
    joined = pages.join(found, "host").select("host", "html", "skeleton")

    def count(it):
        for batch in it:  # counts are combined before they leave the task
            known: dict = {}
            tally: dict = {}
            for name, page, skeleton in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if name not in known:
                    known[name] = rebuild(skeleton.as_py())[0]
                same = evidence(parse(page), known[name])
                if same is not None:
                    for n in (-1, *same):  # -1 counts the pages that tell
                        tally[name, n] = tally.get((name, n), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in tally], pa.string()), pa.array([k[1] for k in tally], pa.int32()),
                                              pa.array(tally.values(), pa.int64())], names=["host", "node", "pages"])

    counts = joined.mapInArrow(count, "host string, node int, pages long").groupBy("host", "node").agg(F.sum("pages").alias("pages"))
    counts = stage(counts, "node-counts")
    telling = counts.where("node = -1").select("host", F.col("pages").alias("telling"))
    constant = (counts.where("node >= 0").join(telling, "host").where((F.col("telling") >= MIN_PAGES) & (F.col("pages") >= SAME_SHARE * F.col("telling")))
                .groupBy("host").agg(F.collect_list("node").alias("template")))  # at most the pivot's nodes
    return stage(found.join(constant, "host", "left"), "templates")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(key, url, text) for every input row.

    Null and empty pages have an empty text; a null URL or one without a host is extracted without a wrapper; null keys
    stay, repeated rows are extracted one by one, an empty table gives no rows; other columns are neither read nor
    returned.  Whole pages are read; nothing is capped.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("html"), host(F.col(url)).alias("host"))
    with_text = rows.where("html IS NOT NULL").select("host", "html")
    found = templates(with_text, pivots(with_text))
    joined = rows.join(found, "host", "left").select("key", "url", "html", "host", "skeleton", "template")
    schema = arrow_schema(pages, key, url=pa.string(), text=pa.string())

    def run(it):
        known: dict = {}
        for batch in it:
            if len(known) > 1000:
                known = {}
            keys, urls, texts, hosts = (batch.column(i).to_pylist() for i in range(4))
            out = []
            for i, name in enumerate(hosts):
                if name not in known:
                    template = frozenset(batch.column(5)[i].as_py() or ())
                    known[name] = (rebuild(batch.column(4)[i].as_py())[0] if template else None, template)
                out.append(extract(parse(texts[i]), *known[name]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, schema.field(0).type), pa.array(urls, pa.string()), pa.array(out, pa.string())], schema=schema)

    return joined.mapInArrow(run, spark_schema(schema)).withColumnRenamed("url", url) if url != "url" else joined.mapInArrow(run, spark_schema(schema))
