"""Main text of web pages by wrapper induction.

Pages of a host that have the same layout (names of their containers, outside of
articles) are aligned with one reference page of that layout by simple tree
matching: two nodes match if tag and class agree, and the matched children of
two nodes form the heaviest sequence of pairs in order.  A reference node whose
text is the same on at least ``CONSTANT`` of a layout's pages is template; so is
a node that the reference lacks, if that share of the pages has its text at the
same place (the names from the root down).  The slots that vary are content.
Page parts that say what
they are (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, comments, by element or by a whole class, id or role) are no content
anywhere; names do not count on articles, main, headings and paragraphs, nor on
what holds a page's only articles or main.  Compound names say nothing; the
template decides there.  Where a page
has article elements, or else main elements, the text is looked for in these; their
nodes are matched and counted like all others.

What is template is a node's own running text: its strings, and those of the
inline elements among them.  Elements inside it are judged by themselves.

All pages are counted, those with the same text once; fewer than ``LEAST_PAGES``
are no evidence.  Layouts with fewer different texts are taken together, host by
host.  Reference pages: the page with the lowest hash of each layout, one of up
to ``REFERENCE_BYTES`` if there is any.  Pages meet the reference and template of
their layout in joins; those sides are broadcast up to a counted bound, and up to it no page carries its
reference's text with it.

A page is parsed once for its keys (host, layout, digest), which are saved beside it.  Matching
takes the product of two nodes' numbers of children in time, and two bits for each such pair in memory.

Since a heading with the same words on half of a layout's pages ("Summary") is constant, it is template
and goes from articles too.  Defined results: a null, empty or text-free page gives an empty text.  A page
without a readable host belongs to the host "".  Repeated pages each get a row.
Elements may be nested at any depth.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.common import id_set, saved, slices

CONSTANT = 0.5
LEAST_PAGES = 3
REFERENCE_BYTES = 20_000
MAX_BROADCAST_BYTES = 32 << 20
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>",
    re.DOTALL,
)
DIGIT = re.compile(r"[0-9]")
NAMED = re.compile(r"""(?:^|[\s/])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
CONTAINERS = {"body", "main", "section", "div", "table"}
UNREAD = {"script", "style", "head"}
# HTML's own element names by their meaning there.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr",
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "div", "dl", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p",
    "pre", "section", "table", "ul",
}
ALIKE = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
NO_CONTENT = RAW | {
    "head", "nav", "footer", "aside", "form", "button", "select", "option", "input", "object", "svg", "canvas",
    "dialog", "menu", "template", "audio", "video", "map", "math",
}
NO_CONTENT_NAMES = {
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "discussion", "footer",
    "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup",
    "promo", "promotion", "related", "replies", "share", "sharing", "sidebar", "social", "sponsor", "sponsored",
    "subscribe", "toolbar",
}


# Never judged by name.
UNNAMED = {"html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "p"}


class Node:
    __slots__ = ("children", "name", "number", "pieces", "role", "tag")

    def __init__(self, tag: str, name: str, role: str) -> None:
        self.tag, self.name, self.role = tag, name, role
        self.children: list[Node] = []
        self.pieces: list[str | Node] = []  # texts and children in order
        self.number = -1


def role_of(tag: str, names: list[str], open_tags: list[Node]) -> str:
    """"none" or, by name alone, "named" for what is no content, "main" or "article" for what says it is, else nothing."""
    if tag in NO_CONTENT:
        return "none"
    if tag not in UNNAMED and not NO_CONTENT_NAMES.isdisjoint(names):
        return "named"
    if tag == "header":
        return "" if any(n.role == "article" for n in open_tags) else "none"
    if tag == "article":
        return "article"
    return "main" if tag == "main" or "main" in names and tag == "div" else ""


def parse(page: str) -> Node:
    """The page's tree; missing end tags are read as HTML reads them."""
    root = Node("#page", "", "")
    stack = [root]
    opened: Counter[str] = Counter()  # elements on the stack, so that no end tag looks for one that is not there
    at = 0

    def text(piece: str) -> None:
        if piece:
            stack[-1].pieces.append(entities.unescape(piece) if "&" in piece else piece)

    def close(upto: int) -> None:
        for node in stack[upto:]:
            opened[node.tag] -= 1
        del stack[upto:]

    while m := TOKEN.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if not opened[tag]:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if stack[k].tag in {"article", "table", "td", "body"} and tag in INLINE | {"p", "li"}:
                    break
            continue
        if tag in CLOSES_P and opened["p"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag not in INLINE:
                    break
        if tag in ALIKE:
            same, bounds = ALIKE[tag]
            for k in range(len(stack) - 1, 0, -1) if any(opened[x] for x in same) else ():
                if stack[k].tag in same:
                    close(k)
                    if tag != "tr" or stack[-1].tag not in same:
                        break
                elif stack[k].tag in bounds:
                    break
        attributes = m[3]
        names = " ".join(x.strip("\"'") for x in NAMED.findall(attributes)).lower().split() if "=" in attributes else []
        lasting = [x for x in names if not DIGIT.search(x)]  # "post-123" names a page, not a slot
        node = Node(tag, " ".join([tag, *lasting]), role_of(tag, names, stack))
        stack[-1].children.append(node)
        stack[-1].pieces.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            if not end:
                break
            at = page.find(">", at) + 1 or len(page)
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            opened[tag] += 1
    text(page[at:])
    settle_names(root)
    return root


def settle_names(root: Node) -> None:
    """Parts named as no content are none, but for those around a page's articles, or else mains, if all are in such parts.

    Where a main lies outside such parts and all articles lie in them, the main stays what the text is looked for in.
    """
    named: list[Node] = []
    held: dict[str, list] = {"article": [], "main": []}
    free = {"article": False, "main": False}
    todo: list = [(root, None, False)]
    while todo:
        node, around, inside = todo.pop()
        if node.role == "none":
            continue
        if node.role in held and not inside:
            free[node.role] |= around is None
            held[node.role].append((node, around))
            inside = node.role == "article"  # whose parts are judged by name
        elif node.role == "named":
            named.append(node)
            around = around if inside else (node, around)
        todo += [(x, around, inside) for x in node.children]
    freed: set[int] = set()
    if not free["article"]:
        for node, around in held["article"] or ([] if free["main"] else held["main"]):
            if free["main"]:
                node.role = ""
            while around is not None and id(around[0]) not in freed:
                freed.add(id(around[0]))
                around = around[1]
    for node in named:
        node.role = "" if id(node) in freed else "none"


def runs_on(node: Node) -> bool:
    """Whether the node has strings of its own, so that inline elements are parts of its sentence."""
    return any(isinstance(x, str) and not x.isspace() for x in node.pieces)


def own(node: Node) -> tuple[list[str], list[Node], list[Node]]:
    """The node's running text, the inline elements that are part of it, and the other elements below these."""
    strings, inner, others, joins = [], [], [], runs_on(node)
    todo: list = list(reversed(node.pieces))
    while todo:
        piece = todo.pop()
        if isinstance(piece, str):
            strings.append(piece)
        elif piece.tag == "br":
            strings.append(" ")
        elif piece.role == "none":
            continue
        elif joins and piece.tag in INLINE:
            inner.append(piece)
            todo += reversed(piece.pieces)
        else:
            others.append(piece)
    return strings, inner, others


def own_text(node: Node) -> str:
    return " ".join("".join(own(node)[0]).split())


def aligned_nodes(root: Node) -> list[Node]:
    """Nodes that take part in matching, numbered in page order; parts that are no content anywhere do not."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        node.number = len(found)
        found.append(node)
        node.children = own(node)[2]
        todo += reversed(node.children)
    return found


def weight(one: Node, two: Node, texts: dict[int, str], others: dict[int, str], known: dict) -> float:
    """Simple tree matching: nodes matched, and a little more for equal texts; pairs below first, whatever the depth."""
    todo = [(one, two)]
    while todo:
        a, b = todo[-1]
        key = a.number, b.number
        inner = [y for y in b.children if y.children] if a.children and key not in known else []
        below = [
            (x, y) for x in a.children if x.children for y in inner if x.name == y.name and (x.number, y.number) not in known
        ] if inner else []
        if below:
            todo += below
            continue
        todo.pop()
        if key not in known:
            total = 1.0 + 0.5 * (texts[a.number] == others[b.number])
            known[key] = total + (children_weight(a, b, texts, others, known) if a.children and b.children else 0)
    return known[one.number, two.number]


def child_rows(one: Node, two: Node, texts, others, known) -> Iterator[np.ndarray]:
    """Heaviest matchings of the first children of both, one row for each child of ``one``; pairs that both have children are known."""
    numbers: dict = {}
    names = np.array([numbers.setdefault(b.name, len(numbers)) for b in two.children])
    words = np.array([numbers.setdefault((others[b.number],), len(numbers)) for b in two.children])
    inner = np.flatnonzero([bool(b.children) for b in two.children])
    row = np.zeros(len(names) + 1)
    yield row
    for a in one.children:
        same = names == numbers.get(a.name, -1)
        each = 1.0 + 0.5 * (words == numbers.get((texts[a.number],), -1))
        if a.children:
            for k in inner[same[inner]]:
                each[k] = known[a.number, two.children[k].number]
        best = np.where(same, row[:-1] + each, 0.0)
        row = np.append(0.0, np.maximum.accumulate(np.maximum(best, row[1:])))
        yield row


SMALL_TABLE = 2048


def child_table(one: Node, two: Node, texts, others, known) -> list[list[float]]:
    """The rows of a small table, without arrays."""
    table = [[0.0] * (len(two.children) + 1)]
    for a in one.children:
        above, row, mine = table[-1], [0.0], texts[a.number]
        for k, b in enumerate(two.children):
            best = max(above[k + 1], row[k])
            if a.name == b.name:
                leaf = not (a.children and b.children)
                each = 1.0 + 0.5 * (mine == others[b.number]) if leaf else known[a.number, b.number]
                best = max(best, above[k] + each)
            row.append(best)
        table.append(row)
    return table


def is_small(one: Node, two: Node) -> bool:
    return len(one.children) * len(two.children) <= SMALL_TABLE


def children_weight(one: Node, two: Node, texts, others, known) -> float:
    if is_small(one, two):
        return child_table(one, two, texts, others, known)[-1][-1]
    for row in child_rows(one, two, texts, others, known):
        last = row[-1]
    return float(last)


def child_pairs(one: Node, two: Node, texts, others, known) -> list[tuple[Node, Node]]:
    """The matched children, last first; of equal matchings the one that leaves out later children of ``one``, then of ``two``.

    A large table is kept as two bits a cell: whether a cell equals the one above, and the one before.
    """
    if is_small(one, two):
        table = child_table(one, two, texts, others, known)
        above = lambda i, j: table[i][j] == table[i - 1][j]
        before = lambda i, j: table[i][j] == table[i][j - 1]
    else:
        rows, ups, lefts = child_rows(one, two, texts, others, known), [], []
        last = next(rows)
        for row in rows:
            ups.append(np.packbits(row == last))
            lefts.append(np.packbits(row[1:] == row[:-1]))
            last = row
        above = lambda i, j: ups[i - 1][j >> 3] >> (7 - (j & 7)) & 1
        before = lambda i, j: lefts[i - 1][(j - 1) >> 3] >> (7 - ((j - 1) & 7)) & 1
    pairs = []
    i, j = len(one.children), len(two.children)
    while i and j:
        if above(i, j):
            i -= 1
        elif before(i, j):
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((one.children[i], two.children[j]))
    return pairs


def matched(one: Node, two: Node, texts, others) -> list[tuple[Node, Node]]:
    """Pairs of the heaviest matching, from the roots down."""
    known: dict = {}
    weight(one, two, texts, others, known)
    pairs, todo = [], [(one, two)]
    while todo:
        a, b = todo.pop()
        pairs.append((a, b))
        if a.children and b.children:
            todo += child_pairs(a, b, texts, others, known)
    return pairs


def same_text_pairs(root: Node, reference: tuple[Node, dict[int, str]]) -> list[tuple[int, Node]]:
    """Reference nodes, and the page nodes matched with them that hold the same words."""
    texts = {n.number: own_text(n) for n in aligned_nodes(root)}
    other, others = reference
    pairs = matched(root, other, texts, others)
    return [(b.number, a) for a, b in pairs if texts[a.number] and texts[a.number] == others[b.number]]


def marks(root: Node, reference: tuple[Node, dict[int, str]]) -> list[tuple[int, Node]]:
    """Nodes with text: the number of the reference node with the same words, else a negative hash of place and words."""
    found = same_text_pairs(root, reference)
    met = {id(node) for _, node in found}
    todo = [(root, 0)]
    while todo:
        node, place = todo.pop()
        place = zlib.crc32(node.name.encode("utf-8", "replace"), place)
        todo += [(x, place) for x in node.children]
        if id(node) not in met and (words := own_text(node)):
            code = blake2b(words.encode("utf-8", "replace"), digest_size=8, salt=place.to_bytes(4, "big")).digest()
            found.append((-1 - (int.from_bytes(code, "big") >> 1), node))
    return found


class Trees(dict):
    """Trees stay in their process; what is sent to tasks is empty."""

    def __reduce__(self):
        return Trees, ()


REFERENCES: dict[str, tuple[Node, dict[int, str]]] = Trees()


def reference_tree(page: str) -> tuple[Node, dict[int, str]]:
    """The tree of a reference page; a task keeps up to 256 of them."""
    if page not in REFERENCES:
        if len(REFERENCES) >= 256:
            REFERENCES.clear()
        root = parse(page)
        REFERENCES[page] = root, {n.number: own_text(n) for n in aligned_nodes(root)}
    return REFERENCES[page]


def blocks(node: Node, template: set[int], into: list[list[str]]) -> None:
    """The node's text without the strings of template nodes, block by block; ``into`` ends with the block being filled."""
    todo: list = [node]
    while todo:
        now = todo.pop()
        if isinstance(now, str):
            into[-1].append(now)
        elif now is None:
            into.append([])
        elif now.tag == "br":
            into[-1].append(" ")
        elif now.role != "none":
            parts = list(reversed(now.pieces))
            if id(now) in template:
                parts = [x for x in parts if not isinstance(x, str)]
            todo += parts if now.tag in INLINE else [None, *parts, None]


def outermost(root: Node, role: str) -> list[Node]:
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.role == role:
            found.append(node)
        elif node.role != "none":
            todo += [x for x in reversed(node.pieces) if isinstance(x, Node)]
    return found


def main_text(page: str, reference: str | None, template: list[int]) -> str:
    """Content blocks in page order, joined by an empty line."""
    root = parse(page)
    roots = outermost(root, "article") or outermost(root, "main")
    into: list[list[str]] = [[]]
    constant: set[int] = set()
    if reference is not None and template:
        wanted = set(template)
        for mark, node in marks(root, reference_tree(reference)):
            if mark in wanted:
                constant |= {id(x) for x in [node, *own(node)[1]]}
    for node in roots or [root]:
        into.append([])
        blocks(node, constant, into)
    texts = (" ".join("".join(block).split()) for block in into)
    return "\n\n".join(t for t in texts if t)


def code(*parts: str) -> int:
    """A 64-bit hash."""
    data = "\0".join(parts).encode("utf-8", "replace")
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "big", signed=True)


def page_keys(root: Node) -> tuple[int, int]:
    """Layout and digest: hashes of the containers' lasting names outside of articles, and of all words."""
    names: set[str] = set()
    strings: list[str] = []
    holds = {"article": False, "main": False}
    todo: list = [(root, False)]
    while todo:
        piece, inside = todo.pop()
        if isinstance(piece, str):
            strings.append(piece)
        elif piece.tag not in UNREAD:
            if not inside:
                if piece.tag in holds:
                    holds[piece.tag] = True
                inside = piece.tag == "article"
                if not inside and piece.tag in CONTAINERS:
                    names.update(piece.name.split()[1:])
            todo += [(x, inside) for x in reversed(piece.pieces)]
    layout = code(*sorted(names - NO_CONTENT_NAMES), str(holds["article"]), str(holds["main"]))
    return layout, code(" ".join(" ".join(strings).split()))


def with_layout(pages: DataFrame) -> DataFrame:
    """page_id, url, html, host, layout, digest of every page, each parsed once; saved, since four steps read them."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys = [page_keys(parse(page)) for page in batch.column(2).to_pylist()]
            added = [pa.array([key[k] for key in keys], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "layout", "digest"])

    read = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    schema = "page_id bigint, url string, html string, host string, layout bigint, digest bigint"
    return saved(read.mapInArrow(run, schema), "op10-pages", compression="zstd")


def layouts(pages: DataFrame) -> DataFrame:
    """host, layout, n (different texts) of the layouts that are a group of their own."""
    counted = pages.select("host", "layout", "digest").distinct().groupBy("host", "layout").agg(F.count("*").alias("n"))
    return saved(counted.filter(f"n >= {LEAST_PAGES}").select("host", "layout"), "op10-layouts")


def with_kind(pages: DataFrame, own_layouts: DataFrame) -> DataFrame:
    """The pages with their group: the layout, or 0 for all of a host's rarer layouts."""
    kinds = id_set(own_layouts.withColumn("kind", F.col("layout")))
    return pages.join(kinds, ["host", "layout"], "left").withColumn("kind", F.coalesce("kind", F.lit(0).cast("bigint")))


def references(pages: DataFrame) -> DataFrame:
    """host, kind, id, n (different texts), reference (one page) of every group."""
    order = F.struct(F.octet_length("html") > REFERENCE_BYTES, F.xxhash64("url", "html"))
    of = ["host", "kind"]
    counted = pages.select(*of, "digest").distinct().groupBy(*of).agg(F.count("*").alias("n"))
    chosen = pages.groupBy(*of).agg(F.min_by("html", order).alias("reference"))
    return saved(chosen.join(counted, of).withColumn("id", F.monotonically_increasing_id()), "op10-references")


def with_group(pages: DataFrame, groups: DataFrame, columns: list[str]) -> tuple[DataFrame, Callable[[int, str | None], str | None]]:
    """The pages with ``columns`` of their groups, among them id and reference, and how a task reads a reference from these two.

    Up to ``MAX_BROADCAST_BYTES`` the groups are broadcast, and the reference pages go to each Python process once
    instead of beside every page, where they would make up most of what tasks hold; the column is null then.
    """
    size = groups.agg(F.sum(F.octet_length("reference") + 100)).first()[0] or 0
    if size > MAX_BROADCAST_BYTES:
        return pages.join(groups, ["host", "kind"]).select(*columns), lambda _, text: text
    texts = {row.id: row.reference for row in groups.select("id", "reference").collect()}
    shared = groups.sparkSession.sparkContext.broadcast(texts)
    short = F.broadcast(groups.withColumn("reference", F.lit(None).cast("string")))
    return pages.join(short, ["host", "kind"]).select(*columns), lambda number, _: shared.value[number]


def templates(pages: DataFrame, reference: DataFrame) -> DataFrame:
    """host, kind, id, reference, template: the marks that are constant in the group."""

    met, read = with_group(pages, reference.filter(f"n >= {LEAST_PAGES}"), ["html", "digest", "id", "reference"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [
                (group, mark, digest)
                for page, digest, group, other in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for mark in {m for m, _ in marks(parse(page), reference_tree(read(group, other)))}
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in range(3)], names=["id", "mark", "digest"])

    counted = met.mapInArrow(run, "id bigint, mark bigint, digest bigint")
    constant = counted.distinct().groupBy("id", "mark").agg(F.count("*").alias("same")).join(
        reference.select("id", "n"), "id"
    ).filter(f"same >= {LEAST_PAGES} AND same >= {CONSTANT} * n")
    lists = constant.groupBy("id").agg(F.collect_list("mark").alias("template"))  # about two pages' nodes at most
    empty = F.array().cast("array<bigint>")
    return saved(
        reference.join(lists, "id", "left").select("host", "kind", "id", "reference", F.coalesce("template", empty).alias("template")),
        "op10-templates",
    )


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    every = with_layout(pages)
    kinds = with_kind(every, layouts(every))
    template = templates(kinds, references(kinds))

    joined, read = with_group(kinds, template, ["page_id", "url", "html", "id", "reference", "template"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True)
            texts = [main_text(page, read(group, other), marked) for page, group, other, marked in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
