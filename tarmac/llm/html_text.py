"""Main text of web pages by wrapper induction over the pages of a host.

1. A host's reference page is the page with the smallest hash.  It is joined to
   the host's pages where they lie (broadcast if all reference pages are
   small), so that a host with a third of all pages stays in many tasks.
2. Every page's DOM tree is aligned with the reference tree by simple tree
   matching: of two nodes with the same label the children are matched in
   order so that the number of matched nodes is largest.  A page's block of
   text thereby falls into a slot of the reference tree.
3. Over all pages of the host, a slot whose text is the same in most of them is
   template; slots that vary are content.  Links, chars and equal texts are
   counted per slot over every page.  What has no counterpart in the reference
   page is counted by its path (labels from the root): a text that most of the
   host's different pages with that path hold is template as well.  Inside a
   marked article a constant is template only on many pages that are no near
   copies of the reference page: stories may share passages.
4. A page's text is its blocks outside template slots and link lists.  Parts
   that the markup itself names as something else (navigation, footers,
   adverts, notices, forms, reader comments) are left out before that, and if
   the page marks articles, the text is looked for in all of them.
"""

from __future__ import annotations

import hashlib
import html
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .registry import query

#: so many hosts (a name and a number, or a reference page's slots each) and so many bytes of reference pages are
#: broadcast at most
SMALL_HOSTS, SMALL_BYTES = 5_000, 64 << 20
#: a slot is template if its text is the reference page's in this part of the pages, of at least so many
CONSTANT, FROM_PAGES = 0.7, 2
#: without a counterpart in the reference page, a text is template on at least so many different pages
FROM_UNMATCHED = 3
#: inside a marked article a constant is template only on so many pages that are no near copies of each other, and in
#: nearly all of them; a page is a near copy if this part of its article's blocks is the reference page's
MARKED_PAGES, MARKED_CONSTANT, NEAR_COPY = 8, 0.9, 0.5
#: elements nested more deeply belong to their ancestor of that depth, as in browsers
DEEPEST = 200
#: cells of a table of two lists of children that are held at once; longer lists are matched by parts of it, as exactly
MOST_PAIRS = 1 << 23
#: sizes of matchings that are remembered at once
MOST_SIZES = 1 << 20
#: a slot outside a marked article is a list of links if this part of its characters is link text over all pages
LINKS = 0.6

# Element names of HTML.
RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "canvas", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
         "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p",
         "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: elements that an opening tag ends
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
#: elements that hold no article text
OTHER = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "input", "label"} | RAW
#: words of class, id or role that name other parts of a page
NAMED = {"ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment",
         "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "hidden", "login", "menu",
         "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "promoted",
         "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar",
         "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget",
         "complementary", "contentinfo", "alert"}
ARTICLE = {"article", "main"}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)>?", re.S)
_NAME = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?",
                   re.I)
_PART = re.compile(r"[^a-z]+")


class Node:
    __slots__ = ("tag", "label", "kids", "other", "article", "slot", "text", "shape", "count", "sink")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.kids, self.slot, self.text = tag, [], -1, None
        self.sink = self   # the node that gets its content while parsing
        words = []
        hidden, article = False, tag in ARTICLE
        if attrs:
            for name, a, b, c in _NAME.findall(attrs):
                value = (a or b or c).lower()
                name = name.lower()
                hidden |= name == "hidden" or (name == "aria-hidden" and value == "true")
                article |= (name == "role" and "main" in value.split()) or (
                    name == "itemprop" and "articlebody" in value.split())
                words += [w for w in _PART.split(value) if w]
        self.label = (tag, *words[:2])
        named = not NAMED.isdisjoint(words)
        self.article = article and not named
        self.other = tag in OTHER or hidden or (not article and named)


def parse(page: str) -> Node:
    """DOM tree of a page; never fails: what is not markup is text, and open elements end with the page."""
    root = Node("html")
    stack, at = [root], 0
    low = None

    def end(i: int):
        if len(stack) > DEEPEST and any(n.tag in BLOCK for n in stack[max(i, DEEPEST):]):
            stack[-1].sink.kids.append(Node("div"))   # an empty block: what follows is a block of its own
        del stack[i:]

    while True:
        m = _TAG.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text and not text.isspace():
            stack[-1].sink.kids.append(html.unescape(text))
        elif text:
            stack[-1].sink.kids.append(" ")
        if not m:
            return root
        at = m.end()
        name = m.group(2)
        if not name:
            if page.startswith("<![CDATA[", m.start()):
                stack[-1].sink.kids.append(page[m.start() + 9:at].removesuffix("]]>"))
            continue
        tag = name.lower()
        if m.group(1):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    end(i)
                    break
                if tag not in BLOCK and stack[i].tag in BLOCK:
                    break   # an inline end tag does not close blocks
            continue
        if tag in ("html", "body"):
            continue
        if tag in BLOCK:   # a block ends an open paragraph
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    end(i)
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in ENDS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ENDS[tag]:
                    end(i)
                    break
                if stack[i].tag in ("ul", "ol", "dl", "table", "menu", "select"):
                    break
        node = Node(tag, m.group(3))
        if len(stack) < DEEPEST or tag in RAW or tag in VOID:
            stack[-1].sink.kids.append(node)
        elif not node.other:
            node.sink = stack[-1].sink
            if tag in BLOCK:
                node.sink.kids.append(Node("div"))
        if tag in RAW or tag == "title":
            if low is None:
                low = page.lower()
            stop = low.find("</" + tag, at)
            at = len(page) if stop < 0 else stop
            stack.append(node)
            if tag in RAW:
                node.kids.clear()
                stack.pop()
                close = page.find(">", at)
                at = len(page) if close < 0 else close + 1
        elif tag not in VOID and not m.group(3).endswith("/"):
            stack.append(node)


class Shapes:
    """Numbers of equal subtrees (labels only), and sizes of the largest matchings of two of them."""

    def __init__(self):
        self.numbers, self.sizes = {}, {}

    def name(self, node: Node) -> Node:
        node.shape = self.numbers.setdefault((node.label, *(k.shape for k in node.kids)), len(self.numbers))
        node.count = 1 + sum(k.count for k in node.kids)
        return node

    def size(self, a: Node, b: Node) -> int:
        """Nodes in the largest matching of two trees."""
        if a.shape == b.shape:
            return a.count
        if a.label != b.label:
            return 0
        key = (a.shape, b.shape)
        if key not in self.sizes:
            size = 1 + self.matched(a.kids, b.kids, False)[0]
            if len(self.sizes) >= MOST_SIZES:
                self.sizes.clear()
            self.sizes[key] = size
            return size
        return self.sizes[key]

    def matched(self, x: list, y: list, pairs: bool = True) -> tuple[int, list[tuple[int, int]]]:
        """Nodes in the largest matching of two lists of children in order, and which pairs it has.

        Children of one shape at either end match each other in some largest matching; what is between is aligned by
        a table whose rows are computed at once.
        """
        n, m, lo = len(x), len(y), 0
        while lo < n and lo < m and x[lo].shape == y[lo].shape:
            lo += 1
        while n > lo and m > lo and x[n - 1].shape == y[m - 1].shape:
            n, m = n - 1, m - 1
        total = sum(k.count for k in x[:lo]) + sum(k.count for k in x[n:])
        out = [(i, i) for i in range(lo)] + [(i, i + m - n) for i in range(n, len(x))] if pairs else []
        x, y = x[lo:n], y[lo:m]
        if not x or not y:
            return total, out
        kinds, at = np.unique([q.shape for q in y], return_inverse=True)
        one = {q.shape: q for q in y}
        labels: dict = {}
        for i, k in enumerate(kinds.tolist()):
            labels.setdefault(one[k].label, []).append(i)
        weights: dict = {}

        def below(row: np.ndarray, p: Node) -> np.ndarray:
            """The table's row of p under the given one, as wide as that."""
            if p.shape not in weights:
                if len(weights) * len(kinds) > MOST_PAIRS:
                    weights.clear()
                w = np.zeros(len(kinds), dtype=np.int32)
                for i in labels.get(p.label, ()):
                    w[i] = self.size(p, one[int(kinds[i])])
                weights[p.shape] = w
            out = np.zeros(len(row), dtype=np.int32)
            np.maximum.accumulate(np.maximum(row[1:], row[:-1] + weights[p.shape][at[:len(row) - 1]]), out=out[1:])
            return out

        def trace(first: int, last: int, row: np.ndarray, j: int) -> int:
            """Pairs of x[first:last], whose table lies under ``row``, on the path up from column j; where it gets out.

            A table of more than ``MOST_PAIRS`` cells is halved: the same path, half of its rows in memory at a time.
            """
            row, i = row[:j + 1], last - first
            if i > 1 and i * j > MOST_PAIRS:
                middle, there = (first + last) // 2, row
                for p in x[first:middle]:
                    there = below(there, p)
                j = trace(middle, last, there, j)
                return trace(first, middle, row, j) if j else 0
            rows = [row]
            for p in x[first:last]:
                rows.append(below(rows[-1], p))
            while i and j:
                if rows[i][j] == rows[i - 1][j]:
                    i -= 1
                elif rows[i][j] == rows[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    found.append((first + i, j))
            return j

        row, found = np.zeros(len(y) + 1, dtype=np.int32), []
        if pairs:
            trace(0, len(x), row, len(y))
            return total + sum(self.size(x[i], y[j]) for i, j in found), out + [(lo + i, lo + j) for i, j in found]
        for p in x:
            row = below(row, p)
        return total + int(row[-1]), out


def trimmed(node: Node, shapes: Shapes) -> Node:
    """The tree with runs of inline content as text leaves of their block: (tag ``#``, text, link characters)."""
    out = Node(node.tag)
    out.label, out.other, out.article = node.label, node.other, node.article
    parts: list[str] = []
    links = 0

    def flush():
        nonlocal links
        text = " ".join("".join(parts).split())
        if text:
            leaf = Node("#")
            leaf.text = (text, min(links, len(text)))
            out.kids.append(shapes.name(leaf))
        parts.clear()
        links = 0

    def walk(n: Node, in_link: bool):
        nonlocal links
        for k in n.kids:
            if isinstance(k, str):
                parts.append(k)
                links += len(k) if in_link else 0
            elif k.tag == "br":
                parts.append(" ")
            elif k.other or k.tag == "title":
                continue
            elif k.tag in BLOCK:
                flush()
                block = trimmed(k, shapes)
                if block.kids:
                    out.kids.append(block)
            else:
                walk(k, in_link or k.tag == "a")

    walk(node, False)
    flush()
    return shapes.name(out)


def match(a: Node, b: Node, number: dict[int, int], shapes: Shapes) -> int:
    """Simple tree matching of two trees; sets the slots of ``a``'s nodes to the numbers of ``b``'s.  Returns its size."""
    if a.label != b.label:
        return 0
    a.slot = number[id(b)]
    total, pairs = shapes.matched(a.kids, b.kids)
    for i, j in pairs:
        match(a.kids[i], b.kids[j], number, shapes)
    return 1 + total


def _number(tree: Node) -> tuple[dict[int, int], dict[int, str]]:
    """Number of every node of the reference tree in page order, and the texts of its leaves."""
    numbers, texts = {}, {}

    def walk(n: Node):
        numbers[id(n)] = len(numbers)
        if n.text:
            texts[numbers[id(n)]] = n.text[0]
        for k in n.kids:
            walk(k)

    walk(tree)
    return numbers, texts


def _main(tree: Node) -> list[tuple[Node, int]]:
    """The outermost marked nodes with text, in page order, or the whole page, each with the slot it lies in."""
    found = []

    def walk(n: Node, around: int):
        if n.article and n.kids:   # trimmed nodes without text have no children
            found.append((n, around))
            return
        for k in n.kids:
            walk(k, n.slot if n.slot >= 0 else around)

    walk(tree, -1)
    return found or [(tree, -1)]


def blocks(tree: Node, texts: dict[int, str]) -> list[tuple[int, bool, int, str, str, bool]]:
    """(slot, same text as the reference page, link characters, text, path, in a marked article) of the blocks of a
    page's main part.

    A block without a counterpart has the negative number of the slot it lies in.
    """
    out = []

    def walk(n: Node, around: int, path: str, marked: bool):
        slot = n.slot if n.slot >= 0 else -1 - max(around, 0)
        path += "/" + ".".join(n.label)
        if n.text:
            out.append((slot, texts.get(slot) == n.text[0], n.text[1], n.text[0], path, marked))
        for k in n.kids:
            walk(k, n.slot if n.slot >= 0 else around, path, marked)

    for n, around in _main(tree):
        walk(n, around, "", n.article)
    return out


_BLOCKS = ("page_id long, url string, host string, copy boolean, slot array<int>, same array<boolean>, "
           "links array<int>, text array<string>, key array<long>, marked array<boolean>, first array<boolean>, "
           "page long, path array<long>")


def _key(path: str, text: str) -> tuple[int, int]:
    """Hashes of a block's path, and of its path and text."""
    a = hashlib.blake2b(path.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    b = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8, key=a).digest()
    return int.from_bytes(a, "big", signed=True), int.from_bytes(b, "big", signed=True)


def _align(frames):
    """Blocks of pages, aligned with their host's reference page (column ``reference``), host by host in a batch."""
    for pages in frames:
        rows = []
        for host, some in pages.groupby("host", sort=False):
            shapes = Shapes()
            ref = trimmed(parse(some["reference"].iloc[0]), shapes)
            numbers, texts = _number(ref)
            for page_id, url, page, h in zip(some["page_id"], some["url"], some["html"], some["h"]):
                tree = trimmed(parse(page), shapes)
                match(tree, ref, numbers, shapes)
                found = blocks(tree, texts)
                inside = [f[1] for f in found if f[5]]
                keys = [_key(f[4], f[3]) if f[0] < 0 else (0, 0) for f in found]
                seen: set[int] = set()
                first = [not (f[0] in seen or seen.add(f[0])) for f in found]
                copy = all(f[1] for f in found) or (len(inside) > 0 and sum(inside) >= NEAR_COPY * len(inside))
                rows.append((page_id, url, host, copy, [f[0] for f in found],
                             [f[1] for f in found], [f[2] for f in found], [f[3] for f in found],
                             [k[1] for k in keys], [f[5] for f in found], first, h, [k[0] for k in keys]))
        out = pd.DataFrame(rows, columns=["page_id", "url", "host", "copy", "slot", "same", "links", "text", "key",
                                          "marked", "first", "page", "path"])
        yield out.astype({"page_id": "Int64"})


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text (blocks joined by two line feeds), n_chars.

    A null html is empty and has the empty text; a null or odd url belongs to
    the host of no name.  Repeated rows are pages like any other.  Pages with
    the reference page's very text, or with half of its article, show nothing
    about template and content, so they don't count there.  Elements nested more
    than ``DEEPEST`` deep belong to their ancestor of that depth.  Lists of
    children of any length are matched in the same way: memory is bounded, time
    grows with the product of their lengths.  Other columns are ignored; an
    empty table gives an empty result.
    """
    scratch = Scratch(pages.sparkSession, "pages")
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), host.alias("host"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("h", F.xxhash64("html"))
    hosts = scratch.keep(rows.groupBy("host").agg(F.min("h").alias("h")), "hosts")
    chosen = F.broadcast(hosts) if hosts.count() <= SMALL_HOSTS else hosts
    reference = rows.select("host", "h", "html").join(chosen, ["host", "h"]).dropDuplicates(["host"])
    reference = scratch.keep(reference.select("host", F.col("html").alias("reference")), "reference")
    size = reference.agg(F.count("*").alias("n"), F.sum(F.octet_length("reference")).alias("bytes")).first()
    small = size["n"] <= SMALL_HOSTS and (size["bytes"] or 0) <= SMALL_BYTES
    # beyond that the pages are shuffled by host for these joins, which Spark splits where a host is large
    dealt = rows.select("page_id", "url", "host", "html", "h").join(F.broadcast(reference) if small else reference, "host")
    aligned = scratch.keep(dealt.mapInPandas(_align, _BLOCKS), "aligned")
    slots = (aligned.filter("not copy").select("host", F.explode(F.arrays_zip("slot", "same", "links", "marked", "first",
                                                           F.transform("text", F.length).alias("chars"))).alias("b"))
             .groupBy("host", "b.slot").agg(F.count("*").alias("n"), F.sum(F.col("b.same").cast("long")).alias("same"),
                                            F.sum("b.links").alias("links"), F.sum("b.chars").alias("chars"),
                                            F.max("b.marked").alias("marked"),
                                            F.sum(F.col("b.first").cast("long")).alias("pages")))
    template = F.when(F.col("marked"), (F.col("n") >= MARKED_PAGES) & (F.col("same") >= MARKED_CONSTANT * F.col("n"))).otherwise(
        (F.col("n") >= FROM_PAGES) & (F.col("same") >= CONSTANT * F.col("n"))) | (
        ~F.col("marked") & (F.col("pages") >= FROM_PAGES) & (F.col("links") > LINKS * F.col("chars")))
    dropped = slots.filter(template).groupBy("host").agg(F.collect_set("slot").alias("template"))
    # equal texts without a counterpart; equal pages count once
    alone = aligned.filter("not copy").select("host", "page", F.explode(F.filter(F.arrays_zip("slot", "path", "key", "marked"),
                                                                                 lambda b: b["slot"] < 0)).alias("b"))
    least = F.when(F.col("marked"), MARKED_PAGES).otherwise(FROM_UNMATCHED)
    held = (alone.select("host", "page", "b.path", "b.key", "b.marked").distinct()
            .groupBy("host", "path", "key").agg(F.count("*").alias("n"), F.max("marked").alias("marked")).filter(F.col("n") >= least))
    paths = (alone.select("host", "page", "b.path").distinct()
             .groupBy("host", "path").agg(F.count("*").alias("pages")))
    share = F.when(F.col("marked"), MARKED_CONSTANT).otherwise(CONSTANT)
    common = (held.join(paths, ["host", "path"]).filter(F.col("n") >= share * F.col("pages"))
              .groupBy("host").agg(F.collect_set("key").alias("common")))
    dropped = dropped.join(common, "host", "full")
    met = aligned.join(F.broadcast(dropped) if small else dropped, "host", "left")
    kept = F.filter(F.arrays_zip("slot", "text", "key"),
                    lambda b: ~(F.coalesce(F.array_contains("template", b["slot"]), F.lit(False)) | (
                        (b["slot"] < 0) & F.coalesce(F.array_contains("common", b["key"]), F.lit(False)))))
    text = F.concat_ws("\n\n", F.transform(kept, lambda b: b["text"]))
    return met.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


@query("op7_wrapper_html")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
