"""Main text of web pages: template parts are found by what recurs over a host's pages.

Subtrees of the parsed page are hashed and counted per host, and per first folder of a host, in
Spark; those that recur on many of its pages are its template and go, beside parts whose tag, role or class says that
they are no article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import saved, text_of
from pulsemart.llm.url_rules import host_of

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^\"'>])*+>|[^>]*+>)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Parts that are no text of an article, by tag and by ARIA role.
NO_TEXT = set(
    "head script style noscript template nav aside footer form fieldset button select option "
    "textarea input iframe object embed svg canvas audio video map dialog menu".split()
)
NO_TEXT_ROLES = set(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar "
    "toolbar tablist".split()
)
#: The same by a class or id that is one of these words, or made of nothing but them.
NO_TEXT_WORDS = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot "
    "sponsor sponsored sponsors promo promos promotion promoted banner banners cookie cookies consent "
    "gdpr notice notices popup popups modal overlay newsletter subscribe subscription signup "
    "sidebar sidebars aside rail widget widgets menu menus nav navbar navigation navi topnav "
    "breadcrumb breadcrumbs pagination pager footer footers masthead comment comments commentlist "
    "disqus replies reply respond discussion share sharing social related recommended "
    "recommendations login search searchbox toolbar skip paywall outbrain taboola".split()
)
#: Tags without text of their own, whatever they hold.
NEVER_TEXT = set(
    "head script style noscript template button select option textarea input iframe object embed "
    "svg canvas audio video map".split()
)
#: Tags that hold no article for the mere length of their text.
ASIDES = {"nav", "aside", "footer", "menu", "dialog"}
HEADERS = {"header", "headers", "topbar", "siteheader", "pageheader"}
#: Parts that a host's template may consist of wherever they stand. Others below them, paragraphs,
#: headings, links and the like, count too, but not beside running text that is the page's own.
PARTS = set("div section ul ol dl table nav aside header footer form center main".split())
#: What paragraphs and the like stand in.
BOXES = PARTS | {"#page", "html", "body", "article"}
CLOSED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"},
    "tfoot": {"tr", "td", "th", "thead", "tbody"},
}
SCOPES = {"ul", "ol", "dl", "table", "td", "th", "div", "article", "section", "select", "body"}


@dataclass
class Node:
    tag: str
    attrs: str = ""
    children: list[Node | str] = field(default_factory=list)
    #: Is or holds the article, or most of the page's text: never dropped for what it is called.
    holds_article: bool = False
    #: Hash of tags and texts below, and whether there is any text; see `hash_subtrees`.
    key: int = 0
    has_words: bool = False


def parse(page: str) -> Node:
    """A tree of elements and texts. Tolerates unclosed, stray and crossed tags."""
    root = Node("#page")
    stack, at = [root], 0
    text = lambda a, b: a < b and stack[-1].children.append(html.unescape(page[a:b]))
    search = TOKEN.search
    while found := search(page, at):
        text(at, found.start())
        at = found.end()
        tag = found["tag"]
        if tag is None:
            if page.startswith("<![CDATA[", found.start()):
                stack[-1].children.append(found[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if found["end"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth and (tag not in INLINE or all(n.tag in INLINE for n in stack[depth + 1 :])):
                del stack[depth:]
            continue
        attrs = found["attrs"][:-1]
        if tag not in INLINE and tag not in VOID:
            ends = CLOSED_BY.get(tag, ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends or stack[i].tag == "p" and tag not in RAW:
                    del stack[i:]
                    if tag not in CLOSED_BY:
                        break
                elif stack[i].tag in SCOPES and stack[i].tag not in ends:
                    break
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag in VOID or attrs.endswith("/") and tag not in INLINE | PARTS | RAW | {"p"}:
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*/?>", re.I).search(page, at)
            node.children.append(page[at : close.start() if close else len(page)])
            at = close.end() if close else len(page)
            continue
        stack.append(node)
    text(at, len(page))
    mark_article(root)
    hash_subtrees(root)
    return root


def is_marked(node: Node) -> bool:
    return node.tag in ("article", "main") or bool(node.attrs) and (
        "articlebody" in node.attrs.lower()
        or "role=" in node.attrs
        and attributes(node).get("role") in ("main", "article")
    )


def mark_article(root: Node) -> None:
    """Mark the marked node with the most text, what holds most of the text, and all around them."""
    order, parent, stack = [], {}, [root]
    while stack:
        node = stack.pop()
        order.append(node)
        for child in node.children:
            if isinstance(child, Node) and child.tag not in NEVER_TEXT:
                parent[id(child)] = node
                stack.append(child)
    size: dict[int, int] = {}
    for node in reversed(order):
        size[id(node)] = sum(
            len(c.strip()) if isinstance(c, str) else size.get(id(c), 0) for c in node.children
        )
    marked = [n for n in order if is_marked(n)]
    held = [max(marked, key=lambda n: size[id(n)])] if marked else []
    held += [n for n in order if 2 * size[id(n)] > size[id(root)] and n.tag not in ASIDES]
    for node in held:
        while node is not None and not node.holds_article:
            node.holds_article = True
            node = parent.get(id(node))


def attributes(node: Node) -> dict[str, str]:
    return {
        k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(node.attrs)
    }


def says_no_text(node: Node, in_article: bool) -> bool:
    """Whether tag, role or class tell that a part is no text of the article."""
    if node.tag in NEVER_TEXT:
        return True
    if node.holds_article:
        return False
    if node.tag in NO_TEXT:
        return True
    if node.tag == "header" and not in_article:
        return True
    if not node.attrs or node.tag in ("html", "body", "main"):
        return False
    has = attributes(node)
    if "hidden" in has or has.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", has.get("style", "")):
        return True
    if has.get("role", "").lower() in NO_TEXT_ROLES:
        return True
    for name in f"{has.get('class', '')} {has.get('id', '')}".lower().split():
        pieces = set(re.findall(r"[^\W\d_]+", name))
        if pieces and (pieces <= NO_TEXT_WORDS or name in HEADERS and not in_article):
            return True
    return False


def inside(node: Node, test, found: list[Node], in_article: bool = False) -> list[Node]:
    """Topmost nodes that pass a test, none of them within a part that is no text."""
    stack = [iter(node.children)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif isinstance(child, Node) and not says_no_text(child, in_article):
            if test(child):
                found.append(child)
            else:
                stack.append(iter(child.children))
    return found


def main_parts(root: Node) -> tuple[list[Node], bool]:
    """The nodes that hold the article, and whether the page marks them as such.

    A mark that has less text than all that stands outside it marks something else.
    """
    body = inside(root, lambda n: n.tag == "body", []) or [root]
    whole = sum(text_size(n, False) for n in body)
    marks = (
        lambda n: n.tag == "article",
        lambda n: "articlebody" in n.attrs.lower(),
        lambda n: n.tag == "main" or "role=" in n.attrs and attributes(n).get("role") == "main",
    )
    for mark in marks:
        found = inside(root, mark, [])
        if found and 2 * sum(text_size(n, True) for n in found) >= whole:
            return found, True
    return body, False


def text_size(node: Node, in_article: bool) -> int:
    """Characters of the texts below a node that are not in a part without text."""
    total, stack = 0, [node]
    while stack:
        for child in stack.pop().children:
            if isinstance(child, str):
                total += len(child.strip())
            elif not says_no_text(child, in_article):
                stack.append(child)
    return total


def words_of(node: Node) -> Iterator[str]:
    """Texts below a node with a blank at each border of a block; a line break is one too."""
    stack: list = [node]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            yield top
        elif top.tag in INLINE:
            stack.extend(reversed(top.children))
        elif top.tag not in RAW:
            stack.append(" ")
            stack.extend(reversed(top.children))
            yield " "


def joined(node: Node) -> str:
    return " ".join("".join(words_of(node)).split())


def hash_subtrees(root: Node) -> None:
    """Give each node the hash of its tag, texts and children's hashes, from the leaves upwards.

    Numbers in texts are left out: they are dates and counters. Linear in the page, however deep.
    """
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node))
    for node in reversed(order):
        out, words = [node.tag], False
        for child in node.children:
            if isinstance(child, str):
                text = re.sub(r"\d+", "0", " ".join(child.split()))
                words |= bool(text)
                out.append(f"={text}")
            else:
                words |= child.has_words
                out.append(f"<{child.key}")
        value = xxhash.xxh3_64_intdigest("\x00".join(out).encode("utf-8", "replace"))
        node.key = value - (1 << 64) if value >> 63 else value
        node.has_words = words and node.tag not in RAW


def may_be_template(node: Node, parent: Node) -> bool:
    return node.tag in PARTS or (
        parent.tag in BOXES and node.tag not in VOID and node.tag not in BOXES
    )


def page_hashes(page: str) -> set[int]:
    """Hashes of the parts of the main text and its surroundings that may be template."""
    nodes, marked = main_parts(parse(page))
    found, stack = set(), list(nodes)
    while stack:
        top = stack.pop()
        for child in top.children:
            if isinstance(child, Node) and not says_no_text(child, marked):
                if may_be_template(child, top):
                    found.add(child.key)
                stack.append(child)
    return found


def template_children(node: Node, template: frozenset[int], in_article: bool) -> set[int]:
    """Which children of a node, by position, are template.

    What is no part by itself only goes if no text or such child of the page's own is beside it.
    """
    parts, others, own_text = set(), set(), False
    for i, child in enumerate(node.children):
        if isinstance(child, str):
            own_text |= bool(child.strip())
        elif child.tag in VOID or says_no_text(child, in_article):
            continue
        elif may_be_template(child, node):
            if child.key in template:
                (parts if child.tag in PARTS else others).add(i)
            elif child.tag not in PARTS:
                own_text |= child.has_words
    return parts if own_text else parts | others


def main_text(page: str, template: frozenset[int] = frozenset()) -> str:
    """The article's text. A page that would lose all of it to the template keeps it."""
    nodes, marked = main_parts(parse(page))

    def kept(template: frozenset[int]) -> str:
        def pruned(node: Node) -> Node:
            copy = Node(node.tag)
            stack = [(node, copy)]
            while stack:
                old, new = stack.pop()
                gone = template_children(old, template, marked) if template else ()
                for i, child in enumerate(old.children):
                    if isinstance(child, str):
                        new.children.append(child)
                    elif i in gone or says_no_text(child, marked):
                        new.children.append(Node("br"))
                    else:
                        below = Node(child.tag)
                        new.children.append(below)
                        stack.append((child, below))
            return copy

        return " ".join(filter(None, (joined(pruned(n)) for n in nodes)))

    return kept(template) or (kept(frozenset()) if template else "")


def folder_of(url: Column) -> Column:
    """The first folder of a url's path, null if it has none."""
    folder = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*/([^/?#]+)/", 1)
    return F.when(folder != "", folder)


def template_hashes(
    pages: DataFrame,
    min_pages: int = 5,
    share: float = 0.3,
    many: int = 50,
    least_share: float = 0.01,
) -> DataFrame:
    """host, folder, template: hashes of subtrees on many pages of a host, or of a host's folder.

    A page counts a subtree once. Many are a `share` of the pages, at least `min_pages`; but `many`
    pages are enough, or a `least_share` where that is more. The null folder stands for the whole
    host. The arrays are bounded: with k parts on a page, at most k / least_share of them reach
    the bar, and what does not is gone before they are gathered.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, folders, found = [], [], []
            for host, folder, page in zip(
                *(batch.column(i).to_pylist() for i in range(3)), strict=True
            ):
                own = page_hashes(page)
                hosts += [host] * len(own)
                folders += [folder] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(folders, pa.string()), pa.array(found, pa.int64())],
                ["host", "folder", "hash"],
            )

    def bars(keys: list[str]) -> DataFrame:
        n = F.count("*")
        enough = F.least(share * n, F.greatest(F.lit(many), least_share * n))
        return places.groupBy(*keys).agg(F.greatest(F.lit(min_pages), enough).alias("bar"))

    url = F.col("url")
    places = pages.select(host_of(url).alias("host"), folder_of(url).alias("folder"))
    counts = (
        pages.select(host_of(url).alias("host"), folder_of(url).alias("folder"), text_of("html").alias("html"))
        .mapInArrow(hashes, "host string, folder string, hash long")
        .groupBy("host", "folder", "hash")
        .agg(F.count("*").alias("n"))
    )
    counts = saved(counts, "subtrees")  # counted once, by folder and by host
    by_host = (
        counts.groupBy("host", "hash")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= min_pages)
        .join(bars(["host"]), "host")
        .select("host", F.lit(None).cast("string").alias("folder"), "hash", "n", "bar")
    )
    by_folder = (
        counts.where(F.col("folder").isNotNull() & (F.col("n") >= min_pages))
        .join(bars(["host", "folder"]), ["host", "folder"])
        .select("host", "folder", "hash", "n", "bar")
    )
    return (
        by_host.unionByName(by_folder)
        .where("n >= bar")
        .groupBy("host", "folder")
        .agg(F.collect_list("hash").alias("template"))
    )


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), **options) -> DataFrame:
    """The `keep` columns and text, one row per page.

    Null html is empty, and a page without text gives the empty text. A null url, or one without
    ://, has the empty host. White space, no-break blanks included, becomes one blank. Repeated
    rows give the same text, one row each.
    """
    template = saved(template_hashes(pages, **options), "templates")
    whole = template.where("folder IS NULL").select(
        F.col("host").alias("__host"), F.col("template").alias("__whole")
    )
    parts = template.where("folder IS NOT NULL").select(
        F.col("host").alias("__fh"), F.col("folder").alias("__ff"), F.col("template").alias("__part")
    )
    rows = pages.select(
        F.struct(*keep).alias("__row"),
        host_of(F.col("url")).alias("__h"),
        folder_of(F.col("url")).alias("__f"),
        text_of("html").alias("__html"),
    )
    rows = rows.join(whole, F.col("__h") == F.col("__host"), "left").join(
        parts, (F.col("__h") == F.col("__fh")) & (F.col("__f") == F.col("__ff")), "left"
    )
    schema = rows.select("__row").schema.add("text", "string")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                main_text(page, frozenset(whole or ()) | frozenset(part or ()))
                for page, whole, part in zip(
                    *(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string())], ["__row", "text"]
            )

    return rows.select("__row", "__html", "__whole", "__part").mapInArrow(texts, schema).select(
        "__row.*", "text"
    )
