"""Pages to their parts: each page is parsed once, in an Arrow UDF that returns a struct."""

from __future__ import annotations

import re
import time
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from palisade import constants as C
from palisade.functions import urls
from palisade.functions.text import clean_text, in_slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "template", "noscript"))
BLOCK = frozenset("p div section article main li ul ol table tr h1 h2 h3 h4 h5 h6 pre blockquote figure br hr".split())


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        """This node and all below, in document order, without recursion."""
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def texts(self):
        stack = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                yield n
            elif n.tag not in RAW:
                stack.extend(reversed(n.children))

    def text(self, glue: str) -> str:
        return glue.join(t for t in (x.strip() for x in self.texts()) if t)


class Tree(HTMLParser):
    """Lenient: an end tag closes up to its start tag if there is one open, void tags never open."""

    def __init__(self, html: str, clock: Clock):
        super().__init__(convert_charrefs=True)
        self.clock = clock
        self.root = self.at = Node("", {}, None)
        self.depth: dict[str, int] = {}
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.clock.tick()
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.depth[tag] = self.depth.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        self.clock.tick()
        if not self.depth.get(tag):
            return
        while self.at.tag != tag:
            self.depth[self.at.tag] -= 1
            self.at = self.at.parent
        self.depth[tag] -= 1
        self.at = self.at.parent

    def handle_data(self, data):
        self.at.children.append(data)


_CHROME = re.compile(C.CHROME_NAMES, re.I)
_ROOT_CLASS, _ROOT_WHOLE = re.compile(C.ROOT_CLASS, re.I), re.compile(C.ROOT_CLASS_WHOLE, re.I)


#: Names of an article's parts besides those of its root.
_CONTENT = re.compile(r"article|body|content|entry|main|post|story|text", re.I)
#: Characters of running text that make a part of a page its article.
MIN_TEXT = 200


def classes(n: Node) -> list[str]:
    return n.attrs["class"].split() if "class" in n.attrs else []


def article_root(root: Node, nodes: list[Node] | None = None) -> Node:
    """article, main, role=main, a class that names an article's content, a content class, else the whole page."""
    tests = (
        lambda n: n.tag == "article",
        lambda n: n.tag == "main",
        lambda n: n.attrs.get("role") == "main",
        lambda n: any(_ROOT_CLASS.search(c) for c in classes(n)),
        lambda n: any(_ROOT_WHOLE.fullmatch(c) for c in classes(n)),
    )
    nodes = list(root.walk()) if nodes is None else nodes
    return next((n for test in tests for n in nodes if test(n)), root)


class Clock:
    """The time that a page may take: `tick` raises TimeoutError once it is over."""

    def __init__(self, budget: float, now=time.monotonic):
        self.now, self.end, self.ticks = now, now() + budget, 0

    def tick(self, every: int = 256) -> None:
        self.ticks += 1
        if self.ticks % every == 0 and self.now() > self.end:
            raise TimeoutError


def class_weight(n: Node) -> int:
    """What a node's names promise: 25 for an article's content, -25 for the like of navigation and comments."""
    if not n.attrs:
        return 0
    names = [*classes(n), n.attrs.get("id", "")]
    good = any(_ROOT_CLASS.search(x) or _ROOT_WHOLE.fullmatch(x) or _CONTENT.search(x) for x in names)
    return 25 * (good - any(_CHROME.search(x) for x in names if x))


def main_content(root: Node, clock: Clock) -> Node | None:
    """The part of a page that reads like an article, as a node of its own; None if no part has MIN_TEXT characters of it.

    Each block of running text scores by its length and commas for the three nodes around it, the nearer the more. What a
    node has is weighed by its names and tag, and by how much of its text isn't links. The best node is joined by those of
    its neighbours that score well themselves or are paragraphs of plain sentences, as articles are often split.
    """
    measured: dict[int, tuple[int, int]] = {}  # characters of text, and of links, below a node
    order = []
    for n in root.walk():
        clock.tick()
        order.append(n)
    for n in reversed(order):  # what is below a node comes after it
        clock.tick()
        own = sum(len(c.strip()) for c in n.children if isinstance(c, str)) if n.tag not in RAW else 0
        some = [measured[id(c)] for c in n.children if isinstance(c, Node)]
        text = own + sum(t for t, _ in some)
        measured[id(n)] = (text, text if n.tag == "a" else sum(x for _, x in some))
    plain = lambda n: 1 - measured[id(n)][1] / max(1, measured[id(n)][0])
    scores: dict[int, float] = {}
    nodes: dict[int, Node] = {}
    for n in order:
        clock.tick()
        block = n.tag in ("p", "pre", "blockquote", "td", "li") or (n.tag in ("div", "section") and not any(isinstance(c, Node) and c.tag in BLOCK for c in n.children))
        length = measured[id(n)][0]
        if not block or length < 25:
            continue
        score = 1 + min(length / 100, 10) + n.text(" ").count(",")
        above = n.parent
        for share in (1.0, 0.5, 1 / 3):
            if above is None or not above.tag or above.tag in ("html", "body") and share < 1:
                break
            if id(above) not in scores:
                scores[id(above)] = class_weight(above) + (5 if above.tag in ("div", "section") else -3 if above.tag in ("ul", "ol", "form", "table") else 0)
                nodes[id(above)] = above
            scores[id(above)] += share * score
            above = above.parent
    final = {k: v * plain(nodes[k]) for k, v in scores.items()}
    if not final:
        return None
    best = nodes[max(final, key=final.__getitem__)]
    least, kept = max(10.0, 0.2 * final[id(best)]), []
    for n in best.parent.children if best.parent is not None else [best]:
        clock.tick()
        if not isinstance(n, Node):
            continue
        text, _ = measured[id(n)]
        alike = 0.2 * final[id(best)] if best.attrs.get("class") and n.attrs.get("class") == best.attrs["class"] else 0
        sentence = n.tag in ("p", "pre", "blockquote") and ((text > 80 and plain(n) > 0.75) or (plain(n) == 1 and re.search(r"\.(?:\s|$)", n.text(" "))))
        if n is best or final.get(id(n), 0) + alike >= least or sentence or (n.tag in ("h1", "h2") and plain(n) > 0.75 and text):
            kept.append(n)
    if sum(measured[id(n)][0] - measured[id(n)][1] for n in kept) < MIN_TEXT:
        return None
    out = Node("div", {}, None)
    out.children = kept
    return out


def without_chrome(root: Node) -> Node:
    """Takes navigation, sharing, related links and the like out, below the root itself."""
    for n in list(root.walk()):
        named = n.attrs and (any(_CHROME.search(c) for c in classes(n)) or _CHROME.search(n.attrs.get("id", "")))
        if n is not root and (n.tag in C.CHROME_TAGS or named):
            n.parent.children.remove(n)
    return root


def parts(html: str | None, budget: float = C.READ_BUDGET) -> dict:
    """A page's parts. A page that takes more than `budget` seconds is given as its bare text, without parts."""
    try:
        return _parts(html or "", Clock(budget))
    except TimeoutError:
        bare = re.sub(r"(?is)<(script|style|template|noscript)\b.*?</\1\s*>|<[^>]*>", "\n", html)
        body = "\n".join(t for t in map(str.strip, unescape(bare).splitlines()) if t)
        return dict.fromkeys(_FIELDS) | {"feeds": [], "links": [], "images": [], "body": body, "code": "", "tables": ""}


def _parts(html: str, clock: Clock) -> dict:
    tree = Tree(html, clock).root
    nodes = list(tree.walk())
    first = lambda test: next((n for n in nodes if test(n)), None)
    links = [{"href": n.attrs["href"], "text": n.text(" ")} for n in nodes if n.tag == "a" and n.attrs.get("href")]
    other = [n.attrs for n in nodes if n.tag == "link" and "alternate" in n.attrs.get("rel", "").lower().split() and n.attrs.get("href")]
    feeds = sorted({a["href"] for a in other if re.search("rss|atom|xml", a.get("type", "").lower())})
    time = first(lambda n: n.tag == "time" and n.attrs.get("datetime"))
    meta = first(lambda n: n.tag == "meta" and n.attrs.get("name") == "date") or first(lambda n: n.tag == "meta" and n.attrs.get("property") == "article:published_time")
    base = first(lambda n: n.tag == "base" and n.attrs.get("href"))
    title = first(lambda n: n.tag == "title")
    found = article_root(tree, nodes)
    root = without_chrome(found)
    if found is tree:  # nothing says where the article is: where most of its text stands, else the whole page
        root = main_content(tree, clock) or tree
    code, tables, images = [], [], []
    for n in root.walk():
        if n.tag in ("pre", "code", "kbd", "samp") and len(t := n.text("\n")) >= 3:
            code.append(t)
        elif n.tag == "tr" and any(cells := [c.text(" ") for c in n.walk() if c.tag in ("th", "td")]):
            tables.append("\t".join(cells))
        elif n.tag == "img" and (src := next((n.attrs[a] for a in C.IMAGE_SOURCES if n.attrs.get(a)), None)):
            images.append(src)
    return {
        "title": title.text(" ") if title else None, "base": base.attrs["href"] if base else None, "time_tag": time.attrs["datetime"] if time else None,
        "meta_date": meta.attrs.get("content") if meta else None, "feeds": feeds, "links": links, "body": root.text("\n"),
        "code": "\n".join(code), "tables": "\n".join(tables), "images": list(dict.fromkeys(images)),
    }


_TEXT, _TEXTS = T.StringType(), T.ArrayType(T.StringType())
_LINKS = T.ArrayType(T.StructType([T.StructField("href", _TEXT), T.StructField("text", _TEXT)]))
_FIELDS = ("title", "base", "time_tag", "meta_date", "feeds", "links", "body", "code", "tables", "images")
PARTS = T.StructType([T.StructField(k, {"feeds": _TEXTS, "images": _TEXTS, "links": _LINKS}.get(k, _TEXT)) for k in _FIELDS])


@F.arrow_udf(PARTS)
def page_parts(html: pa.Array) -> pa.Array:
    """Parts of each page; a batch is read some pages at a time, as their trees take many times their text."""
    return in_slices(html, lambda some: [parts(h) for h in some], to_arrow_type(PARTS))


def rich_text(p: Column) -> Column:
    """Body, code and tables in one labelled text."""
    out = F.concat_ws("\n\n", F.lit("=== ARTICLE BODY ==="), clean_text(p["body"]), F.lit("=== CODE BLOCKS ==="), p["code"], F.lit("=== TABLES ==="), p["tables"])
    return F.regexp_replace(out, r"^\s+|\s+$", "")


def article_images(pages: DataFrame, url: str = "url", p: str = "parts") -> DataFrame:
    """(url, idx, image_url): the article's images, absolute, http only, in order, each once."""
    absolute = F.transform(F.col(p)["images"], lambda i: urls.resolve(F.coalesce(F.col(p)["base"], F.col(url)), i))
    kept = F.array_distinct(F.filter(absolute, lambda i: F.startswith(i, F.lit("http"))))
    return pages.select(url, F.posexplode(kept).alias("idx", "image_url"))


def image_texts(images: DataFrame, read: DataFrame, url: str = "url") -> DataFrame:
    """(url, image_text): texts of each article's images in order; `read` has image_url and text, one row an image."""
    found = images.join(read.where("text <> ''").select("image_url", "text"), "image_url")
    entry = F.format_string("=== Image %d: %s ===\n%s", F.col("idx") + 1, "image_url", "text")
    return found.groupBy(url).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", entry.alias("e")))), lambda x: x["e"]), "\n\n").alias("image_text"))
