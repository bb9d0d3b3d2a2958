"""HTML pages as columns: a small forgiving tree over the standard parser, behind Arrow-batched functions.

The tree closes an open <p> where a block begins, open <li>, cells and rows where a new one does, and ignores end tags
without a start; other repairs that browsers make aren't attempted.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from contextlib import suppress
from html.parser import HTMLParser
from itertools import islice
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: a start tag -> open tags that it ends
_ENDS = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_ENDS |= {tag: {"p"} for tag in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()}
_SCOPE = frozenset("table ul ol div section article body select dl".split())
_RAW = ("script", "style")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def strings(self, skip: frozenset[str] = frozenset()) -> Iterator[str]:
        stack: list = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                if text := node.strip():
                    yield text
            elif node.tag not in skip:
                stack.extend(reversed(node.children))

    def text(self, between: str = " ", skip: frozenset[str] = frozenset()) -> str:
        return between.join(self.strings(skip))

    def all(self, *tags: str) -> Iterator[Node]:
        return (n for n in self.walk() if n.tag in tags)

    def fits(self, selector: str) -> bool:
        if selector[0] == "#":
            return self.attrs.get("id") == selector[1:]
        return selector[1:] in self.attrs.get("class", "").split() if selector[0] == "." else self.tag == selector


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("document", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in _ENDS.get(tag, ()):
                del self.open[i:]
                break
            if self.open[i].tag in _SCOPE:
                break
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)})
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parsed(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


#: Where titles and contents stand, what is hidden, blocks, file links and phrases of related sections. Fixed values.
TITLE_PLACES = ("h1", "h2", ".title", "#title", ".toanvan-title")
CONTENT_PLACES = ("#toanvancontent", ".toanvancontent", "#ctl00_Content_vanBanChiTiet", ".content", ".vbpq-content", "#content", "main")
HIDDEN = frozenset(("script", "style", "noscript", "iframe"))
BLOCKS = ("p", "li", "td", "th", "h1", "h2", "h3", "h4")
FILE_PARTS = (".pdf", ".doc", ".docx", ".rtf", "/filedata/", "/attachments/")
RELATED_PHRASES = ("van ban lien quan", "van ban huong dan", "van ban sua doi", "van ban duoc can cu", "can cu")


def title_of(root: Node) -> str:
    """The first non-blank of two meta titles, headings and title places; <title> isn't one."""
    for key, value in (("property", "og:title"), ("name", "title")):
        node = next((n for n in root.all("meta") if n.attrs.get(key) == value), None)
        if node and node.attrs.get("content", "").strip():
            return node.attrs["content"].strip()
    return next((t for s in TITLE_PLACES for n in root.walk() if n.fits(s) and (t := n.text())), "")


def blocks_of(root: Node) -> list[str]:
    """Texts of block tags, by kind of tag and then in document order; nested ones repeat; else the whole text."""
    found = [t for tag in BLOCKS for n in root.all(tag) if (t := n.text(skip=HIDDEN))]
    return found or [t for t in [root.text(skip=HIDDEN)] if t]


def content_of(root: Node) -> str:
    """Lines of the first content place, else of the page, without hidden parts, header, footer and navigation."""
    skip = HIDDEN | {"header", "footer", "nav"}
    for place in CONTENT_PLACES:
        for node in _outside(root, skip):
            if node.fits(place):
                return node.text("\n", skip)
    return root.text("\n", skip)


def _outside(root: Node, skip: frozenset[str]) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        if node.tag not in skip:
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))


def _resolved(link: Node, base: str) -> Iterator[str]:
    """Where a link goes, if it goes anywhere."""
    if href := link.attrs.get("href", "").strip():
        with suppress(ValueError):
            yield urljoin(base, href)


def _hrefs(root: Node, base: str) -> Iterator[str]:
    return (url for a in root.all("a") for url in _resolved(a, base))


def links_of(root: Node, base: str, host: str, path: str, needs: str) -> list[str]:
    """Absolute links to hosts with the suffix, with a path of the pattern and the given part, once each, in order."""
    out: dict[str, None] = {}
    for url in _hrefs(root, base):
        u = urlparse(url)
        if (u.hostname or "").endswith(host) and re.search(path, u.path) and needs in url:
            out[url] = None
    return list(out)


def _key(text: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn").replace("Đ", "D").replace("đ", "d")
    return " ".join(re.sub(r"[\s:/\-_,.;]+", " ", plain.lower()).split())


#: Tags whose text may make a section a related one, and tags whose text may be a label with a value. Fixed values.
SECTIONS = frozenset(("div", "section", "table", "ul"))
LABELLED = frozenset(("li", "p", "div", "span"))
#: Longest text that is read as a label with a value, and what a link to a document has. Fixed values.
LABEL_CHARS, DOCUMENT_LINK = 300, "ItemID="

FACTS = "array<struct<kind:string,key:string,value:string>>"


def _facts_of(node: Node, base: str, related: bool) -> Iterator[tuple[str, str, str]]:
    """What one node states by itself: a row's label and value, a text's label and value, or where a link goes."""
    if node.tag == "tr":
        texts = [c.text() for c in islice(node.all("th", "td"), 2)]
        if len(texts) == 2 and all(texts):
            yield "cell", _key(texts[0]), texts[1]
    elif node.tag in LABELLED:
        text = node.text()
        label, value = (x.strip() for x in (text.split(":", 1) if ":" in text and len(text) <= LABEL_CHARS else ("", "")))
        if label and value:
            yield "label", _key(label), value
    elif node.tag == "a":
        for url in _resolved(node, base):
            if any(p in url.lower() for p in FILE_PARTS):
                yield "file", "", url
            if related and DOCUMENT_LINK in url:
                yield "related", "", url


def facts_of(root: Node, base: str) -> Iterator[tuple[str, str, str]]:
    """(kind, key, value) rows of a page in the order of its nodes, from one walk.

    A link is related within a section whose text has one of the phrases. Texts of inner sections are part of those
    around, so the outermost section decides for all within it, and each is read for phrases once.
    """
    todo = [(root, False, False)]
    while todo:
        node, inside, related = todo.pop()
        if node.tag in SECTIONS and not inside:
            plain = _key(node.text())
            inside, related = True, any(p in plain for p in RELATED_PHRASES)
        yield from _facts_of(node, base, related)
        todo.extend((c, inside, related) for c in reversed(node.children) if isinstance(c, Node))


def values(facts: Column, kind: str) -> Column:
    """Distinct values of one kind, in order."""
    return F.array_distinct(F.transform(F.filter(facts, lambda f: f["kind"] == kind), lambda f: f["value"]))


def pairs(facts: Column) -> Column:
    """Facts that are a label and a value: those of table rows, then those of texts."""
    return F.concat(*(F.filter(facts, lambda f: f["kind"] == kind) for kind in ("cell", "label")))


def labelled(facts: Column, *synonyms: str) -> Column:
    """The first value whose label has one of the synonyms, else ""."""
    has = lambda f: F.exists(F.array(*map(F.lit, synonyms)), lambda s: F.contains(f["key"], s))
    return F.coalesce(F.get(F.filter(pairs(facts), has), F.lit(0))["value"], F.lit(""))


def _mapped(kind: str, one: Callable) -> Callable[..., Column]:
    @F.pandas_udf(kind)
    def run(html: pd.Series, base: pd.Series) -> pd.Series:
        return pd.Series([one(parsed(h), b or "") for h, b in zip(html, base)], dtype=object)

    return run


def as_written(html: Column) -> Column:
    """html whose character references without a semicolon (a text cut within one ends so) are read as they are written;
    browsers take some of these for references."""
    return F.regexp_replace(html, r"&(?!#?[A-Za-z0-9]+;)", "&amp;")


def html_title(html: Column) -> Column:
    return _mapped("string", lambda r, _: title_of(r))(html, F.lit(""))


def html_blocks(html: Column) -> Column:
    return _mapped("array<string>", lambda r, _: blocks_of(r))(html, F.lit(""))


def html_content(html: Column) -> Column:
    return _mapped("string", lambda r, _: content_of(r))(html, F.lit(""))


def html_links(html: Column, base: Column, host: str = "", path: str = "", needs: str = "") -> Column:
    return _mapped("array<string>", lambda r, b: links_of(r, b, host, path, needs))(html, base)


def html_facts(html: Column, base: Column) -> Column:
    return _mapped(FACTS, lambda r, b: [dict(zip(("kind", "key", "value"), f)) for f in facts_of(r, b)])(html, base)


def html_file_links(html: Column, base: Column) -> Column:
    return values(html_facts(html, base), "file")


def html_related_links(html: Column, base: Column) -> Column:
    return values(html_facts(html, base), "related")


def by_label(facts: Column, most: int | None = None) -> Column:
    """map<string,array<string>>: label -> its values, or the first `most` of them."""

    def grouped(found: Column) -> Column:
        of = lambda k: F.transform(F.filter(found, lambda f: f["key"] == k), lambda f: f["value"])
        some = lambda k: of(k) if most is None else F.slice(of(k), 1, most)
        return F.map_from_entries(F.transform(F.array_distinct(F.transform(found, lambda f: f["key"])), lambda k: F.struct(k, some(k))))

    return F.get(F.transform(F.array(pairs(facts)), grouped), F.lit(0))


def html_pairs(html: Column) -> Column:
    return by_label(html_facts(html, F.lit("")))


def html_page(html: Column, base: Column) -> Column:
    """struct<title,content,text,facts>, from one parse; text is that of the whole page, content that of its content."""

    @F.pandas_udf(f"title string, content string, text string, facts {FACTS}")
    def run(pages: pd.Series, bases: pd.Series) -> pd.DataFrame:
        rows = []
        for page, url in zip(pages, bases):
            root = parsed(page)
            rows.append((title_of(root), content_of(root), root.text("\n", frozenset(_RAW)), [dict(zip(("kind", "key", "value"), f)) for f in facts_of(root, url or "")]))
        return pd.DataFrame(rows, columns=["title", "content", "text", "facts"])

    return run(html, base)
