"""Main text of web pages by site template removal.

Every page is parsed into its element tree. Every block subtree with text is hashed (tag, class, id, text of the
whole subtree); Spark counts the pages of each host that have a hash, and hashes on many pages of a host are its
template. Extraction deletes template subtrees and takes the blocks of what is left of the article.

What cannot recur on a host (one page, changing adverts) goes by its kind: elements that never hold main text and
classes, ids or roles that name menus, adverts, comments and the like. A class token counts as a whole: ``with-sidebar`` or ``nav-open`` name
no menu, and words that can also name main text (notice, form, related) are left to the host's counts. No name drops an element that holds
most of the page's text besides template, or the only article or main element. Within an article, text elements (paragraphs,
headings, list items, quotes, tables) stay even when they recur: a passage that a site repeats in its articles is
main text.

The counts of a host that passes ``min_pages`` are bounded: at most (subtrees per page) / ``min_share`` hashes can be on a share
``min_share`` of its pages. The template table is written first, so Catalyst broadcasts it only where its size allows
and otherwise joins by host with skew splitting.

Defined results: null html = empty text; a null or hostless url has no template; repeated rows are extracted each (and
count as pages each); a page cut off in a tag, comment or reference keeps the text before it. Only ``page_id``,
``url`` and ``html`` are read.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .store import written

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody tfoot thead tr ul".split())
TEXT_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr figure figcaption".split())
NEVER_MAIN = frozenset("head script style title noscript template iframe noembed noframes svg math canvas audio video object nav footer aside form fieldset menu "
                       "button select textarea option dialog search".split())
ENDS_P = BLOCK - {"option", "html", "body"}
# Words in a class, id or role that name what is not main text; those among them that can also name main text and
# decide nothing alone; words that may stand beside them in one token.
OTHER_WORDS = frozenset("ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
                        "notification alert popup modal overlay newsletter subscribe subscription signup paywall sidebar sidenav aside complementary menu menubar nav "
                        "navbar navigation breadcrumb breadcrumbs footer contentinfo masthead comment comments commentlist disqus respond replies reply share sharing social "
                        "related recommended recommendations widget toolbar pager pagination login search skip dialog form".split())
UNSURE_WORDS = frozenset("notice notices notification alert form related recommended recommendations search share sharing social dialog widget skip aside promotion banner "
                         "reply replies respond menu login subscription consent overlay".split())
PLACE_WORDS = frozenset("site page main post posts list box bar container wrapper block section area buttons links left right top bottom slot unit item items".split())
HEADER_WORDS = frozenset({"header", "topbar"})
SURE_WORDS, BESIDE_OTHER, BESIDE_HEADER = OTHER_WORDS - UNSURE_WORDS, OTHER_WORDS | PLACE_WORDS, HEADER_WORDS | PLACE_WORDS
NEVER_OTHER = frozenset({"html", "body", "main"})

_MARKUP = re.compile(r"<(?:!--(.*?)(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(>|\Z)|[!?/][^>]*(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Node:
    __slots__ = ("tag", "attributes", "children", "parent")

    def __init__(self, tag: str, attributes: dict, parent: "Node | None"):
        self.tag, self.attributes, self.parent, self.children = tag, attributes, parent, []


def parse(page: str) -> Node:
    """The element tree; text stands in ``children`` as str, with references decoded."""
    root = node = Node("#root", {}, None)
    at, size = 0, len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        if m is None:
            node.children.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            node.children.append(html.unescape(page[at:m.start()]))
        at = m.end()
        if m[3] is None:
            continue  # comment, doctype, processing instruction
        tag = m[3].lower()
        if m[5] != ">":
            break  # cut off inside a tag
        if m[2]:
            up = node
            while up.parent is not None and up.tag != tag:
                if tag not in BLOCK and up.tag in BLOCK:
                    up = root  # an inline end tag closes nothing across a block
                    break
                up = up.parent
            if up.parent is not None:
                node = up.parent
            continue
        node = _close_implied(node, tag)
        attributes = {a[0].lower(): html.unescape(a[1] or a[2] or a[3]) for a in _ATTRIBUTE.findall(m[4])} if m[4] and not m[4].isspace() else {}
        child = Node(tag, attributes, node)
        node.children.append(child)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            stop = end.start() if end else size
            if tag not in NEVER_MAIN:
                child.children.append(page[at:stop])
            at = end.end() if end else size
        elif tag not in VOID:
            node = child
    return root


def _close_implied(node: Node, tag: str) -> Node:
    """Where a start tag goes once the elements that it ends are closed."""
    own = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}.get(tag)
    stops = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}.get(tag, set())
    up, found = node, None
    while up.parent is not None:
        if own and up.tag in own:
            found = up
        if up.tag in stops:
            break
        if tag in ENDS_P and up.tag == "p":
            found = up
        if up.tag in BLOCK and up.tag != "p" and not (own and up.tag in own) and up.tag not in ("tr",) and not own:
            break
        up = up.parent
    return found.parent if found is not None else node


def _tokens(node: Node) -> list[set[str]]:
    """The words of every class, id and role token."""
    a = node.attributes
    said = " ".join(a[k] for k in ("class", "id", "role") if a.get(k))
    return [words for token in said.split() if (words := {w.lower() for w in _WORD.findall(token)})]


def _named(tokens: list[set[str]], sure: frozenset, others: frozenset) -> bool:
    """Whether a whole token is made of such words, a sure one among them."""
    return any(t & sure and t <= others for t in tokens)


def is_named_other(node: Node, in_article: bool) -> bool:
    """Whether an element's class, id or role says that it is not main text."""
    if not node.attributes or node.tag in NEVER_OTHER:
        return False
    tokens = _tokens(node)
    if node.tag == "article" and not in_article:
        return any(t <= {"comment", "comments", "reply"} for t in tokens)
    return (_named(tokens, SURE_WORDS, BESIDE_OTHER)
            or (not in_article and _named(tokens, HEADER_WORDS, BESIDE_HEADER)))


class _Any(frozenset):
    def __contains__(self, item) -> bool:
        return True


ANY = _Any()  # holds every element


def is_other(node: Node, in_article: bool, held: frozenset | set = frozenset()) -> bool:
    """Whether an element's kind says that it is not main text; no name says so of the elements in ``held``."""
    tag, a = node.tag, node.attributes
    if tag in NEVER_MAIN:
        return True
    if tag in NEVER_OTHER:
        return False
    if tag == "header" and not in_article:
        return True
    if not a:
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", a.get("style", "")):
        return True
    return id(node) not in held and is_named_other(node, in_article)


def _squeeze(text: str) -> str:
    return " ".join(text.split())


def subtree_hashes(root: Node) -> dict[int, int]:
    """id(node) -> 64-bit hash of every block element's subtree that has text."""
    hashes: dict[int, int] = {}
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack.extend(c for c in n.children if isinstance(c, Node))
    digest: dict[int, tuple[bytes, bool]] = {}
    for n in reversed(order):
        h = hashlib.blake2b(f"<{n.tag}|{n.attributes.get('class', '')}|{n.attributes.get('id', '')}>".encode("utf-8", "replace"), digest_size=8)
        some = False
        for c in n.children:
            if isinstance(c, Node):
                sub, has = digest.pop(id(c))
                some |= has
                h.update(b"<" + sub)
            elif text := _squeeze(c):
                some = True
                h.update(b"\x00" + text.encode("utf-8", "replace"))
        value = h.digest()
        digest[id(n)] = (value, some)
        if some and n.tag in BLOCK and n.tag not in NEVER_OTHER:
            hashes[id(n)] = int.from_bytes(value, "little", signed=True)
    return hashes


def _is_top(node: Node) -> bool:
    return node.tag in ("article", "main") or node.attributes.get("role") == "main"


def _held(root: Node, hashes: dict[int, int], template: frozenset) -> set[int]:
    """Elements that no name may drop: they hold most of the page's text besides template, or its only articles and main elements."""
    order: list[Node] = []
    stack: list[Node] = [root]
    while stack:
        n = stack.pop()
        if n is not root and (is_other(n, True, ANY) or hashes.get(id(n)) in template):
            continue
        order.append(n)
        stack.extend(c for c in n.children if isinstance(c, Node))
    size: dict[int, int] = {}
    tops: dict[int, bool] = {}
    for n in reversed(order):
        nodes = [c for c in n.children if isinstance(c, Node)]
        size[id(n)] = sum(size.get(id(c), 0) for c in nodes) + sum(len(_squeeze(c)) for c in n.children if isinstance(c, str))
        tops[id(n)] = (_is_top(n) and not is_named_other(n, False)) or any(tops.get(id(c)) for c in nodes)
    free, stack = False, [root]  # is there one outside of what names drop?
    while stack and not free:
        n = stack.pop()
        if id(n) in size and not (n is not root and is_named_other(n, False)):
            free = _is_top(n)
            stack.extend(c for c in n.children if isinstance(c, Node))
    return {id(n) for n in order if 2 * size[id(n)] > size[id(root)] or (tops[id(n)] and not free)}


def _articles(root: Node, held: set[int]) -> list[Node]:
    """The outermost articles; else the main elements; else the whole page."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        n, inside = stack.pop()
        if n.tag != "#root" and is_other(n, False, held):
            continue
        kind = "article" if n.tag == "article" else "main" if n.tag == "main" or n.attributes.get("role") == "main" else None
        if kind and not (kind == "article" and inside):
            found[kind].append(n)
        stack.extend((c, inside or kind == "article") for c in reversed(n.children) if isinstance(c, Node))
    return found["article"] or found["main"]


def main_text(page: str | None, template: frozenset = frozenset()) -> str:
    """The article's blocks, one line each."""
    if not page:
        return ""
    root = parse(page)
    hashes = subtree_hashes(root) if template else {}
    held = _held(root, hashes, template)
    articles = _articles(root, held)
    blocks: list[str] = []
    run: list[str] = []

    def flush():
        if text := _squeeze("".join(run)):
            blocks.append(text)
        run.clear()

    for top in articles or [root]:
        stack: list = [top]
        while stack:
            n = stack.pop()
            if n is None:
                flush()
            elif isinstance(n, str):
                run.append(n)
            elif n.tag in ("br", "td", "th", "wbr"):
                if n.tag != "wbr":
                    run.append(" ")
                stack.extend(reversed(n.children))
            elif n is not top and is_other(n, bool(articles), held):
                run.append(" ")
            elif n is not top and hashes.get(id(n)) in template and not (articles and n.tag in TEXT_BLOCK):
                continue
            elif n.tag in BLOCK or n is top:
                flush()
                stack.append(None)
                stack.extend(reversed(n.children))
            else:
                stack.extend(reversed(n.children))
        flush()
    return "\n".join(blocks)


@dataclass(frozen=True)
class TemplateParams:
    min_pages: int = 5        # a template subtree is on so many pages of its host at least
    min_share: float = 0.2    # and on this share of them


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in tv.slices(batches, "html", 4 << 20):
        hosts, found = [], []
        for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
            own = set(subtree_hashes(parse(page)).values()) if page and host else set()
            hosts.extend([host] * (len(own) + 1))
            found.extend([None, *own])  # the null row counts the page
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(found, pa.int64())], ["host", "h"])


def site_templates(pages: DataFrame, params: TemplateParams = TemplateParams()) -> DataFrame:
    """(host, template): the hashes of subtrees that recur on many of a host's pages."""
    seen = pages.select("host", "html").mapInArrow(_hash_batches, "host string, h long")
    counts = written(seen.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") >= params.min_pages) | F.col("h").isNull()), "html_counts")
    sizes = counts.filter("h is null").select("host", F.col("n").alias("pages"))
    often = counts.filter("h is not null").join(sizes, "host").filter(F.col("n") >= params.min_share * F.col("pages"))
    return written(often.groupBy("host").agg(F.sort_array(F.collect_set("h")).alias("template")), "html_templates")


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets: dict[str, frozenset] = {}
    for part in tv.slices(batches, "html", 4 << 20):
        texts = []
        templates = part.column("template")
        for i, (host, page) in enumerate(zip(part.column("host").to_pylist(), part.column("html").to_pylist())):
            if host not in sets:
                if len(sets) > 1000:
                    sets.clear()
                sets[host] = frozenset(templates[i].as_py() or ())
            texts.append(main_text(page, sets[host]))
        yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], dtype=np.int64))],
                                         ["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame, params: TemplateParams = TemplateParams()) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"),
                       _host(F.col("url")).alias("host"))
    return (src.join(site_templates(src, params), "host", "left")
            .mapInArrow(_extract_batches, "page_id long, url string, text string, n_chars long"))
