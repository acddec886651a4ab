"""HTML extraction: main text of a page, with site templates found per host.

Two passes over the pages.  The first parses a page, hashes every element subtree
bottom-up (tag and text, attributes left out) and Spark counts the hashes per
host; a subtree on many different pages of its host is template.  The second
parses again, deletes template subtrees and page furniture (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, reader comments, by
element, role and class), and joins the remaining blocks.

"Many" is at least ``min_pages`` and ``min_share`` of the host's pages, where pages
whose main content is the same count once (copies of an article are no template).
So a host has at most nodes-per-page / ``min_share`` templates: its set is small
whatever the host's size.  That a text recurs does not make it a template inside an
``article`` or ``main``: there it must also stand in the same place (counted from the
first or from the last element) on nearly all pages of the host that mark their main
content (``article_share``) and have ``min_words`` words; if templates make up more than
half of the article it is a near copy and none is deleted.

Main content: the live ``article`` elements where they hold the bulk of the live text.
``main`` is taken instead if a tenth of its and their words, or ``MAIN_WORDS`` words, are
outside them; without ``main``, the body is if a third of the words outside links are.

Names: outside the marked content one telling word in a class or id makes furniture; on pages without any,
only whole tokens that name a site's own parts do (``CLEAR_UNMARKED``).
Inside it only whole class tokens and ids that mean nothing else do (``CLEAR_NAME``; of adverts on any
element); elements with a telling word are counted there like subtrees outside.
A recurring subtree of fewer than ``min_words`` words goes only if it has a telling name.
Headings are never furniture by name, sections not by a word of their id (often the slug
of a title).

Text: character references decoded, white space inside a block turned into one
space, blocks trimmed and joined in page order by one line end.

Defined cases: null or empty html gives the empty text; markup that never closes is
closed at the end of the page; a page without ``article`` or ``main``, or
with empty ones, is taken from its body; null and malformed urls share the empty host; repeated rows get
equal answers; extra columns pass through, input columns named like an output
column are replaced.

Scale: hashes are counted with map-side aggregation, so a host with a third of all
pages is no hot key; the template table is staged, so the planner knows its size
when it joins it to the pages by host (broadcast only below Spark's threshold).
"""

from __future__ import annotations

import html as htmllib
import re
import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import over, prepared, sliced, staged

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>", re.S)
_SLOT = struct.Struct("<QQB")
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody tfoot thead tr ul".split())
FURNITURE = frozenset(
    "head script style noscript template title nav footer aside form button select textarea input fieldset iframe "
    "object embed canvas svg annotation annotation-xml audio video menu dialog noembed noframes xmp search datalist".split())
FURNITURE_ROLE = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar "
                           "toolbar tablist status log".split())
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
FURNITURE_NAME = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs footer sidebar aside widget widgets ad ads adv advert adverts "
    "advertisement advertising adsense adslot banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices "
    "notification alert newsletter subscribe subscription signup signin login popup modal overlay paywall share sharing "
    "social related recommended recommendations trending comment comments commentlist reply replies respond disqus "
    "discussion pagination pager toolbar masthead skip copyright disclaimer search form".split())
#: Whole class tokens and ids that are furniture inside an article too.
CLEAR_NAME = frozenset(
    "ad ads ad-slot adslot ad-container ad-wrapper ad-unit ad-banner adsbygoogle advert adverts advertisement share-buttons share-bar "
    "share-links sharing-buttons sharedaddy addtoany social-share social-buttons social-links comment comments comment-list commentlist "
    "comments-area comments-section comment-section comment-respond comment-form disqus_thread cookie-notice cookie-banner "
    "cookie-consent newsletter-signup newsletter-form subscribe-box signup-form login-form search-form breadcrumb breadcrumbs "
    "pagination navbar sidebar post-navigation related-posts related-articles related-stories recommended-articles skip-link".split())
#: More of them outside, where ids of sections and wrappers of every article are concerned.
CLEAR_OUTSIDE = CLEAR_NAME | frozenset("nav navigation menu footer masthead topbar related recommended trending".split())
#: What stands for a site's own parts where nothing is marked as main content.
CLEAR_UNMARKED = CLEAR_OUTSIDE | frozenset("header site-header page-header site-footer page-footer site-nav main-nav main-menu".split())
#: Names of adverts, which make any element furniture; code is highlighted by names like ``comment``.
ADVERT_NAME = frozenset("ad ads ad-slot adslot ad-container ad-wrapper ad-unit ad-banner adsbygoogle advert adverts advertisement".split())
ARTICLE_NAME = frozenset("comment comments reply ad ads advert promo sponsored related".split())
CONTAINER = frozenset("div section ul ol dl li ins".split())
OTHER_BLOCK = frozenset("p table details figure blockquote center".split())
MAIN_WORDS = 40
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
HEADER_NAME = frozenset("header masthead topbar".split())
#: Names of wrappers round the whole page, such as "page with-sidebar": no furniture if an article is inside.
WRAPPER_NAME = frozenset("layout page wrapper wrap container content has with no site main body".split())
_CLOSES_P = BLOCK - {"body", "html", "option", "optgroup", "caption", "tbody", "thead", "tfoot", "tr", "legend"}
_SIBLING = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
            "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr")),
            "option": ("option", ("select", "datalist")), "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
            "thead": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",))}


class Page:
    """A parsed page as parallel lists, elements in document order (parents before children)."""

    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self) -> None:
        self.tag, self.attrs, self.parent = ["#page"], [""], [-1]
        self.children: list[list] = [[]]  # of each element: int elements and str texts, in order


def parse(source: str) -> Page:
    page = Page()
    tag_of, parent_of, children_of = page.tag, page.parent, page.children
    open_: list[int] = [0]

    def close_to(names, stops) -> None:
        for depth in range(len(open_) - 1, 0, -1):
            name = tag_of[open_[depth]]
            if name in names:
                del open_[depth:]
                return
            if name in stops:
                return

    def text(piece: str) -> None:
        if piece:
            children_of[open_[-1]].append(htmllib.unescape(piece) if "&" in piece else piece)

    at, size = 0, len(source)
    while at < size:
        found = _TOKEN.search(source, at)
        if not found:
            text(source[at:])
            break
        text(source[at:found.start()])
        at = found.end()
        if found["cdata"] is not None:
            children_of[open_[-1]].append(found["cdata"])
            continue
        name = found["tag"] or found["tag2"]
        if not name:
            continue
        name = name.lower()
        if found["end"] or found["end2"]:
            if name == "br":
                children_of[open_[-1]].append(" ")
            elif name not in VOID:
                close_to((name,), ("#page",) if name in ("body", "html", "article", "main", "table") else ("article", "main", "table", "td", "th") if name not in BLOCK else ("table",) if name not in ("tr", "tbody", "thead", "tfoot", "caption") else ("#page",))
            continue
        if name == "br" or name == "wbr":
            if name == "br":
                children_of[open_[-1]].append(" ")
            continue
        if name in _CLOSES_P:
            close_to(("p",), ("article", "button", "td", "th", "table", "div", "section", "li"))
        if name in _SIBLING:
            names, stops = _SIBLING[name]
            names = (names,) if isinstance(names, str) else names
            for _ in names:
                before = len(open_)
                close_to(names, stops)
                if len(open_) == before:
                    break
        new = len(tag_of)
        tag_of.append(name)
        page.attrs.append(found["attrs"] or found["attrs2"] or "")
        parent_of.append(open_[-1])
        children_of.append([])
        children_of[open_[-1]].append(new)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>?", re.I).search(source, at)
            inner = source[at:end.start() if end else size]
            if name == "title":
                children_of[new].append(inner)
            at = end.end() if end else size
        elif name not in VOID:
            open_.append(new)
    return page


def subtree_hashes(page: Page) -> list[int]:
    """A hash of every element's subtree: tags, order and collapsed text."""
    hashes = [0] * len(page.tag)
    for i in range(len(page.tag) - 1, -1, -1):
        parts = [page.tag[i].encode()]
        for child in page.children[i]:
            if isinstance(child, int):
                parts.append(hashes[child].to_bytes(8, "little"))
            elif words := child.split():
                parts.append(" ".join(words).encode("utf-8", "surrogatepass"))
        hashes[i] = xxhash.xxh3_64_intdigest(b"\0".join(parts)) & ~1
    return hashes


def slot_hashes(page: Page, hashes: list[int], inside: list[bool]) -> list[tuple[int, ...]]:
    """Of every element below an ``article`` or ``main``: its subtree with its place there, counted from the
    first and from the last element.  Odd numbers; those of subtrees alone are even."""
    size = len(page.tag)
    slots: list[tuple[int, ...]] = [()] * size
    first, last = [0] * size, [0] * size
    for i in range(size):
        if not inside[i]:
            continue
        below = [c for c in page.children[i] if isinstance(c, int)]
        top = page.tag[i] in ("article", "main")
        for k, c in enumerate(below):
            first[c] = ((0 if top else first[i]) * 0x9E3779B97F4A7C15 + k + 1) & 0xFFFFFFFFFFFFFFFF
            last[c] = ((0 if top else last[i]) * 0x9E3779B97F4A7C15 + len(below) - k) & 0xFFFFFFFFFFFFFFFF
            slots[c] = tuple(xxhash.xxh3_64_intdigest(_SLOT.pack(hashes[c], at, side)) | 1
                             for side, at in enumerate((first[c], last[c])))
    return slots


def _is_furniture(tag: str, attrs: str, in_main: bool, holds_main: bool, holds_all: bool, unmarked: bool) -> bool:
    if tag in FURNITURE and not (holds_main and tag in ("form", "fieldset")) or tag == "header" and not (in_main or holds_main):
        return True
    if not attrs or tag in ("html", "body"):
        return False
    attributes = [(name.lower(), value.strip("\"'")) for name, value in _ATTR.findall(attrs)]
    for name, value in attributes:
        if name == "role":
            if value.lower() in FURNITURE_ROLE:
                return True
        elif name in ("class", "id"):
            if tag in HEADINGS or tag == "main":
                continue
            tokens = set(value.lower().split())
            if tag == "article":
                if tokens & ARTICLE_NAME if name == "class" else re.fullmatch(r"comment-\d+", value, re.I):
                    return True
            elif in_main:
                clear = CLEAR_NAME if tag in CONTAINER else CLEAR_NAME - {"comment"} if tag in OTHER_BLOCK else ADVERT_NAME
                if tokens & clear and (name == "class" or not _is_section(tag, attributes)):
                    return True
            elif unmarked:
                if tokens & CLEAR_UNMARKED and (name == "class" or not _is_section(tag, attributes) or tokens & CLEAR_OUTSIDE):
                    return True
            elif name == "id" and _is_section(tag, attributes) or holds_all:
                if tokens & CLEAR_OUTSIDE and not (holds_main and _words(value) & WRAPPER_NAME):
                    return True
            elif (words := _words(value)) & (FURNITURE_NAME | HEADER_NAME) and not (holds_main and words & WRAPPER_NAME):
                return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def _words(name: str) -> set[str]:
    return {w.lower() for w in _WORDS.findall(name)}


def _is_section(tag: str, attributes: list[tuple[str, str]]) -> bool:
    return tag == "section" or any(name == "class" and "section" in value.lower().split() for name, value in attributes)


def _is_named(tag: str, attrs: str) -> bool:
    """Named by a word that may mean furniture."""
    if not attrs or tag in HEADINGS or tag in ("article", "main"):
        return False
    attributes = [(name.lower(), value.strip("\"'")) for name, value in _ATTR.findall(attrs)]
    return any((name == "class" or name == "id" and not _is_section(tag, attributes)) and _words(value) & FURNITURE_NAME
               for name, value in attributes)


def _is_core(tag: str, attrs: str) -> bool:
    """Marked as main content."""
    return tag in ("article", "main") or "main" in attrs and any(
        n.lower() == "role" and v.strip("\"'").lower() == "main" for n, v in _ATTR.findall(attrs))


def _outermost(page: Page, marked: list[int]) -> list[int]:
    known, out = set(marked), []
    for i in marked:
        up = page.parent[i]
        while up > 0 and up not in known:
            up = page.parent[up]
        if up <= 0:
            out.append(i)
    return out


def _chosen(page: Page, dead: list[bool], articles: list[int], mains: list[int], body: list[int]) -> list[int]:
    """The elements that hold the live text, in document order."""
    if not (articles or mains):
        return body
    size = len(page.tag)
    words, prose = [0] * size, [0] * size  # live words of a subtree; those outside links
    for i in range(size - 1, -1, -1):
        if not dead[i]:
            own = sum(len(c.split()) for c in page.children[i] if isinstance(c, str))
            words[i] += own
            prose[i] = 0 if page.tag[i] == "a" else prose[i] + own
            if i:
                words[page.parent[i]] += words[i]
                prose[page.parent[i]] += prose[i]
    articles, mains = [i for i in articles if words[i]], [i for i in mains if words[i]]
    if not articles or not mains:
        if articles:
            told = sum(prose[i] for i in _outermost(page, articles))
            whole = sum(prose[i] for i in body)
            return body if 3 * (whole - told) >= whole > told else articles
        return mains or body
    tops, in_main = set(_outermost(page, articles)), set(_outermost(page, mains + articles)) & set(mains)
    inner = {i for i in tops if any(up in in_main for up in _ancestors(page, i))}
    held = sum(words[i] for i in in_main)
    told = sum(words[i] for i in tops)
    outside = held - sum(words[i] for i in inner)
    if outside < MAIN_WORDS and 10 * outside < outside + told:
        return articles
    apart = tops - inner
    return sorted(in_main | apart) if sum(words[i] for i in apart) > held else sorted(in_main)


def _ancestors(page: Page, i: int):
    while (i := page.parent[i]) > 0:
        yield i


def layout(page: Page) -> tuple[list[bool], list[int], list[bool], list[bool]]:
    """Per element whether it is (in) furniture; the roots of the main content; per element whether it is (in)
    marked main content, and whether it holds some."""
    dead, inside = [False] * len(page.tag), [False] * len(page.tag)
    articles, mains, bodies = [], [], []
    cores = [0] * len(page.tag)  # below an element
    for i in range(len(page.tag) - 1, 0, -1):
        cores[page.parent[i]] += cores[i] + _is_core(page.tag[i], page.attrs[i])
    holds = [n > 0 for n in cores]
    for i in range(1, len(page.tag)):
        tag, up = page.tag[i], page.parent[i]
        inside[i] = inside[up] or _is_core(tag, page.attrs[i])
        dead[i] = dead[up] or _is_furniture(tag, page.attrs[i], inside[up], holds[i], 0 < cores[i] == cores[0], not cores[0])
        if not dead[i]:
            if tag == "article":
                articles.append(i)
            elif _is_core(tag, page.attrs[i]):
                mains.append(i)
            elif tag == "body":
                bodies.append(i)
    chosen = _chosen(page, dead, articles, mains, bodies[:1] or [0])
    tops = set(_outermost(page, chosen))
    roots = [i for i in chosen if i in tops]
    return dead, roots, inside, holds


def _blocks(page: Page, roots: list[int], skip: list[bool]) -> list[str]:
    blocks: list[str] = []
    piece: list[str] = []

    def flush() -> None:
        if piece:
            if words := "".join(piece).split():
                blocks.append(" ".join(words))
            piece.clear()

    for root in roots:
        flush()
        stack: list = [root]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                piece.append(node)
            elif node < 0:
                flush()
            elif not skip[node]:
                block = page.tag[node] in BLOCK
                if block:
                    flush()
                    stack.append(~node)
                elif page.tag[node] in ("td", "th"):
                    piece.append(" ")
                stack.extend(reversed(page.children[node]))
        flush()
    return blocks


def main_text(page: Page, hashes: list[int], template: set[int], min_words: int) -> str:
    dead, roots, inside, holds = layout(page)
    plain = _blocks(page, roots, dead)
    if template:
        slots = slot_hashes(page, hashes, inside)
        skip = list(dead)
        tops = set(roots)
        for i in range(1, len(page.tag)):
            if page.parent[i] >= 0 and skip[page.parent[i]]:
                skip[i] = True
            elif i not in tops:
                alone = hashes[i] in template and not holds[i] and not _is_top(page, inside, i) and (
                    not inside[i] or _is_named(page.tag[i], page.attrs[i]))
                if alone or any(s in template for s in slots[i]):
                    words = sum(len(b.split()) for b in _blocks(page, [i], dead))
                    # a word or two that recur are no template unless their element is named like one
                    skip[i] = words >= (1 if alone and _is_named(page.tag[i], page.attrs[i]) else min_words)
        size = lambda of, without: sum(map(len, _blocks(page, of, without)))
        marked = roots if inside[roots[0]] else [i for i in range(1, len(page.tag)) if _is_top(page, inside, i) and not dead[i]]
        if size(marked, skip) <= 0.5 * size(marked, dead):
            skip = [dead[i] if inside[i] else skip[i] for i in range(len(skip))]
        kept = _blocks(page, roots, skip)
        if sum(map(len, kept)) > 0.1 * sum(map(len, plain)):
            plain = kept
    return "\n".join(plain)


def _is_top(page: Page, inside: list[bool], i: int) -> bool:
    return inside[i] and not inside[page.parent[i]]


def _host_subtrees(batches):
    """Per page: host, hash of its main content, whether some is marked, distinct hashes of the subtrees outside
    marked content or named there, and of the slots inside it."""
    for batch in sliced(batches, "html", 1 << 20):
        pages = [parse(s or "") for s in batch.column(1).to_pylist()]
        mains, marked, lists = [], [], []
        for page in pages:
            hashes = subtree_hashes(page)
            dead, roots, inside, holds = layout(page)
            mains.append(np.uint64(xxhash.xxh3_64_intdigest(b"".join(hashes[r].to_bytes(8, "little") for r in roots))))
            marked.append(any(i and not d for i, d in zip(inside, dead)))
            tops = set(roots)
            found = [h for i, h in enumerate(hashes) if i and not (holds[i] or i in tops) and page.tag[i] not in ("html", "body", "head")
                     and (not inside[i] or _is_named(page.tag[i], page.attrs[i]))]
            found += [s for i, slot in enumerate(slot_hashes(page, hashes, inside)) if not (dead[i] or i in tops) for s in slot]
            lists.append(np.unique(np.array(found, np.uint64)).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.array(mains, np.uint64).view(np.int64)), pa.array(marked, pa.bool_()), pa.array(lists, pa.list_(pa.int64()))],
            names=["host", "main", "marked", "subtrees"])


def host_of(url):
    """Lower-case host of a url column, without user, port or a leading www; empty if there is none."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(host, r"^www\.", "")


def site_templates(pages: DataFrame, min_pages: int, min_share: float, article_share: float) -> DataFrame:
    """Per host: the hashes of its template subtrees, and of its template slots inside marked content."""
    found = pages.select("host", "html").mapInArrow(_host_subtrees, "host string, main long, marked boolean, subtrees array<long>")
    # copies of one article count as one page of the host
    found = staged(found, "page-subtrees")
    sizes = (found.groupBy("host", "main").agg(F.max("marked").alias("marked"))
             .groupBy("host").agg(F.count("*").alias("pages"), F.count_if("marked").alias("marked")))
    counts = (found.select("host", "main", F.explode("subtrees").alias("subtree"))
              .groupBy("host", "subtree").agg(F.count("*").alias("n"))
              .filter(F.col("n") >= min_pages))
    # the rows of the few candidates only: how many different main contents carry each
    least = F.when(F.col("subtree").bitwiseAND(F.lit(1)) == 1, article_share * F.col("marked")).otherwise(min_share * F.col("pages"))
    many = counts.join(sizes, "host").withColumn("least", F.greatest(least, F.lit(float(min_pages)))).filter(F.col("n") >= F.col("least"))
    seen = (found.select("host", "main", F.explode("subtrees").alias("subtree"))
            .join(many.select("host", "subtree", "least"), ["host", "subtree"])
            .groupBy("host", "subtree", "least", "main").agg(F.lit(1).alias("one"))
            .groupBy("host", "subtree", "least").agg(F.count("*").alias("n")))
    return (seen.filter(F.col("n") >= F.col("least"))
            .groupBy("host").agg(F.collect_set("subtree").alias("template")))


def _extractor(min_words: int):
    @F.arrow_udf("string")
    def extract(source: pa.Array, template: pa.Array) -> pa.Array:
        out = []
        for html, known in zip(source.to_pylist(), template.to_pylist()):
            page = parse(html or "")
            known = {h & 0xFFFFFFFFFFFFFFFF for h in known} if known else set()
            out.append(main_text(page, subtree_hashes(page) if known else [], known, min_words))
        return pa.array([t.encode("utf-8", "replace").decode() for t in out], pa.string())

    return extract


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = 10,
                      min_share: float = 0.1, min_words: int = 5, article_share: float = 0.9) -> DataFrame:
    """``pages`` plus ``text``, the main text (empty if there is none)."""
    prepared(pages.sparkSession)
    narrow = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    templates = staged(site_templates(narrow, min_pages, min_share, article_share), "site-templates").select(
        F.col("host").alias("__hx_host"), F.col("template").alias("__hx_template"))
    joined = pages.withColumn("__hx_of", host_of(F.col(url_col))).join(
        templates, F.col("__hx_of") == F.col("__hx_host"), "left")
    out = over(joined, text=_extractor(min_words)(F.col(f"`{html_col}`"), F.col("__hx_template")))
    return out.drop("__hx_of", "__hx_host", "__hx_template")
