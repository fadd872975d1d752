"""Main text of web pages by equivalence-class template deduction.

The tokens of a page are its structural elements, told apart by their path of
tags and class names, and its text blocks. Over the pages of one host every
token has an occurrence vector: how often it occurs on each page. Tokens with
equal vectors form an equivalence class. A class on at least ``SUPPORT`` of
the host's pages is valid, so an error page or a second layout changes
nothing; the valid classes, each nested in its parent's class from the root
down, are the host's template. Pages without html do not count. What remains
between template tokens are slots. The template element whose slots hold the
text is the container of the main text; text blocks that are themselves
template tokens are notices, also below ``article`` and ``main``, and named
boilerplate is left out, unless it holds the page's main elements or most of
its text (see ``settle``). Below these two a repeated text is a notice only if
what stands beside it changes from page to page, as an article that is
published twice keeps its order.

A vector enters the aggregation as the XOR of a hash per page and count, so
classes come out of one partial aggregation over all pages, however many a
host has. Only tokens of valid classes leave it; these are a bounded number per host. Hosts with fewer than
``FEW_PAGES`` pages have no vectors worth comparing; they are deduced as one
pool.
"""

from __future__ import annotations

import html
import re

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanekit.llm.common import stage

FEW_PAGES = 3
TEXT_SHARE = 0.8
LONG_TEXT = 200
SUPPORT = 0.5
NEARLY_ALL = 0.9
#: From this many tags on whose quotes are never closed, a page's quotes no
#: longer hide a ">", so that reading stays linear in the page.
OPEN_QUOTES = 8

#: Element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: Void elements that end a line; the others stand within one.
BREAKS = frozenset(("br", "hr"))
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var".split())
CLOSES_ITSELF = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                 "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table select div section article main body td th blockquote".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form script style noscript template head title button select "
                             "option textarea iframe svg canvas menu dialog object audio video noembed noframes".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay menu nav navbar navigation breadcrumb "
    "breadcrumbs sidebar widget widgets related recommended share sharing social comment comments disqus reply "
    "replies respond footer header masthead toolbar pagination pager newsletter subscribe subscription signup login "
    "search copyright disclaimer".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
MAIN_TAGS = frozenset(("article", "main"))
#: Below a main element these name its headline.
HEADLINE_NAMES = frozenset(("header", "masthead"))

_OPEN = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)|[!?])")
_ATTRIBUTES = re.compile(r"(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>")
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(^|\s)(hidden|aria-hidden\s*=\s*["']?true)(?=[\s"'/]|$)""", re.I)
_LETTERS = re.compile(r"[a-z]+")
_FILLED = r"[^\x00-\x20]"


class Element:
    """An open element: its path's hash, whether it is boilerplate by its tag
    (or an ancestor's), whether its names say so, how much clean text lies below
    it. ``settle`` decides on the names."""

    __slots__ = ("tag", "path", "parent", "depth", "boilerplate", "named", "main", "clean")

    def __init__(self, tag, path, parent, boilerplate, named):
        self.tag, self.path, self.parent, self.named = tag, path, parent, named
        self.depth = parent.depth + 1 if parent else 0
        self.boilerplate = boilerplate or bool(parent and parent.boilerplate)
        self.main = tag in MAIN_TAGS or bool(parent and parent.main)
        self.clean = 0


def _element(tag: str, attributes: str, parent: Element) -> Element:
    names, role = [], ""
    for kind, value in _NAMES.findall(attributes) if "=" in attributes else ():
        words = _LETTERS.findall(html.unescape(value).lower())
        if kind.lower() == "role":
            role = words[0] if words else ""
        else:
            names += words
    plain = tag in MAIN_TAGS or tag in ("html", "body")
    headline = parent.main and tag == "header"
    boilerplate = (tag in BOILERPLATE_TAGS and not headline) or role in BOILERPLATE_ROLES or bool(
        _HIDDEN.search(attributes))
    hints = BOILERPLATE_NAMES.intersection(names) - (HEADLINE_NAMES if parent.main else frozenset())
    label = f"{parent.path}/{tag}" + ("" if plain else "." + ".".join(sorted(set(names))))
    return Element(tag, xxhash.xxh64_intdigest(label.encode()) >> 1, parent, boilerplate, bool(hints) and not plain)


def parse(page: str) -> tuple[list[Element], list[tuple[Element, str, bool]]]:
    """All structural elements in page order (the first is an invisible root),
    and the text blocks as (element, text, mostly a link). Text is decoded,
    white space in a block is one space. Void and inline elements are no
    structure, and of them only ``BREAKS`` end a block; missing end tags are
    supplied. A tag whose quotes are never closed ends at its first ">", and
    what has no ">" behind it is text."""
    root = Element("", 0, None, False, False)
    stack, elements = [root], [root]
    opened: dict[str, int] = {}                          # elements on the stack by tag
    blocks: list[tuple[Element, str, bool]] = []
    held: list[str] = []
    links = linked = 0

    def flush():
        nonlocal linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                at = stack[-1]
                link = 2 * linked > len(text)
                blocks.append((at, text, link))
                if not at.boilerplate and not link:
                    at.clean += len(text)
            held.clear()
            linked = 0

    def pop():
        done = stack.pop()
        opened[done.tag] -= 1
        if not done.boilerplate:
            stack[-1].clean += done.clean

    def add(text):
        nonlocal linked
        held.append(text)
        if links:
            linked += len(text)

    at, size, last, unclosed = 0, len(page), page.rfind(">"), 0
    while at < size:
        m = _OPEN.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if m[1]:
            end = page.find("-->", at)
            at = size if end < 0 else end + 3
            continue
        if at > last:
            add(page[m.start():])
            break
        begin = at
        if not m[3]:
            at = page.find(">", at) + 1
            continue
        whole = _ATTRIBUTES.match(page, at) if unclosed < OPEN_QUOTES else None
        unclosed += whole is None
        at = whole.end() if whole else page.find(">", at) + 1
        tag, closing = m[3].lower(), bool(m[2])
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
            continue
        if tag in VOID:
            if tag in BREAKS:
                flush()
            continue
        flush()
        if closing:
            if opened.get(tag):
                while stack[-1].tag != tag:
                    pop()
                pop()
                links = 0
            continue
        ends = CLOSES_ITSELF.get(tag, ("p",))
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in ends:
                while len(stack) > depth:
                    pop()
            elif stack[depth].tag in SCOPE or depth < len(stack) - 3:
                break
        stack.append(_element(tag, page[begin:at - 1], stack[-1]))
        elements.append(stack[-1])
        opened[tag] = opened.get(tag, 0) + 1
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
            at = end.start() if end else size
    flush()
    while len(stack) > 1:
        pop()
    return elements, blocks


def settle(elements: list[Element], blocks: list[tuple[Element, str, bool]], confirmed=frozenset(),
           lifted=frozenset()) -> None:
    """Marks what lies below named elements as boilerplate, and takes its text
    out of ``clean``. A name is a hint: it does not count for an element that
    holds all main elements of the page, or whose path is ``lifted`` (holds
    most text of the host's pages), or that holds ``TEXT_SHARE`` of the page's
    text and ``LONG_TEXT`` characters, unless the host has ``confirmed`` it."""
    if not any(e.named for e in elements):
        return
    mains = [e for e in elements if e.tag in MAIN_TAGS and not e.boilerplate and not e.parent.main]
    tops = {id(m) for m in mains}
    around: dict[int, int] = {}                          # main elements below each element
    for e in reversed(elements[1:]):                     # children come last
        below = around.get(id(e), 0) + (id(e) in tops)
        if below:
            around[id(e.parent)] = around.get(id(e.parent), 0) + below
    # several main elements may be comments: these must hold half of the text
    enough = len(mains) == 1 or 2 * sum(m.clean for m in mains) >= elements[0].clean
    whole = elements[0].clean
    for e in elements[1:]:
        if e.named and not e.boilerplate:
            holds = bool(mains) and enough and around.get(id(e), 0) == len(mains)
            large = e.clean >= max(TEXT_SHARE * whole, LONG_TEXT) and e.path not in confirmed
            e.boilerplate = not (holds or large or e.path in lifted)
        e.boilerplate |= e.parent.boilerplate
    for e in elements:
        e.clean = 0
    for e, text, link in blocks:
        if not e.boilerplate and not link:
            e.clean += len(text)
    for e in reversed(elements[1:]):                     # children come last
        if not e.boilerplate:
            e.parent.clean += e.clean


def tokens(page: str) -> dict[int, list[int]]:
    """token -> [times on the page, parent, depth, clean text in it, the whole
    page's clean text, kind, the texts before and after]; kind 2: a main
    element, 1: another element, 0: a text block, -1: a text block below a main
    element, whose neighbours there are given (0: none), 3: an element named
    like boilerplate, whatever its name decides, with its text under another
    token. None for a blank page."""
    found: dict[int, list[int]] = {}
    if not re.search(_FILLED, page):
        return found
    elements, blocks = parse(page)
    for e in elements:
        if e.named and not e.boilerplate:
            row = found.setdefault(named_token(e.path), [0, e.path, e.depth, 0, elements[0].clean, 3, 0, 0])
            row[0] += 1
            row[3] += e.clean
    settle(elements, blocks)
    whole = elements[0].clean
    for e in elements:
        if e.boilerplate:
            continue
        kind = 2 if e.tag in MAIN_TAGS else 1
        row = found.setdefault(e.path, [0, e.parent.path if e.parent else -1, e.depth, 0, whole, kind, 0, 0])
        row[0] += 1
        row[3] += e.clean
    texts = [(e, text_token(e, text), 0 if link else len(text)) for e, text, link in blocks if not e.boilerplate]
    inner = [t for e, t, _ in texts if e.main]
    beside = iter(zip([0, *inner], [*inner[1:], 0]))
    for e, token, clean in texts:
        around = next(beside) if e.main else (0, 0)
        row = found.setdefault(token, [0, e.path, e.depth + 1, 0, whole, -1 if e.main else 0, *around])
        row[0] += 1
        row[3] += clean
    return found


def named_token(path: int) -> int:
    return xxhash.xxh64_intdigest(f"named:{path}".encode()) >> 1


def text_token(e: Element, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{e.path}:{text}".encode()) >> 1


def nest(rows: pd.DataFrame) -> list[list]:
    """The template as its classes, outermost first, each a list of its
    elements (rows of ``rows``). A class are the elements with one occurrence
    vector. The root's class is the outermost; another class stands in the slots
    of the class that its outermost elements' parents belong to, and if that is
    in the template, so is it. An element whose parent is in no class of the
    template is no part of its class: the same count on every page has put
    together what does not stand together."""
    classes: dict[str, list] = {}
    of: dict[int, str] = {}
    for t in rows[rows.kind.isin((1, 2))].sort_values(["depth", "token"], kind="stable").itertuples():
        if t.token == 0 or t.parent in of:
            classes.setdefault(t.vector, []).append(t)   # in the order of the nesting: parents come first
            of[t.token] = t.vector
    return list(classes.values())


def deduce(rows: pd.DataFrame, n_pages: int, few_pages: int = FEW_PAGES) -> tuple[int, list[int]]:
    """(container, notices) of one host from its tokens (token, parent, depth,
    kind, clean, pages, times, vector; whole, the clean text of all pages with
    the token; varied, whether its neighbours differ between pages).

    The template are the valid element classes, nested (see ``nest``): the
    gaps between its elements are the slots. The container is the deepest
    template element, of a class that occurs once on its pages, whose slots
    hold at least ``TEXT_SHARE`` of their clean text. Notices are the text blocks of valid
    classes; a class on less than ``NEARLY_ALL`` pages that holds more than
    half of their text is none, as these pages are copies of one another. Below
    main elements a class with more than half of the text is never one, a block
    of it must have neighbours that differ, and it must be on ``NEARLY_ALL``
    pages with a main element: articles quote each other.
    """
    rows = rows[rows.pages >= SUPPORT * n_pages]
    root = rows[rows.token == 0]
    if root.empty or n_pages < few_pages:
        return 0, []
    if "whole" not in rows:
        rows = rows.assign(whole=int(root.clean.iloc[0]))
    elements = [t for members in nest(rows) for t in members if t.times == t.pages]
    notices: list[int] = []
    mains = rows.pages[rows.kind == 2].max() if (rows.kind == 2).any() else n_pages
    for (kind, _), texts in rows[rows.kind <= 0].groupby(["kind", "vector"]):
        copied = 2 * texts.clean.sum() > texts.whole.max()
        everywhere = texts.pages.max() >= NEARLY_ALL * (mains if kind else n_pages)
        if everywhere and not copied and texts.varied.any() if kind else everywhere or not copied:
            notices += texts.token.astype(int).tolist()
    holding = [e for e in elements if e.clean >= TEXT_SHARE * e.whole]
    return int(max(holding, key=lambda e: (e.depth, e.clean, -e.token)).token) if holding else 0, sorted(notices)


def named_paths(rows: pd.DataFrame, n_pages: int, few_pages: int = FEW_PAGES) -> tuple[list[int], list[int]]:
    """(confirmed, lifted) paths of a host's elements named like boilerplate:
    those of valid classes, by their share of the text of their pages."""
    if n_pages < few_pages:
        return [], []
    valid = rows[(rows.kind == 3) & (rows.pages >= SUPPORT * n_pages)]
    large = (valid.clean >= TEXT_SHARE * valid.whole) & (valid.clean > 0)
    return sorted(valid.parent[~large].astype(int)), sorted(valid.parent[large].astype(int))


def extract(page: str | None, container: int | None, notices: frozenset[int], confirmed: frozenset[int] = frozenset(),
            lifted: frozenset[int] = frozenset()) -> str:
    """The main text: the clean blocks of the slots below the container, one
    line each. On a page that lacks the container, or has a main element that
    holds nearly all of its text, that element (or the whole page) counts."""
    if not page:
        return ""
    elements, blocks = parse(page)
    settle(elements, blocks, confirmed, lifted)
    inside = [e for e in elements if e.path == container and not e.boilerplate] or elements[:1]
    clean = sum(e.clean for e in inside)
    below = _below(elements, inside)
    mains = [e for e in elements if e.tag in MAIN_TAGS and id(e) in below and not e.boilerplate
             and not (e.parent and e.parent.main)]
    if mains and sum(e.clean for e in mains) >= TEXT_SHARE * clean:
        below = _below(elements, mains)
    return "\n".join(text for e, text, _ in blocks
                     if id(e) in below and not e.boilerplate and text_token(e, text) not in notices)


def _below(elements: list[Element], tops: list[Element]) -> set[int]:
    found = {id(e) for e in tops}
    for e in elements:                                   # parents come first
        if e.parent is not None and id(e.parent) in found:
            found.add(id(e))
    return found


# ------------------------------------------------------------------ operator

def _host(url) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def page_tokens(pages: DataFrame) -> DataFrame:
    """(host, page, token, times, parent, depth, clean, whole, kind, before,
    after) of all pages that are not blank."""

    def run(batches):
        for b in batches:
            host, page = b.column(0), b.column(1)
            for i in range(0, b.num_rows, 64):
                rows = [(h.as_py(), p.as_py(), t, *row) for h, p, text in
                        zip(host[i:i + 64], page[i:i + 64], b.column(2)[i:i + 64])
                        for t, row in tokens(text.as_py() or "").items()]
                if not rows:
                    continue
                columns = zip(*rows)
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(),
                         pa.int8(), pa.int64(), pa.int64())
                names = ["host", "page", "token", "times", "parent", "depth", "clean", "whole", "kind",
                         "before", "after"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return (pages.select(_host(F.col("url")).alias("host"), F.xxhash64("page_id", "url", "html").alias("page"), "html")
            .mapInArrow(run, "host string, page bigint, token bigint, times bigint, parent bigint, depth int, "
                             "clean bigint, whole bigint, kind tinyint, before bigint, after bigint"))


def templates(pages: DataFrame, few_pages: int = FEW_PAGES) -> DataFrame:
    """(host, container, notices, confirmed, lifted) for every host with ``few_pages`` pages or
    more that are not blank; the row with a null host is the pool of all others."""
    named = pages.select("page_id", "url", "html")
    sizes = named.groupBy(_host(F.col("url")).alias("host")).agg(
        F.count_if(F.col("html").rlike(_FILLED)).alias("n"))
    groups = stage(sizes.withColumn("grp", F.when(F.col("n") >= few_pages, F.col("host"))), "html-hosts")
    counts = groups.groupBy("grp").agg(F.sum("n").alias("n_pages"))
    grouped = (page_tokens(named).join(groups.select("host", "grp"), "host")
               .groupBy("grp", "token").agg(
                   F.count("*").alias("pages"), F.sum("times").alias("times"), F.sum("clean").alias("clean"),
                   F.sum("whole").alias("whole"),
                   ((F.min("before") != F.max("before")) | (F.min("after") != F.max("after"))).alias("varied"),
                   F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.max("kind").alias("kind"),
                   F.concat_ws(":", F.expr("bit_xor(xxhash64(page, times))"),
                               F.expr("bit_xor(xxhash64(times, page, 1))")).alias("vector")))
    frequent = (grouped.join(counts.select(F.col("grp").alias("g"), "n_pages"), F.col("grp").eqNullSafe(F.col("g")))
                .drop("g").filter(F.col("pages") >= SUPPORT * F.col("n_pages")))

    def run(key, rows):
        n_pages = int(rows.n_pages.iloc[0])
        found = [key[0], *deduce(rows, n_pages, few_pages), *named_paths(rows, n_pages, few_pages)]
        return pd.DataFrame([found], columns=["grp", "container", "notices", "confirmed", "lifted"])

    found = frequent.groupBy("grp").applyInPandas(run, "grp string, container bigint, notices array<bigint>, "
                                                        "confirmed array<bigint>, lifted array<bigint>")
    return groups.join(found.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g"))).select(
        "host", "container", "notices", "confirmed", "lifted")


def main_text(pages: DataFrame, few_pages: int = FEW_PAGES) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (columns
    page_id, url, html; others are ignored).

    Null or empty html and pages without text give the empty text. A url that
    is null or names no host belongs to the host ''. Repeated rows are rows of
    their own with the same result (their hashes cancel in the vectors, for
    all tokens alike). No rows in, none out.
    """
    found = stage(templates(pages, few_pages), "html-templates").withColumnRenamed("host", "__host")

    @F.arrow_udf("string")
    def run(html_: pa.Array, container: pa.Array, *paths: pa.Array) -> pa.Array:
        return pa.array([extract(h.as_py(), c.as_py(), *(frozenset(x.as_py() or ()) for x in found))
                         for h, c, *found in zip(html_, container, *paths)], pa.string())

    return (pages.select("page_id", "url", "html")
            .join(found, _host(F.col("url")) == F.col("__host"), "left")
            .select("page_id", "url", run("html", "container", "notices", "confirmed", "lifted").alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
