"""Main text of web pages by a site style tree.

1. *Merge.*  Pages of one host are merged element by element.  A style node is an element path (tags with
   their class or id); a content node is a style node with the text of its branch, so siblings of one path
   stay apart by what they hold.  For each the tree counts the host's pages that show it.
2. *Importance.*  Of a content node: the information of meeting it on a page of the host, ``-log2`` of the share of pages
   that hold it, at most 1 (0 if every page does, 1 from every second page down).  Of its style node: the normalised entropy of
   its presentations (sequences of child elements).  A branch's importance is mostly its content's.
3. *Remove.*  From each page go branches of low importance (on nearly all of at least ``MIN_PAGES`` pages), with or without
   classes, and whatever their element.  Elements and class words that are never main text (menus, footers, forms, adverts,
   comments, hidden parts: the lists below) go first, as a prior; where a page has ``article`` or ``main``, what lies outside goes.

Plain running text inside ``article`` or ``main`` is never removed for being repeated: pages may be copies of
one another.  Parsing is linear in the page: open elements are found by position, paths are hashes over the
parent's, and a branch's content is a range of the page's blocks under one prefix hash.  Counts are
pre-aggregated per task; a host's tree is a set of grouped rows and never one task's work, and only the nodes to remove
travel back to the pages.

Defined results: NULL or empty html gives an empty text; a page whose URL has no host belongs to no
site and loses nothing to step 2; text without any tag is one block; if the removals leave a page
without article nothing, only the element rules apply; very long
pages are parsed whole in linear time; repeated rows are extracted each on its own;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from strata.llm.common import BROADCAST_ROWS, bounded_broadcast, cut, per_batch, small_batches

MIN_PAGES = 5
LOW = 0.15
CONTENT_SHARE = 0.9
#: The smallest share of a host's pages at which a content node can be of low importance.
MIN_SHARE = 2 ** (-LOW / CONTENT_SHARE)
#: Bytes of rules (ids of nodes, hosts) that may be broadcast.
BROADCAST_BYTES = 16 << 20

#: Elements that end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body br canvas caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frame frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav noframes noscript "
    "ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never main text, wherever they stand.
DROPPED = frozenset(
    "head title script style noscript template iframe object embed svg math canvas audio video map nav aside footer form "
    "button select textarea input label fieldset dialog menu frameset noframes applet".split())
#: Their content is not markup.
OPAQUE = frozenset("script style textarea title noscript iframe noframes template svg math xmp".split())
#: Words in a class, id or role that mark a branch as no main text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox adunit alert banner billboard "
    "breadcrumb breadcrumbs comment comments commentlist consent contentinfo cookie cookies copyright dfp dialog "
    "disclaimer disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "notification outbrain overlay paginate pagination pager popup promo promos promoted promotion recommended related "
    "rail replies reply respond responses search share sharing sharebar shoutbox sidebar sidenav signin signup skip social sponsor sponsored "
    "sponsors subscribe subscription taboola toc toolbar topbar trending widget widgets".split())
#: Of those, the ones that may also name a part of the article itself.
OUTSIDE_ONLY = frozenset("header banner".split())
#: Words that turn a name into a remark about the page ("has-sidebar"), and words that a part of the text starts with.
REMARKS = frozenset("has with no without".split())
CONTENT = frozenset("content article post entry story layout wrapper container".split())
#: Text elements that repetition alone never removes.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote ul ol li dl dt dd table tbody thead tfoot tr td th figure "
                    "figcaption article main body html".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Opening one of the values closes an open key (a missing end tag).
_CLOSES = {"p": BLOCKS - {"br", "body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
           "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}, "head": {"body"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "option": {"select"}, "p": {"td", "th", "li", "article", "main", "section", "div", "blockquote", "button"}}


_M64 = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15
#: Tags that an opening tag closes, by the opening tag.
_CLOSERS: dict[str, tuple[str, ...]] = {}
for _open, _by in _CLOSES.items():
    for _t in _by:
        _CLOSERS[_t] = (*_CLOSERS.get(_t, ()), _open)
#: Elements beyond which an opening tag closes nothing.
_WALLS = tuple(sorted({*_SCOPE["p"], "table", "ul", "ol", "dl", "select", "body"}))


class Element:
    """An element of a page.  Its branch holds the blocks ``first .. last`` of the page."""

    __slots__ = ("tag", "plain", "parent", "path", "kind", "main", "owner", "children", "first", "last", "gone")

    def __init__(self, tag: str, name: str, parent: "Element | None", kind: int, main: bool, first: int):
        self.tag, self.plain, self.parent, self.kind, self.main = tag, "." not in name and "#" not in name, parent, kind, main
        self.path = xxhash.xxh3_64_intdigest(f"{parent.path if parent else 0}/{name}")
        self.owner = self if tag in BLOCKS or parent is None else parent.owner  # the block that text in it belongs to
        self.children: list[str] = []
        self.first = self.last = first
        self.gone = False


def _attributes(raw: str) -> dict[str, str]:
    return {m.group(1).lower(): (m.group(2) or "").strip("\"'") for m in _ATTR.finditer(raw)} if raw.strip(" /") else {}


def _name(tag: str, attrs: dict[str, str]) -> tuple[str, set[str], bool]:
    """(name in the style tree, marking words, hidden)."""
    words: set[str] = set()
    for token in " ".join(attrs.get(a, "") for a in ("class", "id", "role")).split():
        parts = [w.lower() for w in _PART.findall(token)] or [token.lower()]
        marks = {w for w in (*parts, token.lower()) if w in MARKS}
        if marks and not REMARKS & set(parts) and not (parts[0] in CONTENT and parts[-1] not in MARKS):
            words |= marks
    hidden = "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(attrs.get("style", "")))
    short = ".".join(attrs.get("class", "").split()[:3]) or ("#" + attrs["id"] if attrs.get("id") and not re.search(r"\d", attrs["id"]) else "")
    return f"{tag}.{short}" if short else tag, words, hidden


def parse(page: str) -> tuple[list[tuple[str, Element]], list[Element], bool]:
    """(text blocks with their element, elements in page order, whether the page has an article or main element).

    ``kind`` of an element is the strongest removal that holds for its branch: 0 none, 1 by class
    word, 2 by element.
    """
    root = Element("", "", None, 0, False, 0)
    stack, elements = [root], [root]
    places: dict[str, list[int]] = {}  # where the stack holds a tag
    blocks: list[tuple[str, Element]] = []
    run: list[str] = []
    has_main = False

    def flush() -> None:
        if run:
            text = " ".join("".join(run).split())
            if text:
                top = stack[-1]
                blocks.append((text, top.owner if top.owner.kind >= top.kind else top))
            run.clear()

    def say(piece: str) -> None:
        if piece:
            top = stack[-1]
            if top.kind < 2 or top.tag not in OPAQUE:
                run.append(html.unescape(piece) if "&" in piece else piece)

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def cut_stack(i: int) -> None:
        for e in stack[i:]:
            e.last = len(blocks)
            places[e.tag].pop()
        del stack[i:]

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag:
            if m.group().startswith("<![CDATA["):
                say(m.group()[9:].removesuffix("]]>"))
            continue
        closing = bool(m.group(1) or m.group(4))
        block = tag in BLOCKS
        if closing:
            if block or tag in DROPPED:
                flush()
            i = last((tag,))
            if i and i >= last(_SCOPE.get(tag, ())):
                if any(x.tag in BLOCKS or x.tag in DROPPED for x in stack[i:]):
                    flush()
                cut_stack(i)
            continue
        if block or tag in DROPPED:
            flush()
        while (i := last(_CLOSERS.get(tag, ()))) and i >= last(_WALLS):
            t = stack[i].tag
            cut_stack(i)
            if t not in ("td", "th", "tr"):
                break
        top = stack[-1]
        top.children.append(tag)
        if tag in VOID:
            continue
        attrs = _attributes(m.group(3) or m.group(6) or "")
        name, words, hidden = _name(tag, attrs)
        is_main = tag in ("article", "main") or "main" in attrs.get("role", "").lower().split() or attrs.get("itemprop") == "articleBody"
        kind = top.kind
        if tag in DROPPED or hidden or (tag == "header" and not top.main):
            kind = 2
        elif tag not in ("html", "body") and not (is_main and "comment" not in words and "comments" not in words):
            if words and not (top.main and words <= OUTSIDE_ONLY):
                kind = max(kind, 1)
        elif is_main and words & {"comment", "comments", "related", "promo", "sidebar"}:
            kind = max(kind, 1)
        main = top.main or (is_main and kind == 0)
        has_main = has_main or main
        e = Element(tag, name, top, kind, main, len(blocks))
        elements.append(e)
        if tag in OPAQUE:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = close.end() if close else end
            continue
        places.setdefault(tag, []).append(len(stack))
        stack.append(e)
    flush()
    for e in stack:
        e.last = len(blocks)
    return blocks, elements, has_main


def content_nodes(blocks: list[tuple[str, Element]], elements: list[Element]) -> Iterator[tuple[Element, int]]:
    """(element, content node) of every branch with text that the tree may judge."""
    prefix, power = [0], [1]
    for text, _ in blocks:
        prefix.append((prefix[-1] * _STEP + xxhash.xxh3_64_intdigest(text)) & _M64)
        power.append(power[-1] * _STEP & _M64)
    for e in elements:
        if e.last == e.first or e.kind == 2 or not (e.tag in BLOCKS or e.tag == "section") or e.tag in ("html", "body", "head"):
            continue
        if e.main and (e.tag in ("article", "main") or e.tag in RUNNING and e.plain):
            continue
        content = (prefix[e.last] - prefix[e.first] * power[e.last - e.first]) & _M64
        yield e, xxhash.xxh3_64_intdigest(f"{e.path}:{content}") - (1 << 63)


def style_rows(page: str) -> set[tuple[int, int, int]]:
    """Distinct (style node, presentation, content node) of a page."""
    blocks, elements, _ = parse(page)
    return {(e.path - (1 << 63), xxhash.xxh3_64_intdigest(",".join(e.children)) - (1 << 63), node)
            for e, node in content_nodes(blocks, elements)}


def extract(page: str, low: frozenset[int] = frozenset()) -> str:
    """Main text of a page; ``low`` are the host's content nodes of low importance."""
    blocks, elements, has_main = parse(page)
    if low:
        for e, node in content_nodes(blocks, elements):
            e.gone = node in low
        for e in elements[1:]:  # parents come first
            e.gone = e.gone or e.parent.gone
    if has_main:
        return "\n".join(t for t, e in blocks if e.main and e.kind == 0 and not e.gone)
    kept = [t for t, e in blocks if e.kind == 0 and not e.gone]
    return "\n".join(kept or [t for t, e in blocks if e.kind < 2])


def host(url: str) -> Column:
    """Lower-case host of a URL without port and user, NULL if there is none."""
    found = F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def importance(pages: DataFrame) -> DataFrame:
    """The style tree's repeated nodes: ``host, path, node, n_pages, shown, presentation, content, importance``."""
    small_batches(pages.sparkSession)

    def make():
        row = pa.struct([("path", pa.int64()), ("style", pa.int64()), ("node", pa.int64())])
        return lambda texts: pa.array(
            [[{"path": p, "style": s, "node": c} for p, s, c in style_rows(t.decode("utf-8", "replace"))] for t in texts],
            type=pa.list_(row))

    udf = per_batch(make, "array<struct<path:bigint,style:bigint,node:bigint>>")
    sited = pages.select(host("url").alias("host"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("raw")).where(F.col("host").isNotNull())
    seen = cut(sited.select("host", F.explode(udf("raw")).alias("b")).select("host", "b.*")
               .groupBy("host", "path", "style", "node").agg(F.count(F.lit(1)).alias("c")), "style-nodes")
    styles = seen.groupBy("host", "path", "style").agg(F.sum("c").alias("c"))
    m = F.sum("c")
    entropy = F.when(m > 1, (F.log(m) - F.sum(F.col("c") * F.log("c")) / m) / F.log(m)).otherwise(0.0)
    styles = styles.groupBy("host", "path").agg(entropy.alias("presentation"))
    sites = pages.select(host("url").alias("host")).where(F.col("host").isNotNull()).groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    # nodes that most pages lack go before anything is joined
    nodes = seen.groupBy("host", "path", "node").agg(F.sum("c").alias("shown")).where(F.col("shown") >= MIN_PAGES * MIN_SHARE)
    common = nodes.join(sites.where(F.col("n_pages") >= MIN_PAGES), "host").where(F.col("shown") >= F.col("n_pages") * MIN_SHARE)
    content = F.least(F.lit(1.0), F.greatest(F.lit(0.0), -F.log2(F.col("shown") / F.col("n_pages"))))
    return (common.join(styles, ["host", "path"]).withColumn("content", content)
            .withColumn("importance", (1 - CONTENT_SHARE) * F.col("presentation") + CONTENT_SHARE * F.col("content")))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    small_batches(pages.sparkSession)
    low = importance(pages).where(F.col("importance") < LOW)
    rules = cut(low.groupBy("host").agg(F.array_sort(F.collect_set("node")).alias("low")), "style-rules")
    hosts, nodes = rules.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("low")), F.lit(0))).first()
    small = 100 * hosts + 8 * nodes <= BROADCAST_BYTES
    h, mine = "_host", pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("raw"))
    joined = (mine.withColumn(h, host("url"))
              .join(bounded_broadcast(rules.withColumnRenamed("host", "_site"), 0 if small else BROADCAST_ROWS + 1),
                    F.col(h) == F.col("_site"), "left"))

    @arrow_udf("string")
    def text(raw: pa.Array, low: pa.Array) -> pa.Array:
        return pa.array([extract(r.decode("utf-8", "replace"), frozenset(p or ())) for r, p in
                         zip(raw.to_pylist(), low.to_pylist())], type=pa.string())

    return (joined.select("page_id", "url", text("raw", "low").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
