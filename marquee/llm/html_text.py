"""HTML extraction: the main text of a page without its site's templates.

Element subtrees that recur across pages of a host are the site's templates.
Every page is read into blocks of text; each block knows the subtrees around
it, by a hash over their tags and text. Spark counts on how many different
pages of its host a subtree stands, and blocks inside subtrees that stand on
``MIN_PAGES`` or more and on ``MIN_SHARE`` of the host's different pages are
deleted: what a few of many pages share is text. Headings, paragraphs, list
items, cells and quotes recur by themselves as well, so they go only as part of
a container that recurs.

Two things bound that rule. What the markup itself names as no part of the
article (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
comments, hidden parts) goes in any case, also on sites with few pages. And
where a page marks its article, headings, paragraphs, lists and quotes inside
it are text even if other pages quote them; only other containers inside an
article are held against the counts. Pages with equal text count once, so
mirrored pages don't make each other a template.

Names are read from whole class, id and role tokens: ``sidebar-left`` names a
sidebar, ``has-sidebar`` and ``nav-open`` say something about their element, and
an element that calls itself ``content`` is one unless another of its tokens is
a name as a whole. Headings and ``main`` are never dropped by name, an
``article`` only by such a whole token, and inside an article names count on
containers alone. Of text in articles and text in ``main`` outside them, that is
kept of which there is more.

A block is the text between two block-level tags: references decoded, white
space runs one space, trimmed; blocks are joined by one line feed. A subtree's
hash is made of its own text and its children's hashes, and elements nested
deeper than ``DEPTH`` lie beside each other there, as in browsers; so reading a
page takes time in proportion to its length.

Edge cases: NULL or empty html gives the empty text, as does a page without
any text; markup cut off anywhere is read up to its end; a NULL url is a host
of its own; rows that repeat a page are kept row by row; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ship_package, stage

MIN_PAGES = 4
MIN_SHARE = 0.25
#: hosts of many pages whose limits are broadcast; more are joined by shuffle
MAX_BROADCAST = 100_000

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
#: what HTML's parsing rules take as text up to their end tag
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: fixed values: elements that are blocks
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre"
    " search section summary table tbody td tfoot th thead tr ul".split()
)
#: fixed values: elements that are never part of an article
_DROPPED = frozenset(
    "head script style noscript template title nav footer aside form button select textarea input iframe svg canvas"
    " object audio video map dialog menu search".split()
)
#: of an article, text even if it recurs
_TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tfoot tr td th caption figcaption figure".split())
#: text that recurs by itself
_LONE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre tr td th caption figcaption".split())
#: fixed values: words of class, id and role that name such parts
_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments"
    " complementary consent contentinfo cookie cookies copyright dfp disclaimer discussion disqus footer gdpr login"
    " masthead menu menubar modal nav navbar navigation newsletter notice notification overlay paywall pagination pager"
    " popup promo promoted promotion recommended related remark remarks replies reply respond rail share sharing sidebar"
    " signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar trending widget".split()
)
#: fixed values: words that make a token say something about its element
_SAYS_FIRST = frozenset("has have with without no not is show hide can supports".split())
_SAYS_LAST = frozenset("open opened closed active enabled disabled visible collapsed expanded on off".split())
#: fixed values: tokens of elements that hold the page's content
_CONTENT = frozenset("content main page wrapper container layout body post entry article story site".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TELLING = re.compile("class|id|role|hidden|style", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: deepest nesting that is followed
DEPTH = 512
#: end tags that a start tag implies, and the elements that shield them
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_SHIELDS_P = {"table", "td", "th", "button", "caption", "object", "html", "body"}
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


class _Node:
    __slots__ = ("tag", "parts", "dropped", "article", "counted", "hash", "own")

    def __init__(self, tag: str, dropped: bool, article: int, counted: bool) -> None:
        self.tag, self.dropped, self.article, self.counted = tag, dropped, article, counted
        #: hashes of its children and pieces of its own text, in order
        self.parts: list[str] = []
        self.own: list[str] = []
        self.hash = 0

    def text(self, piece: str) -> None:
        self.own.append(piece)

    def settle(self) -> None:
        """What was text up to here becomes one part."""
        if self.own:
            text = " ".join("".join(self.own).split())
            self.own.clear()
            if text:
                self.parts.append(text)

    def close(self, parent: _Node) -> None:
        self.settle()
        if not self.parts:
            return
        digest = xxhash.xxh3_64_intdigest(f"{self.tag}\n" + "\n".join(self.parts))
        if self.counted:
            self.hash = digest - (1 << 63)
        parent.settle()
        parent.parts.append(f"<{digest}>")


def _attributes(text: str) -> dict[str, str]:
    """Names in lower case; of a name that is there twice the first counts."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), value.strip("\"'"))
    return out


def _named(token: str) -> bool:
    """Whether a class, id or role token names a part that is no article text."""
    words = [w.lower() for w in _NAME_WORDS.findall(token)]
    if not words or words[0] in _SAYS_FIRST or words[-1] in _SAYS_LAST:
        return False
    return any(w in _NAMES for w in words)


def _boilerplate(tag: str, attributes: str, article: int) -> bool:
    """Whether an element's attributes say that it is hidden or no part of an
    article. ``article``: whether it stands in one."""
    if not _TELLING.search(attributes):
        return False
    found = _attributes(attributes)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(found.get("style", "")):
        return True
    if tag in _HEADINGS or tag == "main" or (article and tag in _LONE):
        return False
    tokens = [t for name in ("class", "id", "role") for t in found.get(name, "").split()]
    if any(t.lower() in _NAMES for t in tokens):
        return True
    if tag == "article" or any(t.lower() in _CONTENT for t in tokens):
        return False
    return any(map(_named, tokens))


def blocks_of(page: str) -> tuple[list[tuple[str, list[int]]], list[int]]:
    """Blocks that the markup leaves, each with the hashes of the subtrees that
    may be templates; and all such hashes of the page."""
    root = _Node("html", False, 0, False)
    stack, buffer, found, nodes = [root], [], [], []
    at, end = 0, len(page)

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            top = stack[-1]
            found.append((text, top.article, [n for n in stack if n.counted]))

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            node.close(stack[-1])

    def text(piece: str) -> None:
        if "&" in piece:
            piece = entities.unescape(piece)
        top = stack[-1]
        top.text(piece)
        if not top.dropped:
            buffer.append(piece)

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    if tag in _BLOCKS:
                        flush()
                    pop_to(depth)
                    break
            continue
        if tag == "br" or tag in _VOID:
            if tag == "hr":
                flush()
            text(" ")
            continue
        if tag in ("html", "body"):
            continue
        if tag in _BLOCKS:
            flush()
            for depth in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[depth].tag == "p":
                    pop_to(depth)
                    break
                if stack[depth].tag in _SHIELDS_P:
                    break
            ends, shields = _IMPLIED.get(tag, ((), ()))
            if ends:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag in shields:
                        break
                    if stack[depth].tag in ends:
                        pop_to(depth)
                        if tag != "tr":
                            break
        if tag in _RAW:
            m = _RAW[tag].search(page, at)
            at = m.start() if m else end
        if len(stack) >= DEPTH:
            pop_to(DEPTH - 1)
        parent = stack[-1]
        article = parent.article or (2 if tag == "article" else 1 if tag == "main" else 0)
        if tag == "article":
            article = 2
        dropped = parent.dropped or tag in _DROPPED or (tag == "header" and parent.article == 0) or bool(attributes and _boilerplate(tag, attributes, parent.article))
        counted = tag in _BLOCKS and tag not in ("article", "main") and tag not in _LONE and not (article and tag in _TEXT_BLOCKS)
        node = _Node(tag, dropped, article, counted)
        if counted:
            nodes.append(node)
        stack.append(node)
    flush()
    pop_to(1)
    sizes = [sum(len(t) for t, article, _ in found if article == level) for level in (0, 1, 2)]
    level = (2 if sizes[2] >= sizes[1] else 1) if sizes[1] or sizes[2] else 0
    kept = [(t, [n.hash for n in around if n.hash]) for t, article, around in found if article == level]
    return kept, sorted({n.hash for n in nodes if n.hash})


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


_READ = (
    "page_id long, url string, host string, print long, texts array<string>, around array<array<long>>,"
    " subtrees array<long>, settled boolean"
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for url, page in zip(batch.column(1).to_pylist(), batch.column(2)):
            blocks, subtrees = blocks_of(page.as_py() or "")
            texts, around = [b[0] for b in blocks], [b[1] for b in blocks]
            print_ = xxhash.xxh3_64_intdigest("\n".join(texts)) - (1 << 63)
            rows.append((host_of(url), print_, texts, around, subtrees, not any(around)))
        columns = list(zip(*rows)) if rows else [[]] * 6
        types = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.list_(pa.int64())), pa.list_(pa.int64()), pa.bool_()]
        names = ["page_id", "url", "host", "print", "texts", "around", "subtrees", "settled"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(c, t) for c, t in zip(columns, types))], names=names)


def templates(read: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, subtree) of subtrees on ``min_pages`` or more different pages
    and on ``MIN_SHARE`` of its host's."""
    pages = read.groupBy("host", "print").agg(F.first("subtrees").alias("subtrees"))
    each = pages.select("host", F.explode("subtrees").alias("subtree"))
    found = each.groupBy("host", "subtree").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    # hosts where the share asks for more than min_pages
    least = read.select("host", "print").distinct().groupBy("host").agg(F.ceil(F.count("*") * MIN_SHARE).alias("least"))
    least = stage(least.where(F.col("least") > min_pages), "large-hosts")
    if least.count() <= MAX_BROADCAST:
        least = F.broadcast(least)
    found = found.join(least, "host", "left").where(F.coalesce(F.col("pages") >= F.col("least"), F.lit(True)))
    return found.select("host", "subtree")


def extract(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", min_pages: int = MIN_PAGES
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    read = stage(rows.mapInArrow(_read, _READ).withColumn("row", F.monotonically_increasing_id()), "pages")
    known = stage(templates(read, min_pages), "templates")
    # only blocks with a subtree around them wait for the counts
    open_ = read.where(~F.col("settled"))
    asked = open_.select("row", "host", F.explode(F.array_distinct(F.flatten("around"))).alias("subtree"))
    deleted = asked.join(known, ["host", "subtree"], "left_semi").groupBy("row").agg(F.collect_list("subtree").alias("gone"))
    left = (
        open_.join(deleted, "row", "left")
        .withColumn("gone", F.coalesce("gone", F.array().cast("array<long>")))
        .withColumn("texts", F.expr("filter(texts, (t, i) -> not arrays_overlap(around[i], gone))"))
    )
    final = read.where("settled").select("page_id", "url", "texts").unionByName(left.select("page_id", "url", "texts"))
    text = F.array_join("texts", "\n")
    return final.select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))
