"""Main text of web pages: markup first, then differencing with the nearest page.

Markup decides where it can: text in an article is kept, text in menus, forms and the
like is not. What is left open (pages without an article, or text beside it) is decided
by comparison: pages are ordered by host and URL path, a page's lines are aligned with
those of the pages before and after it by longest common subsequence, and open lines
that they share are deleted, since neighbours share a template and not an article.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import in_order, map_batches, stored

KEEP, OPEN, DROP = 2, 1, 0
#: Inside a main part: kept, unless the page has an article, which then decides.
_MAIN = 3

# Elements by their part in a page.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "svg", "math")
APART = ("nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "head", "audio", "video", "canvas", "object")
IN_HEAD = ("title", "meta", "link", "style", "script", "base", "noscript", "template", "head")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
BLOCK = (
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
    "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
    "th", "thead", "tr", "ul",
)
# Elements that end where the next of their kind begins, and what they do not reach over.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}
ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar")
#: Words of class and id that mark a part as no article; the second row only outside one.
MARKS = (
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "sidebar", "aside", "menu", "nav", "navbar",
    "navigation", "breadcrumb", "breadcrumbs", "footer", "comment", "comments", "disqus", "respond", "replies", "newsletter",
    "subscribe", "signup", "login", "share", "sharing", "social", "related", "popup", "modal", "overlay", "pagination", "pager",
    "masthead", "topbar", "toolbar", "skip",
)
OUTER_MARKS = ("header", "search")

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _zone_of(tag: str, attributes: str, inside: bool) -> int | None:
    """What an element makes of the text in it; None if it changes nothing."""
    if tag in APART:
        return DROP
    if tag == "header" and not inside:
        return DROP
    if attributes and "=" in attributes or "hidden" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
            if name in ("class", "id"):
                words = re.split(r"[^a-z0-9]+", value)
                if any(w in MARKS or (w in OUTER_MARKS and not inside) for w in words):
                    return DROP
            elif name == "role" and value in ROLES or name == "hidden" or (name, value) == ("aria-hidden", "true"):
                return DROP
            elif name == "style" and _HIDDEN.search(value):
                return DROP
    if tag == "article" or tag == "main":
        return KEEP if tag == "article" else _MAIN
    return None


def blocks(page: str) -> list[tuple[str, int]]:
    """The text blocks of a page in order, each with its zone.

    References are decoded, white space is one space. Open elements form a stack; an end
    tag closes what it names, and nothing if that is not open.
    """
    found: list[tuple[str, int]] = []
    stack: list[tuple[str, int, bool]] = []  # tag, zone in it, if in an article or main part
    zone, inside, structured = OPEN, False, False
    text: list[str] = []
    at, size = 0, len(page)

    def flush():
        words = "".join(text).split()
        if words:
            found.append((" ".join(words), zone))
        text.clear()

    def state() -> tuple[int, bool]:
        return stack[-1][1:] if stack else (OPEN, False)

    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            text.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            text.append(html.unescape(page[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in BLOCK:
            flush()
        elif tag == "br":
            text.append(" ")
        if m[1]:
            if any(t == tag for t, *_ in stack):
                while stack.pop()[0] != tag:
                    pass
                if state() != (zone, inside):
                    flush()
                zone, inside = state()
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag not in IN_HEAD and stack and any(t == "head" for t, *_ in stack):
            while stack.pop()[0] != "head":  # the head ends where the body begins
                pass
        if tag in BLOCK:
            for n in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph
                if stack[n][0] == "p":
                    del stack[n:]
                    break
                if stack[n][0] in BLOCK:
                    break
        if tag in SIBLINGS:
            ends, limits = SIBLINGS[tag]
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] in ends:
                    del stack[n:]
                    break
                if stack[n][0] in limits:
                    break
        zone, inside = state()
        own = _zone_of(tag, m[3] or "", inside)
        if own is not None and own != zone and not (zone == DROP or (zone == KEEP and own == _MAIN)):
            flush()
            zone = own
        if tag in ("article", "main") and zone != DROP:
            inside = structured = True
        stack.append((tag, zone, inside))
    flush()
    main = OPEN if any(z == KEEP for _, z in found) else KEEP
    beside = DROP if structured else OPEN  # beside an article or main part nothing is open
    return [(t, {OPEN: beside, _MAIN: main}.get(z, z)) for t, z in found]


def common(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` that belong to a longest common subsequence with ``b``.

    Bit-parallel over ``b``: zero bits of a row count the length. Rows are kept at every
    root-th place and made again in between, so long pages need little memory.
    """
    both = set(a) & set(b)
    places = [i for i, x in enumerate(a) if x in both]
    b = [x for x in b if x in both]
    if not places:
        return []
    full = (1 << len(b)) - 1
    at: dict[int, int] = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j

    def after(row: int, i: int) -> int:
        hit = row & at[a[places[i]]]
        return ((row + hit) | (row - hit)) & full

    step = max(1, math.isqrt(len(places)))
    kept, row = [full], full
    for i in range(len(places)):
        row = after(row, i)
        if (i + 1) % step == 0:
            kept.append(row)
    found: list[int] = []
    j = len(b)
    i = len(places)
    while i > 0 and j > 0:
        base = (i - 1) // step
        rows = [kept[base]]
        for k in range(base * step, i):
            rows.append(after(rows[-1], k))
        while i > base * step and j > 0:
            now, above = rows[i - base * step], rows[i - base * step - 1]
            if now >> (j - 1) & 1:
                j -= 1
            elif not above >> (j - 1) & 1:
                i -= 1
            else:
                found.append(places[i - 1])
                i, j = i - 1, j - 1
    return found[::-1]


def shared_lines(lines: list[int], zones: list[int], before: list[int] | None, after: list[int] | None) -> list[int]:
    """Places of the open lines that the neighbours share.

    Deleted are open lines that both neighbours share, and runs of lines at the top or
    bottom of the open part that one of them shares. A single line amid others that only
    one neighbour has is more likely a phrase that two articles have in common. A
    neighbour that has four fifths of all lines of the page is a copy of it and says
    nothing alone.
    """
    given = [set(common(lines, n)) for n in (before, after) if n is not None]
    open_lines = [i for i, z in enumerate(zones) if z == OPEN]
    gone = given[0] & given[1] if len(given) == 2 else set()
    for shared in given:
        if len(shared) < 0.8 * len(lines):
            for run in (open_lines, open_lines[::-1]):
                for i in run:
                    if i not in shared:
                        break
                    gone.add(i)
    return [i for i in open_lines if i in gone]


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^#]*)", 1)


def _same() -> Column:
    nothing = F.lit("\0")
    return F.xxhash64(
        F.coalesce(F.col("url").cast("string"), nothing), F.coalesce(F.col("html").cast("string"), nothing)
    )


def _parse_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, zones = [], []
        for page in batch.column(4):
            got = blocks(page.as_py())
            lines.append([xxhash.xxh64_intdigest(t) - (1 << 63) for t, _ in got])
            zones.append([z for _, z in got])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(lines, pa.list_(pa.int64())), pa.array(zones, pa.list_(pa.int32()))],
            ["page_id", "same", "host", "path", "lines", "zones"],
        )


def _compare_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in ("lines", "zones", "before_lines", "after_lines")]
        gone = [shared_lines(*x) for x in zip(*columns, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(gone, pa.list_(pa.int32()))], ["page_id", "same", "gone"]
        )


def template_lines(pages: DataFrame) -> DataFrame:
    """(page_id, same, gone): the open lines of each page that its neighbours share.

    Only hashes of lines are moved. Places in the global order find the neighbours, so
    a host with any share of all pages is spread like the others.
    """
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    parsed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), _same().alias("same"), _host(url).alias("host"),
        _path(url).alias("path"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).transform(
        map_batches, _parse_task, "page_id long, same long, host string, path string, lines array<long>, zones array<int>"
    )
    # Written first: a range partitioning reads its input twice.
    order = in_order(stored(parsed, "lines"), F.col("host"), F.col("path"), F.col("page_id"), F.col("same"))
    order = stored(order.select("pos", "page_id", "same", "host", "lines", "zones"), "neighbours")
    asked = order.filter(F.exists("zones", lambda z: z == OPEN))
    for name, step in (("before", -1), ("after", 1)):
        other = order.select(
            (F.col("pos") - step).alias("pos"), F.col("host").alias(f"{name}_host"), F.col("lines").alias(f"{name}_lines")
        )
        asked = asked.join(other, "pos", "left").withColumn(
            f"{name}_lines", F.when(F.col(f"{name}_host") == F.col("host"), F.col(f"{name}_lines"))
        )
    compared = asked.select("page_id", "same", "lines", "zones", "before_lines", "after_lines").transform(
        map_batches, _compare_task, "page_id long, same long, gone array<int>"
    )
    # Rows equal in all columns have equal lines; one of them speaks for all.
    return compared.filter(F.size("gone") > 0).groupBy("page_id", "same").agg(F.first("gone").alias("gone"))


def _text_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, gone in zip(batch.column(2), batch.column(3), strict=True):
            gone = set(gone.as_py() or ())
            texts.append("\n\n".join(t for i, (t, z) in enumerate(blocks(page.as_py())) if z != DROP and i not in gone))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    A null page is empty and gives an empty text. Pages without a host (null or odd
    URLs) are a host of their own. Pages that tie in URL are ordered by page_id. A page
    alone on its host keeps its open lines. Rows equal in all columns get equal texts. An
    empty table gives no rows. Further columns are not looked at.
    """
    gone = stored(template_lines(pages), "template")
    gone = gone.select(F.col("page_id").alias("id_"), F.col("same").alias("same_"), "gone")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), _same().alias("same"),
    )
    joined = rows.join(gone, rows.page_id.eqNullSafe(gone.id_) & (rows.same == gone.same_), "left")
    return joined.select("page_id", "url", "html", "gone").transform(
        map_batches, _text_task, "page_id long, url string, text string, n_chars long"
    )
