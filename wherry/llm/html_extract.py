"""Main text of web pages by differencing each page with its neighbours in URL order.

Every page is parsed into lines (its blocks of text, white space folded), once for its text and once for the hashes that its neighbours get. Pages are ordered by host, URL path and page_id; a page's neighbours
are the pages before and after it on its host, the one with the longer common beginning of the path first (the one before on ties). The
page's lines are aligned with the neighbour's by longest common subsequence, and shared lines are deleted: what a site repeats from page to
page is not the page's own text. If nothing would be left, the neighbour is a copy, and the other one is taken; if both are, nothing is deleted.

Passages that many articles quote are shared lines too, and a menu or a footer may be unlike its neighbour's. So an exact check on the markup
follows: lines inside a menu, header, footer, sidebar, notice, advert, form or reader comments are never kept; where the page marks its
article (article, main, role main), shared lines of it are put back and lines outside are dropped. Where it marks none, the differencing
decides, but for shared lines of PROSE_WORDS words and more, which are put back.

The order is made on narrow rows (host, path, hashes): dealt by range into tables of about RANGE_ROWS rows, written once, so that every later step
reads the same ranges; the driver holds the numbers of the ranges. The lines of a page, and the line hashes that go to its two neighbours, are
joined by two hashes of the page, so no host is hot. A page is known by its values; equal rows are one page in the joins.

Defined cases: a null html is empty and gives ''; a null or odd url has an empty host or path; of equal rows each gives a row; a page alone
on its host loses nothing by differencing; a very long page is parsed and aligned whole, in linear space; empty tables give empty results;
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wherry.llm.common import groups_for, slices
from wherry.session import materialize

RANGE_ROWS = 50_000
PROSE_WORDS = 25
#: Beyond so many cells two lists of lines are split before they are aligned.
DIRECT_BITS = 1 << 24

#: Element names of HTML.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template head title iframe object svg canvas math audio video map".split())
CHROME = frozenset("nav footer aside form menu dialog button select textarea fieldset".split())
ENDS_P = BLOCKS - {"body", "html", "title", "option", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SAME_ENDS = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "option": "select"}
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
CHROME_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|menubar|sidebar|footer|header|masthead|topbar|ad|ads|adv|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|banner"
    r"|cookie|cookies|consent|gdpr|notice|notices|popup|modal|overlay|comment|comments|respond|reply|replies|disqus|share|sharing|social|related|breadcrumb|breadcrumbs|newsletter|subscribe|subscription|signup|login|search|widget|widgets|pagination|pager)(?:$|[\s_-])",
    re.I,
)
CHROME_LINE, OPEN_LINE, MAIN_LINE = 0, 1, 2


class _Lines(HTMLParser):
    """Lines of a page with their zone. Hidden elements give none."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int]] = []  # name, hidden, zone
        self.hidden, self.zone = False, OPEN_LINE
        self.parts: list[str] = []
        self.lines: list[tuple[int, str]] = []

    def flush(self) -> None:
        if self.parts:
            if text := " ".join("".join(self.parts).split()):
                self.lines.append((self.zone, text))
            self.parts = []

    def _state(self) -> None:
        self.hidden, self.zone = self.stack[-1][1:] if self.stack else (False, OPEN_LINE)

    def _close(self, name: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == name:
                outer = self.stack[k - 1][2] if k else OPEN_LINE
                if outer != self.zone or any(x[0] in BLOCKS for x in self.stack[k:]):
                    self.flush()
                del self.stack[k:]
                self._state()
                return

    def _close_within(self, name: str, limits: str) -> None:
        stops = limits.split()
        for x in reversed(self.stack):
            if x[0] == name:
                self._close(name)
                return
            if x[0] in stops:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_P:
            self._close_within("p", "article section div td th li blockquote button main")
        if tag in SAME_ENDS:
            for name in ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,):
                self._close_within(name, SAME_ENDS[tag])
        if tag == "body":
            self._close("head")
        if tag in BLOCKS:
            self.flush()
        if tag in VOID:
            self.parts.append(" ")
            return
        known = dict(attrs)
        hidden = self.hidden or tag in HIDDEN or "hidden" in known or known.get("aria-hidden") == "true" or "display:none" in (known.get("style") or "").replace(" ", "").lower()
        zone, role = self.zone, (known.get("role") or "").lower()
        names = f"{known.get('class') or ''} {known.get('id') or ''}"
        if zone != CHROME_LINE:
            if tag in CHROME or role in CHROME_ROLES or (tag == "header" and zone != MAIN_LINE) or (tag not in ("body", "html") and CHROME_NAMES.search(names)):
                zone = CHROME_LINE
            elif tag in ("article", "main") or role in ("main", "article") or known.get("itemprop") == "articleBody":
                zone = MAIN_LINE
        if zone != self.zone:
            self.flush()
        self.stack.append((tag, hidden, zone))
        self.hidden, self.zone = hidden, zone

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML gives the slash no meaning

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self._close(tag)

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)


def page_lines(html: str | None) -> list[tuple[int, str]]:
    """(zone, line) of every visible block, in page order."""
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.lines


def _states(a: list[int], b: list[int]) -> Iterator[int]:
    """After each element of a: the columns where the longest common subsequence with b does not grow, as bits."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    whole = state = (1 << len(b)) - 1
    for x in a:
        same = state & where.get(x, 0)
        state = ((state + same) | (state - same)) & whole
        yield state


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """The length of a longest common subsequence of a and each beginning of b."""
    state = (1 << len(b)) - 1
    for state in _states(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(state.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _aligned(a: list[int], b: list[int], start: int) -> Iterator[int]:
    if len(a) * len(b) > DIRECT_BITS and len(a) > 1:  # split where both halves together are longest
        half = len(a) // 2
        at = int(np.argmax(_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]))
        yield from shared(a[:half], b[:at], start)
        yield from shared(a[half:], b[at:], start + half)
        return
    states, i, j = list(_states(a, b)), len(a), len(b)
    while i and j:
        if states[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or states[i - 1] >> (j - 1) & 1:
            j -= 1
            yield start + i


def shared(a: list[int], b: list[int], start: int = 0) -> set[int]:
    """Positions in a, counted from start, of a longest common subsequence with b."""
    low, high = 0, min(len(a), len(b))
    while low < high and a[low] == b[low]:
        low += 1
    tail = 0
    while tail < high - low and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    ends = {*range(start, start + low), *range(start + len(a) - tail, start + len(a))}
    return ends.union(_aligned(a[low : len(a) - tail], b[low : len(b) - tail], start + low))


def line_hashes(lines: list[tuple[int, str]]) -> list[int]:
    return [xxhash.xxh64_intdigest(t) >> 1 for _, t in lines]


def own_text(lines: list[tuple[int, str]], neighbours: list[list[int]]) -> tuple[str, int]:
    """The page's text after differencing and the check on markup, and how many lines differencing deleted."""
    hashes = line_hashes(lines)
    gone: set[int] = set()
    for other in neighbours:
        gone = shared(hashes, other)
        if any(zone != CHROME_LINE and i not in gone for i, (zone, _) in enumerate(lines)):
            break
    else:
        gone = set()  # copies, or nothing but what is never kept
    marked = any(zone == MAIN_LINE for zone, _ in lines)
    open_ = lambda i, t: not marked and (i not in gone or len(t.split()) >= PROSE_WORDS)
    kept = [t for i, (zone, t) in enumerate(lines) if zone == MAIN_LINE or (zone == OPEN_LINE and open_(i, t))]
    return "\n".join(kept), len(gone)


RESULT = {"page_id": pa.int64(), "url": pa.string(), "text": pa.string(), "n_chars": pa.int64(), "n_shared_lines": pa.int64()}
KEY = ["a", "b"]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """zones (a digit for each line) and lines (none has a newline inside, so they are one string)."""
    names = ["a", "b", "page_id", "url"]
    for batch in slices(batches, "html"):
        pages = [page_lines(html) for html in batch.column("html").to_pylist()]
        columns = [pa.array(["".join(str(z) for z, _ in x) for x in pages]), pa.array(["\n".join(t for _, t in x) for x in pages])]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *columns], names=[*names, "zones", "lines"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        hashes = pa.array([line_hashes(page_lines(html)) for html in batch.column("html").to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("qa"), batch.column("qb"), hashes], names=["qa", "qb", "hashes"])


def _nearness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a page (a, b, host, path, before, after) -> rows (qa, qb) of its neighbours on the host, with a, b and rank."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            near = [x for x in (r["before"], r["after"]) if x is not None and x["host"] == r["host"]]
            near.sort(key=lambda x: -len(commonprefix([r["path"], x["path"]])))
            rows += [(x["a"], x["b"], r["a"], r["b"], rank) for rank, x in enumerate(near)]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], pa.int64()) for k in range(5)], names=["qa", "qb", "a", "b", "rank"])


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            lines = list(zip(map(int, r["zones"]), r["lines"].split("\n")))
            text, n = own_text(lines, [x["hashes"] for x in r["near"] or []])
            rows += [(r["page_id"], r["url"], text, len(text), n)] * r["n"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(RESULT.values())], names=list(RESULT))


def _neighbours(pages: DataFrame) -> DataFrame:
    """qa, qb, a, b, rank: the neighbours (qa, qb) of each page (a, b), nearest first, of pages (a, b, host, path, page_id, url)."""
    order = ["host", "path", "page_id", "url", "a", "b"]
    ranges = groups_for(pages.count(), RANGE_ROWS)
    dealt, _ = materialize(pages.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "ranges")
    numbers = sorted(r["range"] for r in dealt.select("range").distinct().collect())
    page = F.struct("host", "path", "a", "b")
    ends = dealt.groupBy("range").agg(F.min_by(page, F.struct(*order)).alias("first"), F.max_by(page, F.struct(*order)).alias("last"))
    beside = pages.sparkSession.createDataFrame(list(zip(numbers, [None, *numbers], [*numbers[1:], None])), "range int, left int, right int")
    lasts, firsts = ends.select(F.col("range").alias("left"), F.col("last").alias("before_range")), ends.select(F.col("range").alias("right"), F.col("first").alias("after_range"))
    across = beside.join(lasts, "left", "left").join(firsts, "right", "left").select("range", "before_range", "after_range")
    inside = Window.partitionBy("range").orderBy(*order)
    rows = dealt.withColumns({"before": F.lag(page).over(inside), "after": F.lead(page).over(inside)}).join(across, "range")
    placed = rows.select("a", "b", "host", "path", F.coalesce("before", "before_range").alias("before"), F.coalesce("after", "after_range").alias("after"))
    return placed.mapInArrow(_nearness, "qa bigint, qb bigint, a bigint, b bigint, rank bigint")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and n_shared_lines (lines that differencing deleted at first) per row of pages."""
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)"
    url = F.coalesce("url", F.lit(""))
    known = [x for c in ("page_id", "url", "html") for x in (F.col(c), F.isnull(c))]  # a hash passes over nulls
    hashes = [F.xxhash64(*known).alias("a"), F.xxhash64(F.lit("b"), *known).alias("b")]
    address = [F.col("page_id").cast("bigint").alias("page_id"), F.col("url"), F.lower(F.regexp_extract(url, pattern, 1)).alias("host"), F.regexp_extract(url, pattern, 2).alias("path")]
    rows, _ = materialize(pages.select(*hashes, *address).groupBy("a", "b", "page_id", "url", "host", "path").agg(F.count("*").alias("n")), "addresses")
    parsed = pages.select(*hashes, *address[:2], F.col("html")).mapInArrow(_parsed, "a bigint, b bigint, page_id bigint, url string, zones string, lines string").dropDuplicates(KEY)
    told = pages.select(hashes[0].alias("qa"), hashes[1].alias("qb"), "html").mapInArrow(_hashed, "qa bigint, qb bigint, hashes array<bigint>").dropDuplicates(["qa", "qb"])
    wanted = _neighbours(rows.drop("n"))
    sent = told.join(wanted.hint("merge"), ["qa", "qb"]).select("a", "b", F.struct("rank", "hashes").alias("near"))
    near = sent.groupBy(*KEY).agg(F.sort_array(F.collect_list("near")).alias("near"))  # two at most
    both = parsed.join(rows.select(*KEY, "n").hint("merge"), KEY).join(near.hint("merge"), KEY, "left")
    return both.drop(*KEY).mapInArrow(_decided, "page_id bigint, url string, text string, n_chars bigint, n_shared_lines bigint")
