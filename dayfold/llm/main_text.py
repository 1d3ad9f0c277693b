"""The main text of web pages: pages of one host are compared with those of the nearest URL, and what they share goes.

A page becomes lines, one per block of text, each in one of three places: inside the article as the markup names it
(``article``, else ``main`` or their roles), inside what is never main text (menus, headers, footers, sidebars, forms,
adverts, notices, comments, by element, role, or a word of its class or id), or open, which is the rest. Every page is
taken by difference: its lines and those of its neighbours by URL path are aligned by their longest common subsequence,
and the lines that are shared are deleted. What is left is then checked with the markup: what it says is never main text
goes; lines inside a named article are put back even if they are shared, since copies of an article, and passages that
many articles quote, are main text; so is a heading inside an article's header. Open lines are decided on by difference
alone, also those beside a named article.

Pages of one host are sorted by path (without scheme, port, query and fragment). Of the pages before and after, the one
whose path has more folders in common, from the first on, is compared first (the one before, if equal). Where the pages share more than
half of a page's open text they are taken for copies of one article, the other neighbour is tried, and if that is a copy
too, nothing is deleted. Pages of a host that equal each other line by line are compared once, and not with each other.

Only hashes of lines move between tasks. The pages are read twice, once for these and once for the texts.

Defined cases: a NULL html has an empty text; a page without a host (NULL or odd URL) is compared with the others without
one; rows that repeat each other wholly get equal results; text outside any block counts as a block.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.llm.common import attached, stored

ARTICLE, NEVER, OPEN = 0, 1, 2

# Elements of HTML by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br button cite code data del dfn em font i img input ins kbd label mark meter nobr "
    "output progress q rp rt ruby s samp select small span strike strong sub sup svg time tt u var wbr".split()
)
NEVER_TAGS = frozenset(
    "aside button canvas dialog fieldset footer form head header input label menu nav object option select svg".split()
)
NEVER_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
NEVER_WORDS = frozenset(
    "ad ads adslot adsense advert advertisement advertisements advertising adverts banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer gdpr header masthead menu menus modal nav navbar navigation newsletter "
    "notice notices notification pager pagination popup promo promoted promotion recommended related replies reply share "
    "sharing sidebar sidebars signup skip skyscraper social sponsor sponsored subscribe toolbar widget widgets".split()
)
#: Never taken out by class or id, which on these often tell what else the page has.
WHOLE = frozenset(("html", "body", "main"))
#: Open elements that the start of one of the given kinds ends.
CLOSED_BY = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>?""", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


def _place(name: str, attributes: str) -> int | None:
    """Where an element puts its text, if it says so."""
    if name in NEVER_TAGS:
        return NEVER
    place = ARTICLE if name in ("article", "main") else None
    if "=" in attributes:
        for kind, value in _ATTRIBUTE.findall(attributes):
            kind, value = kind.lower(), value.strip("\"'")
            if kind == "role":
                role = value.strip().lower()
                place = NEVER if role in NEVER_ROLES else ARTICLE if role in ("article", "main") else place
            elif kind == "itemprop":
                place = ARTICLE if "articlebody" in value.lower().split() else place
            elif name not in WHOLE:
                for one in value.split():
                    words = _WORD.findall(_CAMEL.sub("-", one).lower())
                    if words and words[0] not in ("no", "has", "with", "without") and not NEVER_WORDS.isdisjoint(words):
                        return NEVER
    return place


def lines_of(page: str) -> list[tuple[str, int]]:
    """The blocks of a page in order, white space in them made one blank, each with its place.

    Where the page names articles and a main part, only the articles count as article.
    """
    found: list[tuple[str, int, bool]] = []
    inline: list[str] = []
    # open elements: name, place of the text in them, whether an article element holds them
    stack: list[tuple[str, int, bool]] = [("", OPEN, False)]
    at = 0

    def end_line():
        if inline:
            text = " ".join(entities.unescape("".join(inline)).split())
            if text:
                found.append((text, stack[-1][1], stack[-1][2]))
            inline.clear()

    length = len(page)
    while at < length:
        sign = page.find("<", at)
        if sign != at:
            inline.append(page[at:sign] if sign >= 0 else page[at:])
        if sign < 0:
            break
        tag = _TOKEN.match(page, sign)
        if tag is None:
            inline.append("<")
            at = sign + 1
            continue
        at = tag.end()
        name = tag[2]
        if name is None:
            continue
        name = name.lower()
        if tag[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    end_line()
                    del stack[i:]
                    break
            else:
                if name not in INLINE:
                    end_line()
            continue
        if name in RAW:
            end = _ENDS[name].search(page, at)
            at = end.start() if end else length
            continue
        place = _place(name, tag[3])
        if name not in INLINE:
            end_line()
            if stack[-1][0] == "p" or stack[-1][0] in CLOSED_BY.get(name, ()):
                stack.pop()
            if name in CLOSED_BY and stack[-1][0] in CLOSED_BY[name]:
                stack.pop()
        elif name == "br":
            inline.append(" ")
        if name in VOID or (name in INLINE and place != NEVER):
            continue
        if place == NEVER and name in INLINE:
            end_line()
        _, outer, in_article = stack[-1]
        if outer == NEVER:
            # a heading in the header of an article is the article's own
            own = name in HEADINGS and stack[-1][0] == "header" and len(stack) > 1 and stack[-2][1] == ARTICLE
            stack.append((name, ARTICLE if own else NEVER, in_article))
        else:
            stack.append((name, outer if place is None else place, in_article or (place == ARTICLE and name == "article")))
    end_line()
    articles = any(inside and place == ARTICLE for _, place, inside in found)
    return [(text, OPEN if articles and place == ARTICLE and not inside else place) for text, place, inside in found]


def shared_lines(ours: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Which of ``ours`` belong to a longest common subsequence with ``theirs``."""
    shared = np.zeros(len(ours), bool)
    a, b = np.flatnonzero(np.isin(ours, theirs)), np.flatnonzero(np.isin(theirs, ours))
    low = 0
    while low < min(len(a), len(b)) and ours[a[low]] == theirs[b[low]]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and ours[a[-1 - high]] == theirs[b[-1 - high]]:
        high += 1
    shared[a[:low]] = True
    shared[a[len(a) - high :]] = True
    _align(ours, theirs, a[low : len(a) - high], b[low : len(b) - high], shared)
    return shared


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For every beginning of ``b`` the length of its longest common subsequence with ``a``, by rows of bits."""
    masks: dict[int, int] = {}
    for i, line in enumerate(b.tolist()):
        masks[line] = masks.get(line, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for line in a.tolist():
        hit = row & masks.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer((~row & full).to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.r_[0, np.cumsum(bits[: len(b)])]


def _align(ours: np.ndarray, theirs: np.ndarray, a: np.ndarray, b: np.ndarray, shared: np.ndarray) -> None:
    """Mark the lines of one longest common subsequence of ours[a] and theirs[b], halving ``a`` to keep memory linear."""
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if len(a) == 0 or len(b) == 0:
            continue
        if len(a) == 1:
            shared[a] |= (theirs[b] == ours[a[0]]).any()
            continue
        half = len(a) // 2
        front = _lengths(ours[a[:half]], theirs[b])
        back = _lengths(ours[a[half:]][::-1], theirs[b][::-1])[::-1]
        cut = int(np.argmax(front + back))
        todo += [(a[:half], b[:cut]), (a[half:], b[cut:])]


# The steps on Spark.

_LIGHT = "key bigint, host string, path string, lines array<bigint>, sizes array<int>, places array<tinyint>"


def _keyed(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, page, url, html): rows that repeat page, url and html share a key."""
    columns = [F.col(key).alias("page"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")]
    return pages.select(F.xxhash64(key, url, html).alias("key"), *columns)


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes, lengths and places of the lines of pages (key, host, path, html)."""
    import xxhash

    for batch in batches:
        lines, sizes, places = [], [], []
        for page in batch.column("html").to_pylist():
            found = lines_of(page)
            lines.append([xxhash.xxh64_intdigest(text) - (1 << 63) for text, _ in found])
            sizes.append([len(text) for text, _ in found])
            places.append([place for _, place in found])
        yield pa.record_batch(
            [
                *(batch.column(c) for c in ("key", "host", "path")),
                pa.array(lines, pa.list_(pa.int64())),
                pa.array(sizes, pa.list_(pa.int32())),
                pa.array(places, pa.list_(pa.int8())),
            ],
            names=["key", "host", "path", "lines", "sizes", "places"],
        )


def _neighbours(pages: DataFrame) -> DataFrame:
    """(key, before, after): the pages next to each by host and path.

    Pages are sorted in ranges, so a host may take any number of tasks; only the first and the last of each range look
    across its edge, through a table of these.
    """
    by = ["host", "path", "key"]
    dealt = pages.select(*by).repartitionByRange(*by).sortWithinPartitions(*by)
    dealt = stored(dealt.withColumn("at", F.monotonically_increasing_id()), "page-order")
    dealt = dealt.withColumn("task", F.shiftright("at", 33))
    page = F.struct("host", "path", "key")
    edges = dealt.groupBy("task").agg(F.min_by(page, "at").alias("low"), F.max_by(page, "at").alias("high"))
    across = edges.select(F.col("high").alias("page"), F.lead("low").over(Window.orderBy("task")).alias("other"))
    # within a range the page after each is the one with the next number
    after = dealt.select((F.col("at") - 1).alias("at"), page.alias("other"))
    pairs = dealt.select("at", page.alias("page")).join(after, "at").select("page", "other")
    pairs = pairs.union(across).where("page.host = other.host")
    both = pairs.select(F.col("page").alias("a"), F.col("other").alias("b"), F.lit(False).alias("is_before")).union(
        pairs.select(F.col("other"), F.col("page"), F.lit(True))
    )
    alike = F.expr(
        "if(a.path = b.path, size(split(a.path, '/')) + 1, "
        "array_position(zip_with(split(a.path, '/'), split(b.path, '/'), (x, y) -> x <=> y), false) - 1)"
    )
    return both.select(F.col("a.key").alias("key"), F.col("b.key").alias("other"), alike.alias("alike"), "is_before")


def _main_place(places: list[int]) -> int:
    """Where a page has its own text: in the article that it names, else in open lines."""
    return ARTICLE if ARTICLE in places else OPEN


def _deletions(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, gone): numbers of the lines that go, of pages (key, lines, sizes, places, others) with their neighbours'
    lines, the nearest first."""
    for batch in rows:
        keys, gone = [], []
        for row in batch.to_pylist():
            lines, own = np.array(row["lines"], np.int64), np.array(row["places"]) == _main_place(row["places"])
            sizes = np.array(row["sizes"], np.int64)
            for other in row["others"]:
                shared = shared_lines(lines, np.array(other, np.int64))
                if 2 * sizes[shared & own].sum() <= sizes[own].sum():
                    if shared.any():
                        keys.append(row["key"])
                        gone.append(np.flatnonzero(shared).astype(np.int32))
                    break
        yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], names=["key", "gone"])


def template_lines(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, gone): of every page, the numbers of the lines that it shares with its neighbours by URL, wherever they stand.
    Pages that lose nothing have no row."""
    keyed = _keyed(pages, key, url, html)
    light = keyed.select("key", _host(F.col("url")).alias("host"), _path(F.col("url")).alias("path"), "html")
    light = stored(light.mapInArrow(_fingerprints, _LIGHT), "page-lines").withColumn("content", F.xxhash64("lines", "places"))
    # of pages that equal each other line by line, the first by path stands for all of its host
    first = light.groupBy("host", "content").agg(F.min(F.struct("path", "key")).alias("first"))
    first = stored(first.select("host", "content", "first.*"), "page-contents")
    asked = light.where(F.size("lines") > 0)
    lines = light.select(F.col("key").alias("other"), F.col("lines").alias("other_lines")).dropDuplicates(["other"])
    near = _neighbours(first).join(asked.select("key", "lines", "sizes", "places").dropDuplicates(["key"]), "key")
    near = near.join(lines, "other")
    order = F.struct((-F.col("alike")).alias("x"), (~F.col("is_before")).alias("y"), F.col("other_lines"))
    near = near.groupBy("key").agg(
        *(F.first(c).alias(c) for c in ("lines", "sizes", "places")), F.sort_array(F.collect_list(order)).alias("o")
    )
    near = near.select("key", "lines", "sizes", "places", F.col("o.other_lines").alias("others"))
    found = stored(near.mapInArrow(_deletions, "key bigint, gone array<int>"), "page-templates")
    # and what holds for the first holds for its copies
    copies = attached(first.select("host", "content", "key"), found, "key", "inner").select("host", "content", "gone")
    copies = stored(copies, "page-copies")
    same = attached(asked.select("key", "host", "content").distinct(), copies, ["host", "content"], "inner")
    return stored(same.select("key", "gone"), "page-deletions")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, gone in zip(batch.column("html").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            lines = lines_of(page)
            gone = set(gone or ())
            # the difference, checked with the markup: lines of a named article are put back
            kept = [text for i, (text, place) in enumerate(lines) if place == ARTICLE or (place == OPEN and i not in gone)]
            texts.append("\n\n".join(kept))
        texts = pa.array(texts, pa.string())
        sizes = pc.utf8_length(texts).cast(pa.int64())
        yield pa.record_batch([batch.column("page"), batch.column("url"), texts, sizes], names=["page", "url", "text", "n_chars"])


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, ``url``, ``text`` and ``n_chars`` of every page: its blocks of main text, two line ends between them."""
    gone = template_lines(pages, key, url, html)
    with_gone = attached(_keyed(pages, key, url, html), gone, "key", "left").select("page", "url", "html", "gone")
    kind = pages.schema[key].dataType.simpleString()
    texts = with_gone.mapInArrow(_texts, f"page {kind}, url string, text string, n_chars bigint")
    return texts.select(F.col("page").alias(key), F.col("url").alias(url), "text", "n_chars")
