"""Main text of web pages by nearest-URL page differencing, with markup as a guard.

1. Lines. A page becomes lines, one for the text of each block element: character references decoded, white space turned
   into one space, trimmed. What stands in elements or classes for menus, headers, footers, sidebars, notices, adverts, forms,
   scripts, styles and comments goes; where a page marks its main region (article, main or their roles), lines outside go.
2. Pairs. Pages are ordered by host and URL path, in ranges of equal size over the cluster (a host that holds a third of
   all pages is spread over many ranges). The page of the same host whose path shares the longest beginning stands next to it in
   that order, before or after; pages at the border of a range are compared with those of the next range in a second step.
3. Differencing. The lines of a page and of its nearest one are aligned by longest common subsequence; shared lines are
   deleted. A marked main region is the article by its author's word, and its lines stay.

Differencing alone deletes the articles of pages that are copies of each other. So a shared line goes only if it is a
template line of its host: it stands on two pages or more that have bodies of their own, which are pages with two lines or
more, and a quarter of their text, that no other page of the host has; copies and near copies (another date, another advert)
have not.

Only hashes of lines are shuffled; texts of pages with deleted lines are made again in a second scan.

Defined results: null html is the empty page and has the empty text. A page without a neighbour is judged by markup alone. A null
url has the empty host and path. Repeated rows get a row each. Extra columns are ignored. Markup that isn't closed runs to
the end of the page, a tag that isn't closed is text. A page is parsed in time and memory in proportion to its length.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import cut

#: Quotes count only behind an equals sign.
OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+)>")
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object canvas xmp noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements that end where their parent does or the next of their kind starts.
IMPLIED = frozenset("p li dt dd tr td th option tbody thead tfoot".split())
OUT = frozenset("head nav footer aside form menu dialog button select fieldset".split())
MAIN = frozenset(("article", "main"))
#: A class, id or role is excluded if all its words are in one of these lists, one of them not in the second; and as below.
OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner sidebar widget related recommended cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription signup login comment comments respond disqus breadcrumb breadcrumbs menu menus nav navbar "
    "navigation footer pagination pager copyright skip complementary contentinfo dialog".split()
)
PLAIN_WORDS = frozenset("area bar block body bottom box container content global group header holder inner item items left list main outer page panel posts right row section site slot text top unit wrap wrapper".split())
#: Only outside a main region: inside one, these are parts of the article or its subject.
HEADER_WORDS = frozenset("header masthead topbar banner share sharing social search form alert".split())
#: A name that ends with one of these, or begins with one of the second list, is excluded whatever else it says ("post-comments",
#: "google-ads", "disqus_thread"), but for names that tell of something elsewhere ("has-sidebar").
LAST_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion sidebar related recommended cookie cookies consent gdpr popup modal newsletter subscribe "
    "subscription signup login comment comments respond disqus breadcrumb breadcrumbs nav navbar navigation footer pagination pager copyright".split()
)
FIRST_WORDS = frozenset("disqus advert advertisement sponsored cookie cookies gdpr newsletter comments breadcrumb breadcrumbs pagination".split())
ELSEWHERE = frozenset("has have with without no not is hide show before after above below near".split())
#: Names of nothing but these are buttons for sharing, inside a main region too.
SHARE_WORDS = frozenset("share shares sharing social".split())
SHARE_MORE = frozenset("button buttons link links icon icons bar list tools widget follow this post article page top bottom inline sticky".split())
WORD = re.compile(r"[a-z]{2,}")
#: A page with a body of its own has so many lines, and one part in so many of its text, that no other page of its host has.
OWN_LINES, OWN_PART = 2, 4
#: Lines that stand more often than this in a page get a bit set of their places for the whole alignment.
OFTEN = 64


@dataclass
class Line:
    text: str
    main: bool


def tokens(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """(text, "", "", False) and ("", name, attributes, closing) in order. Comments and declarations are left out."""
    pos, size = 0, len(page)
    quotes = True  # whether quotes in tags still pair up
    last = page.rfind(">")
    while pos < size:
        at = page.find("<", pos)
        if at < 0 or at > last:
            yield page[pos:], "", "", False
            return
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            nxt = size if end < 0 else end + 3
        elif page[at + 1 : at + 2] in ("!", "?"):
            nxt = page.index(">", at) + 1
        else:
            m = OPEN.match(page, at) if quotes else None
            if not m and (short := NAME.match(page, at)):
                quotes = False  # a quote that nothing closes: from here on tags end at the first >
                end = page.index(">", short.end())
                m = (page[at : end + 1], short[1], short[2], page[short.end() : end])
            if not m:
                yield page[pos : at + 1], "", "", False
                pos = at + 1
                continue
            if at > pos:
                yield page[pos:at], "", "", False
            name, pos = m[2].lower(), at + len(m[0])
            if not m[1] and name in RAW:
                pos = _raw_end(page, name, pos)
            else:
                yield "", name, m[3], bool(m[1])
            continue
        if at > pos:
            yield page[pos:at], "", "", False
        pos = nxt


def _raw_end(page: str, name: str, pos: int) -> int:
    """Where the closing tag of raw text ends."""
    found = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, pos)
    end = page.find(">", found.end()) if found else -1
    return len(page) if end < 0 else end + 1


def attributes(text: str) -> tuple[set[str], bool, bool]:
    """Excluding words of class, id and role; hidden; the role of a main region."""
    words, hidden, main = set(), False, False
    for m in ATTRIBUTE.finditer(text):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name in ("class", "id", "role"):
            for token in value.split():
                parts = WORD.findall(token)
                if not parts:
                    continue
                if all(x in OUT_WORDS or x in PLAIN_WORDS or x in HEADER_WORDS for x in parts):
                    words.update(x for x in parts if x in OUT_WORDS or x in HEADER_WORDS)
                elif (parts[-1] in LAST_WORDS or parts[0] in FIRST_WORDS) and ELSEWHERE.isdisjoint(parts):
                    words.add(parts[-1] if parts[-1] in LAST_WORDS else parts[0])
                if not SHARE_WORDS.isdisjoint(parts) and all(x in SHARE_WORDS or x in SHARE_MORE or x in PLAIN_WORDS for x in parts) and not {"share", "shares", "sharing"}.isdisjoint(parts):
                    words.add("sharing buttons")
            main = main or name == "role" and value.strip() == "main"
    return words, hidden, main


def lines_of(page: str) -> tuple[list[Line], bool]:
    """Lines outside excluded markup, and whether the page marks a main region."""
    out: list[Line] = []
    held: list[str] = []
    main: list[str] = []  # open main regions, by name
    regions: Counter = Counter()  # how many of each name
    opened: Counter = Counter()  # open elements outside excluded ones
    within: Counter = Counter()  # open elements inside the excluded one
    skip, marked, at = "", False, 0

    def close() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append(Line(text, bool(main)))
            held.clear()

    def ends_skip(name: str, closing: bool) -> bool:
        """Whether the excluded element ends before this tag, without a closing tag of its own."""
        if closing:
            return name not in INLINE and not within[name] and (skip in INLINE or name not in IMPLIED) and opened[name] > 0
        if within.total():
            return False
        return skip == "p" and name not in INLINE and name not in VOID or skip in IMPLIED and name == skip

    for text, name, attrs, closing in tokens(page):
        if text:
            if not skip:
                held.append(text)
            continue
        if skip:
            if ends_skip(name, closing):
                skip = ""
            else:
                if name in VOID:
                    continue
                if not closing:
                    within[name] += name == skip or skip in INLINE or name not in INLINE and name not in IMPLIED
                elif within[name]:
                    within[name] -= 1
                elif name == skip and not (skip in IMPLIED and within.total()):
                    skip = ""
                continue
        if name == "br":
            held.append(" ")
            continue
        block = name not in INLINE
        if block:
            close()
        if closing:
            opened[name] -= opened[name] > 0
            if name in MAIN and regions[name]:
                while (last := main.pop()) != name:
                    regions[last] -= 1
                regions[name] -= 1
            elif main and name == main[-1].partition(" ")[2]:
                at -= 1
                if not at:
                    main.pop()
            continue
        if name in VOID:
            continue
        words, hidden, role = attributes(attrs) if attrs else (set(), False, False)
        bad = name in OUT or hidden or words & OUT_WORDS or "sharing buttons" in words or not main and (name == "header" or words & HEADER_WORDS)
        if bad and name not in ("html", "body", *MAIN):
            skip = name
            within.clear()
            continue
        opened[name] += 1
        if name in MAIN:
            main.append(name)
            regions[name] += 1
            marked = True
        elif role and not main:
            main.append(f"role {name}")
            marked, at = True, 1
        elif main and name == main[-1].partition(" ")[2]:
            at += 1
    close()
    return out, marked


def page_lines(page: str) -> tuple[list[str], bool]:
    """The lines that markup leaves, and whether the page marks a main region."""
    lines, marked = lines_of(page)
    return [x.text for x in lines if x.main or not marked], marked


class _Places:
    """Bit sets of the places of symbols in a sequence; those of rare symbols are made when asked for."""

    def __init__(self, b: list):
        self.at: dict = {}
        for k, x in enumerate(b):
            self.at.setdefault(x, []).append(k)
        self.often = {x: self._bits(ks) for x, ks in self.at.items() if len(ks) > OFTEN}

    @staticmethod
    def _bits(places: list[int]) -> int:
        row = bytearray(places[-1] // 8 + 1)
        for k in places:
            row[k >> 3] |= 1 << (k & 7)
        return int.from_bytes(row, "little")

    def __getitem__(self, x: object) -> int:
        return self.often[x] if x in self.often else self._bits(self.at[x]) if x in self.at else 0


def _lengths(a: list, b: list) -> np.ndarray:
    """Lengths of longest common subsequences of a and the first j of b, for j from 0."""
    full, places = (1 << len(b)) - 1, _Places(b)
    v = full
    for x in a:
        if u := v & places[x]:
            v = (v + u | v - u) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common(a: list, b: list) -> set[int]:
    """Positions in a that a longest common subsequence of a and b takes, in memory in proportion to their lengths.

    Both are halved again and again where the lengths of the halves' subsequences add up to most; lengths come a row at a time, as a bit set.
    """
    out: set[int] = set()
    todo = [(0, a, b)]
    while todo:
        at, a, b = todo.pop()
        n = 0
        while n < len(a) and n < len(b) and a[n] == b[n]:
            n += 1
        out.update(range(at, at + n))
        m = 0
        while m < len(a) - n and m < len(b) - n and a[-1 - m] == b[-1 - m]:
            m += 1
        out.update(range(at + len(a) - m, at + len(a)))
        at, a, b = at + n, a[n : len(a) - m], b[n : len(b) - m]
        if not a or not b:
            continue
        if len(a) == 1:
            if a[0] in b:
                out.add(at)
            continue
        mid = len(a) // 2
        k = int((_lengths(a[:mid], b) + _lengths(a[mid:][::-1], b[::-1])[::-1]).argmax())
        todo += [(at, a[:mid], b[:k]), (at + mid, a[mid:], b[k:])]
    return out


def _hash(text: str) -> int:
    x = xxhash.xxh3_64_intdigest(text.encode())
    return x - (1 << 64) if x >> 63 else x


def _prefix(a: str, b: str) -> int:
    """Characters that both begin with."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


ROW = "key bigint, host string, path string, marked boolean, lines array<bigint>, near int, shared array<bigint>, border boolean"
_KINDS = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.int64()), pa.bool_()]


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of pages in order, each with what it shares with the nearest page beside it, if that is nearer than `near`."""
    names = ["key", "host", "path", "marked", "lines", "near", "shared", "border"]
    wait, link, first = None, None, True  # the row before, and how near it and what follows are

    def done(row: dict, before: tuple | None, after: tuple | None, border: bool) -> tuple:
        near, lines = max((x for x in (before, after) if x), key=lambda x: x[0], default=(-1, None))
        if near > row["near"]:
            shared = common(row["lines"], lines)
            row["near"], row["shared"] = near, sorted({row["lines"][k] for k in shared})
        return *(row[n] for n in names[:-1]), border

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _KINDS, strict=True)], names)

    for b in slices(batches):
        rows = []
        for row in b.to_pylist():
            if wait:
                same = _prefix(wait["path"], row["path"]) if wait["host"] == row["host"] else None
                rows.append(done(wait, link, None if same is None else (same, row["lines"]), first))
                link, first = None if same is None else (same, wait["lines"]), False
            wait = row
        yield batch(rows)
    if wait:
        yield batch([done(wait, link, None, True)])


def template_lines(pages: DataFrame) -> DataFrame:
    """host and hash of each line that two pages or more with bodies of their own have; copies are one page."""
    rows = pages.select("host", F.xxhash64("lines").alias("page"), F.explode(F.arrays_zip("lines", "sizes")).alias("x"))
    rows = rows.select("host", "page", F.col("x.lines").alias("line"), F.col("x.sizes").alias("n")).distinct()
    lone = rows.groupBy("host", "line").agg(F.count(F.lit(1)).alias("k"), F.min("page").alias("page"), F.min("n").alias("n")).filter("k = 1")
    own = lone.groupBy("host", "page").agg(F.sum("n").alias("own"), F.count(F.lit(1)).alias("k")).filter(F.col("k") >= OWN_LINES)
    whole = rows.groupBy("host", "page").agg(F.sum("n").alias("whole"))
    voters = own.join(whole, ["host", "page"]).filter(F.col("own") * OWN_PART >= F.col("whole")).select("host", "page")
    return rows.join(voters, ["host", "page"]).groupBy("host", "line").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("host", "line")


def deletions(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """key, gone: hashes of the lines that go from a page. lines: key, host, path, marked, lines, sizes of each page."""
    keys = ("host", "path", "key")
    ordered = lines.select("key", "host", "path", "marked", "lines", F.lit(-1).alias("near"), F.lit(None).cast("array<bigint>").alias("shared"), F.lit(False).alias("border"))
    ranges = ordered.repartitionByRange(partitions, *keys) if partitions else ordered.repartitionByRange(*keys)
    inside = cut(ranges.sortWithinPartitions(*keys).mapInArrow(_nearest, ROW), "pages-near")
    # the first and the last page of each range, in one sorted list of two rows a range
    across = inside.filter("border").repartition(1).sortWithinPartitions(*keys).mapInArrow(_nearest, ROW)
    shared = inside.filter("NOT border").unionByName(across).filter("size(shared) > 0 AND NOT marked").select("key", "host", F.explode("shared").alias("line"))
    # a template line stands on very many pages, so it meets them in 16 parts
    parts = template_lines(lines).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(15))))
    hits = shared.withColumn("part", F.pmod("key", F.lit(16)).cast("int")).join(parts, ["host", "line", "part"])
    return hits.groupBy("key").agg(F.collect_set("line").alias("gone"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", partitions: int | None = None) -> DataFrame:
    """One row per row of pages: id, url, text, n_chars, n_deleted (lines that differencing took). partitions: ranges of pages."""

    def parts(text: Column) -> Column:
        return F.coalesce(text.cast("string"), F.lit(""))

    url = parts(F.col(url_col))
    source = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.xxhash64(F.col(id_col).cast("string"), url, parts(F.col(html_col))).alias("key"),
        F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1).alias("path"),
        parts(F.col(html_col)).alias("html"),
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [page_lines(page) for page in b.column(3).to_pylist()]
            out = [[m for _, m in found], [[_hash(x) for x in lines] for lines, _ in found], [[len(x) for x in lines] for lines, _ in found]]
            kinds = [pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *map(pa.array, out, kinds)], ["key", "host", "path", "marked", "lines", "sizes"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, taken = [], []
            for page, gone in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                lines, left = page_lines(page)[0], set(gone or ())
                kept = [x for x in lines if _hash(x) not in left] if left else lines
                texts.append("\n".join(kept))
                taken.append(len(lines) - len(kept))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(taken, pa.int64())], ["id", "url", "text", "n_deleted"])

    lines = cut(source.select("key", "host", "path", "html").mapInArrow(read, "key bigint, host string, path string, marked boolean, lines array<bigint>, sizes array<int>"), "pages-lines")
    gone = cut(deletions(lines, partitions), "pages-gone")
    kind = source.schema["id"].dataType.simpleString()
    out = source.join(gone, "key", "left").select("id", "url", "html", "gone").mapInArrow(write, f"id {kind}, url string, text string, n_deleted bigint")
    return out.select("id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_deleted")
