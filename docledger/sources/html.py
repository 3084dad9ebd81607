"""HTML tables and links as rows, by a streaming parser in the tasks."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse


class _Rows(HTMLParser):
    """Cells of table rows (text, tag, first link) and all anchors (href, text), in page order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[tuple[str, str, str | None]]] = []
        self.links: list[tuple[str, str]] = []
        self.cell: list | None = None
        self.link: list | None = None
        self.skip = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "tr":
            self._close()
            self.rows.append([])
        elif tag in ("td", "th"):
            self._close()
            self.cell = [tag, [], None]
        elif tag == "a":
            self.link = [dict(attrs).get("href") or "", []]
            if self.cell is not None and self.cell[2] is None:
                self.cell[2] = self.link[0]

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag in ("td", "th", "tr", "table"):
            self._close()
        elif tag == "a" and self.link is not None:
            self.links.append((self.link[0], " ".join("".join(self.link[1]).split())))
            self.link = None

    def handle_data(self, data: str) -> None:
        if not self.skip:
            if self.cell is not None:
                self.cell[1].append(data)
            if self.link is not None:
                self.link[1].append(data)

    def _close(self) -> None:
        if self.cell is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append((" ".join("".join(self.cell[1]).split()), self.cell[0], self.cell[2]))
            self.cell = None


def parse(html: str | None) -> _Rows:
    p = _Rows()
    p.feed(html or "")
    p.close()
    p._close()
    return p


def table_rows(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page id, row number, cells: array of struct(text, tag, href)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [
                (k, n, [{"text": t, "tag": g, "href": h} for t, g, h in row])
                for k, page in zip(b["id"], b["html"], strict=True)
                for n, row in enumerate(r for r in parse(page).rows if r)
            ]
            yield pd.DataFrame(out, columns=["id", "row", "cells"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    return rows.mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, row int, cells array<struct<text:string,tag:string,href:string>>").withColumnRenamed("id", id_col)


def links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page id, position, href, text of each anchor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(k, n, h, t) for k, page in zip(b["id"], b["html"], strict=True) for n, (h, t) in enumerate(parse(page).links)]
            yield pd.DataFrame(out, columns=["id", "pos", "href", "text"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    return rows.mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, pos int, href string, text string").withColumnRenamed("id", id_col)


def posts(rows: DataFrame, page: str = "page_id") -> DataFrame:
    """List pages: a post per row that links to one; the date-like cell, the department in the cell before; first per id."""
    from ..functions.dates import loose_date
    from ..functions.text import link_id
    from ..operators.catalog import first_per

    linked = rows.withColumn("at", F.get(F.filter("cells", lambda c: link_id(c["href"]).isNotNull()), 0)).filter("at IS NOT NULL")
    dated = F.transform("cells", lambda c: loose_date(c["text"]).isNotNull())
    where = F.array_position(dated, True)
    out = linked.select(
        page,
        "row",
        link_id(F.col("at.href")).alias("post_id"),
        F.col("at.text").alias("title"),
        F.col("at.href").alias("href"),
        F.when(where > 0, loose_date(F.get(F.col("cells"), (where - 1).cast("int"))["text"])).alias("published_date"),
        F.when(where > 1, F.get(F.col("cells"), (where - 2).cast("int"))["text"]).alias("department"),
    )
    return first_per(out, [page, "post_id"], [F.col("row")])


def directory(rows: DataFrame, page: str = "page_id") -> DataFrame:
    """Directory tables: a th with the name and at least three td, whose texts hold postal code and phone."""
    name = F.get(F.filter("cells", lambda c: c["tag"] == "th"), 0)["text"]
    cells = F.filter("cells", lambda c: c["tag"] == "td")
    text = F.array_join(F.transform(cells, lambda c: c["text"]), " ")
    out = rows.filter((F.size(F.filter("cells", lambda c: c["tag"] == "th")) > 0) & (F.size(F.filter("cells", lambda c: c["tag"] == "td")) >= 3))
    return out.select(
        page, "row", name.alias("name"), F.nullif(F.regexp_extract(text, r"\b(\d{5})\b", 1), F.lit("")).alias("postal_code"), F.nullif(F.regexp_extract(text, r"(\d{2,3}-\d{3,4}-\d{4})", 1), F.lit("")).alias("phone")
    )


def labelled(rows: DataFrame, label: str, page: str = "page_id") -> DataFrame:
    """page, value: text of the first cell behind one that holds just the label, in page order; empty values don't count."""
    at = F.array_position(F.transform("cells", lambda c: collapse(c["text"]) == label), True)
    value = F.when(at > 0, collapse(F.get("cells", at.cast("int"))["text"]))
    found = rows.select(page, "row", value.alias("value")).filter("value <> ''")
    return found.groupBy(page).agg(F.min_by("value", "row").alias("value"))


# Paths, query keys and the closing label of attachment links.
DOWNLOAD, ATTACHMENT = r"(?:download|atchFileDownload)\.do", r"/(\d+)/(?:download|atchFileDownload)\.do"
ATTACHMENT_KEYS, VIEW_LABEL = ("fileSeq", "atchFileId", "fileId"), r"\s*바로보기\s*$"


def attachments(anchors: DataFrame, base: Column, page: str = "page_id") -> DataFrame:
    """page, attachment_id, filename, url: links to files, each id once (its first link), without the label for viewing.

    anchors: page, pos, href, text and what `base` needs. The id is a part of the path or of the query, else the URL.
    """
    from ..functions.text import absolute_url
    from ..operators.catalog import first_per

    url = absolute_url(F.col("href"), base)
    ways = [F.regexp_extract("href", ATTACHMENT, 1), *[F.regexp_extract("href", rf"[?&]{k}=([^&#]+)", 1) for k in ATTACHMENT_KEYS]]
    ident = F.coalesce(*[F.nullif(w, F.lit("")) for w in ways], url)
    rows = anchors.filter(F.col("href").rlike(DOWNLOAD)).select(page, "pos", ident.alias("attachment_id"), url.alias("url"), F.trim(F.regexp_replace(collapse(F.col("text")), VIEW_LABEL, "")).alias("name"))
    named = F.coalesce(F.nullif("name", F.lit("")), F.concat(F.lit("attachment-"), "attachment_id"))
    return first_per(rows, [page, "attachment_id"], [F.col("pos")]).select(page, "attachment_id", named.alias("filename"), "url")


def named_links(anchors: DataFrame, names: DataFrame, name: str, page: str = "page_id") -> DataFrame:
    """page, name, href: the first link whose text is a name, or begins with it and a parenthesis; spaces don't count."""
    key = F.regexp_extract(F.replace("text", F.lit(" "), F.lit("")), r"^([^(]*)", 1)
    keyed = anchors.select(page, "pos", "href", key.alias(name)).join(names.select(name).distinct(), name)
    return keyed.groupBy(page, name).agg(F.min_by("href", "pos").alias("href"))


def own_host_link(anchors: DataFrame, base: Column, wanted: Column, page: str = "page_id") -> DataFrame:
    """page, target: the first link with the wanted text whose host is the page's own; hosts that can't be told never agree."""
    from ..functions.text import absolute_url

    host = lambda u: F.nullif(F.lower(F.regexp_extract(u, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1)), F.lit(""))
    target = absolute_url(F.col("href"), base)
    rows = anchors.filter(wanted).select(page, "pos", target.alias("target"), (host(target) == host(base)).alias("same"))
    return rows.filter("same").groupBy(page).agg(F.min_by("target", "pos").alias("target"), F.count(F.lit(1)).alias("n"))


# How a page's script sets its marker.
MARKER = r"position\s*=\s*new\s+(?:kakao|daum)\.maps\.LatLng\(\s*([+-]?\d+(?:\.\d+)?)\s*,\s*([+-]?\d+(?:\.\d+)?)\s*\)"


def marker(html: Column) -> Column:
    """struct(lat, lon) of the marker that a page's script sets, if it is exactly one distinct point."""
    parts = [F.transform(F.regexp_extract_all(html, F.lit(MARKER), F.lit(k)), lambda x: x.cast("double")) for k in (1, 2)]
    found = F.array_distinct(F.zip_with(*parts, lambda a, b: F.struct(a.alias("lat"), b.alias("lon"))))
    return F.when(F.size(found) == 1, F.get(found, 0))
