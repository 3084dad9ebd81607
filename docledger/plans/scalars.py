"""Scalar queries: strings, dates, names, URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import rules as R
from ..functions import text as T
from ..session import table
from ..sources import html as H
from .registry import query


@query("""
    SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS page,
      coalesce(nullif(regexp_extract(url, '/([0-9]+)[^/0-9]*$', 1), ''), nullif(regexp_extract(url, '/([0-9]+)', 1), '')) AS number, regexp_extract(url, '\\.([a-z]+)(?:[?#].*)?$', 1) = 'html' AS is_html FROM pages
""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    number = F.coalesce(F.nullif(F.regexp_extract(u, r"/([0-9]+)[^/0-9]*$", 1), F.lit("")), F.nullif(F.regexp_extract(u, "/([0-9]+)", 1), F.lit("")))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.try_parse_url(u, F.lit("PROTOCOL")).alias("scheme"),
        F.try_parse_url(u, F.lit("HOST")).alias("host"),
        F.try_parse_url(u, F.lit("QUERY"), F.lit("page")).alias("page"),
        number.alias("number"),
        (T.extension(u, ("html",)) == "html").alias("is_html"),
    )


@query("""
    WITH l AS (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root FROM pages),
         e AS (SELECT page_id, root, generate_subscripts(links, 1) - 1 AS pos, unnest(links) AS link FROM l)
    SELECT page_id, pos::INT AS pos, IF(link LIKE '/%', root || link, link) AS target FROM e
""")
def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.posexplode(links).alias("pos", "link"))
    return rows.select("page_id", "pos", T.absolute_url(F.col("link"), F.col("url")).alias("target"))


@query(r"""
    WITH l AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS t FROM pages),
         e AS (SELECT page_id, root, unnest(h) AS href, unnest(t) AS text, generate_subscripts(h, 1) AS pos FROM l)
    SELECT page_id, arg_min(root || href, pos) AS first_link, count(*) AS n FROM e WHERE text LIKE 't%' AND href LIKE '/%' GROUP BY 1
""")
def link_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First link of a page on its own host whose text starts with a letter. Links to other hosts and to none are planted before."""
    foreign = F.lit('<a href="https://elsewhere.org/t">too far</a><a href="http://">to nowhere</a><a href="mailto:t@h.org">to someone</a>')
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.concat(foreign, "html").alias("html"))
    anchors = H.links(pages).join(pages.select("page_id", "url"), "page_id")
    return H.own_host_link(anchors, F.col("url"), F.col("text").startswith("t")).select("page_id", F.col("target").alias("first_link"), "n")


@query("""
    SELECT doc_id, split_part(text, chr(10), 1) ILIKE '%the%' AS hit, coalesce(nullif(regexp_extract(text, '^\\s*\\[([^\\]]*)\\]', 1), ''), 'unknown') AS prefix FROM documents
""")
def title_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.split_part("text", F.lit("\n"), F.lit(1))
    return table(spark, sf_dir, "documents").select("doc_id", F.lower(first).contains("the").alias("hit"), T.bracket_prefix(F.col("text")).alias("prefix"))


@query("""
    SELECT p_partkey, replace(p_name, ' ', '') AS compact, CASE WHEN p_type LIKE '%Y' THEN 'class-y' WHEN p_type LIKE '%L' THEN 'class-l' ELSE 'other' END AS kind,
      CASE WHEN p_name LIKE '%red%' THEN 'warm' WHEN p_name LIKE '%blue%' OR p_name LIKE '%green%' THEN 'cold' END AS tone FROM part
""")
def label_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        T.squeeze(F.col("p_name")).alias("compact"),
        T.ends_label(F.col("p_type"), {"Y": "class-y", "L": "class-l"}).alias("kind"),
        T.contains_label(F.col("p_name"), {"warm": ("red",), "cold": ("blue", "green")}).alias("tone"),
    )


@query("""
    SELECT p_partkey, regexp_replace(regexp_replace(lower(p_brand), '[0-9]+', '#', 'g'), '[\\s_.-]+', ' ', 'g') AS pattern,
      trim(regexp_replace(lower(p_name || '/' || p_brand), '[^0-9a-z]+', '-', 'g'), '-') AS slug, regexp_replace(p_brand || ' <' || p_name || '>?', '[<>:"/\\\\|?*]', '_', 'g') AS safe FROM part
""")
def name_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        T.name_pattern(F.col("p_brand")).alias("pattern"),
        T.slug(F.concat("p_name", F.lit("/"), "p_brand")).alias("slug"),
        T.safe_filename(F.concat("p_brand", F.lit(" <"), "p_name", F.lit(">?"))).alias("safe"),
    )


@query("""
    SELECT page_id, CASE WHEN url LIKE '%.html%' THEN page_id % 3 = 1 ELSE FALSE END AS mismatch FROM pages
""")
def mime_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared types by page: right, wrong or generic; only .html pages can mismatch."""
    mime = F.get(F.array(F.lit("text/html; charset=utf-8"), F.lit("application/pdf"), F.lit("application/octet-stream")), (F.col("page_id") % 3).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", R.mime_mismatch(T.extension(F.col("url"), ("html",)), mime, {"html": ("text/html", "application/xhtml+xml")}).alias("mismatch"))


@query("""
    SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, o_orderdate::DATE::VARCHAR AS loose FROM orders
""")
def text_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods and dates from free text with two-digit years and other separators."""
    o = table(spark, sf_dir, "orders")
    short = F.when(F.year("o_orderdate") >= 2000, F.date_format("o_orderdate", "yy년 M월 식단표")).otherwise(F.date_format("o_orderdate", "M월 표"))
    ym = D.year_month(short, F.year("o_orderdate"))
    loose = D.loose_date(F.concat(F.lit("posted "), F.date_format("o_orderdate", "yyyy.M/d")))
    loose = F.coalesce(loose, D.loose_date(F.date_format("o_orderdate", "yyyy.M.d")))
    return o.select("o_orderkey", ym["year"].alias("year"), ym["month"].alias("month"), loose.cast("string").alias("loose"))


@query("""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderdate::DATE WHEN 1 THEN make_date(2024, month(o_orderdate), least(day(o_orderdate), 28)) WHEN 2 THEN make_date(2024, 5, day(o_orderdate)) END::VARCHAR AS day FROM orders
""")
def cell_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of cells that hold a whole date, a month and a day, a day, or none; in a sheet of May 2024."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    short = F.concat_ws("/", F.month(d), F.least(F.dayofmonth(d), F.lit(28)))
    text = F.when(k == 0, F.date_format(d, "yyyy. M. d")).when(k == 1, short).when(k == 2, F.concat(F.dayofmonth(d).cast("string"), F.lit("일"))).otherwise("menu")
    return table(spark, sf_dir, "orders").select("o_orderkey", D.cell_date(text, F.lit(2024), F.lit(5)).cast("string").alias("day"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 40 BETWEEN 1 AND 29 THEN make_date(2024, 2, (o_orderkey % 40)::INT)::VARCHAR WHEN o_orderkey % 40 = 0 OR o_orderkey % 40 BETWEEN 30 AND 39 THEN NULL END AS small,
      (DATE '1899-12-30' + (60 + o_orderkey % 50000)::INT)::VARCHAR AS serial FROM orders
""")
def serial_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as dates: day of February 2024 where there is one, spreadsheet serials from 60."""
    y, m = F.lit(2024), F.lit(2)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        D.serial_date((F.col("o_orderkey") % 40).cast("double"), y, m).cast("string").alias("small"),
        D.serial_date((F.col("o_orderkey") % 50000 + 60).cast("double"), y, m).cast("string").alias("serial"),
    )


@query("""
    SELECT o_orderkey, (isodow(o_orderdate) - 1)::INT AS weekday, isodow(o_orderdate) - 1 <> o_orderkey % 7 AS mismatch, year(o_orderdate) <> 1998 OR month(o_orderdate) <> 5 AS outside FROM orders
""")
def weekday_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.weekday(d).alias("weekday"), (F.weekday(d) != F.col("o_orderkey") % 7).alias("mismatch"), ((F.year(d) != 1998) | (F.month(d) != 5)).alias("outside")
    )


@query("""
    SELECT page_id, IF(regexp_matches(t, '[0-9]{3}'), '', array_to_string(list_transform(list_filter(string_split_regex(t, '[^0-9]+'), lambda x: try_cast(x AS BIGINT) BETWEEN 1 AND 31), lambda x: x::INT::VARCHAR), ',')) AS days
    FROM (SELECT page_id, IF(page_id % 2 = 0, url, page_id % 40 || '일, ' || page_id % 29 || '/' || page_id % 7) AS t FROM pages)
""")
def days_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day numbers of URLs, where three digits in a row leave none, and of lists of days."""
    k = F.col("page_id")
    listed = F.concat((k % 40).cast("string"), F.lit("일, "), (k % 29).cast("string"), F.lit("/"), (k % 7).cast("string"))
    p = table(spark, sf_dir, "pages").select("page_id", F.when(k % 2 == 0, F.col("url")).otherwise(listed).alias("t"))
    return p.select("page_id", F.array_join(F.transform(D.days_in_text(F.col("t")), lambda d: d.cast("string")), ",").alias("days"))


@query("""
    SELECT user_id, max(ts)::DATE::VARCHAR AS last_success, coalesce(floor((epoch(TIMESTAMP '2024-01-31') - epoch(max(ts))) / 86400) >= 7, TRUE) AS stale
    FROM (SELECT user_id, IF(event_type = 'purchase', ts, NULL) AS ts FROM events) GROUP BY 1
""")
def health_gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last"))
    return e.select("user_id", F.to_date("last").cast("string").alias("last_success"), D.stale(F.col("last"), F.lit("2024-01-31").cast("timestamp"), 7).alias("stale"))


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n, chr(64 + l_linenumber::INT) || (l_orderkey % 50 + 1)::VARCHAR AS coordinate, (l_orderkey % 50 + 1)::INT AS row_number, l_linenumber AS column_number FROM lineitem GROUP BY ALL
""")
def coordinates_a1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 coordinates taken apart again."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    c = F.concat(F.char(F.lit(64) + F.col("l_linenumber")), (F.col("l_orderkey") % 50 + 1).cast("string"))
    return lines.select("l_orderkey", "l_linenumber", "n", c.alias("coordinate"), T.a1_row(c).alias("row_number"), T.a1_column(c).alias("column_number"))


@query("""
    SELECT doc_id, array_to_string(list_sort(list_filter(['the', 'des', 'der', 'los'], lambda w: contains(lower(text), w))), ',') AS keywords FROM documents
""")
def keyword_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.lower("text")
    counts = F.create_map(*[x for w in ("the", "des", "der", "los") for x in (F.lit(w), text.contains(w))])
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.sort_array(F.map_keys(F.map_filter(counts, lambda k, v: v))), ",").alias("keywords"))


@query("""
    SELECT lang, CASE lang WHEN 'en' THEN 'ready' WHEN 'fr' THEN 'review' WHEN 'de' THEN 'failed' ELSE 'unsupported' END AS route, count(*) AS n FROM documents GROUP BY 1
""")
def handler_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Handlers by format (here: language); one raises on every row and fails only its own rows."""
    from ..operators.registry import Handlers

    def fails(row: dict) -> tuple[str, list[str]]:
        raise ValueError("can't be read")

    handlers = Handlers({"en": lambda row: ("ready", []), "fr": lambda row: ("review", ["MISSING_DATE"]), "de": fails})
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.col("lang").alias("format"))
    return handlers.process(docs).groupBy(F.col("format").alias("lang"), "route").agg(F.count(F.lit(1)).alias("n"))
