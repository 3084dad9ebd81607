"""Audit queries: distributions, shares, families, rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import bucket
from ..operators import audit as A
from ..session import table
from .registry import query


@query("""
    SELECT o_orderpriority AS a, year(o_orderdate)::VARCHAR AS b, count(*) AS n, GROUPING(o_orderpriority, year(o_orderdate)::VARCHAR)::BIGINT AS level
    FROM orders GROUP BY GROUPING SETS ((o_orderpriority, year(o_orderdate)::VARCHAR), (o_orderpriority), (year(o_orderdate)::VARCHAR))
""")
def crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.grouped_counts(table(spark, sf_dir, "orders"), F.col("o_orderpriority"), F.year("o_orderdate").cast("string"))


@query("SELECT v AS value, count(p_type) AS n FROM (VALUES ('ECONOMY'), ('SMALL'), ('MEDIUM'), ('LARGE'), ('UNSEEN')) t(v) LEFT JOIN part ON p_type = v GROUP BY 1")
def fixed_domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.domain_counts(table(spark, sf_dir, "part"), F.col("p_type"), ["ECONOMY", "SMALL", "MEDIUM", "LARGE", "UNSEEN"])


@query("""
    WITH a AS (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderdate < '1998-01-01' GROUP BY 1), b AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)
    SELECT o_orderpriority, coalesce(a.n, 0) AS old_n, coalesce(b.n, 0) AS new_n,
           round(coalesce(a.n * 100.0::DOUBLE / (SELECT sum(n) FROM a), 0), 2) AS old_share, round(coalesce(b.n * 100.0::DOUBLE / (SELECT sum(n) FROM b), 0), 2) AS new_share
    FROM a FULL JOIN b USING (o_orderpriority)
""")
def share_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return A.share_change(o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")), o, "o_orderpriority")


@query("""
    SELECT p_brand, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS share, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) AS INT) AS rank FROM part GROUP BY 1
""")
def priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.priority(table(spark, sf_dir, "part"), "p_brand")


@query("""
    SELECT coalesce(year(o_orderdate)::VARCHAR, 'unknown') AS year, month(o_orderdate)::INT AS month, count(*) AS n FROM orders GROUP BY ALL
""")
def period_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.coalesce(F.year("o_orderdate").cast("string"), F.lit("unknown")).alias("year"), F.month("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n"))


TAGS = ("p", "li", "a", "h1", "div", "b")


@query("""
    SELECT page_id, """ + ", ".join(f"len(regexp_extract_all(html, '(?i)<{t}[\\s>]'))::INT AS n_{t}" for t in TAGS) + ", length(html)::INT AS n_chars FROM pages")
def markup_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", *A.tag_profile(F.col("html"), TAGS), F.length("html").alias("n_chars"))


@query("""
    WITH f AS (SELECT page_id, split_part(url, '/', 4) AS lang, len(regexp_extract_all(html, '(?i)<p[\\s>]')) AS p, len(regexp_extract_all(html, '(?i)<li[\\s>]')) AS li FROM pages),
         v AS (SELECT page_id, lang, concat(CASE WHEN p <= 5 THEN '<= 5' WHEN p <= 10 THEN '<= 10' WHEN p <= 20 THEN '<= 20' ELSE '> 20' END, '|',
                CASE WHEN li <= 4 THEN '<= 4' WHEN li <= 6 THEN '<= 6' ELSE '> 6' END) AS features FROM f)
    SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, features) AS INT) AS family FROM (SELECT lang, features, count(*) AS n, min(page_id) AS example FROM v GROUP BY ALL)
""")
def template_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.split_part("url", F.lit("/"), F.lit(4)).alias("lang"), *A.tag_profile(F.col("html"), ("p", "li")))
    features = F.concat_ws("|", bucket(F.col("n_p"), (5, 10, 20)), bucket(F.col("n_li"), (4, 6)))
    return A.families(pages, "page_id", "lang", features)


PATH = r"^[a-zA-Z]+://[^/?#]*([^?#]*)"


@query(f"""
    WITH u AS (SELECT length(html) AS size, list_filter(string_split(regexp_extract(url, '{PATH}', 1), '/'), lambda x: x <> '') AS p FROM pages),
         e AS (SELECT size, unnest(['/'] || IF(len(p) >= 1, ['/' || p[1]], []) || IF(len(p) >= 2, ['/' || p[1] || '/' || p[2]], [])) AS prefix FROM u)
    SELECT prefix, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS files FROM e GROUP BY 1
""")
def prefix_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return A.prefix_rollup(pages, F.regexp_extract("url", PATH, 1), F.length("html").cast("long"))


@query("SELECT page_id, CAST(length(html) AS BIGINT) AS size FROM pages ORDER BY size DESC, page_id LIMIT 20")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.length("html").cast("long").alias("size")).orderBy(F.desc("size"), "page_id").limit(20)


@query("""
    WITH l AS (SELECT source, doc_id FROM documents ANTI JOIN labels USING (doc_id)) SELECT source, doc_id, count(*) OVER (PARTITION BY source) AS n FROM l
""")
def unresolved_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label, a row each, with how many their source has: no list of a source's ids is gathered."""
    lone = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")
    counts = lone.groupBy(F.col("source").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    return lone.join(counts, F.col("source").eqNullSafe(F.col("of"))).select("source", "doc_id", "n")


@query("""
    WITH a AS (SELECT doc_id, unnest([source || '-' || coalesce(lang, ''), IF(doc_id % 5 = 0, NULL, lang), IF(doc_id % 7 = 0, 'unknown', 'menu')]) AS role, unnest([0, 1, 2]) AS pos FROM documents)
    SELECT coalesce(role, 'unknown') AS role, doc_id, pos::INT AS pos, count(*) OVER (PARTITION BY coalesce(role, 'unknown')) AS n FROM a WHERE coalesce(role, 'unknown') NOT IN ('en', 'fr', 'menu')
""")
def unknown_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attachments whose role is none of the known ones, with how many share it: three attachments a document, roles null or strange in some."""
    k = F.col("doc_id")
    roles = F.array(F.concat("source", F.lit("-"), F.coalesce("lang", F.lit(""))), F.when(k % 5 != 0, F.col("lang")), F.when(k % 7 == 0, "unknown").otherwise("menu"))
    posts = table(spark, sf_dir, "documents").select("doc_id", F.transform(roles, lambda r: F.struct(r.alias("role"))).alias("attachments"))
    return A.unknown_roles(posts, "doc_id", "attachments", ["en", "fr", "menu"])


@query("""
    SELECT o_orderstatus, count(*) AS n, CAST(sum((o_orderpriority = '1-URGENT')::INT) AS BIGINT) AS urgent, CAST(sum((o_orderpriority = '5-LOW')::INT) AS BIGINT) AS low,
           CASE WHEN sum((o_orderpriority = '1-URGENT')::INT) > 0 THEN 'partial' ELSE 'complete' END AS run_status FROM orders GROUP BY 1
""")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT")
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), urgent.alias("urgent"), F.count_if(F.col("o_orderpriority") == "5-LOW").alias("low"), F.when(urgent > 0, "partial").otherwise("complete").alias("run_status")
    )


@query("""
    SELECT count(DISTINCT l_suppkey) AS institutions, min(l_shipdate)::DATE::VARCHAR AS first_day, max(l_shipdate)::DATE::VARCHAR AS last_day,
           count(DISTINCT (l_suppkey, l_shipdate)) AS institution_days, count(*) AS rows_in, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM lineitem
""")
def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(
        F.countDistinct("l_suppkey").alias("institutions"),
        F.min("l_shipdate").cast("date").cast("string").alias("first_day"),
        F.max("l_shipdate").cast("date").cast("string").alias("last_day"),
        F.countDistinct("l_suppkey", "l_shipdate").alias("institution_days"),
        F.count(F.lit(1)).alias("rows_in"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("amount"),
    )


@query("""
    SELECT IF(n >= 4, '4+', n::VARCHAR) AS items, count(*) AS slots FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1
""")
def item_count_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(F.when(F.col("n") >= 4, "4+").otherwise(F.col("n").cast("string")).alias("items")).agg(F.count(F.lit(1)).alias("slots"))
