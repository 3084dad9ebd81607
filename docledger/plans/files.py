"""File queries: round trips, routes, dead letters, integrity, published versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from ..shared import new_path
from ..sources import files as S
from ..sources import html as H
from .registry import query


@query("SELECT doc_id, lang, source, CAST(n_chars AS BIGINT) AS n_chars FROM documents WHERE doc_id % 10 <> 7")
def scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as JSON lines with blank and broken lines planted, read leniently."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    line = F.when(F.col("doc_id") % 10 == 7, F.lit('{"doc_id": broken')).otherwise(F.to_json(F.struct(*d.columns), {"ignoreNullFields": "false"}))
    path = new_path(spark, "jsonl")
    d.select(F.when(F.col("doc_id") % 10 == 3, F.concat(line, F.lit("\n\n"))).otherwise(line).alias("value")).write.text(path)
    return S.read_jsonl(spark, path, d.schema, strict=False)


@query("SELECT count(*) AS n_dead, '{\"doc_id\": broken' AS line FROM documents WHERE doc_id % 10 = 7")
def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    line = F.when(F.col("doc_id") % 10 == 7, F.lit('{"doc_id": broken')).otherwise(F.to_json(F.struct(*d.columns)))
    path = new_path(spark, "jsonl")
    d.select(line.alias("value")).write.text(path)
    return S.dead_rows(spark, path, d.schema).groupBy("line").agg(F.count(F.lit(1)).alias("n_dead"))


@query("SELECT CASE WHEN quality = 1 AND toxic = 0 THEN 'ready' WHEN toxic = 1 THEN 'failed' ELSE 'review' END AS route, count(*) AS n, min(doc_id) AS first_id FROM labels GROUP BY 1")
def routed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    route = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "ready").when(F.col("toxic") == 1, "failed").otherwise("review")
    path = new_path(spark, "routes")
    S.write_routes(table(spark, sf_dir, "labels").withColumn("route", route), path)
    return spark.read.parquet(path).groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))


@query("""
    SELECT year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, count(*) AS n, CAST(sum((o_orderstatus = 'F')::INT) AS BIGINT) AS finished FROM orders GROUP BY ALL
""")
def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions: the second rewrites the months of late deliveries only; both pass their checks before they count."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    store, keys = S.Published(spark, new_path(spark, "published")), ["y", "m"]
    checks = {"duplicates": lambda df: df.groupBy("o_orderkey").count().filter("count > 1"), "nulls": lambda df: df.filter("o_orderstatus IS NULL")}
    early = o.filter("NOT (m = 6 AND o_orderkey % 2 = 0)")
    store.publish(early, "v1", keys, checks)
    again = o.filter("m = 6")
    store.publish(store.overwrite_touched(store.read(), again, keys), "v2", keys, checks)
    return store.read().groupBy("y", "m").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"))


#: Tables whose first file has a wrong digest in the manifest.
WRONG_TABLES = ("nation.parquet", "orders.parquet")


@query()
def file_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given tables' files by signature, size and digest, against a manifest in which the first file of two tables has a wrong digest:
    these alone don't verify."""
    f = S.digests(spark, f"{sf_dir}/*.parquet", "*.parquet")
    row = f.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("file_size"), F.col("digest").alias("sha256"), F.regexp_extract("path", r"([^/]*\.parquet)(/[^/]*)*$", 1).alias("table"))
    first = row.groupBy("table").agg(F.min("name").alias("first"))
    wrong = F.col("table").isin(*WRONG_TABLES) & (F.col("name") == F.col("first"))
    manifest = row.join(first, "table").select("name", "file_size", F.when(wrong, F.reverse("sha256")).otherwise(F.col("sha256")).alias("sha256"))
    return S.verified(f, manifest).select("name", S.detected_format(F.col("head")).alias("format"), "length")


@query("""
    SELECT source, CASE WHEN source LIKE '%1%' THEN 'pdf' WHEN source LIKE '%2%' THEN 'ole' ELSE 'unknown' END AS detected, count(*) AS n, CAST(sum((source LIKE '%1%')::INT) AS BIGINT) AS agreeing FROM documents GROUP BY ALL
""")
def ext_vs_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents with planted signatures, all declared as pdf."""
    head = F.when(F.col("source").contains("1"), F.unhex(F.lit("255044462D312E37"))).when(F.col("source").contains("2"), F.unhex(F.lit("D0CF11E0A1B11AE1"))).otherwise(F.unhex(F.lit("00000000")))
    d = table(spark, sf_dir, "documents").select("source", S.detected_format(F.concat(head, F.col("text").cast("binary"))).alias("detected"))
    return d.groupBy("source", "detected").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("detected") == "pdf").alias("agreeing"))


@query("""
    WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages) SELECT page_id, len(h)::BIGINT AS n_links, len(list_distinct(h))::BIGINT AS n_distinct FROM l WHERE len(h) > 0
""")
def html_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors of pages by the HTML parser."""
    return H.links(table(spark, sf_dir, "pages")).groupBy("page_id").agg(F.count(F.lit(1)).alias("n_links"), F.countDistinct("href").alias("n_distinct"))


@query("SELECT s_suppkey, '0' || (s_suppkey % 9 + 1) || '-' || ((s_suppkey // 10000) % 9877 + 123) || '-' || lpad((s_suppkey % 10000)::VARCHAR, 4, '0') AS phone, lpad((s_suppkey * 7)::VARCHAR, 5, '0') AS postal_code, s_name AS name FROM supplier")
def html_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as pages with a directory table, read back. Keys above four digits go on in the middle group of the phone number."""
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey").cast("long")
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    middle = F.floor(k / 10000) % 9877 + 123
    phone = F.concat(F.lit("0"), (k % 9 + 1).cast("string"), F.lit("-"), middle.cast("string"), F.lit("-"), F.lpad((k % 10000).cast("string"), 4, "0"))
    row = F.concat(F.lit("<table><tr><th>"), "s_name", F.lit("</th>"), cell(F.lit("addr &amp; more")), cell(F.lpad((k * 7).cast("string"), 5, "0")), cell(phone), F.lit("</tr></table>"))
    rows = H.table_rows(s.select(F.col("s_suppkey").alias("page_id"), row.alias("html")))
    return H.directory(rows).select(F.col("page_id").alias("s_suppkey"), "phone", "postal_code", "name")


@query("""
    SELECT 'f' || s_suppkey || '.json' AS name, length(s_name)::BIGINT + 2 AS length FROM supplier WHERE s_suppkey % 7 <> 1 AND s_suppkey % 11 <> 2
""")
def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as files against a manifest: some sizes aren't given, some are wrong, as are some digests; paths that leave the folder match nothing."""
    k, path = F.col("s_suppkey"), new_path(spark, "manifest-files")
    rows = table(spark, sf_dir, "supplier").select(k, F.concat(F.lit("f"), k.cast("string")).alias("stem"), F.concat(F.lit('"'), "s_name", F.lit('"')).alias("value"))
    S.write_json_documents(rows, path)
    size = F.when(k % 7 == 1, 1).when(k % 5 != 0, F.length("value")).cast("long")
    digest = F.sha2("value", 256)
    manifest = rows.select(F.concat("stem", F.lit(".json")).alias("name"), size.alias("file_size"), F.when(k % 11 == 2, F.reverse(digest)).otherwise(digest).alias("sha256"))
    outside = manifest.withColumn("name", F.concat(F.lit("../"), "name"))
    return S.verified(S.digests(spark, path, "*.json"), manifest.unionByName(outside)).select("name", "length")
