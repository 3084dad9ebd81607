"""Geo and read-side queries: boxes, shared points, availability, search, polymorphic shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import geo as G
from ..session import table
from .registry import query


@query("""
    SELECT p_partkey, CASE WHEN lat NOT BETWEEN -90 AND 90 OR lon NOT BETWEEN -180 AND 180 THEN 'INVALID_COORDINATE_RANGE'
      WHEN NOT ((lat BETWEEN 34.0 AND 38.65 AND lon BETWEEN 125.0 AND 129.65) OR (lat BETWEEN 33.1 AND 33.65 AND lon BETWEEN 126.1 AND 127.0)) THEN 'OUTSIDE_KOREA_OR_OFFSHORE' END AS issue
    FROM (SELECT p_partkey, (p_size + 20)::DOUBLE AS lat, p_retailprice / 10 AS lon FROM part)
""")
def bbox_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", G.coordinate_issue((F.col("p_size") + 20).cast("double"), F.col("p_retailprice") / 10).alias("issue"))


@query("""
    SELECT p_size, p_type, count(*) AS n, min(p_partkey) AS first_id, min(p_brand) = max(p_brand) AS same_address FROM part GROUP BY ALL HAVING count(*) > 1
""")
def dup_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.shared_points(table(spark, sf_dir, "part"), "p_size", "p_type", "p_partkey", "p_brand")


@query("""
    WITH b AS (SELECT p_size, p_type FROM part GROUP BY ALL HAVING count(*) > 1 AND min(p_brand) <> max(p_brand))
    SELECT p_partkey, IF(b.p_size IS NULL, part.p_size, NULL) AS p_size, IF(b.p_size IS NULL, part.p_type, NULL) AS p_type, IF(b.p_size IS NULL, 'PASS', 'REVIEW') AS status FROM part LEFT JOIN b USING (p_size, p_type)
""")
def withhold_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type", "p_brand")
    return G.withhold_shared(p, "p_size", "p_type", "p_partkey", "p_brand").select("p_partkey", "p_size", "p_type", "status")


@query("""
    SELECT n_regionkey, min(c_acctbal) AS low, max(c_acctbal) AS high, count(*) AS n, CAST(sum((c_acctbal < 0)::INT) AS BIGINT) AS negative FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def region_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.groupBy("n_regionkey").agg(F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("negative"))


@query("""
    SELECT vec_id, IF(ok, x, NULL) AS x, IF(ok, y, NULL) AS y FROM (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, vec_id % 9 <> 0 AND embedding[1] BETWEEN -0.1 AND 0.1 AND embedding[2] BETWEEN -0.1 AND 0.1 AS ok FROM embeddings)
""")
def coordinate_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with planted NaN: both parts or none."""
    e = table(spark, sf_dir, "embeddings")
    x = F.when(F.col("vec_id") % 9 == 0, float("nan")).otherwise(F.get("embedding", 0).cast("double"))
    # float bounds: the components are 32-bit
    a, b = G.clean_pair(x, F.get("embedding", 1).cast("double"), (-0.1, 0.1, -0.1, 0.1))
    return e.select("vec_id", a.alias("x"), b.alias("y"))


@query("""
    SELECT label, count(*) AS n, CAST(sum((vec_id % 4 <> 0 AND vec_id % 6 <> 0)::INT) AS BIGINT) AS n_finite FROM embeddings GROUP BY 1
""")
def finite_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.when(F.col("vec_id") % 4 == 0, float("nan")).when(F.col("vec_id") % 6 == 0, float("inf")).otherwise(F.get("embedding", 0).cast("double"))
    return table(spark, sf_dir, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(G.finite(x)).alias("n_finite"))


@query("""
    SELECT s_suppkey, '서울' AS province, '세종대로 ' || (s_suppkey % 90 + 1) AS road, '서울특별시 중구 세종대로 ' || (s_suppkey % 90 + 1) AS address FROM supplier
""")
def address_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postal noise around a road address is removed again."""
    a = F.concat(F.lit("우 04524 서울특별시 중구  세종대로 "), (F.col("s_suppkey") % 90 + 1).cast("string"), F.lit(" (태평로) 3층"))
    clean = G.physical_address(a)
    return table(spark, sf_dir, "supplier").select("s_suppkey", G.province(clean).alias("province"), G.road(a).alias("road"), clean.alias("address"))


@query("""
    WITH p AS (SELECT o_custkey, year(o_orderdate) AS y, string_agg(DISTINCT strftime(o_orderdate, '%m'), ' ' ORDER BY strftime(o_orderdate, '%m')) AS m FROM orders GROUP BY ALL)
    SELECT o_custkey, string_agg(y || ':' || m, ';' ORDER BY y DESC) AS years FROM p GROUP BY 1
""")
def availability_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years, latest first, each with its months in order."""
    per = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.sort_array(F.collect_set(F.date_format("o_orderdate", "MM"))).alias("m"))
    years = per.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("y", "m")), asc=False).alias("ys"))
    return years.select("o_custkey", F.array_join(F.transform("ys", lambda x: F.concat_ws(":", x["y"], F.array_join(x["m"], " "))), ";").alias("years"))


@query("""
    SELECT c_custkey, c_name, CAST(row_number() OVER (ORDER BY has_data DESC, c_name, c_custkey) AS INT) AS rank FROM (
      SELECT c_custkey, c_name, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS has_data FROM customer WHERE lower(c_name) LIKE '%00001%' OR lower(c_mktsegment) LIKE '%build%') QUALIFY rank <= 50
""")
def search_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 50 hits of a search: with data first, then by name in Korean collation (ASCII names sort alike)."""
    c = table(spark, sf_dir, "customer").filter(F.lower("c_name").contains("00001") | F.lower("c_mktsegment").contains("build"))
    has = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has", F.lit(True))
    best = c.join(has, "c_custkey", "left").orderBy(F.desc(F.coalesce("has", F.lit(False))), F.collate("c_name", "ko"), "c_custkey").limit(50)
    from pyspark.sql import Window

    w = Window.orderBy(F.desc(F.coalesce("has", F.lit(False))), F.collate("c_name", "ko"), "c_custkey")
    return best.select("c_custkey", "c_name", F.row_number().over(w).alias("rank"))


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events
""")
def variant_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("v"))
    return e.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"), F.try_variant_get("v", "$.missing", "string").alias("missing"))


@query("""
    SELECT o_orderkey, IF(o_orderkey % 4 = 3, 0, CASE o_orderkey % 4 WHEN 0 THEN 2 ELSE 1 END)::INT AS n_items, CASE o_orderkey % 4 WHEN 3 THEN '' WHEN 0 THEN 'a,' || o_orderstatus ELSE o_orderstatus END AS items FROM orders
""")
def polymorphic_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots in four shapes (object with items, bare list of strings, list of objects, null) brought to one."""
    s = F.col("o_orderstatus")
    shape = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit('{"menu_items":[{"name":"a"},{"name":"'), s, F.lit('"}]}')))
    shape = shape.when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit('["'), s, F.lit('"]'))).when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit('[{"name":"'), s, F.lit('"}]'))).otherwise("null")
    v = table(spark, sf_dir, "orders").select("o_orderkey", F.try_parse_json(shape).alias("v"))
    named = "array<struct<name:string>>"
    bare = F.when(F.schema_of_variant("v") == "ARRAY<STRING>", F.try_variant_get("v", "$", "array<string>"))
    items = F.coalesce(
        bare,
        F.transform(F.try_variant_get("v", "$.menu_items", named), lambda x: x["name"]),
        F.transform(F.try_variant_get("v", "$", named), lambda x: x["name"]),
        F.array().cast("array<string>"),
    )
    return v.select("o_orderkey", F.size(items).alias("n_items"), F.array_join(items, ",").alias("items"))


@query("""
    SELECT count(*) AS total, CAST(sum(has::INT) AS BIGINT) AS with_data, CAST(sum((NOT has)::INT) AS BIGINT) AS without_data, CAST(sum((c_acctbal < 0)::INT) AS BIGINT) AS no_coordinates, round(sum(has::INT) * 100.0 / count(*))::BIGINT AS percent
    FROM (SELECT c_acctbal, c_custkey IN (SELECT o_custkey FROM orders) AS has FROM customer)
""")
def legend_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    has = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has", F.lit(True))
    c = table(spark, sf_dir, "customer").join(has, "c_custkey", "left").withColumn("has", F.coalesce("has", F.lit(False)))
    return c.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("has").alias("with_data"),
        F.count_if(~F.col("has")).alias("without_data"),
        F.count_if(F.col("c_acctbal") < 0).alias("no_coordinates"),
        F.round(F.count_if("has") * 100.0 / F.count(F.lit(1))).cast("bigint").alias("percent"),
    )


@query("""
    WITH m AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderkey, o_orderkey % 3 AS kind FROM orders),
         a AS (SELECT o_custkey, month, count(*) AS n FROM m GROUP BY ALL)
    SELECT o_orderkey, CASE kind WHEN 0 THEN 'by_id' WHEN 1 THEN 'inline' ELSE 'month' END AS step, CASE kind WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE n END AS n_sources FROM m JOIN a USING (o_custkey, month)
""")
def day_sources_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of a slot: by its ids, else those inline, else all of its month."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    per = o.groupBy("o_custkey", "month").agg(F.count(F.lit(1)).alias("n"))
    ids = F.when(F.col("o_orderkey") % 3 == 0, F.array("o_orderkey")).otherwise(F.array().cast("array<bigint>"))
    inline = F.when(F.col("o_orderkey") % 3 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array().cast("array<int>"))
    rows = o.join(per, ["o_custkey", "month"]).select("o_orderkey", "n", ids.alias("ids"), inline.alias("inline"))
    return rows.select(
        "o_orderkey",
        F.when(F.size("ids") > 0, "by_id").when(F.size("inline") > 0, "inline").otherwise("month").alias("step"),
        F.when(F.size("ids") > 0, F.size("ids")).when(F.size("inline") > 0, F.size("inline")).otherwise(F.col("n")).cast("bigint").alias("n_sources"),
    )


@query("""
    SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, min(IF(o_orderstatus = 'F', o_orderdate, NULL))::DATE::VARCHAR AS first_day FROM orders GROUP BY ALL
""")
def first_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.min(day).cast("string").alias("first_day"))
