"""Read-side and location queries: institutions, sources, manifests, months, candidates of points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import display as D
from ..operators import catalog as C
from ..operators import geo as G
from ..session import table
from .registry import query


@query("""
    SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'full ' || s_name WHEN 1 THEN s_name WHEN 2 THEN 'short' ELSE '이름 미상' END AS name, CASE s_suppkey % 4 WHEN 2 THEN 'short' WHEN 0 THEN 'full ' || s_name WHEN 1 THEN s_name ELSE '이름 미상' END AS short_name,
      ['구치소', '교도소', '지소', '교정기관', '교도소'][s_suppkey % 5 + 1] AS type_label, ['서울특별시 중구', '강원도 춘천시', '어딘가 3', '주소 정보 없음'][s_suppkey % 4 + 1] AS address, ['서울', '강원', '어딘가', ''][s_suppkey % 4 + 1] AS region,
      IF(s_suppkey % 3 = 0, 'https://h.org/' || s_suppkey, NULL) AS url FROM supplier
""")
def institution_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as institutions with some of three names, types by code or name, missing addresses, local URLs."""
    k = F.col("s_suppkey")
    v = lambda n: (k % n).cast("int")
    kind = F.get(F.array(*map(F.lit, ("detention_center", "PRISON", "서울지소", "school", "북부교도소"))), v(5))
    address = F.get(F.array(F.lit("서울특별시 중구"), F.lit("강원도 춘천시"), F.lit("어딘가 3"), F.lit("")), v(4))
    url = F.get(F.array(F.concat(F.lit(" https://h.org/"), k.cast("string")), F.lit("file:///x"), F.lit("https://h.org/data/raw/x")), v(3))
    x = D.institution(F.when(v(4) == 1, F.col("s_name")), F.when(v(4) == 0, F.concat(F.lit("full "), "s_name")).otherwise(F.lit("")), F.when(v(4) == 2, "short"), kind, address, url)
    return table(spark, sf_dir, "supplier").select("s_suppkey", x.alias("x")).select("s_suppkey", "x.*")


@query("""
    SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'd' || page_id WHEN 1 THEN 'old' || page_id END AS document_id, CASE page_id % 4 WHEN 0 THEN 'menu.xlsx' WHEN 1 THEN 'b.hwp' WHEN 2 THEN 'title' ELSE '수용자 식단표 원본' END AS filename,
      IF(page_id % 2 = 0, url, NULL) AS post_url, IF(page_id % 5 = 0, 'http://d.org/f', NULL) AS download_url, coalesce(IF(page_id % 2 = 0, url, NULL), IF(page_id % 5 = 0, 'http://d.org/f', NULL)) AS url, IF(page_id % 2 = 1, '2024-01-02', '2023-01-01') AS published_date FROM pages
""")
def source_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as sources under new names and old aliases; folders of file names, local paths and empty texts go."""
    k, none = F.col("page_id"), F.lit(None).cast("string")
    x = D.source(
        F.when(k % 4 == 0, "a/menu.xlsx").when(k % 4 == 1, "C:\\x\\b.hwp").otherwise(F.lit("")), F.when(k % 4 == 2, "title").otherwise(none),
        F.when(k % 4 == 0, F.col("url")).otherwise(F.lit("")), F.when(k % 4 == 2, F.col("url")).otherwise(F.lit("/data/x")), F.when(k % 5 == 0, "http://d.org/f").otherwise("data/raw/f"),
        F.when(k % 2 == 1, "2024-01-02"), F.lit("2023-01-01"), F.when(k % 3 == 0, F.concat(F.lit("d"), k.cast("string"))), F.when(k % 3 == 1, F.concat(F.lit("old"), k.cast("string"))),
    )
    return table(spark, sf_dir, "pages").select("page_id", x.alias("x")).select("page_id", "x.*")


@query("SELECT source, IF(source LIKE '%1%', '검증 완료 XLS/XLSX 식단 자료', '공식 수용자 식단 데이터') AS title, IF(source LIKE '%1%', 'Excel 검증 완료', '검증 완료') AS badge, count(*) AS n FROM documents GROUP BY 1")
def scope_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = F.when(F.col("source").contains("1"), "excel_ready_only").otherwise(F.col("source"))
    return table(spark, sf_dir, "documents").select("source", D.scope_label(scope).alias("x")).groupBy("source", "x.title", "x.badge").agg(F.count(F.lit(1)).alias("n"))


@query("""
    WITH h AS (SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')) SELECT c_custkey, c_name FROM h ORDER BY -c_custkey LIMIT 1
""")
def first_with_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first institution of the manifest (in falling order of keys) with anything available."""
    has = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(has, "c_custkey", "left_semi").orderBy(F.desc("c_custkey")).limit(1).select("c_custkey", "c_name")


@query("""
    SELECT l_orderkey, first(k ORDER BY l_linenumber, l_partkey, l_suppkey) AS key, CAST(min(l_linenumber) AS INT) AS position FROM (
      SELECT *, CASE WHEN l_returnflag = 'A' THEN 'd' || l_suppkey WHEN l_returnflag = 'R' THEN 'file' || l_linestatus ELSE 'title' END AS k FROM lineitem) GROUP BY l_orderkey, k
""")
def unique_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of an order, one for each first present of id, file name and title; their first position counts."""
    flag = F.col("l_returnflag")
    ident, name = F.when(flag == "A", F.concat(F.lit("d"), "l_suppkey")), F.when(flag == "R", F.concat(F.lit("file"), "l_linestatus"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", D.filled(ident, name, F.lit("title")).alias("key"))
    return lines.groupBy("l_orderkey", "key").agg(F.min("l_linenumber").alias("position"))


@query("""
    SELECT o_orderkey, CAST(row_number() OVER (ORDER BY coalesce(strftime(d, '%Y-%m-%d'), '') DESC, o_orderkey DESC) AS INT) AS position FROM (SELECT o_orderkey, IF(o_orderkey % 10 = 0, NULL, o_orderdate) AS d FROM orders) QUALIFY position BETWEEN 101 AND 350
""")
def manifest_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest by falling date, those without one last, from a checkpoint on: a slice of a report of fixed size."""
    day = F.when(F.col("o_orderkey") % 10 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    order = [F.desc(F.coalesce("day", F.lit(""))), F.desc("o_orderkey")]
    part = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day")).orderBy(*order).offset(100).limit(250)
    return part.select("o_orderkey", (F.row_number().over(Window.orderBy(*order)) + 100).alias("position"))


@query("""
    SELECT o_custkey, year(o_orderdate)::VARCHAR AS year, array_to_string(list_sort(list_distinct(list(month(o_orderdate)::INT))), ',') AS months FROM orders GROUP BY ALL
""")
def manifest_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of a manifest as texts, with some that are none (0, 13, words): numbers from 1 to 12 in order stay."""
    per = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").cast("string").alias("year")).agg(F.collect_set(F.month("o_orderdate").cast("string")).alias("m"))
    noisy = F.concat(F.array(*map(F.lit, ("13", "0", "May", ""))), "m", F.array(F.lit("-1")))
    return per.select("o_custkey", "year", F.array_join(D.months(noisy).cast("array<string>"), ",").alias("months"))


@query("""
    WITH x AS (SELECT c_custkey AS k, c_mktsegment AS s FROM customer), m(meal, i) AS (VALUES ('breakfast', 0), ('lunch', 1), ('dinner', 2))
    SELECT k, '2024-01-02' AS day, meal, CASE i WHEN 0 THEN 'rice,' || s WHEN 1 THEN s ELSE '' END AS items FROM x, m WHERE k % 3 = 0
    UNION ALL SELECT k, '2024-01-03', 'lunch', s || '2' FROM x WHERE k % 3 = 1 UNION ALL SELECT k, '2024-01-04', 'dinner', 'tea' FROM x WHERE k % 3 = 1
""")
def month_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months as days with three shapes of slots, as flat records (a later one replaces an earlier, other meals don't count), or empty."""
    s = F.col("c_mktsegment")
    days = F.concat(F.lit('{"days":{"2024-01-02":{"breakfast":{"menu_items":[{"name":"rice"},{"name":"'), s, F.lit('"}]},"lunch":["'), s, F.lit('"," "],"dinner":null}}}'))
    flat = F.concat(
        F.lit('{"records":[{"meal_date":"2024-01-03","meal_type":"lunch","menu_items":["'), s, F.lit('1"]},{"meal_date":"2024-01-03","meal_type":"snack","menu_items":["x"]},{"meal_date":"2024-01-04","meal_type":"dinner","menu_items":[{"name":"tea"}]},'),
        F.lit('{"meal_date":"2024-01-03","meal_type":"lunch","menu_items":["'), s, F.lit('2"]}]}'),
    )
    month = F.when(F.col("c_custkey") % 3 == 0, days).when(F.col("c_custkey") % 3 == 1, flat).otherwise("{}")
    slots = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.explode(D.month_slots(F.try_parse_json(month))).alias("x"))
    return slots.select("k", "x.day", "x.meal", F.array_join(D.items_of(F.col("x.slot")), ",").alias("items"))


PLACES = """
    p AS (SELECT s_suppkey AS k, s_suppkey % 12 AS v FROM supplier),
    i AS (SELECT k, v, array_to_string(list_filter([IF(v = 1, 'ADMINISTRATIVE_AREA_MISMATCH', NULL), IF(v IN (2, 4, 5), 'COORDINATE_REGION_MISMATCH', NULL), IF(v IN (3, 9), 'DISTRICT_MISMATCH', NULL), IF(v = 6, 'INSUFFICIENT_PRECISION', NULL), IF(v IN (4, 11), 'INVALID_COORDINATE_RANGE', NULL),
      IF(v = 7, 'MUNICIPALITY_MISMATCH', NULL), IF(v = 8, 'OFFICIAL_INSTITUTION_IDENTITY_MISMATCH', NULL), IF(v = 5, 'OUTSIDE_KOREA_OR_OFFSHORE', NULL), IF(v IN (4, 9), 'ROAD_ADDRESS_MISMATCH', NULL)], lambda x: x IS NOT NULL), ',') AS issues FROM p)
"""


def _places(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers with addresses, and a candidate point each with one fault by its key; two for some, from a geocoder for some, none for some."""
    k, v = F.col("k"), F.col("v")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), (F.col("s_suppkey") % 12).alias("v"))
    number = (k % 90 + 1).cast("string")
    rows = rows.withColumn("address", F.when(v == 7, F.concat(F.lit("경기도 수원시 팔달구 중부대로 "), number)).otherwise(F.concat(F.lit("서울특별시 중구 세종대로 "), number, F.lit(" (태평로)"))))
    returned = (
        F.when(v == 1, F.concat(F.lit("부산광역시 중구 세종대로 "), number))
        .when(v == 3, F.concat(F.lit("서울특별시 종로구 세종대로 "), number))
        .when(v == 4, F.concat(F.lit("서울특별시 중구 세종대로 "), number, F.lit("9")))
        .when(v == 7, F.concat(F.lit("경기도 용인시 팔달구 중부대로 "), number))
        .when(v == 9, F.lit("서울특별시 중구"))
        .otherwise(F.concat(F.lit("우 04524 서울특별시 중구 세종 대로  "), number, F.lit(" 3층")))
    )
    lat = F.when(v == 2, "37.90").when(v == 5, "40.1").when(v == 4, "97").when(v == 11, "none").when(v == 7, "37.3").otherwise("37.56")
    candidates = rows.select(
        "k", lat.alias("latitude"), F.when(v == 7, "127.0").otherwise("126.97").alias("longitude"), returned.alias("returned_address"),
        F.when(v == 6, "coarse").otherwise(G.EXACT).alias("precision"), (v != 10).alias("official"), (v != 8).alias("identity"),
    )
    return rows, candidates


@query(f"WITH {PLACES} SELECT k, issues, IF(issues = '', 'PASS', 'REVIEW') AS status FROM i")
def location_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine issue codes of candidate points."""
    rows, candidates = _places(spark, sf_dir)
    c = rows.hint("merge").join(candidates, "k")
    issues = G.location_issues(*[F.col(x) for x in ("address", "latitude", "longitude", "returned_address", "precision", "official", "identity")])
    return c.select("k", F.array_join(issues, ",").alias("issues")).withColumn("status", F.when(F.col("issues") == "", "PASS").otherwise("REVIEW"))


@query(f"""
    WITH {PLACES} SELECT k, IF(k % 5 = 0, 2, IF(k % 7 = 0, 0, 1))::BIGINT AS n_candidates, CASE WHEN k % 5 = 0 THEN 'REVIEW' WHEN k % 7 = 0 THEN 'UNRESOLVED' WHEN issues <> '' THEN 'REVIEW' WHEN v = 10 THEN 'GEOCODED' ELSE 'VERIFIED' END AS status,
      CASE WHEN k % 5 = 0 THEN 'MULTIPLE_CANDIDATES' WHEN k % 7 = 0 THEN '' ELSE issues END AS issues, IF(k % 5 <> 0 AND k % 7 <> 0 AND issues = '', 37.56, NULL)::DOUBLE AS latitude FROM i
""")
def candidate_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No candidate, one that is judged, or several that are for review."""
    rows, c = _places(spark, sf_dir)
    found = c.filter("k % 5 = 0 OR k % 7 <> 0").unionByName(c.filter("k % 5 = 0"))
    out = G.attach_candidates(rows, found, "k")
    return out.select("k", "n_candidates", "status", F.array_join("issues", ",").alias("issues"), "latitude")


@query("""
    SELECT s_suppkey AS k, t.lat AS latitude, t.lon AS longitude, t.a AS returned_address, t.p AS precision FROM (
      SELECT s_suppkey, unnest(IF(s_suppkey % 4 = 0, [], IF(s_suppkey % 4 = 3, [struct_pack(lat := '37.1', lon := '127.1', a := 'plain', p := 'coarse'), struct_pack(lat := '37.2', lon := '127.2', a := 'road ' || s_suppkey, p := 'institution_marker_or_full_road_address')],
        [struct_pack(lat := '37.2', lon := '127.2', a := 'road ' || s_suppkey, p := IF(s_suppkey % 4 = 1, 'institution_marker_or_full_road_address', 'coarse'))]))) AS t FROM supplier)
""")
def geocoder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates from a geocoder's JSON: none, one of a road, one of a region with a road, two."""
    k = F.col("s_suppkey")
    road = lambda kind: F.concat(F.lit('{"x":"127.2","y":"37.2","address_name":"plain","address_type":"' + kind + '","road_address":{"address_name":"road '), k.cast("string"), F.lit('"}}'))
    plain = F.lit('{"x":"127.1","y":"37.1","address_name":"plain","address_type":"REGION_ADDR","road_address":null}')
    inner = F.when(k % 4 == 1, road("ROAD_ADDR")).when(k % 4 == 2, road("REGION_ADDR")).when(k % 4 == 3, F.concat(plain, F.lit(","), road("ROAD_ADDR"))).otherwise("")
    rows = table(spark, sf_dir, "supplier").select(k.alias("k"), F.concat(F.lit('{"documents":['), inner, F.lit("]}")).alias("payload"))
    return G.geocoder_candidates(rows, "k").select("k", "latitude", "longitude", "returned_address", "precision")


@query("""
    SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'old' WHEN o_orderkey % 7 = 0 THEN 'old' WHEN o_orderkey % 3 = 0 THEN 'new' WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS kept FROM orders WHERE NOT (o_orderkey % 11 = 0)
""")
def attachment_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert of attachments in posts: a failed refresh keeps the old row, as does one that only finds the same content again as a
    duplicate; else the incoming row counts, and attachments that an incoming post lacks are dropped."""
    o, k = table(spark, sf_dir, "orders"), F.col("k")
    old = o.select(F.col("o_orderkey").alias("k"), F.lit("s").alias("sha256"), F.lit("downloaded").alias("status"), F.lit("old").alias("kept"))
    status = F.when(k % 5 == 0, "failed").when(k % 7 == 0, "duplicate").otherwise("downloaded")
    sha = F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, "s").otherwise("t")
    came = ((k % 2 == 0) | (k % 3 == 0) | (k % 5 == 0) | (k % 7 == 0)) & (k % 11 != 0)
    new = old.filter(came).withColumns({"sha256": sha, "status": status, "kept": F.lit("new")})
    refreshed = old.select("k").withColumn("post", k % 11 == 0)  # these posts came again, without their attachment
    out = C.merge_attachments(old, new, refreshed.filter("post").select("k"), ["k"])
    return out.select("k", "kept")


@query("""
    SELECT doc_id, 'changed' AS why FROM documents WHERE doc_id % 3 = 1 UNION ALL SELECT doc_id, 'failed' FROM documents WHERE doc_id % 6 = 0
""")
def processed_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is processed again: ids whose content is another than the one processed, and those that failed, which aren't recorded."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    k = F.col("document_id")
    done = d.filter(k % 6 != 0).withColumn("sha256", F.when(k % 3 == 1, F.reverse("sha256")).otherwise(F.col("sha256")))
    left = C.unprocessed(d, done, ["document_id", "sha256"])
    return left.select(k.alias("doc_id"), F.when(k % 6 == 0, "failed").otherwise("changed").alias("why"))
