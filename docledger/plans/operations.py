"""Queries of runs: contracts, dead letters, counters, samples, display choices, versions of inputs, retries of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as C
from ..operators import contract as K
from ..operators import publish as P
from ..operators import release as L
from ..operators import runs as R
from ..operators.registry import Handlers, IncrementalRun
from ..session import table
from ..shared import new_path
from ..sources import files as S
from ..streaming import core as T
from ..streaming.state import BucketedTable
from .registry import query


@query("""
    SELECT p_partkey, p_partkey % 6 < 3 AS hit FROM part
""")
def title_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of meal plans in several spellings and widths, and others."""
    forms = ("2024년 5월 수용자 식단표", "직원·수용자　식단표 안내", "급식 식단표(1월) 수용자", "직원 식단표", "수용자 접견 안내", "메뉴")
    title = F.concat(F.get(F.array(*map(F.lit, forms)), (F.col("p_partkey") % 6).cast("int")), F.lit(" "), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", R.meal_plan_title(title).alias("hit"))


@query("""
    SELECT o_orderkey, array_to_string(list_filter([IF(v = 3, 'ATTACHMENT_COUNT', NULL), IF(v IN (4, 5), 'ATTACHMENT_FIELD', NULL), IF(v = 6, 'DOWNLOAD_WITHOUT_DIGEST', NULL), IF(v = 2, 'INVALID_DATE', NULL), IF(v IN (0, 1), 'REQUIRED_FIELD', NULL)], lambda x: x IS NOT NULL), ',') AS issues
    FROM (SELECT o_orderkey, o_orderkey % 9 AS v FROM orders)
""")
def row_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as posts with their attachments; each constraint is broken by some."""
    v, k = F.col("o_orderkey") % 9, F.col("o_orderkey").cast("string")
    text = lambda x: F.lit(x).cast("string")
    a = F.struct(F.when(v == 4, "").otherwise(k).alias("attachment_id"), F.when(v == 5, text(None)).otherwise(F.lit("u")).alias("url"), F.lit("downloaded").alias("status"), F.when(v == 6, text(None)).otherwise(F.lit("d")).alias("sha256"))
    b = F.struct(k.alias("attachment_id"), F.lit("u").alias("url"), F.lit("failed").alias("status"), text(None).alias("sha256"))
    day = F.when(v == 2, "2024-02-30").when(v == 7, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    issues = R.post_issues(F.when(v == 0, "").otherwise(k), F.when(v == 1, text(None)).otherwise(F.lit("t")), F.lit("u"), day, F.when(v == 3, 1).otherwise(2), F.array(a, b))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(issues, ",").alias("issues"))


@query("""
    SELECT page_id, array_to_string(list_filter([IF(page_id % 7 = 1, 'IDENTITY', NULL), IF(page_id % 7 = 2, 'INVALID_DOWNLOAD_URL', NULL), IF(page_id % 7 = 3, 'INVALID_POST_URL', NULL), IF(page_id % 7 = 4, 'MISSING_METADATA', NULL)], lambda x: x IS NOT NULL), ',') AS issues FROM pages
""")
def source_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 7
    rows = table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit("p"), "page_id", F.when(k == 1, "-b").otherwise("-a")).alias("document_id"), F.concat(F.lit("p"), "page_id").alias("post_id"), F.lit("a").alias("attachment_id"),
        F.when(k != 4, "f.xlsx").alias("original_filename"), F.lit("2024-01-01").alias("published_date"), F.when(k == 3, F.concat(F.lit("ftp://"), "url")).otherwise(F.col("url")).alias("post_url"), F.when(k == 2, "http://").otherwise(F.col("url")).alias("download_url"),
    )
    return rows.select("page_id", F.array_join(R.source_issues(rows), ",").alias("issues"))


@query("""
    SELECT doc_id, CASE WHEN doc_id % 8 = 0 THEN 'x' ELSE lang END AS lang, CAST(row_number() OVER (ORDER BY IF(doc_id % 5 = 0, '', '2024-01-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0')) DESC, doc_id DESC) AS BIGINT) AS position FROM documents QUALIFY position <= 500
""")
def catalog_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog upserted, written in order, checked as written and only then made current; the first 500 of it."""
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", F.when(k % 5 != 0, F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))).alias("published_date"))
    new = C.later_wins([d, d.filter(k % 8 == 0).withColumn("lang", F.lit("x"))], ["doc_id"])
    store = S.Published(spark, new_path(spark, "catalog"))
    order = R.catalog_order("published_date", "doc_id")
    checks = {"duplicates": lambda df: df.groupBy("doc_id").count().filter("count > 1"), "dates": lambda df: df.filter("published_date IS NOT NULL AND try_to_date(published_date) IS NULL")}
    store.publish_sorted(new, "v1", order, checks)
    from pyspark.sql import Window

    first = store.read().orderBy(*order).limit(500)
    return first.select("doc_id", "lang", F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("position"))


@query("""
    SELECT 'parse' AS stage, doc_id::VARCHAR AS key, IF(doc_id % 10 = 3, 'ValueError', 'Error') AS error_class, IF(doc_id % 10 = 3, 'no table: ' || source, 'odd') AS message FROM documents WHERE doc_id % 10 IN (3, 4)
""")
def failed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that failed as dead letters, appended and read again; the others go on."""
    k = F.col("doc_id") % 10
    error = F.when(k == 3, F.concat(F.lit("ValueError: no table: "), "source")).when(k == 4, "odd")
    good, bad = S.split_dead(table(spark, sf_dir, "documents").select("doc_id", error.alias("_error")))
    letters, path = R.failures(bad, "parse", "doc_id"), new_path(spark, "dead-letters")
    for part in (letters.filter("key % 2 = 0"), letters.filter("key % 2 = 1")):
        part.write.mode("append").json(path)
    lost = good.join(bad.select("doc_id"), "doc_id", "left_semi").select(F.lit("lost").alias("stage"), F.col("doc_id").cast("string").alias("key"), F.lit("").alias("error_class"), F.lit("").alias("message"))
    return spark.read.schema("stage string, key string, error_class string, message string").json(path).unionByName(lost)


@query("""
    WITH c AS (SELECT doc_id % 15 = 1 OR doc_id % 3 = 0 AS isnew, doc_id % 5 = 0 AS five, doc_id % 20 = 2 AS failed, CASE WHEN doc_id % 4 = 0 THEN 'ready' WHEN doc_id % 4 = 1 THEN 'review' WHEN doc_id % 4 = 2 THEN 'failed' END AS o FROM documents)
    SELECT count(*) FILTER (isnew) AS "new", count(*) FILTER (NOT isnew AND five) AS changed, count(*) FILTER (NOT isnew AND NOT five) AS unchanged, count(*) FILTER (failed) AS download_failed, count(*) FILTER (o = 'ready') AS ready, count(*) FILTER (o = 'review') AS review,
      count(*) FILTER (o = 'failed') AS failed, 'PARTIAL_SUCCESS' AS status FROM c
""")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    change = F.when(k % 15 == 1, "NEW_POST").when(k % 3 == 0, "NEW_ATTACHMENT").when(k % 5 == 0, "ATTACHMENT_CHANGED").otherwise("UNCHANGED")
    rows = table(spark, sf_dir, "documents").select(change.alias("change_type"), F.when(k % 20 == 2, "failed").alias("download_status"), F.when(k % 4 == 0, "ready").when(k % 4 == 1, "review").when(k % 4 == 2, "failed").alias("outcome"))
    return R.run_counters(rows)


@query("""
    SELECT count(*) AS total, count(*) FILTER (s = 0) AS downloaded, count(*) FILTER (s = 1) AS reused, count(*) FILTER (s = 2) AS duplicate, count(*) FILTER (s = 3) AS failed, count(*) FILTER (s > 3) AS pending, count(*) FILTER (s > 3) = 0 AS complete FROM (SELECT l_orderkey % 6 AS s FROM lineitem)
""")
def download_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.get(F.array(*map(F.lit, ("downloaded", "reused", "duplicate", "failed", "waiting"))), (F.col("l_orderkey") % 6).cast("int"))
    return R.download_summary(table(spark, sf_dir, "lineitem").select(status.alias("status")))


@query("""
    SELECT lang AS format, count(*) AS documents, count(*) FILTER (doc_id % 3 = 0) AS passed, count(*) FILTER (doc_id % 3 = 1) AS partial, count(*) FILTER (doc_id % 3 = 2) AS failed, CAST(sum(doc_id % 90) AS BIGINT) AS valid, CAST(sum(doc_id % 4) AS BIGINT) AS warnings, CAST(sum(doc_id % 2) AS BIGINT) AS invalid,
      count(*) FILTER (doc_id % 6 = 0) AS eligible FROM documents GROUP BY ROLLUP (lang)
""")
def sample_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(F.col("lang").alias("format"), F.when(k % 3 == 0, "PASS").when(k % 3 == 1, "PARTIAL").otherwise("FAIL").alias("status"), (k % 90).alias("valid"), (k % 4).alias("warnings"), (k % 2).alias("invalid"), (k % 6 == 0).alias("eligible"))
    return R.sample_summary(rows)


@query("""
    WITH t AS (SELECT min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_orderpriority), g AS (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1),
      f AS (SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, -o_orderkey)) AS k, max(o_orderdate) AS d FROM orders SEMI JOIN g USING (o_custkey) ANTI JOIN t USING (o_orderkey) GROUP BY 1)
    SELECT o_orderkey, 'taken' AS reason FROM t UNION ALL (SELECT k, 'multi-role post coverage' FROM f ORDER BY d DESC, k LIMIT 24 - (SELECT count(*) FROM t))
""")
def sample_top_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of 24 topped up with one order of each customer whose orders have several states, newest first."""
    o = table(spark, sf_dir, "orders")
    taken = o.groupBy("o_orderpriority").agg(F.min("o_orderkey").alias("o_orderkey")).select("o_orderkey", F.lit("taken").alias("reason"))
    return R.topped_up(o, taken, "o_custkey", "o_orderkey", "o_orderstatus", [F.desc("o_orderdate")], 24)


@query("SELECT c_custkey FROM customer WHERE (lower(c_name) LIKE '%build%' OR lower(c_mktsegment) LIKE '%build%' OR 'addr' LIKE '%build%')")
def search_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("address", F.when(F.col("c_custkey") % 2 == 0, "addr"))
    return R.search(c, "  BUILD ", ["c_name", "c_mktsegment", "address"]).select("c_custkey")


@query("""
    SELECT c_custkey, 'all' AS shown FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'with data' FROM customer WHERE c_custkey % 3 = 0 AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
""")
def map_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 3 != 1, 37.0).alias("latitude"), F.when(k % 3 != 2, 127.0).alias("longitude"))
    has = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    pick = lambda only, name: R.displayed(c, has, "c_custkey", only).select("c_custkey", F.lit(name).alias("shown"))
    return pick(False, "all").unionByName(pick(True, "with data"))


@query("SELECT o_custkey, o_orderdate::DATE::VARCHAR AS day, bool_or(o_orderkey % 4 < 3) AS has FROM orders GROUP BY ALL")
def days_with_meals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of institutions: slots are filled, empty or missing."""
    k, slot = F.col("o_orderkey") % 4, F.collect_list
    per = table(spark, sf_dir, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(*[slot(F.when(k == i, "rice")).alias(m) for i, m in enumerate(("b", "l", "d"))])
    return per.select("o_custkey", F.col("day").cast("string").alias("day"), R.has_meals([F.col("b"), F.col("l"), F.when(F.size("d") > 0, F.col("d"))]).alias("has"))


@query("""
    WITH m AS (SELECT o_orderkey AS k, o_custkey AS c, strftime(o_orderdate, '%Y-%m') AS m FROM orders)
    SELECT k, 'by_id' AS step, 'd' || k AS document_id FROM m WHERE k % 3 = 0 UNION ALL SELECT k, 'inline', 'x' || k FROM m WHERE k % 3 = 1 UNION ALL SELECT a.k, 'month', 'd' || b.k FROM m a JOIN m b USING (c, m) WHERE a.k % 3 = 2
""")
def day_source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of days in all three steps; some ids that days name aren't in the month's list."""
    k = F.col("o_orderkey")
    m = table(spark, sf_dir, "orders").select(k.alias("k"), F.col("o_custkey").alias("c"), F.date_format("o_orderdate", "yyyy-MM").alias("m"), F.concat(F.lit("d"), k.cast("string")).alias("document_id"))
    none, kk = F.array().cast("array<string>"), F.col("k")
    days = m.select("k", "c", "m", F.when(kk % 3 == 0, F.array("document_id", F.lit("gone"))).when(kk % 3 == 1, F.array(F.lit("gone"))).otherwise(none).alias("ids"), F.when(kk % 3 == 2, none).otherwise(F.array(F.concat(F.lit("x"), kk.cast("string")))).alias("inline"))
    return R.day_sources(days, m.select("c", "m", "document_id"), ["c", "m"], "k")


@query("""
    WITH g AS (SELECT o_orderkey AS k, o_orderkey % 5 AS v FROM orders WHERE o_orderkey % 2 = 0)
    SELECT k, CASE WHEN v = 0 THEN 'missing' WHEN v IN (1, 2) THEN 'differs' ELSE 'exact' END AS state, 3 AS n_expected, [0, 3, 2, 3, 3][v + 1] AS n_found, [0, 3, 2, 3, 3][v + 1] AS n_both FROM g
""")
def golden_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden slots against found ones: missing, in another order, short of one item, or the same."""
    k, v = F.col("k"), F.col("k") % 5
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("p"))
    items = lambda *x: F.array(*[F.lit(y) if isinstance(y, str) and y != "p" else F.col(y) for y in x])
    golden = o.filter(k % 2 == 0).select("k", items("p", "rice", "rice").alias("items"))
    found = o.filter(v != 0).select("k", F.when(v == 1, items("rice", "p", "rice")).when(v == 2, items("p", "rice")).otherwise(items("p", "rice", "rice")).alias("items"))
    return R.golden_compare(golden, found, ["k"])


@query("""
    SELECT p_partkey, '{"p_brand":' || IF(p_partkey % 4 = 0, 'null', '"' || p_brand || '"') || ',"p_name":"' || p_name || '","p_size":' || p_size || '}' AS text, sha256(text)[1:12] AS short FROM part
""")
def canonical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as JSON with sorted names and nulls, and its short digest."""
    p = table(spark, sf_dir, "part").withColumn("p_brand", F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")))
    return p.select("p_partkey", R.canonical_json("p_size", "p_name", "p_brand").alias("text")).withColumn("short", F.substring(F.sha2("text", 256), 1, 12))


@query("""
    SELECT 'again' AS run, TRUE AS same UNION ALL SELECT 'one value', FALSE UNION ALL SELECT 'one row less', FALSE UNION ALL SELECT 'other code', FALSE UNION ALL SELECT 'other order', TRUE
""")
def input_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether versions of changed inputs are that of the first run: they are if nothing but the order of rows changed."""
    n, c = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    version = lambda a, b, code="1": R.input_version({"nation": a, "customer": b}, code).select("version")
    runs = {
        "again": version(n, c), "one value": version(n, c.withColumn("c_name", F.when(F.col("c_custkey") == 7, "x").otherwise(F.col("c_name")))), "one row less": version(n, c.filter("c_custkey <> 7")),
        "other code": version(n, c, "2"), "other order": version(n.repartition(3), c.repartition(5)),
    }
    out, first = None, version(n, c).select(F.col("version").alias("first"))
    for name, v in runs.items():
        row = v.join(F.broadcast(first)).select(F.lit(name).alias("run"), (F.col("version") == F.col("first")).alias("same"))
        out = row if out is None else out.unionByName(row)
    return out


@query("""
    SELECT 'institution_id' AS column_name, count(*) FILTER (s_suppkey % 4 <> 3 AND s_suppkey % 3 = 0) AS changed, count(*) FILTER (s_suppkey % 4 = 3 AND s_suppkey % 3 = 0) AS unresolved FROM supplier UNION ALL SELECT 'role', count(*) FILTER (s_suppkey % 5 = 0), 0 FROM supplier
""")
def backfill_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored catalog enriched: ids that names resolve, roles that were missing; what changed and what is still open."""
    k = F.col("s_suppkey")
    before = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k % 3 != 0, "i").alias("institution_id"), F.when(k % 5 != 0, "inmate").alias("role"))
    after = before.select("s_suppkey", F.coalesce("institution_id", F.when(k % 4 != 3, "i")).alias("institution_id"), F.coalesce("role", F.lit("unknown")).alias("role"))
    return R.backfill_counts(before, after, "s_suppkey", ["institution_id", "role"])


@query("""
    SELECT 'duplicate_id' AS check_name, 0::BIGINT AS failures UNION ALL SELECT 'routed_twice', count(*) FROM documents WHERE doc_id % 100 = 1 UNION ALL SELECT 'not_routed', count(*) FROM documents WHERE doc_id % 100 = 2 UNION ALL SELECT 'ready_not_public', count(*) FROM documents WHERE doc_id % 100 = 3
    UNION ALL SELECT 'public_not_ready', count(*) FROM documents WHERE doc_id % 100 = 5 UNION ALL SELECT 'report_count', 1
""")
def dataset_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest, routes, public rows and the report against each other, with faults planted."""
    k = F.col("doc_id")
    manifest = table(spark, sf_dir, "documents").select("doc_id")
    routes = manifest.filter(k % 100 != 2).withColumn("route", F.when((k % 2 == 1), "ready").otherwise("review"))
    routes = routes.filter(k % 100 != 5).unionByName(manifest.filter(k % 100 == 5).withColumn("route", F.lit("review"))).unionByName(manifest.filter(k % 100 == 1).withColumn("route", F.lit("failed")))
    public = manifest.filter((k % 2 == 1) & (k % 100 != 3))
    return P.reconcile_dataset(manifest, routes, public, "doc_id", {"ready": -1})


@query("""
    WITH b AS (SELECT o_orderkey, o_orderdate AS began, o_orderdate + INTERVAL 1 DAY * (o_orderkey % 40) AS ended FROM orders)
    SELECT o_orderkey, strftime(began, '%Y-%m') AS seen_before, strftime(least(ended, (SELECT max(o_orderdate) FROM orders)), '%Y-%m') AS seen_after,
           strftime(began, '%Y-%m') = strftime(least(ended, (SELECT max(o_orderdate) FROM orders)), '%Y-%m') AND o_orderkey % 7 <> 3 AS consistent FROM b
""")
def version_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as builds of up to 39 days against a pointer that moves to a new version each month: builds during which it moved, and
    those that report another version, are inconsistent."""
    k, began = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    o = table(spark, sf_dir, "orders").select(k, began.alias("began"), F.date_format(began, "yyyy-MM").alias("month"))
    builds = o.select(k.alias("build"), "began", F.date_add("began", (k % 40).cast("int")).cast("timestamp_ntz").alias("ended"), F.when(k % 7 == 3, "other").otherwise(F.col("month")).alias("report"))
    moves = o.groupBy("month").agg(F.date_trunc("month", F.min("began")).cast("timestamp_ntz").alias("at")).withColumnRenamed("month", "version")
    return L.consistent_builds(builds, moves).select(F.col("build").alias("o_orderkey"), "seen_before", "seen_after", "consistent")


@query("""
    SELECT doc_id::VARCHAR AS document_id, CASE WHEN lang = 'de' THEN 'failed' WHEN lang IN ('en', 'fr') THEN IF(doc_id % 6 = 1, 'review', 'ready') ELSE 'unsupported' END AS route,
           CASE WHEN lang IN ('en', 'fr') AND doc_id % 6 <> 1 THEN 'accepted' ELSE 'held' END AS status, CASE WHEN lang IN ('en', 'fr') AND doc_id % 6 <> 1 THEN IF(doc_id % 3 = 0, 1, 0) ELSE IF(doc_id % 3 = 2, 0, 1) END::INT AS run FROM documents
""")
def injected_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries through injected collector, handlers and judge. The second has every third document with new content and the
    next ones unchanged: accepted ones aren't handled again, held ones are tried again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("document_id"), F.coalesce("lang", F.lit("none")).alias("format"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))

    def collect(k: int) -> DataFrame:
        rows = docs if k == 0 else docs.filter("doc_id % 3 < 2").withColumn("sha256", F.when(F.col("doc_id") % 3 == 0, F.reverse("sha256")).otherwise(F.col("sha256")))
        return rows.drop("doc_id")

    def fails(row: dict) -> tuple[str, list[str]]:
        raise ValueError("can't be read")

    def menu(row: dict) -> tuple[str, list[str]]:
        return ("review", ["MISSING_DATE"]) if int(row["document_id"]) % 6 == 1 else ("ready", [])

    judge = lambda rows: rows.withColumn("status", F.when(F.col("route") == "ready", "accepted").otherwise("held"))
    run = IncrementalRun(spark, collect, Handlers({"en": menu, "fr": menu, "de": fails}), judge)
    for k in range(2):
        run.run(k)
    return run.result().select("document_id", "route", "status", "run")


@query("SELECT c_custkey, c_custkey % 4 = 0 AS private, 'c_note,local_path' AS fields FROM customer")
def forbidden_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Private names anywhere in the schema of nested rows, and rows with a private value in any leaf."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.struct("c_name", F.array(F.struct(F.when(k % 4 == 0, "data/raw/x").otherwise(F.col("c_mktsegment")).alias("local_path"))).alias("files"), F.create_map(F.lit("a"), F.struct(F.lit("n").alias("c_note"))).alias("notes")).alias("row"))
    found = K.forbidden_keys(rows, {"local_path", "c_note", "traceback"})
    private = K.any_leaf(F.col("row"), rows.schema["row"].dataType, lambda x: x.startswith("data/raw/"))
    return rows.select("c_custkey", private.alias("private"), F.lit(",".join(found)).alias("fields"))


@query("""
    SELECT doc_id, CASE WHEN doc_id % 4 = 1 THEN 2 ELSE 1 END AS attempts, CASE WHEN doc_id % 12 = 5 THEN 'failed' ELSE 'processed' END AS state FROM documents
""")
def stream_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries of the same sources: what is processed once isn't processed again, what failed is tried again as long as it comes."""
    k = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    tried = BucketedTable(spark, "tried", "doc_id bigint, sha256 string, attempts int, state string", ["doc_id"])

    def attempt(old: DataFrame, batch: DataFrame) -> DataFrame:
        left = C.unprocessed(batch, old.filter("state = 'processed'"), ["doc_id", "sha256"])
        fails = (k % 4 == 1) & ((F.col("delivery") == 0) | (k % 12 == 5))
        new = left.select("doc_id", "sha256", F.when(fails, "failed").otherwise("processed").alias("now"))
        both = old.join(new, ["doc_id", "sha256"], "full_outer")
        return both.select("doc_id", "sha256", (F.coalesce("attempts", F.lit(0)) + F.col("now").isNotNull().cast("int")).alias("attempts"), F.coalesce("now", "state").alias("state"))

    deliveries = [docs.withColumn("delivery", F.lit(0)), docs.filter(k % 4 < 2).withColumn("delivery", F.lit(1)), docs.filter(k % 4 == 0).withColumn("delivery", F.lit(2))]
    T.run_deliveries(spark, deliveries, lambda df, n: tried.merge(df, n, attempt), "retries")
    return tried.at(tried.last).select("doc_id", "attempts", "state")


@query("""
    SELECT doc_id, sha256(coalesce(text, '')) AS digest, CASE WHEN doc_id % 4 = 0 THEN 'manifest.xlsx' WHEN doc_id % 6 = 0 THEN 'catalog.xlsx' END AS filename FROM documents WHERE doc_id % 4 = 0 OR doc_id % 6 = 0
""")
def seed_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known digests of two sources whose files verify; the manifest's file metadata override the catalog's."""
    k = F.col("doc_id")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    d = table(spark, sf_dir, "documents").select("doc_id", digest.alias("digest"), digest.alias("stored"))
    side = lambda test, name, wrong: C.verified_rows(d.filter(test).withColumns({"stored": F.when(wrong, F.reverse("stored")).otherwise(F.col("stored")), "filename": F.lit(name)}), "digest", "stored").select("doc_id", "digest", "filename")
    extra = (k % 4 != 0) & (k % 6 != 0)
    return C.later_wins([side((k % 6 == 0) | extra, "catalog.xlsx", extra), side(k % 4 == 0, "manifest.xlsx", F.lit(False))], ["doc_id"])
