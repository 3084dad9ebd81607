"""Catalog queries: canonical copies, change classes, upsert, resolution, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import alias_key, bracket_tokens
from ..operators import catalog as C
from ..operators import layout as L
from ..session import table
from .registry import query


@query("""
    SELECT doc_id, min(doc_id) OVER w AS canonical, doc_id <> min(doc_id) OVER w AS duplicate, substr(sha256(coalesce(text, '')), 1, 12) AS short_id
    FROM documents WINDOW w AS (PARTITION BY sha256(coalesce(text, '')))
""")
def content_hash_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    docs = table(spark, sf_dir, "documents").select("doc_id", digest.alias("d"))
    out = C.canonical_copy(docs, F.col("d"), F.lit(True), "doc_id", "doc_id")
    return out.select("doc_id", "canonical", "duplicate", F.substring("d", 1, 12).alias("short_id"))


@query("""
    SELECT doc_id, CASE WHEN doc_id % 15 = 1 THEN 'NEW_POST' WHEN doc_id % 3 = 0 THEN 'NEW_ATTACHMENT' WHEN doc_id % 5 = 0 THEN 'ATTACHMENT_CHANGED' ELSE 'UNCHANGED' END AS change_type
    FROM documents
""")
def change_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline: documents without every third (no digest there) and without posts of remainder 1; every fifth text changed since."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").alias("post"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    base = docs.filter("doc_id % 15 <> 1").withColumn("digest", F.when(F.col("doc_id") % 3 != 0, F.col("digest")))
    incoming = docs.withColumn("digest", F.when(F.col("doc_id") % 5 == 0, F.concat("digest", F.lit("'"))).otherwise(F.col("digest")))
    return C.change_class(incoming, base, "doc_id", "post", "digest").select("doc_id", "change_type")


OLD_NEW = """
    b AS (SELECT o_orderkey AS k, o_orderstatus AS d, o_totalprice AS v FROM orders WHERE o_orderdate < '1999-01-01'),
    i AS (SELECT o_orderkey AS k, IF(o_orderkey % 4 = 0, 'N', o_orderstatus) AS d, o_totalprice + 1 AS v, o_orderkey % 11 = 0 AS failed FROM orders WHERE o_orderdate >= '1997-01-01')
"""


def _old_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    base = o.filter(F.col("o_orderdate") < at("1999-01-01")).select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("d"), F.col("o_totalprice").alias("v"))
    digest = F.when(F.col("o_orderkey") % 4 == 0, "N").otherwise(F.col("o_orderstatus"))
    new = o.filter(F.col("o_orderdate") >= at("1997-01-01")).select(
        F.col("o_orderkey").alias("k"), digest.alias("d"), (F.col("o_totalprice") + 1).alias("v"), (F.col("o_orderkey") % 11 == 0).alias("failed")
    )
    return base, new


@query(f"""
    WITH {OLD_NEW} SELECT coalesce(b.k, i.k) AS k, IF(i.k IS NULL OR (b.k IS NOT NULL AND i.failed), b.d, i.d) AS d, IF(i.k IS NULL OR (b.k IS NOT NULL AND i.failed), b.v, i.v) AS v
    FROM b FULL JOIN i ON b.k = i.k
""")
def catalog_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, new = _old_new(spark, sf_dir)
    return C.upsert(base.withColumn("failed", F.lit(False)), new, ["k"], F.col("new_failed"), ["d", "v", "failed"]).drop("failed")


@query(f"WITH {OLD_NEW} SELECT b.k, b.d AS old_digest, i.d AS new_digest FROM b JOIN i ON b.k = i.k WHERE b.d <> i.d AND NOT i.failed AND b.k % 8 <> 0")
def change_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, new = _old_new(spark, sf_dir)
    events = C.change_events(base, new, ["k"], "d", F.col("failed"))
    history = events.filter("k % 8 = 0")  # recorded by an earlier run
    return C.append_new(history, events.unionByName(events.filter("k % 3 = 0")), ["k", "old_digest", "new_digest"])


@query("""
    SELECT c_custkey, IF(c_custkey % 3 = 0, c_acctbal + 1, c_acctbal) AS c_acctbal, IF(c_custkey % 3 = 0, 'later', 'earlier') AS source FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0
""")
def union_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    early = c.filter("c_custkey % 2 = 0").withColumn("source", F.lit("earlier"))
    late = c.filter("c_custkey % 3 = 0").withColumns({"c_acctbal": F.col("c_acctbal") + 1, "source": F.lit("later")})
    return C.later_wins([early, late], ["c_custkey"])


@query("""
    SELECT s_suppkey, n_nationkey AS resolved FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND s_suppkey % 4 <> 3
""")
def alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation names in several spellings, resolved by their normalised form; every fourth is a name that nobody has."""
    n = table(spark, sf_dir, "nation")
    aliases = n.select(alias_key(F.col("n_name")).alias("alias"), F.col("n_nationkey").alias("id"))
    ways = F.array(F.col("n_name"), F.concat(F.lit("["), F.lower("n_name"), F.lit("]")), F.replace(F.col("n_name"), F.lit("_"), F.lit(" - ")), F.concat(F.lit("no such "), F.col("n_name")))
    s = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.get(ways, (F.col("s_suppkey") % 4).cast("int")).alias("name"))
    return C.resolve(s, aliases, alias_key(F.col("name"))).select("s_suppkey", "resolved")


@query("SELECT lower(regexp_replace(c_mktsegment, '[ ._-]', '', 'g')) AS alias, count(DISTINCT c_nationkey) AS n_ids FROM customer GROUP BY 1 HAVING n_ids > 1")
def alias_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments in two spellings as aliases of nations: those that lead to more than one nation can't resolve anything."""
    c = table(spark, sf_dir, "customer")
    spelled = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("["), F.lower("c_mktsegment"), F.lit("]"))).otherwise(F.concat(F.lit(" "), F.col("c_mktsegment")))
    return C.ambiguous_aliases(c.select(alias_key(spelled).alias("alias"), F.col("c_nationkey").alias("id")), "alias", "id")


@query("SELECT c_custkey, IF(c_custkey % 5 = 0, NULL, c_nationkey) AS resolved FROM customer")
def bracket_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles '[nobody] [NATION_x] ...': the first bracket that an alias resolves."""
    n = table(spark, sf_dir, "nation")
    aliases = n.select(alias_key(F.col("n_name")).alias("alias"), F.col("n_nationkey").alias("id"))
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    token = F.when(F.col("c_custkey") % 5 == 0, "nobody else").otherwise(F.col("n_name"))
    titles = c.select("c_custkey", F.concat(F.lit("[nobody] ["), token, F.lit("] menu of "), F.col("c_mktsegment")).alias("title"))
    keys = F.transform(bracket_tokens(F.col("title")), alias_key)
    return C.resolve_any(titles, aliases, keys, "c_custkey").select("c_custkey", "resolved")


@query("""
    SELECT c_custkey, IF(c_custkey % 3 = 0, IF(c_custkey % 2 = 0, NULL, 'old'), c_mktsegment) AS c_mktsegment FROM customer
""")
def old_row_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    old = c.filter("c_custkey % 3 = 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 2 != 0, "old"))
    return C.old_row_wins(c, old, ["c_custkey"], ["c_mktsegment"])


@query("SELECT c_custkey, IF(c_custkey % 3 = 0 AND c_custkey % 2 <> 0, 'old', c_mktsegment) AS c_mktsegment FROM customer")
def preserve_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    old = c.filter("c_custkey % 3 = 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 2 != 0, "old"))
    return C.preserve(c, old, ["c_custkey"], ["c_mktsegment"])


@query("""
    SELECT doc_id, sha256(text) AS digest, IF(doc_id % 4 = 0, 'manifest', 'catalog') AS origin FROM documents WHERE text IS NOT NULL AND n_chars = length(text) AND (doc_id % 4 = 0 OR doc_id % 6 = 0)
""")
def seed_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known digests from two sources whose integrity holds; the manifest's entry overrides the catalog's."""
    d = table(spark, sf_dir, "documents").filter("text IS NOT NULL AND n_chars = length(text)").select("doc_id", F.sha2("text", 256).alias("digest"))
    return C.later_wins([d.filter("doc_id % 6 = 0").withColumn("origin", F.lit("catalog")), d.filter("doc_id % 4 = 0").withColumn("origin", F.lit("manifest"))], ["doc_id"])


@query("""
    SELECT o_orderpriority, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS newest, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS oldest FROM orders GROUP BY 1
""")
def newest_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.newest_and_oldest(table(spark, sf_dir, "orders"), "o_orderpriority", ["o_orderdate", "o_orderkey"])


@query("""
    WITH p AS (SELECT o_orderkey, o_orderpriority AS a, year(o_orderdate)::VARCHAR AS b, o_orderstatus AS c FROM orders),
         t1 AS (SELECT a AS v, min(o_orderkey) AS k FROM p GROUP BY 1),
         t2 AS (SELECT b AS v, min(o_orderkey) AS k FROM p WHERE b NOT IN (SELECT b FROM p WHERE o_orderkey IN (SELECT k FROM t1)) GROUP BY 1),
         s AS (SELECT k FROM t1 UNION SELECT k FROM t2),
         t3 AS (SELECT c AS v, min(o_orderkey) AS k FROM p WHERE c NOT IN (SELECT c FROM p WHERE o_orderkey IN (SELECT k FROM s)) GROUP BY 1),
         u AS (SELECT k AS o_orderkey, 'priority' AS reason, 0 AS stage FROM t1 UNION ALL SELECT k, 'year', 1 FROM t2 UNION ALL SELECT k, 'status', 2 FROM t3)
    SELECT o_orderkey, reason, stage, o_orderkey AS position FROM u ORDER BY stage, o_orderkey LIMIT 12
""")
def diverse_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    stages = [("priority", F.col("o_orderpriority")), ("year", F.year("o_orderdate").cast("string")), ("status", F.col("o_orderstatus"))]
    return C.cover_values(o, stages, "o_orderkey", "o_orderkey", 12)


@query("""
    SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' UNION ALL (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O' ORDER BY o_orderkey DESC LIMIT 25)
""")
def recent_n_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in state O are new; of the others the 25 most recent are refreshed."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", (-F.col("o_orderkey")).alias("position"))
    return C.refresh(o, F.col("o_orderstatus") != "O", "position", 25).select("o_orderkey")


@query("""
    SELECT l_orderkey, l_linenumber, concat(l_orderkey, '-', l_linenumber) AS document_id, l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY ALL
""")
def explode_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines nested per order, exploded again into manifest rows with composed ids."""
    nested = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag")).alias("lines"))
    rows = nested.select("l_orderkey", F.explode("lines").alias("x")).filter(F.col("x.l_returnflag").isin("A", "R"))
    out = rows.select("l_orderkey", "x.l_linenumber", F.concat_ws("-", "l_orderkey", "x.l_linenumber").alias("document_id"), "x.l_partkey")
    return out.groupBy("l_orderkey", "l_linenumber", "document_id", "l_partkey").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT doc_id, concat(source, '-', doc_id) AS document_id, coalesce(nullif(lang, ''), 'unknown') AS language, CAST(n_chars AS BIGINT) AS size FROM documents
""")
def public_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.concat_ws("-", "source", "doc_id").alias("document_id"), F.coalesce(F.nullif("lang", F.lit("")), F.lit("unknown")).alias("language"), F.col("n_chars").alias("size"))


@query("""
    SELECT p_partkey, CAST(count(s) AS BIGINT) AS n_candidates, CASE count(s) WHEN 0 THEN 'UNRESOLVED' WHEN 1 THEN 'EVALUATE' ELSE 'REVIEW' END AS status
    FROM part LEFT JOIN (SELECT DISTINCT l_partkey, l_suppkey AS s FROM lineitem WHERE l_quantity > 45) ON p_partkey = l_partkey GROUP BY 1
""")
def candidate_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("n"))
    out = table(spark, sf_dir, "part").select("p_partkey").join(found, F.col("p_partkey") == F.col("l_partkey"), "left")
    n = F.coalesce("n", F.lit(0))
    return out.select("p_partkey", n.alias("n_candidates"), F.when(n == 0, "UNRESOLVED").when(n == 1, "EVALUATE").otherwise("REVIEW").alias("status"))


@query("""
    SELECT l_partkey, min(l_suppkey) AS only_supplier FROM lineitem WHERE l_quantity > 45 GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 1
""")
def single_value_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with exactly one distinct supplier, without collecting a part's lines."""
    per = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").groupBy("l_partkey").agg(F.min("l_suppkey").alias("a"), F.max("l_suppkey").alias("b"))
    return per.filter("a = b").select("l_partkey", F.col("a").alias("only_supplier"))


@query("""
    SELECT l_orderkey, arg_min(l_partkey, (CASE l_returnflag WHEN 'R' THEN 0 WHEN 'N' THEN 1 ELSE 2 END, l_linenumber, l_partkey)) AS l_partkey FROM lineitem GROUP BY 1
""")
def first_of_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    route = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min_by("l_partkey", F.struct(route, "l_linenumber", "l_partkey")).alias("l_partkey"))


@query("""
    SELECT l_orderkey, l_partkey, l_quantity, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_partkey, l_linenumber) AS INT) AS rank FROM lineitem QUALIFY rank <= 2
""")
def group_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two largest lines of each order (a top-k report)."""
    out = L.top_per(table(spark, sf_dir, "lineitem"), ["l_orderkey"], [F.desc("l_quantity"), F.col("l_partkey"), F.col("l_linenumber")], 2)
    return out.select("l_orderkey", "l_partkey", "l_quantity", "rank")


@query("""
    WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL), a AS (SELECT * FROM c ORDER BY n DESC, c_nationkey, c_mktsegment LIMIT 1)
    SELECT 1 AS pick, c_nationkey, c_mktsegment, n FROM a
    UNION ALL (SELECT 2, c_nationkey, c_mktsegment, n FROM c ORDER BY c_nationkey = (SELECT c_nationkey FROM a), n DESC, c_nationkey, c_mktsegment LIMIT 1)
""")
def two_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best group, and the best of another nation."""
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    best = c.orderBy(F.desc("n"), "c_nationkey", "c_mktsegment").limit(1)
    others = c.join(best.select("c_nationkey"), "c_nationkey", "left_anti").orderBy(F.desc("n"), "c_nationkey", "c_mktsegment").limit(1)
    pick = lambda df, k: df.select(F.lit(k).alias("pick"), "c_nationkey", "c_mktsegment", "n")
    return pick(best, 1).unionByName(pick(others, 2))
