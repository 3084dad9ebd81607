"""Conflicts, merging, fingerprints, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import publish as P
from ..session import table
from ..shared import cut
from .registry import query

SLOT, CONTENT = ["l_partkey", "l_suppkey"], ["l_returnflag", "l_linestatus"]


@query("""
    SELECT l_partkey, l_suppkey, count(*) AS n_variants, CAST(sum(n) AS BIGINT) AS n_rows, min(p) AS first_document, max(p) AS last_primary,
           CAST(sum(n) AS BIGINT) - count(*) AS duplicates
    FROM (SELECT l_partkey, l_suppkey, l_returnflag, l_linestatus, count(*) AS n, min(l_orderkey) AS p FROM lineitem GROUP BY ALL)
    GROUP BY ALL HAVING count(*) > 1
""")
def conflict_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.conflicts(table(spark, sf_dir, "lineitem"), SLOT, CONTENT, "l_orderkey")


@query("""
    WITH v AS (SELECT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem GROUP BY ALL),
         s AS (SELECT l_partkey, l_suppkey FROM v GROUP BY ALL HAVING count(*) > 1)
    SELECT l_orderkey, bool_or(s.l_partkey IS NOT NULL) AS conflicting, CASE WHEN bool_or(s.l_partkey IS NOT NULL) THEN 'review' ELSE 'ready' END AS route
    FROM lineitem LEFT JOIN s USING (l_partkey, l_suppkey) GROUP BY l_orderkey
""")
def conflict_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    bad = P.conflicting_documents(lines, SLOT, CONTENT, "l_orderkey").withColumn("bad", F.lit(True))
    out = lines.select("l_orderkey").distinct().join(bad, "l_orderkey", "left")
    flag = F.coalesce("bad", F.lit(False))
    return out.select("l_orderkey", flag.alias("conflicting"), F.when(flag, "review").otherwise("ready").alias("route"))


@query("""
    SELECT l_partkey, l_suppkey, l_returnflag, l_linestatus, min(l_orderkey) AS "primary",
           array_to_string(list_sort(list_distinct(list(l_orderkey))), ',') AS documents
    FROM lineitem GROUP BY ALL
""")
def dedup_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.merge_documents(table(spark, sf_dir, "lineitem"), SLOT, CONTENT, "l_orderkey")
    return out.withColumn("documents", F.array_join(F.transform("documents", lambda d: d.cast("string")), ","))


def _merge_sql(rounds: int = 10) -> str:
    """Rounds of rejection one after the other, more than any of the given tables needs."""
    steps = ["b AS (SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem WHERE l_orderkey % 2 = 0)",
             "i AS (SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, IF(l_orderkey % 2 = 0, 'X', l_linestatus) AS l_linestatus FROM lineitem WHERE l_orderkey % 2 = 1 OR l_orderkey % 10 = 0)",
             "a0 AS (SELECT DISTINCT l_orderkey FROM i)"]
    for k in range(rounds):
        steps += [
            f"n{k} AS MATERIALIZED (SELECT * FROM b ANTI JOIN a{k} USING (l_orderkey) UNION ALL SELECT * FROM i SEMI JOIN a{k} USING (l_orderkey))",
            f"s{k} AS (SELECT l_partkey, l_suppkey FROM n{k} GROUP BY ALL HAVING count(DISTINCT (l_returnflag, l_linestatus)) > 1)",
            f"a{k + 1} AS MATERIALIZED (SELECT l_orderkey FROM a{k} ANTI JOIN (SELECT DISTINCT l_orderkey FROM n{k} SEMI JOIN s{k} USING (l_partkey, l_suppkey)) USING (l_orderkey))",
        ]
    return f"WITH {', '.join(steps)} SELECT l_orderkey, IF(l_orderkey IN (SELECT l_orderkey FROM a{rounds}), 'accepted', 'rejected') AS outcome FROM a0"


@query(_merge_sql())
def merge_fixpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base: even orders; incoming: odd orders, and new versions of every tenth even order. Result: incoming documents and outcome."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    base = lines.filter("l_orderkey % 2 = 0")
    changed = lines.filter("l_orderkey % 10 = 0").withColumn("l_linestatus", F.lit("X"))
    incoming = lines.filter("l_orderkey % 2 = 1").unionByName(changed)
    accepted, rejected = P.merge_to_fixpoint(base, incoming, SLOT, CONTENT, "l_orderkey", lambda df: cut(df, "merge"))
    return accepted.withColumn("outcome", F.lit("accepted")).unionByName(rejected.withColumn("outcome", F.lit("rejected")))


ORDERS_BY_MONTH = """
    o AS (SELECT o.*, n_name, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


def _by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c.select("c_custkey", "c_nationkey"), o["o_custkey"] == F.col("c_custkey")).join(n.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.withColumns({"y": F.year("o_orderdate"), "m": F.month("o_orderdate")})


@query(f"""
    WITH {ORDERS_BY_MONTH}
    SELECT DISTINCT n_name, CAST(y AS INT) AS y, CAST(m AS INT) AS m FROM o WHERE o_orderkey % 97 = 0
    UNION SELECT n_name, CAST(y AS INT), CAST(IF(m = 12, 1, m + 1) AS INT) FROM o WHERE o_orderkey % 97 = 0
""")
def touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 97th order moves to the next month of its year: both months are touched."""
    base = _by_month(spark, sf_dir)
    accepted = base.filter("o_orderkey % 97 = 0").withColumn("m", F.when(F.col("m") == 12, 1).otherwise(F.col("m") + 1))
    return P.touched(base, accepted, "o_orderkey", ["n_name", "y", "m"])


@query(f"""
    WITH {ORDERS_BY_MONTH}, a AS (SELECT n_name, y, m, o_orderkey, o_orderstatus FROM o WHERE o_orderkey % 1009 <> 1),
         b AS (SELECT n_name, y, m, o_orderkey, IF(o_orderkey % 503 = 0, 'Z', o_orderstatus) AS o_orderstatus FROM o),
         fa AS (SELECT n_name, y, m, string_agg(o_orderkey || o_orderstatus, ',' ORDER BY o_orderkey, o_orderstatus) AS f FROM a GROUP BY ALL),
         fb AS (SELECT n_name, y, m, string_agg(o_orderkey || o_orderstatus, ',' ORDER BY o_orderkey, o_orderstatus) AS f FROM b GROUP BY ALL)
    SELECT n_name, CAST(y AS INT) AS y, CAST(m AS INT) AS m,
           CASE WHEN fa.f IS NULL THEN 'added' WHEN fb.f IS NULL THEN 'dropped' ELSE 'changed' END AS state
    FROM fa FULL JOIN fb USING (n_name, y, m) WHERE fa.f IS DISTINCT FROM fb.f
""")
def partition_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _by_month(spark, sf_dir)
    old = base.filter("o_orderkey % 1009 <> 1")
    new = base.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 503 == 0, "Z").otherwise(F.col("o_orderstatus")))
    return P.changed_partitions(old, new, ["n_name", "y", "m"], ["o_orderkey", "o_orderstatus"])


@query("""
    WITH l AS (SELECT l_orderkey, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS s FROM lineitem GROUP BY 1)
    SELECT 'duplicate_order' AS check_name, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS failures
    UNION ALL SELECT 'line_without_order', (SELECT count(*) FROM l ANTI JOIN orders ON l_orderkey = o_orderkey)
    UNION ALL SELECT 'order_without_line', (SELECT count(*) FROM (SELECT DISTINCT o_orderkey FROM orders) ANTI JOIN l ON l_orderkey = o_orderkey)
    UNION ALL SELECT 'lines_above_total', (SELECT count(*) FROM orders JOIN l ON l_orderkey = o_orderkey WHERE s > CAST(o_totalprice AS DECIMAL(18,2)))
""")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    per = lines.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("s"))
    joined = orders.join(per, orders["o_orderkey"] == per["l_orderkey"])
    sides = P.one_sided(per.select(F.col("l_orderkey").alias("k")), orders.select(F.col("o_orderkey").alias("k")), ["k"])
    return (
        P.check(orders.groupBy("o_orderkey").count(), "duplicate_order", F.col("count") > 1)
        .unionByName(P.check(sides, "line_without_order", F.col("side") == "left"))
        .unionByName(P.check(sides, "order_without_line", F.col("side") == "right"))
        .unionByName(P.check(joined, "lines_above_total", F.col("s") > F.col("o_totalprice").cast("decimal(18,2)")))
    )


@query("""
    WITH b AS (SELECT c_custkey, c_name, IF(c_custkey % 7 = 0, c_nationkey + 1, c_nationkey) AS c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 50 <> 0),
         a AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer)
    SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)
""")
def state_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two states of customer; the balance is volatile and doesn't count."""
    a = table(spark, sf_dir, "customer")
    b = a.filter("c_custkey % 50 <> 0").withColumns({"c_nationkey": F.expr("IF(c_custkey % 7 = 0, c_nationkey + 1, c_nationkey)"), "c_acctbal": F.col("c_acctbal") + 1})
    return P.state_difference(a, b, ("c_acctbal",))


@query("""
    SELECT column_name, CAST(sum(d) AS BIGINT) AS n_changed, column_name IN ('c_acctbal') AS allowed FROM (
      SELECT 'c_acctbal' AS column_name, CAST(c_custkey % 3 = 0 AS INT) AS d FROM customer
      UNION ALL SELECT 'c_mktsegment', CAST(c_custkey % 100 = 0 AS INT) FROM customer
      UNION ALL SELECT 'c_name', 0 FROM customer UNION ALL SELECT 'c_nationkey', 0 FROM customer) GROUP BY 1
""")
def column_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values of each column changed between two versions, and whether that column may change."""
    a = table(spark, sf_dir, "customer")
    b = a.withColumns({"c_acctbal": F.expr("IF(c_custkey % 3 = 0, c_acctbal + 1, c_acctbal)"), "c_mktsegment": F.expr("IF(c_custkey % 100 = 0, 'NEW', c_mktsegment)")})
    columns = [c for c in a.columns if c != "c_custkey"]
    both = a.select("c_custkey", F.struct(*columns).alias("a")).join(b.select("c_custkey", F.struct(*columns).alias("b")), "c_custkey")
    counts = both.agg(*[F.count_if(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n_changed").withColumn("allowed", F.col("column_name") == "c_acctbal")


@query("""
    SELECT o_orderdate::DATE::VARCHAR AS day, string_agg(o_orderpriority || '=' || n, ';' ORDER BY o_orderpriority) AS slots
    FROM (SELECT o_orderdate, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_orderdate
""")
def month_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """days -> slots as nested maps, read back to one line per day."""
    per = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    slots = per.groupBy("day").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("slot", "n")))).alias("slots"))
    months = slots.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(F.map_from_entries(F.collect_list(F.struct("day", "slots"))).alias("days"))
    days = months.select(F.explode("days").alias("day", "slots"))
    text = F.array_join(F.transform(F.map_entries("slots"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return days.select(F.col("day").cast("string").alias("day"), text.alias("slots"))


@query("""
    WITH b AS (SELECT source, doc_id // 1000 AS block, sha256(string_agg(doc_id || ':' || sha256(coalesce(text, '')), ',' ORDER BY doc_id)) AS d, count(*) AS n FROM documents GROUP BY ALL),
         c AS (SELECT source, block // 1000 AS block, sha256(string_agg(block || ':' || d, ',' ORDER BY block)) AS d, sum(n) AS n FROM b GROUP BY ALL),
         h AS (SELECT max(block) > 0 AS third FROM c),
         r AS (SELECT source, IF(any_value(third), sha256(string_agg(block || ':' || d, ',' ORDER BY block)), any_value(d)) AS d, sum(n) AS n FROM c, h GROUP BY source)
    SELECT substr(d, 1, 24) AS version, source, CAST(n AS BIGINT) AS n FROM r
""")
def corpus_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version per source: the root of a tree of digests over a thousand ids or nodes each, in order. The SQL knows three levels (10 ** 9 ids)."""
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    return P.ordered_versions(rows, ["source"], "doc_id", "sha256")


@query("""
    SELECT strftime(o_orderdate, '%Y-%m') AS month, CASE WHEN min(o_orderdate) >= '2000-06-01' THEN 'added' WHEN max(o_orderdate) >= '2000-06-01' OR bool_or(o_orderkey % 997 = 0) THEN 'updated' ELSE 'same' END AS state
    FROM orders GROUP BY 1
""")
def months_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that a delivery adds or updates: orders from June 2000 on are new, every 997th order has another price and keeps its id."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.date_format("o_orderdate", "yyyy-MM").alias("month"), price.alias("price"))
    early = o.filter(F.col("o_orderdate") < F.lit("2000-06-01").cast("timestamp_ntz"))
    later = o.withColumn("price", F.when(F.col("o_orderkey") % 997 == 0, F.col("price") + 1).otherwise(F.col("price")))
    return P.months_changed(early, later, ["month"], ["o_orderkey", "price"])


@query("""
    SELECT source, doc_id, CASE WHEN doc_id % 211 = 3 THEN 'dropped' WHEN doc_id % 307 = 5 THEN 'changed' ELSE 'added' END AS state
    FROM documents WHERE doc_id % 211 = 3 OR doc_id % 307 = 5 OR doc_id % 401 = 7
""")
def version_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a new version of the corpus drops, changes and adds, found by walking down two digest trees."""
    k = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    dropped, changed = k % 211 == 3, k % 307 == 5
    before = rows.filter(dropped | changed | (k % 401 != 7))
    after = rows.filter(~dropped).withColumn("sha256", F.when(changed, F.reverse("sha256")).otherwise(F.col("sha256")))
    old, new = (P.digest_tree(x, ["source"], "doc_id", "sha256", 64) for x in (before, after))
    return P.tree_difference(old, new, before, after, ["source"], "doc_id", "sha256", 64)


@query("""
    SELECT 'customer_without_nation' AS check_name, (SELECT count(*) FROM customer ANTI JOIN nation ON c_nationkey = n_nationkey) AS failures
    UNION ALL SELECT 'nation_without_region', (SELECT count(*) FROM nation ANTI JOIN region ON n_regionkey = r_regionkey)
    UNION ALL SELECT 'nation_without_customer', (SELECT count(*) FROM nation ANTI JOIN customer ON c_nationkey = n_nationkey)
    UNION ALL SELECT 'order_without_customer', (SELECT count(*) FROM orders ANTI JOIN customer ON c_custkey = o_custkey)
    UNION ALL SELECT 'customer_without_order', (SELECT count(*) FROM customer ANTI JOIN orders ON c_custkey = o_custkey)
""")
def referential_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {x: table(spark, sf_dir, x) for x in ("customer", "nation", "region", "orders")}

    def anti(name: str, a: str, x: str, b: str, y: str) -> DataFrame:
        lone = t[a].select(F.col(x).alias("k")).join(t[b].select(F.col(y).alias("k")).distinct(), "k", "left_anti")
        return lone.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")

    return (
        anti("customer_without_nation", "customer", "c_nationkey", "nation", "n_nationkey")
        .unionByName(anti("nation_without_region", "nation", "n_regionkey", "region", "r_regionkey"))
        .unionByName(anti("nation_without_customer", "nation", "n_nationkey", "customer", "c_nationkey"))
        .unionByName(anti("order_without_customer", "orders", "o_custkey", "customer", "c_custkey"))
        .unionByName(anti("customer_without_order", "customer", "c_custkey", "orders", "o_custkey"))
    )


@query("SELECT c_custkey FROM customer SEMI JOIN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') ON c_custkey = o_custkey")
def semi_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(done, "c_custkey", "left_semi")


@query("""
    SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 48 EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity < 3
""")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.filter("l_quantity > 48").select("l_partkey").distinct().join(lines.filter("l_quantity < 3").select("l_partkey"), "l_partkey", "left_anti")
