"""Streaming queries, run to completion over the tables' files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as C
from ..session import table
from ..shared import new_path
from ..streaming import core as S
from ..streaming.state import ROCKS, STORE, BucketedTable, action_runs, observed_once, review_items
from .registry import query


@query("""
    SELECT ts::DATE::VARCHAR AS day, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY ALL
""")
def stream_daily_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.table_stream(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "1 hour")
    daily = e.groupBy(F.window("at", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))
    flat = daily.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.col("total").cast("double").alias("total"))
    return S.collect_complete(flat, "daily")


@query("SELECT DISTINCT user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS k FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source once, however often it is observed within 90 days; what is older leaves the state."""
    e = S.table_stream(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "90 days")
    e = e.select("at", "user_id", "event_type", (F.get_json_object("props", "$.k").cast("bigint") % 5).alias("k"))
    return S.collect_append(e.dropDuplicatesWithinWatermark(["user_id", "event_type", "k"]).drop("at"), "dedup")


@query("SELECT event_type, count(DISTINCT (user_id, json_extract_string(props, '$.k'))) AS n FROM events GROUP BY 1")
def stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique observations (user, k) per family (event type); an observation stays in the state for 90 days of the stream's time."""
    e = S.table_stream(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("at"), "event_type", "user_id", F.get_json_object("props", "$.k").alias("k"))
    once = observed_once(e, "at", ["event_type", "user_id", "k"], "90 days")
    counts = BucketedTable(spark, "drift", "event_type string, n bigint", ["event_type"])

    def count(old: DataFrame, batch: DataFrame) -> DataFrame:
        return old.unionByName(batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))).groupBy("event_type").agg(F.sum("n").alias("n"))

    S.run(once, lambda df, k: counts.merge(df, k, count), name="drift")
    return counts.at(counts.last)


@query("""
    WITH f AS (SELECT user_id, min((ts, event_id)) AS f FROM events WHERE event_type = 'error' GROUP BY 1),
         a AS (SELECT e.user_id, ts, event_id, event_type, event_type = 'signup' AND value > 30 AS silences, f FROM events e JOIN f ON e.user_id = f.user_id AND (ts, event_id) >= f
               WHERE event_type IN ('error', 'purchase') OR (event_type = 'signup' AND value > 30)),
         b AS (SELECT *, coalesce(bool_or(silences) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS silent,
                      lag(event_type) OVER (PARTITION BY user_id, silences ORDER BY ts, event_id) AS before FROM a),
         l AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS n_seen, bool_or(silences) AS ignored, arg_max(event_type, (ts, event_id)) FILTER (NOT silences) AS last_kind, min(ts) AS first_seen,
                      max(ts) FILTER (event_type = 'error' OR (event_type = 'purchase' AND before = 'error' AND NOT silent)) AS last_seen FROM b GROUP BY 1)
    SELECT user_id, n_seen, CASE WHEN ignored THEN 'IGNORED' WHEN last_kind = 'error' THEN 'OPEN' ELSE 'RESOLVED' END AS status, first_seen::TIMESTAMP AS first_seen, last_seen::TIMESTAMP AS last_seen FROM l
""")
def stream_review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors open a user's item, purchases resolve it, some signups silence it.

    Two streams: the first composes each batch's actions to one function a user, the second leads the users' states on.
    """
    kind = F.col("event_type")
    action = F.when(kind == "error", "add").when(kind == "purchase", "resolve").when((kind == "signup") & (F.col("value") > 30), "ignore")
    e = S.table_stream(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), action.alias("action")).filter("action IS NOT NULL")
    steps, states = new_path(spark, "review-steps"), new_path(spark, "review")

    def compose(batch: DataFrame, k: int) -> None:
        runs = action_runs(batch, "user_id", "ts", "event_id", [3600, 86400])
        runs.select(F.col("user_id").alias("key"), F.lit(k).alias("batch"), "step.*").write.mode("overwrite").parquet(f"{steps}/{k}")

    S.run(e, compose, name="review-actions")
    own = spark.read.parquet(f"{steps}/*").schema
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        items = review_items(spark.readStream.schema(own).parquet(f"{steps}/*"))
        S.run(items, lambda df, k: df.withColumn("batch", F.lit(k)).write.mode("overwrite").parquet(f"{states}/{k}"), "update", "review")
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)
    # a batch has one row for each key it touches; the last one is the key's state
    last = spark.read.parquet(f"{states}/*").groupBy("key").agg(F.max_by(F.struct("n_seen", "status", "first_seen", "last_seen"), "batch").alias("s"))
    local = lambda c: F.col(f"s.{c}").cast("timestamp_ntz").alias(c)
    return last.select(F.col("key").alias("user_id"), "s.n_seen", "s.status", local("first_seen"), local("last_seen"))


@query("""
    WITH v AS (SELECT doc_id // 3 AS document, CAST(doc_id % 3 AS INT) AS version, coalesce(text, '') AS t FROM documents),
         x AS (SELECT v.document, v.version, sha256(IF(v.document % 3 = 0 AND v.version = 1, coalesce(f.t, v.t), v.t)) AS d FROM v LEFT JOIN v f ON f.document = v.document AND f.version = 0),
         w AS (SELECT document, version, d, lag(d) OVER (PARTITION BY document ORDER BY version) AS p FROM x)
    SELECT document, version, CASE WHEN p IS NULL THEN 'NEW_POST' WHEN p = d THEN 'UNCHANGED' ELSE 'ATTACHMENT_CHANGED' END AS change_type FROM w
""")
def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries of document versions, each classified against the state that the ones before left; every third document's
    second version is its first one again."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.floor(F.col("doc_id") / 3).alias("document"), (F.col("doc_id") % 3).cast("int").alias("version"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    first = rows.filter("version = 0").select("document", F.col("digest").alias("first"))
    again = (F.col("document") % 3 == 0) & (F.col("version") == 1) & F.col("first").isNotNull()
    rows = rows.join(first, "document", "left").withColumn("digest", F.when(again, F.col("first")).otherwise(F.col("digest"))).drop("first")
    state = BucketedTable(spark, "known", rows.schema, ["document"])
    path = new_path(spark, "changes")

    def each(batch: DataFrame, k: int) -> None:
        known = state.near(batch, k).withColumn("post", F.col("document"))
        C.change_class(batch.withColumn("post", F.col("document")), known, "document", "post", "digest").drop("post").write.mode("overwrite").parquet(f"{path}/{k}")
        state.merge(batch, k, lambda old, new: C.later_wins([old, new], ["document"]))

    S.run_deliveries(spark, [rows.filter(F.col("version") == k) for k in range(3)], each, "deliveries")
    return spark.read.parquet(f"{path}/*").select("document", "version", "change_type")


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1")
def stream_month_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of orders; each batch recomputes the months that it touches and leaves the others alone."""
    month, late = F.date_format("o_orderdate", "yyyy-MM"), (F.month("o_orderdate") > 6) & (F.col("o_orderkey") % 2 == 1)
    o = table(spark, sf_dir, "orders").select(month.alias("month"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.coalesce(late, F.lit(False)).alias("late"))
    deliveries = [o.filter("NOT late").drop("late"), o.filter("late").drop("late")]
    months = BucketedTable(spark, "months", "month string, n bigint, total decimal(38,2)", ["month"])

    def project(old: DataFrame, batch: DataFrame) -> DataFrame:
        new = batch.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(38,2)").alias("total"))
        untouched = old.join(new.select("month"), "month", "left_anti")
        again = old.join(new.select("month"), "month", "left_semi").unionByName(new).groupBy("month").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,2)").alias("total"))
        return untouched.unionByName(again)

    S.run_deliveries(spark, deliveries, lambda df, k: months.merge(df, k, project), "orders")
    return months.at(months.last).select("month", "n", F.col("total").cast("double").alias("total"))


@query("""
    SELECT o_orderkey, IF(o_orderkey % 6 = 0, 2, 1)::INT AS version, o_orderkey % 3 = 0 AND o_orderkey % 2 = 1 AS flagged FROM orders
""")
def stream_no_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery brings every third source only, half of them invalid: nothing published is lost."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    first = o.select("o_orderkey", F.lit(1).alias("version"), F.lit(True).alias("valid"))
    second = o.filter("o_orderkey % 3 = 0").select("o_orderkey", F.lit(2).alias("version"), (F.col("o_orderkey") % 2 == 0).alias("valid"))
    published = BucketedTable(spark, "published", "o_orderkey bigint, version int, flagged boolean", ["o_orderkey"])

    def publish(old: DataFrame, batch: DataFrame) -> DataFrame:
        new = batch.select("o_orderkey", F.col("version").alias("__version"), "valid")
        joined = old.join(new, "o_orderkey", "full_outer")
        good = F.coalesce("valid", F.lit(False))
        return joined.select(
            "o_orderkey", F.when(good, F.col("__version")).otherwise(F.col("version")).alias("version"), (F.coalesce("flagged", F.lit(False)) & ~good | F.coalesce(~F.col("valid"), F.lit(False))).alias("flagged")
        ).filter("version IS NOT NULL")

    S.run_deliveries(spark, [first, second], lambda df, k: published.merge(df, k, publish), "sources")
    return published.at(published.last)
