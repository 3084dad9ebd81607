"""Ordered rows: as-of anchors, blocks, ranges, calendars, nearest rows, grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import grid as G
from ..operators import layout as L
from ..session import table
from ..shared import cut
from .registry import query


@query("""
    SELECT event_id, last_value(IF(event_type = 'signup', event_id, NULL) IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS anchor FROM events
""")
def asof_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return L.asof_anchor(e, ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id"))).select("event_id", "anchor")


@query("""
    WITH s AS (SELECT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS last_turn, role FROM conversations)
    SELECT conv_id, turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) - 1, last_turn) AS block_end FROM s WHERE role = 'user'
""")
def block_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    last = c.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))
    return L.blocks(c.filter("role = 'user'").join(last, "conv_id"), ["conv_id"], "turn", F.col("last_turn")).select("conv_id", "turn", "block_end")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, datediff('day', o_orderdate, l_shipdate)::INT AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAY
""")
def range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("low"), F.date_add(F.to_date("o_orderdate"), 30).alias("high"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("day"))
    return L.range_join(lines, ranges, ["l_orderkey"], "day", "low", "high").select("l_orderkey", "l_linenumber", "l_partkey", F.datediff("day", "low").alias("days"))


@query("""
    WITH k AS (SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS m, isodow(o_orderdate) - 1 AS w FROM orders)
    SELECT y::INT AS y, m::INT AS m, w::INT AS w, d::DATE::VARCHAR AS day FROM k, unnest(generate_series(make_date(y, m, 1), last_day(make_date(y, m, 1)), INTERVAL 1 DAY)) t(d) WHERE isodow(d) - 1 = w
""")
def calendar_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    keys = o.select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.weekday("o_orderdate").alias("w")).distinct()
    return L.calendar_expand(keys, F.col("y"), F.col("m"), F.col("w")).withColumn("day", F.col("day").cast("string"))


@query("""
    WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY ALL)
    SELECT user_id, arg_max(event_type, (n, -f)) AS mode, max(n) AS n FROM c GROUP BY 1
""")
def period_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.mode_first_seen(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query("""
    SELECT conv_id, turn, last_value(IF(role = 'user', turn, NULL) IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nearest FROM conversations
""")
def nearest_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return L.nearest_before(c, ["conv_id"], ["turn"], F.when(F.col("role") == "user", F.col("turn")), "nearest").select("conv_id", "turn", "nearest")


@query("""
    SELECT c.conv_id, c.turn, IF(c.turn % 2 = 1, p.text, c.text) AS effective FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1
""")
def inherit_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd turns are merged children: empty, with the turn before as their parent, whose text they show."""
    c = table(spark, sf_dir, "conversations")
    cells = c.select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, F.col("text")).alias("text"), F.when(F.col("turn") % 2 == 1, F.col("turn") - 1).alias("parent"))
    # a parent is an even turn, so that its own text is what it shows
    return G.effective_text(cells, ["conv_id"], "turn", "text", "parent").select("conv_id", "turn", "effective")


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as menu sheets: a header row, a row per turn with a day number, three meal columns."""
    c = table(spark, sf_dir, "conversations")
    heads = c.select("conv_id").distinct().select("conv_id", F.lit(1).alias("row"), F.explode(F.expr("map(2, '조식', 3, '중식', 4, '석식')")).alias("col", "text"))
    days = c.select("conv_id", (F.col("turn") + 2).cast("int").alias("row"), F.lit(1).alias("col"), (F.col("turn") + 1).cast("string").alias("text"))
    words = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    meals = c.select("conv_id", (F.col("turn") + 2).cast("int").alias("row"), F.explode(F.sequence(F.lit(2), F.lit(4))).alias("col"), words.alias("w"))
    food = meals.select("conv_id", "row", "col", F.concat_ws("/", F.filter("w", lambda x, i: i % 3 == F.col("col") - 2)).alias("text")).filter("text <> ''")
    cells = heads.unionByName(days).unionByName(food)
    return cut(cells.select(F.col("conv_id").cast("string").alias("document_id"), F.lit("s").alias("sheet"), "row", F.col("col").alias("column"), "text"), "cells")


@query("""
    SELECT CAST(conv_id AS VARCHAR) AS document_id, 's' AS sheet, IF(count(*) >= 5, 'date_rows_meal_columns', 'weekday_blocks_meal_columns') AS family, 1 AS header_row, count(*) AS n_days FROM conversations GROUP BY conv_id
""")
def grid_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.layout(_grid(spark, sf_dir)).select("document_id", "sheet", "family", "header_row", "n_days")


WORDS = """
    w AS (SELECT conv_id, turn, list_filter(string_split_regex(text, '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w FROM conversations),
    m AS (SELECT conv_id, turn, unnest([1, 2, 3]) AS k, w FROM w),
    c AS (SELECT conv_id, turn, k, list_filter(w, lambda x, i: (i - 1) % 3 = k - 1) AS x FROM m WHERE len(w) >= k AND conv_id IN (SELECT conv_id FROM conversations GROUP BY 1 HAVING count(*) >= 5))
"""


@query(f"""
    WITH {WORDS}, t AS (SELECT conv_id, turn, k, unnest(string_split_regex(array_to_string(x, '/'), '[/,]')) AS item FROM c),
         n AS (SELECT conv_id, turn, k, count(*) AS n FROM t WHERE item <> '' GROUP BY ALL)
    SELECT CAST(conv_id AS VARCHAR) AS document_id, strftime(make_date(2024, 1, (turn + 1)::INT), '%Y-%m-%d') AS day, ['breakfast', 'lunch', 'dinner'][k] AS meal, n::INT AS n_items FROM n
""")
def grid_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the date-rows layout: one per day row and meal column, with its number of items."""
    records = G.date_rows(_grid(spark, sf_dir), F.lit(2024), F.lit(1))
    return records.select("document_id", F.col("day").cast("string").alias("day"), "meal", F.size("items").alias("n_items"))


@query(f"""
    WITH {WORDS}, t AS (SELECT conv_id, turn, k, unnest(string_split_regex(array_to_string(x, '/'), '[/,]')) AS item FROM c),
         n AS (SELECT conv_id, item, count(*) AS a, count(*) FILTER (NOT (conv_id % 4 = 0 AND turn = 0 AND k = 1)) AS b FROM t WHERE item <> '' GROUP BY ALL)
    SELECT CAST(conv_id AS VARCHAR) AS document_id, CAST(sum(a) AS BIGINT) AS n_a, CAST(sum(b) AS BIGINT) AS n_b, CAST(sum(least(a, b)) AS BIGINT) AS n_both FROM n GROUP BY conv_id
""")
def grid_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the turns' words against items of the records: every fourth document's first breakfast is lost on the way, nothing else is."""
    from ..operators.quality import multiset_overlap

    cells = _grid(spark, sf_dir)
    turns = table(spark, sf_dir, "conversations")
    full = turns.groupBy("conv_id").count().filter("count >= 5").select("conv_id")
    item = F.explode(F.flatten(F.transform(F.split("text", r"\s+"), lambda w: F.split(w, "[/,]"))))
    source = turns.join(full, "conv_id", "left_semi").select(F.col("conv_id").cast("string").alias("document_id"), item.alias("item")).filter("item <> ''")
    records = G.date_rows(cells, F.lit(2024), F.lit(1)).filter("NOT (cast(document_id AS bigint) % 4 = 0 AND day = DATE '2024-01-01' AND meal = 'breakfast')")
    return multiset_overlap(source, records.select("document_id", F.explode("items").alias("item")), ["document_id"], "item")
