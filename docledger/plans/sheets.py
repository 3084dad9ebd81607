"""Menu sheets: layouts, extraction, quality, validation, periods.

Every supplier is a document with one sheet of May 2024, in one of four shapes by its key: days in rows (0), blocks of
weekdays (1), meals in rows (2), or nothing that is known (3). Names and numbers of the suppliers are its food. The
equivalents state the records that such sheets must give.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions import text as T
from ..functions.rules import document_role
from ..operators import audit as A
from ..operators import grid as G
from ..operators import periods as P
from ..operators import quality as Q
from ..operators import records as R
from ..session import table
from ..sources import files as S
from ..shared import cut
from .registry import query

YEAR, MONTH = 2024, 5
DAY = "elt(weekday(make_date(2024, 5, d)) + 1, '월', '화', '수', '목', '금', '토', '일')"
NAMED = "elt(w + 1, '월요일', '화', '水', '목요일', '금', '土', '일')"


def _cell(row: str, column: str, text: str, more: str = "false, true, false") -> str:
    formula, resolved, error = more.split(", ")
    return f"named_struct('row', cast({row} AS int), 'column', cast({column} AS int), 'text', {text}, 'formula', {formula}, 'resolved', {resolved}, 'error', {error})"


SHAPES = {
    0: [
        "array(" + ", ".join([_cell("1", "1", "concat('2024년 5월 수용자 식단표 ', s_name)"), _cell("2", "3", "'조식'"), _cell("2", "4", "'중식'"), _cell("2", "5", "'석식'")]) + ")",
        "flatten(transform(sequence(1, 10), d -> array("
        + ", ".join([
            _cell("1 + 2 * d", "1", DAY), _cell("1 + 2 * d", "2", "cast(d AS string)"), _cell("2 + 2 * d", "2", "''"), _cell("1 + 2 * d", "3", "concat('rice/', k + 1000)"), _cell("2 + 2 * d", "3", "'soup'"),
            _cell("1 + 2 * d", "4", "s_name"), _cell("2 + 2 * d", "4", "'1,200'"), _cell("1 + 2 * d", "5", "IF(d = 7, '#REF!', IF(d = 9, '-', 'egg'))", "d = 6, k % 8 > 0, d = 7"),
            _cell("2 + 2 * d", "5", "IF(d % 5 = 0, '1,200원', IF(d = 9, 'egg', ''))"),
        ])
        + ")))",
        "array(" + ", ".join([_cell("23", "1", "'비고'"), _cell("24", "2", "'31'"), _cell("24", "3", "'ghost'")]) + ")",
    ],
    1: [
        "array(" + ", ".join([_cell("1", "2", "'조식'"), _cell("1", "3", "'점심'"), _cell("1", "4", "'석식'"), _cell("16", "1", "''"), _cell("16", "3", "'last'"), _cell("17", "1", "'※ note'"), _cell("17", "2", "'ghost'")]) + ")",
        "flatten(transform(sequence(0, 6), w -> array("
        + ", ".join([
            _cell("2 + 2 * w", "1", "IF(k % 8 = 1, concat(pmod(w - 2, 7) + 1, '일'), '')"), _cell("3 + 2 * w", "1", NAMED), _cell("2 + 2 * w", "2", "'rice'"), _cell("3 + 2 * w", "2", "concat('soup', w)"),
            _cell("2 + 2 * w", "3", "'noodle (cold, hot)'"), _cell("2 + 2 * w", "4", "'fish, tea'"),
        ])
        + ")))",
    ],
    2: [
        "array(" + ", ".join([_cell("1", "1", "'교도관 식단'"), _cell("3", "1", "'조식'"), _cell("5", "1", "'중식'"), _cell("7", "1", "'석식'"), _cell("9", "1", "'원산지 표'"), _cell("9", "2", "'ghost'")]) + ")",
        f"flatten(transform(sequence(0, 6), w -> array({_cell('2', '2 + w', NAMED)}, "
        + ", ".join(_cell(f"{3 + 2 * j}", "2 + w", f"concat('m{j}·', w)") + ", " + _cell(f"{4 + 2 * j}", "2 + w", f"concat('x{j}·', k)") for j in range(3))
        + ")))",
    ],
    3: ["array(" + ", ".join([_cell("2", "2", "'조식 5/3'"), _cell("4", "3", "s_name"), _cell("4", "4", "'12일'"), _cell("6", "2", "''")]) + ")"],
}


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_suppkey").cast("string").alias("document_id"), F.lit("s").alias("sheet"), "s_name", "s_nationkey")


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cells, with their merges: days over two rows, a footer over labels and meals, an empty merge on unknown sheets."""
    d = _documents(spark, sf_dir)
    parts = [d.filter(f"k % 4 = {kind}").selectExpr("document_id", "sheet", f"inline({x})") for kind, xs in SHAPES.items() for x in xs]
    cells = parts[0]
    for p in parts[1:]:
        cells = cells.unionByName(p)
    box = "named_struct('top', {0}, 'bottom', {1}, 'left', {2}, 'right', {3})"
    days = d.filter("k % 4 = 0").selectExpr("document_id", "sheet", f"inline(transform(sequence(1, 10), d -> {box.format('1 + 2 * d', '2 + 2 * d', '2', '2')}))")
    feet = d.filter("k % 4 = 0").selectExpr("document_id", "sheet", f"inline(array({box.format(23, 23, 1, 3)}))")
    empty = d.filter("k % 4 = 3").selectExpr("document_id", "sheet", f"inline(array({box.format(6, 7, 2, 2)}))")
    return cut(G.with_merges(cells, days.unionByName(feet).unionByName(empty)), "sheets")


@F.pandas_udf(BinaryType())
def packages(keys: pd.Series) -> pd.Series:
    """The smallest OOXML package."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("[Content_Types].xml", "x")
    return pd.Series([out.getvalue()] * len(keys))


def _records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cells and their records, which are extracted once, however often a query reads them."""
    cells = _cells(spark, sf_dir)
    return cells, cut(G.extract(cells, F.lit(YEAR), F.lit(MONTH)), "records")


#: The records of all shapes: i and s are items and coordinates of their cells.
EXPECTED = """
    days AS (SELECT d::DATE AS day, isodow(d) - 1 AS w FROM generate_series(DATE '2024-05-01', DATE '2024-05-31', INTERVAL 1 DAY) t(d)),
    doc AS (SELECT s_suppkey AS k, s_suppkey::VARCHAR AS document_id, s_name FROM supplier),
    a AS (SELECT k, document_id, day, w, day(day) AS d, 1 + 2 * day(day) AS top, s_name FROM doc, days WHERE k % 4 = 0 AND day(day) <= 10),
    b AS (SELECT k, document_id, day, z.w, 2 + 2 * z.w AS top, IF(z.w = 6, 16, 3 + 2 * z.w) AS bottom FROM doc, (SELECT unnest(range(7)) AS w) z, days WHERE k % 4 = 1 AND IF(k % 8 = 1, day(day) = (z.w + 5) % 7 + 1, days.w = z.w)),
    c AS (SELECT k, document_id, day, w, chr(66 + w::INT) AS l FROM doc, days WHERE k % 4 = 2),
    r AS (
        SELECT k, document_id, day, w, 'breakfast' AS meal, top, top + 1 AS bottom, ['rice', (k + 1000)::VARCHAR, 'soup'] AS i, ['C' || top, 'C' || (top + 1)] AS s, 'date_rows_meal_columns' AS family FROM a
        UNION ALL SELECT k, document_id, day, w, 'lunch', top, top + 1, [s_name], ['D' || top], 'date_rows_meal_columns' FROM a
        UNION ALL SELECT k, document_id, day, w, 'dinner', top, top + 1, list_concat([CASE d WHEN 7 THEN '#REF!' WHEN 9 THEN '-' ELSE 'egg' END], IF(d % 5 = 0, ['1,200원'], IF(d = 9, ['egg'], []))),
          list_concat(['E' || top], IF(d % 5 = 0 OR d = 9, ['E' || (top + 1)], [])), 'date_rows_meal_columns' FROM a
        UNION ALL SELECT k, document_id, day, w, 'breakfast', top, bottom, ['rice', 'soup' || w], ['B' || top, 'B' || (top + 1)], 'weekday_blocks_meal_columns' FROM b
        UNION ALL SELECT k, document_id, day, w, 'lunch', top, bottom, list_concat(['noodle (cold, hot)'], IF(w = 6, ['last'], [])), list_concat(['C' || top], IF(w = 6, ['C16'], [])), 'weekday_blocks_meal_columns' FROM b
        UNION ALL SELECT k, document_id, day, w, 'dinner', top, bottom, ['fish', 'tea'], ['D' || top], 'weekday_blocks_meal_columns' FROM b
        UNION ALL SELECT k, document_id, day, w, ['breakfast', 'lunch', 'dinner'][j + 1], 3 + 2 * j, 4 + 2 * j, ['m' || j || '·' || w, 'x' || j || '·' || k], [l || (3 + 2 * j), l || (4 + 2 * j)], 'meal_rows_weekday_columns' FROM c, (SELECT unnest(range(3)) AS j)
    ),
    q AS (SELECT *, list_filter(i, lambda x: x NOT IN ('#REF!', '-', '1,200원')) AS clean, family = 'date_rows_meal_columns' AND meal = 'dinner' AND (day(day) IN (7, 9) OR (day(day) = 6 AND k % 8 = 0)) AS unresolved FROM r)
"""


@query("""
    SELECT s_suppkey::VARCHAR AS document_id, ['date_rows_meal_columns', 'weekday_blocks_meal_columns', 'meal_rows_weekday_columns'][s_suppkey % 4 + 1] AS family, 'high' AS confidence,
      [2, 1, 3][s_suppkey % 4 + 1] AS header_row, [22, 17, NULL][s_suppkey % 4 + 1] AS body_end, [10, IF(s_suppkey % 8 = 1, 7, 0), NULL][s_suppkey % 4 + 1]::BIGINT AS n_days FROM supplier WHERE s_suppkey % 4 < 3
""")
def sheet_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Family of each sheet with its evidence; unknown ones have none."""
    return G.layout(_cells(spark, sf_dir)).select("document_id", "family", "confidence", "header_row", "body_end", "n_days")


@query("""
    SELECT s_suppkey::VARCHAR AS document_id, [1, 1, 1, 2][k] AS min_row, [24, 17, 9, 7][k] AS max_row, [1, 1, 1, 2][k] AS min_column, [5, 4, 8, 4][k] AS max_column, [24, 17, 9, 6][k] AS rows, [5, 4, 8, 3][k] AS columns
    FROM (SELECT *, s_suppkey % 4 + 1 AS k FROM supplier)
""")
def used_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir)
    # a merge reaches beyond its only stored cell
    below = cells.filter("bottom > row").select("document_id", "sheet", F.col("bottom").alias("row"), "column", F.lit("").alias("text"), F.lit(True).alias("child"))
    stored = cells.select("document_id", "sheet", "row", "column", "text", "child", "bottom")
    return G.used_range(stored.unionByName(below, allowMissingColumns=True)).drop("sheet")


@query("""
    SELECT s_suppkey::VARCHAR AS document_id, 1 + 2 * d AS parent_row, 2 + 2 * d AS child_row, d::VARCHAR AS shown FROM supplier, (SELECT unnest(range(1, 11)) AS d) WHERE s_suppkey % 4 = 0
""")
def merged_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of merges, with the text that they show."""
    rows = _cells(spark, sf_dir).filter("child").select("document_id", (F.col("row") - 1).alias("parent_row"), F.col("row").alias("child_row"), F.col("parent_text").alias("shown"))
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("parent_row", "child_row")})


@query("""
    SELECT s_suppkey::VARCHAR AS document_id, 2 AS day_column, 11::BIGINT AS n FROM supplier WHERE s_suppkey % 4 = 0
""")
def sheet_day_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir)
    return G.day_columns(cells, G.layout(cells).filter(F.col("family") == G.FAMILIES[0])).select("document_id", "day_column", "n")


@query(f"WITH {EXPECTED} SELECT document_id, day::VARCHAR AS day, meal, w::INT AS weekday, top::INT AS top, bottom::INT AS bottom, array_to_string(i, '|') AS items, array_to_string(s, ' ') AS source, family FROM r")
def sheet_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all three layouts with their items, blocks and source cells."""
    out = _records(spark, sf_dir)[1]
    return out.select("document_id", F.col("day").cast("string").alias("day"), "meal", "weekday", "top", "bottom", F.array_join("items", "|").alias("items"), F.array_join("source", " ").alias("source"), "family")


@query("""
    SELECT s_suppkey::VARCHAR AS document_id, 2 AS min_row, 6 AS max_row, 2 AS min_column, 4 AS max_column, 1::BIGINT AS n_merges, '조식' AS keywords, '조식 5/3|' || '12일' AS samples, 'none' AS closest FROM supplier WHERE s_suppkey % 4 = 3
""")
def sheet_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What unknown sheets look like."""
    out = G.diagnose(_cells(spark, sf_dir), tuple(x for names in G.MEALS.values() for x in names))
    return out.select("document_id", "min_row", "max_row", "min_column", "max_column", "n_merges", F.array_join("keywords", ",").alias("keywords"), F.array_join("samples", "|").alias("samples"), "closest")


@query("""
    SELECT s_suppkey::VARCHAR AS document_id, CASE s_suppkey % 3 WHEN 0 THEN '수용자' WHEN 1 THEN '일반' ELSE '교도관' END AS sheet FROM supplier WHERE s_suppkey % 4 < 3
""")
def sheet_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's sheets under several names: inmates', general, staff's. Which exist depends on its key."""
    lay = G.layout(_cells(spark, sf_dir)).select("document_id", F.col("document_id").cast("int").alias("k"))
    names = F.array(F.lit("직원"), F.lit("수용자 직원"), F.lit("교도관"), F.lit("일반"), F.lit("수용자"))
    have = F.when(F.col("k") % 3 == 0, names).when(F.col("k") % 3 == 1, F.slice(names, 1, 4)).otherwise(F.array(F.lit("교도관"), F.lit("직원")))
    sheets = lay.select("document_id", F.posexplode(have).alias("position", "sheet"))
    return G.choose_sheets(sheets, "position").select("document_id", "sheet")


@query(f"""
    WITH {EXPECTED} SELECT document_id, CAST(sum(IF(day(day) % 5 = 0, 1, 0)) FILTER (family = 'date_rows_meal_columns' AND meal = 'dinner') AS BIGINT) AS excluded_artifacts,
      CAST(coalesce(sum(1) FILTER (list_contains(i, '#REF!')), 0) AS BIGINT) AS excel_error_menu_items, CAST(coalesce(sum(1) FILTER (list_contains(i, '-')), 0) AS BIGINT) AS unresolved_non_menu_artifacts,
      CAST(IF(k % 8 = 0, 1, 0) AS BIGINT) AS unresolved_formula_values, count(*) FILTER (unresolved) AS unresolved_slots, NOT bool_or(unresolved) AS menu_quality_valid
    FROM q WHERE k % 4 = 0 GROUP BY document_id, k
    UNION ALL SELECT document_id, 0, 0, 0, 0, 0, TRUE FROM q WHERE k % 4 <> 0 GROUP BY 1
""")
def sheet_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of menus per document: prices dropped, errors and placeholders quarantined, an open formula found."""
    cells, records = _records(spark, sf_dir)
    return R.quality_summary(R.menu_quality(records, cells))


@query(f"""
    WITH {EXPECTED} SELECT document_id, day::VARCHAR AS day, t.a AS item, t.c AS classification, t.s AS source_cell, IF(t.c = 'price', 'excluded_from_menu', 'quarantined') AS action FROM (
      SELECT *, unnest([struct_pack(a := '#REF!', c := 'excel_error', s := 'E' || top), struct_pack(a := '-', c := 'placeholder', s := 'E' || top), struct_pack(a := '1,200원', c := 'price', s := 'E' || (top + 1))]) AS t FROM r) WHERE list_contains(i, t.a)
""")
def menu_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts among the items, with the cell that each came from."""
    cells, records = _records(spark, sf_dir)
    rows = R.menu_quality(records, cells).select("document_id", F.col("day").cast("string").alias("day"), F.explode("artifacts").alias("x"))
    return rows.select("document_id", "day", F.col("x.raw_text").alias("item"), "x.classification", "x.source_cell", "x.action")


def _judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records with faults planted by the day: a date of June, a wrong weekday, a second record of the slot, a lost cell, no attachment."""
    cells, records = _records(spark, sf_dir)
    good = cut(R.menu_quality(records, cells), "quality")  # read by four branches
    d, late = F.dayofmonth("day"), F.col("meal") == "lunch"
    rows = good.withColumn("attachment_id", F.when((d == 2) & late, F.lit("")).otherwise(F.lit("a1")))
    rows = rows.withColumns({
        "source": F.when((d == 3) & late, F.array(F.lit("ZZ99"))).otherwise(F.col("source")),
        "weekday": F.when((d == 4) & late, (F.col("weekday") + 1) % 7).otherwise(F.col("weekday")),
        "clean": F.when((d == 5) & late, F.array().cast("array<string>")).otherwise(F.col("clean")),
    })
    again = rows.filter((F.dayofmonth("day") == 6) & late).withColumn("at", F.lit(99))
    moved = rows.filter((F.dayofmonth("day") == 7) & late).withColumns({"day": F.date_add("day", 28), "at": F.lit(98)})
    lost = rows.filter((F.dayofmonth("day") == 8) & late).withColumns({"day": F.lit(None).cast("date"), "at": F.lit(97)})
    return cells, cut(rows.unionByName(again).unionByName(moved).unionByName(lost), "judged")


@query(f"""
    WITH {EXPECTED}, p AS (
        SELECT document_id, day, meal, unresolved, day(day) AS d, meal = 'lunch' AS l, 0 AS extra, len(clean) = 0 AS e FROM q UNION ALL SELECT document_id, day, meal, unresolved, 6, TRUE, 1, FALSE FROM q WHERE day(day) = 6 AND meal = 'lunch'
        UNION ALL SELECT document_id, day + 28, meal, unresolved, 7, TRUE, 2, FALSE FROM q WHERE day(day) = 7 AND meal = 'lunch' UNION ALL SELECT document_id, NULL, meal, unresolved, 8, TRUE, 3, FALSE FROM q WHERE day(day) = 8 AND meal = 'lunch'),
    z AS (SELECT *, list_filter([IF(e OR (l AND d = 5 AND extra = 0), 'BLANK_MEAL', NULL), IF(extra = 2, 'DATE_OUTSIDE_MEAL_MONTH', NULL), IF(l AND d = 6, 'DUPLICATE_DATE_MEAL', NULL), IF(extra = 3, 'INVALID_DATE', NULL),
          IF(l AND d = 3, 'INVALID_SOURCE_CELL', NULL), IF(l AND d = 2, 'MISSING_INPUT_LINK', NULL), IF(unresolved, 'UNRESOLVED_MENU_SLOT', NULL), IF(l AND d = 4, 'WEEKDAY_MISMATCH', NULL)], lambda x: x IS NOT NULL) AS i FROM p)
    SELECT document_id, day::VARCHAR AS day, meal, array_to_string(i, ',') AS issues, CASE WHEN len(i) = 0 THEN 'valid' WHEN i = ['DATE_OUTSIDE_MEAL_MONTH'] THEN 'warning' ELSE 'invalid' END AS status FROM z
""")
def sheet_record_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation of records: all eight codes."""
    cells, rows = _judged(spark, sf_dir)
    out = R.validate(rows, cells, F.lit(YEAR), F.lit(MONTH))
    return out.select("document_id", F.col("day").cast("string").alias("day"), "meal", F.array_join("issues", ",").alias("issues"), "status")


@query(f"""
    WITH {EXPECTED}, g AS (SELECT DISTINCT document_id, day, meal FROM q WHERE len(clean) > 0 AND NOT unresolved), s AS (SELECT document_id, day, list_sort(list(meal)) AS m FROM g GROUP BY ALL)
    SELECT document_id, 'MISSING_MEAL_DATE' AS code, day::VARCHAR AS message FROM (SELECT document_id, day FROM (SELECT DISTINCT document_id FROM r), days) ANTI JOIN s USING (document_id, day)
    UNION ALL SELECT document_id, 'MISSING_DAILY_MEAL', day::VARCHAR || ': missing ' || array_to_string(list_filter(['breakfast', 'dinner', 'lunch'], lambda x: NOT list_contains(m, x)), ',') FROM s WHERE len(m) < 3
""")
def sheet_document_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, records = _records(spark, sf_dir)
    return R.document_issues(cut(R.menu_quality(records, cells), "quality"), YEAR, MONTH)


@query(f"""
    WITH {EXPECTED}, g AS (SELECT document_id, k, count(*) AS n, count(*) FILTER (unresolved) AS u, count(DISTINCT day) AS days, count(DISTINCT IF(NOT unresolved AND len(clean) > 0, day::VARCHAR || meal, NULL)) AS seen FROM q GROUP BY ALL)
    SELECT document_id, n AS records, u AS invalid, CASE WHEN u > 0 OR seen < 93 THEN 'PARTIAL' ELSE 'PASS' END AS status, CASE WHEN seen = 93 THEN 'full' ELSE 'partial' END AS verdict FROM g
    UNION ALL SELECT s_suppkey::VARCHAR, 0, 0, 'FAIL', 'failed' FROM supplier WHERE s_suppkey % 4 = 3
""")
def doc_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of documents from their records and coverage, and the verdict on their coverage."""
    cells, records = _records(spark, sf_dir)
    rows = cut(R.menu_quality(records, cells).withColumn("attachment_id", F.lit("a1")), "quality")
    judged = R.validate(rows, cells, F.lit(YEAR), F.lit(MONTH))
    good = F.when(~F.col("unresolved") & (F.size("clean") > 0), F.struct("day", "meal"))
    per = judged.groupBy("document_id").agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("status") == "invalid").alias("invalid"), F.countDistinct(good).alias("seen"))
    joined = _documents(spark, sf_dir).select("document_id").hint("merge").join(per, "document_id", "left").fillna(0, ["records", "invalid", "seen"])
    none = F.lit(0)
    status = R.document_status(F.col("records"), none, F.col("invalid"), none, F.col("seen") == 93, F.lit(True))
    return joined.select("document_id", "records", "invalid", status.alias("status"), R.coverage_verdict(F.col("seen"), F.lit(93), F.col("records") == 0).alias("verdict"))


@query(f"""
    WITH {EXPECTED}, e AS (SELECT *, IF(k % 3 = 0, ['milk'], clean) AS c, IF(k % 3 = 0, ['A1', 'A2'], s) AS o FROM q WHERE len(clean) > 0)
    SELECT document_id, IF(any_value(len(c)) = 1, 'IDENTICAL_SINGLE_ITEM_THREE_MEALS', 'IDENTICAL_THREE_MEALS') AS code, day::VARCHAR AS detail FROM e GROUP BY document_id, day HAVING count(DISTINCT meal) = 3 AND count(DISTINCT c) = 1
    UNION ALL SELECT document_id, 'MULTIPLE_CELLS_SINGLE_ITEM', day::VARCHAR || ' ' || meal FROM e WHERE len(c) = 1 AND len(o) > 1
    UNION ALL SELECT document_id, 'MOSTLY_SINGLE_ITEM', (count(*) FILTER (len(c) = 1))::VARCHAR FROM e GROUP BY 1 HAVING count(*) FILTER (len(c) = 1) >= 0.9 * count(*)
    UNION ALL SELECT document_id, 'LONG_SINGLE_ITEM_REPETITION', c[1] || ' x' || count(*) FROM e WHERE len(c) = 1 GROUP BY document_id, c[1] HAVING count(*) >= 15
""")
def suspicious_meals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suspicion by all four rules; every third document has milk from two cells for every meal."""
    cells, records = _records(spark, sf_dir)
    rows, milk = R.menu_quality(records, cells).filter("size(clean) > 0"), F.col("document_id").cast("int") % 3 == 0
    rows = rows.withColumns({"clean": F.when(milk, F.array(F.lit("milk"))).otherwise(F.col("clean")), "source": F.when(milk, F.array(F.lit("A1"), F.lit("A2"))).otherwise(F.col("source"))})
    return R.suspicious_meals(cut(rows, "suspects"))


@query("""
    SELECT s_suppkey::VARCHAR AS document_id, CASE WHEN s_suppkey % 4 = 2 THEN IF(s_suppkey % 3 = 0, 'STAFF_TABLE_SELECTED,SUPPLEMENTARY_ONLY_TABLE', IF(s_suppkey % 3 = 1, 'STAFF_TABLE_SELECTED,SUPPLEMENTARY_SCOPE_UNCERTAIN', 'STAFF_TABLE_SELECTED'))
      ELSE IF(s_suppkey % 3 = 0, 'SUPPLEMENTARY_ONLY_TABLE', 'SUPPLEMENTARY_SCOPE_UNCERTAIN') END AS warnings FROM supplier WHERE s_suppkey % 4 = 2 OR (s_suppkey % 4 = 1 AND s_suppkey % 8 <> 1 AND s_suppkey % 3 < 2) OR (s_suppkey % 4 < 2 AND s_suppkey % 3 = 0)
""")
def scope_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles planted in row 1: a table that adds to another, a juvenile table whose breakfasts are all milk."""
    cells, records = _records(spark, sf_dir)
    d, k = _documents(spark, sf_dir), F.col("k") % 3
    text = F.when(k == 0, "소년 수용자 기존 식단에 빵 추가").when(k == 1, "소년 수용자 식단")
    title = d.filter("k % 4 < 3").select("document_id", "sheet", F.lit(1).alias("row"), F.lit(9).alias("column"), text.alias("text")).filter("text IS NOT NULL")
    all_cells = cells.unionByName(G.complete(title), allowMissingColumns=True)
    milk = records.withColumn("clean", F.array(F.lit("우유")))
    return R.scope_warnings(all_cells, milk).select("document_id", F.array_join("warnings", ",").alias("warnings"))




@query("""
    WITH p AS (SELECT s_suppkey::VARCHAR AS document_id, s_suppkey % 4 = 0 AS t, s_suppkey % 7 AS v FROM supplier)
    SELECT document_id, CASE WHEN v < 2 THEN 2024 WHEN v = 2 THEN 2023 WHEN t THEN 2024 WHEN v = 6 THEN NULL ELSE 2025 END::INT AS year,
      CASE WHEN v < 2 THEN 5 WHEN v = 2 THEN 4 WHEN t THEN 5 WHEN v IN (3, 5) THEN 11 END::INT AS month,
      array_to_string(list_filter([IF(v < 3, 'historical metadata year/month', NULL), IF(v > 2 AND t, 'workbook cell year/month', NULL), IF(v IN (3, 5) AND NOT t, 'filename month', NULL),
        IF(v IN (3, 4, 5) AND NOT t, 'publication year', NULL), IF((v = 1 AND t) OR (v = 5 AND t), 'publication fallback confirmed', NULL), IF(v = 1 AND NOT t, 'publication fallback not confirmed', NULL)], lambda x: x IS NOT NULL), ';') AS evidence,
      array_to_string(list_filter([IF(v = 2 AND t, 'PERIOD_CONFLICT', NULL), IF((v IN (3, 4, 5) OR v = 1) AND NOT t, 'YEAR_INFERRED_FROM_PUBLICATION', NULL)], lambda x: x IS NOT NULL), ',') AS warnings FROM p
""")
def period_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven kinds of metadata against sheets that name May 2024 in their title (every fourth) or nothing."""
    v = F.col("k") % 7
    number = lambda x: F.lit(x).cast("int")
    samples = _documents(spark, sf_dir).select(
        "document_id",
        F.when(v < 2, number(YEAR)).when(v == 2, number(2023)).alias("meal_year"),
        F.when(v < 2, number(MONTH)).when(v == 2, number(4)).alias("meal_month"),
        F.when(v.isin(3, 5), "menu_11월.xlsx").otherwise("menu.xlsx").alias("filename"),
        F.when(v.isin(3, 4, 5), "2025-10-30").alias("published_date"),
        v.isin(1, 5).alias("year_inferred"),
        number(None).alias("filename_year"),
        number(None).alias("filename_month"),
    )
    out = P.resolve_period(samples, P.period_evidence(_cells(spark, sf_dir)))
    return out.select("document_id", "year", "month", F.array_join("evidence", ";").alias("evidence"), F.array_join("warnings", ",").alias("warnings"))


ROLES = """
    SELECT p_partkey, CASE p_partkey % 10 WHEN 0 THEN 'mixed' WHEN 1 THEN 'inmate' WHEN 2 THEN 'inmate' WHEN 3 THEN 'staff' WHEN 4 THEN 'supplementary' WHEN 5 THEN 'other' ELSE 'unknown' END AS role,
      CASE p_partkey % 10 WHEN 0 THEN 'filename_inmate_and_staff' WHEN 1 THEN 'filename_inmate_with_supplementary_term' WHEN 2 THEN 'filename_inmate_keyword' WHEN 3 THEN 'filename_staff_keyword' WHEN 4 THEN 'filename_supplementary_keyword'
        WHEN 5 THEN 'filename_non_meal_admin_keyword' WHEN 6 THEN 'generic_meal_table_with_staff_sibling' WHEN 7 THEN 'ambiguous_title_context_inmate' WHEN 8 THEN 'generic_meal_table_without_subject' ELSE 'no_matching_rule' END AS rule,
      CASE p_partkey % 10 WHEN 0 THEN 0.98 WHEN 1 THEN 0.82 WHEN 2 THEN 0.97 WHEN 3 THEN 0.97 WHEN 4 THEN 0.88 WHEN 5 THEN 0.95 WHEN 6 THEN 0.45 WHEN 7 THEN 0.25 WHEN 8 THEN 0.15 ELSE 0.0 END::DOUBLE AS confidence FROM part
"""


@query(ROLES)
def document_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of attachments by file name, title and siblings of the post. A part and the next one are a post's files."""
    names = ["수용자 직원 식단", "수용자 빵표", "수용자 메뉴", "직원 메뉴", "빵표", "업무추진비", "식단표", "plan", "차림표", "misc"]
    k = (F.col("p_partkey") % 10).cast("int")
    files = table(spark, sf_dir, "part").select("p_partkey", k.alias("k"), F.concat(F.get(F.array(*map(F.lit, names)), k), F.lit(" "), "p_name").alias("name"))
    sibling = F.when(F.col("k") == 6, F.array("name", F.lit("직원 식단표"))).otherwise(F.array("name"))
    title = F.when(F.col("k") == 7, "수용자 안내").otherwise("notice")
    return files.select("p_partkey", document_role(F.col("name"), title, sibling).alias("r")).select("p_partkey", "r.role", "r.rule", "r.confidence")


@query("""
    SELECT s_suppkey::VARCHAR AS document_id, array_to_string(list_filter([IF(v = 5, 'EMPTY_ITEMS', NULL), IF(v = 6, 'LAYOUT', NULL), IF(v = 2, 'MEAL_TYPE', NULL), IF(v = 4, 'PROVENANCE', NULL), IF(v IN (0, 1), 'SCHEMA_VERSION', NULL), IF(v IN (1, 3), 'STATUS', NULL)], lambda x: x IS NOT NULL), ',') AS issues
    FROM (SELECT s_suppkey, s_suppkey % 8 AS v FROM supplier)
""")
def ready_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract of published records, each part broken by some."""
    v = F.col("k") % 8
    items = F.when(v == 5, F.array().cast("array<string>")).otherwise(F.array("s_name"))
    issues = R.ready_issues(
        F.when(v == 0, F.lit(None)).when(v == 1, "0.9").otherwise("1.0"), F.when(v == 2, "snack").otherwise("lunch"), F.when(v.isin(1, 3), "warning").otherwise("valid"), items,
        [F.when(v != 4, F.col("document_id")), F.lit("A1")], F.when(v == 6, "unknown").otherwise(G.FAMILIES[1]), G.FAMILIES,
    )
    return _documents(spark, sf_dir).select("document_id", F.array_join(issues, ",").alias("issues"))


@query(f"""
    WITH {EXPECTED} SELECT document_id, CAST(sum(len(i)) AS BIGINT) AS n_a, CAST(sum(len(i) - IF(len(i) > 2 AND k % 5 = 0, 1, 0)) AS BIGINT) AS n_b, CAST(sum(len(i) - IF(len(i) > 2 AND k % 5 = 0, 1, 0)) AS BIGINT) AS n_both FROM r GROUP BY 1
""")
def source_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the cells in each record's block against its items; every fifth document lost the last of three items."""
    cells, records = _records(spark, sf_dir)
    keys = ["document_id", "sheet", "day", "meal"]
    c = G.menu_cells(cells).select(*[F.col(x).alias(f"__{x}") for x in G.SHEET], "row", "column", "text")
    on = (records["document_id"] == c["__document_id"]) & (records["sheet"] == c["__sheet"]) & (records["at"] == c["column"]) & c["row"].between(records["top"], records["bottom"])
    source = records.hint("merge").join(c, on).select(*keys, F.explode(R.menu_tokens(F.col("text"))).alias("item"))
    short = (F.size("items") > 2) & (F.col("document_id").cast("int") % 5 == 0)
    found = records.select(*keys, F.explode(F.when(short, F.slice("items", 1, 2)).otherwise(F.col("items"))).alias("item"))
    per = Q.multiset_overlap(source, found, keys, "item")
    return per.groupBy("document_id").agg(*[F.sum(x).alias(x) for x in ("n_a", "n_b", "n_both")])


@query("""
    SELECT s_suppkey::VARCHAR AS document_id, IF(s_suppkey % 4 = 0, 2, 1) AS header_row, IF(s_suppkey % 4 = 0, 3, 2) AS breakfast, IF(s_suppkey % 4 = 0, 4, 3) AS lunch, IF(s_suppkey % 4 = 0, 5, 4) AS dinner FROM supplier WHERE s_suppkey % 4 < 2
""")
def header_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each sheet that names all meals, with their columns."""
    return G.headers(_cells(spark, sf_dir)).select("document_id", "header_row", "columns.*")


@query("SELECT s_suppkey::VARCHAR AS document_id, IF(s_suppkey % 4 = 0, 22, 16) AS body_end FROM supplier WHERE s_suppkey % 4 < 2")
def footer_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last row of each table: before a merge from the labels into the meals, or before a note."""
    cells = _cells(spark, sf_dir)
    starts = G.headers(cells).select("document_id", "sheet", F.col("header_row").alias("start"), F.least("columns.breakfast", "columns.lunch", "columns.dinner").alias("first_meal"))
    return G.body_ends(cells, starts, notes=True).select("document_id", "body_end")


@query(f"""
    WITH {EXPECTED}, g AS (SELECT document_id, any_value(family) AS layout, bool_or(unresolved) AS bad FROM q GROUP BY 1)
    SELECT IF(bad, 'review', 'ready') AS route, layout, count(*) AS n FROM g GROUP BY ALL UNION ALL SELECT 'review', 'undetected', count(*) FROM supplier WHERE s_suppkey % 4 = 3
""")
def route_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes against layouts; documents without a layout count as undetected."""
    cells, records = _records(spark, sf_dir)
    judged = R.menu_quality(records, cells).groupBy("document_id").agg(F.collect_set("family").alias("families"), F.bool_or("unresolved").alias("bad"))
    rows = _documents(spark, sf_dir).select("document_id").hint("merge").join(judged, "document_id", "left").withColumn("layout", F.explode(F.coalesce("families", F.array(F.lit("undetected")))))
    return rows.groupBy(F.when(F.coalesce("bad", F.lit(True)), "review").otherwise("ready").alias("route"), "layout").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    WITH {EXPECTED}, g AS (SELECT k, any_value(family) AS layout, bool_or(unresolved) AS bad FROM q GROUP BY 1),
         d AS (SELECT s_suppkey AS k, coalesce(layout, 'undetected') AS layout, IF(s_suppkey % 5 = 0, 'xls', 'xlsx') AS extension, CASE WHEN s_suppkey % 7 = 0 THEN 'unknown' WHEN s_suppkey % 10 = 0 THEN 'ole' ELSE 'ooxml' END AS detected,
                      CASE WHEN s_suppkey % 7 = 0 THEN 'failed' WHEN bad OR layout IS NULL THEN 'review' ELSE 'ready' END AS route FROM supplier LEFT JOIN g ON k = s_suppkey),
         x AS (SELECT route, unnest(['extension', 'detected', 'layout']) AS dimension, unnest([extension, detected, layout]) AS value FROM d)
    SELECT dimension, value, count(*) AS documents, count(*) FILTER (route = 'ready') AS ready, count(*) FILTER (route = 'review') AS review, count(*) FILTER (route = 'failed') AS failed FROM x GROUP BY ALL
""")
def route_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes against declared formats, formats by content, and layouts, in one pass. Files of unknown content fail."""
    k = F.col("k")
    cells, records = _records(spark, sf_dir)
    judged = R.menu_quality(records, cells).groupBy("document_id").agg(F.collect_set("family").alias("layout"), F.bool_or("unresolved").alias("bad"))
    content = F.when(k % 7 == 0, F.lit("plain").cast("binary")).when(k % 10 == 0, F.unhex(F.lit("D0CF11E0A1B11AE1"))).otherwise(packages(k))
    d = _documents(spark, sf_dir).select("document_id", F.when(k % 5 == 0, "xls").otherwise("xlsx").alias("extension"), S.detected_format(content).alias("detected")).hint("merge").join(judged, "document_id", "left")
    route = F.when(F.col("detected") == "unknown", "failed").when(F.coalesce("bad", F.lit(True)), "review").otherwise("ready")
    return A.route_tables(d.withColumn("route", route), "route", ["ready", "review", "failed"], {"extension": F.col("extension"), "detected": F.col("detected"), "layout": F.col("layout")})


@query(f"""
    WITH {EXPECTED}, p AS (SELECT document_id, day(day) AS d, meal = 'lunch' AS l, len(clean) = 0 AS e, unresolved FROM q),
    x AS (SELECT 'BLANK_MEAL' AS code, count(*) AS n FROM p WHERE e OR (l AND d = 5) UNION ALL SELECT 'DATE_OUTSIDE_MEAL_MONTH', count(*) FROM p WHERE l AND d = 7 UNION ALL SELECT 'DUPLICATE_DATE_MEAL', 2 * count(*) FROM p WHERE l AND d = 6
      UNION ALL SELECT 'INVALID_DATE', count(*) FROM p WHERE l AND d = 8 UNION ALL SELECT 'INVALID_SOURCE_CELL', count(*) FROM p WHERE l AND d = 3 UNION ALL SELECT 'MISSING_INPUT_LINK', count(*) FROM p WHERE l AND d = 2
      UNION ALL SELECT 'UNRESOLVED_MENU_SLOT', count(*) FROM p WHERE unresolved UNION ALL SELECT 'WEEKDAY_MISMATCH', count(*) FROM p WHERE l AND d = 4) SELECT * FROM x WHERE n > 0
""")
def issue_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each issue code stands in the records' arrays."""
    cells, rows = _judged(spark, sf_dir)
    issues = R.validate(rows, cells, F.lit(YEAR), F.lit(MONTH)).select(F.explode("issues").alias("code"))
    return issues.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    WITH {EXPECTED}, x AS (SELECT document_id, k, day(day) AS d, unnest(list_filter(i, lambda x: x IN ('#REF!', '-', '1,200원'))) AS t FROM r),
    y AS (SELECT IF(t = '1,200원', 'excluded_from_menu', 'quarantined') AS action, CASE t WHEN '#REF!' THEN 'excel_error' WHEN '-' THEN 'placeholder' ELSE 'price' END AS category, k FROM x)
    SELECT action, category, count(*) FILTER (k % 8 = 0) AS before_n, count(*) AS after_n, count(*) FILTER (k % 8 <> 0) AS added FROM y GROUP BY ALL
""")
def version_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts by action and category in two versions; the first holds every other document of the shape."""
    cells, records = _records(spark, sf_dir)
    found = R.menu_quality(records, cells).select(F.col("document_id").cast("int").alias("k"), F.explode("artifacts").alias("x")).select("k", "x.action", F.col("x.classification").alias("category"))
    return A.compare_versions(found.filter("k % 8 = 0"), found, ["action", "category"])


@query("""
    SELECT s_suppkey::VARCHAR AS document_id, [80, 41 + IF(s_suppkey % 8 = 1, 7, 0), 55, 3][k] AS n_cells, [24, 17, 9, 6][k] AS max_row, [1, 0, 0, 0][k]::BIGINT AS n_formulas, [21, 0, 0, 0][k]::BIGINT AS n_numbers, [3, 3, 3, 1][k]::BIGINT AS n_keywords
    FROM (SELECT s_suppkey, s_suppkey % 4 + 1 AS k FROM supplier)
""")
def cell_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure of sheets: cells with text, used rows, formulas, numbers, meals named."""
    p = A.sheet_profile(_cells(spark, sf_dir), tuple(x for names in G.MEALS.values() for x in names))
    return p.select("document_id", F.col("n_cells").cast("int").alias("n_cells"), "max_row", "n_formulas", "n_numbers", "n_keywords")


def _bucket_sql(x: str, *bounds: int) -> str:
    return "CASE " + " ".join(f"WHEN {x} <= {b} THEN '<= {b}'" for b in bounds) + f" ELSE '> {bounds[-1]}' END"


@query(rf"""
    WITH h AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    m AS (SELECT page_id, len(regexp_extract_all(h, '(?i)<(?:p|li|tr|h[1-6]|div)[\s>]')) AS b, length(regexp_replace(h, '<[^>]*>', '', 'g')) AS n, len(regexp_extract_all(h, '(?i)<img[\s>]')) AS i FROM h),
    s AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), w AS (SELECT doc_id, len(string_split(t, chr(10))) AS b, length(t) AS n, len(regexp_extract_all(t, '[0-9]+')) AS i FROM s),
    f AS (SELECT s_suppkey::VARCHAR AS id, 'xlsx' AS extension, 'n1;s|' || ['24x5|m11|석식,조식,중식', '17x4|m0|석식,점심,조식', '9x8|m0|석식,조식,중식', '5x3|m1|조식'][s_suppkey % 4 + 1] AS features FROM supplier
      UNION ALL SELECT 'p' || page_id, 'html', {_bucket_sql("b", 20, 60, 120, 240)} || '|' || {_bucket_sql("n", 100, 500, 1000, 2500, 5000)} || '|' || {_bucket_sql("i", 0, 2, 6, 12)} FROM m
      UNION ALL SELECT 'd' || doc_id, 'text', {_bucket_sql("b", 20, 60, 120, 240)} || '|' || {_bucket_sql("n", 100, 500, 1000, 2500, 5000)} || '|' || {_bucket_sql("i", 0, 2, 6, 12)} FROM w),
    g AS (SELECT extension, sha256(features)[1:12] AS template, count(*) AS n, min(id) AS example FROM f GROUP BY ALL) SELECT *, CAST(row_number() OVER (PARTITION BY extension ORDER BY n DESC, template) AS INT) AS family FROM g
""")
def document_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families of documents by their structure: sheets by shapes, merges and meals named; pages by blocks, characters and images of
    their markup; plain texts by lines, characters and numbers."""
    words = tuple(x for names in G.MEALS.values() for x in names)
    sheets = A.sheet_features(_cells(spark, sf_dir), words).select(F.col("document_id").alias("id"), F.lit("xlsx").alias("extension"), "features")
    html, text = F.coalesce("html", F.lit("")), F.coalesce("text", F.lit(""))
    blocks, images = F.regexp_count(html, F.lit(r"(?i)<(?:p|li|tr|h[1-6]|div)[\s>]")), F.regexp_count(html, F.lit(r"(?i)<img[\s>]"))
    shown = F.length(F.regexp_replace(html, "<[^>]*>", ""))
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), F.lit("html").alias("extension"), A.page_features(blocks, shown, images).alias("features"))
    lines, numbers = F.size(F.split(text, "\n")), F.regexp_count(text, F.lit("[0-9]+"))
    plain = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), F.lit("text").alias("extension"), A.page_features(lines, F.length(text), numbers).alias("features"))
    return A.template_families(sheets.unionByName(pages).unionByName(plain), "id", "extension", "features")


@query("""
    SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS moment, IF(o_orderkey % 3 = 0, '', o_orderstatus) AS text, o_orderkey::VARCHAR AS number FROM orders
""")
def cell_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of cells that hold dates, times, padded or missing texts, numbers."""
    padded = F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit(" \t"), "o_orderstatus", F.lit("\u3000\n")))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderdate").alias("moment"), padded.alias("text"), F.col("o_orderkey").alias("number"))
    return o.select("o_orderkey", *[T.cell_text(F.col(c), kind).alias(c) for c, kind in o.dtypes[1:]])
