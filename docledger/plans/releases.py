"""Release, source and name queries: bundles, audits, month files, workbooks, pages, forms of names."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions import text as T
from ..functions.display import MEALS, shown_url
from ..operators import audit as A
from ..operators import grid as G
from ..operators import release as R
from ..session import table
from ..shared import new_path
from ..sources import files as S
from ..sources import html as H
from ..sources import months as M
from ..sources import workbook as W
from .registry import query


def _bundle(spark: SparkSession, sf_dir: str, faults: bool) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Customers as institutions, their orders as slots and sources; with faults planted by the key."""
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    bad = lambda test, value, good: F.when(test & F.lit(faults), value).otherwise(good)
    ident = F.concat(F.lit("i"), k.cast("string"))
    inst = table(spark, sf_dir, "customer").select(
        ident.alias("institution_id"), bad(k % 50 == 1, F.lit(""), F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("type"), F.lit("addr").alias("address"),
        bad(k % 50 == 2, F.lit(None).cast("double"), bad(k % 50 == 3, F.lit(91.0), F.when(k % 2 == 0, 37.5))).alias("latitude"), F.when(k % 2 == 0, 127.0).alias("longitude"),
        bad(k % 50 == 5, F.lit("ftp://x"), F.lit("https://h.org/x")).alias("source_url"),
    )
    doc = F.concat(F.lit("p"), o.cast("string"), F.lit("-a"))
    rows = table(spark, sf_dir, "orders")
    slots = rows.select(
        F.concat(F.lit("i"), bad(o % 100 == 1, F.lit("x"), F.col("o_custkey").cast("string"))).alias("institution_id"), F.to_date("o_orderdate").alias("day"),
        bad(o % 100 == 2, F.lit("snack"), F.get(F.array(*map(F.lit, MEALS)), (o % 3).cast("int"))).alias("meal"), bad(o % 100 == 3, F.array(F.lit(" ")), F.array("o_orderstatus", F.lit("rice"))).alias("items"),
        doc.alias("document_id"), bad(o % 100 == 4, F.array(F.lit("other")), F.array(doc)).alias("document_ids"),
    )
    sources = rows.select(
        F.concat(F.lit("i"), F.col("o_custkey").cast("string")).alias("institution_id"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), doc.alias("document_id"),
        F.concat(F.lit("p"), o.cast("string")).alias("post_id"), bad(o % 100 == 5, F.lit("b"), F.lit("a")).alias("attachment_id"), F.lit("https://h.org/p").alias("post_url"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("published_date"),
    )
    listed = rows.groupBy(F.concat(F.lit("i"), F.col("o_custkey").cast("string")).alias("institution_id"), F.year("o_orderdate").alias("year")).agg(F.sort_array(F.collect_set(F.month("o_orderdate"))).alias("months"))
    first = F.substring("institution_id", 2, 20).cast("bigint")
    listed = listed.withColumn("months", bad((first % 50 == 7) & (F.col("year") == 1998), F.reverse(F.concat("months", F.array(F.lit(13)))), F.col("months")))
    return inst, slots, sources, listed


NAMES = ("duplicate_institution", "institution_fields", "coordinate_pair", "coordinate_range", "institution_url", "unknown_institution", "meal_type", "menu_items", "document_links", "unlinked_source",
         "unreferenced_source", "source_identity", "duplicate_source", "availability_list", "availability_months", "declared_stats")


@query("SELECT unnest([" + ", ".join(f"'{n}'" for n in NAMES) + "]) AS check_name, 0::BIGINT AS failures, 'good' AS bundle\n" + """
    UNION ALL SELECT n, f, 'bad' FROM (
      WITH c AS (SELECT c_custkey AS k FROM customer), o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d FROM orders), x AS (SELECT * FROM o WHERE k % 100 = 1),
        m AS (SELECT DISTINCT c, year(d) AS y, month(d) AS m FROM o), s AS (SELECT DISTINCT c, year(d) AS y, month(d) AS m FROM o WHERE k % 100 <> 1), g AS (SELECT DISTINCT year(d) AS y, month(d) AS m FROM x),
        w AS (SELECT DISTINCT c FROM m WHERE y = 1998 AND c % 50 = 7)
      SELECT 'duplicate_institution' AS n, 0::BIGINT AS f
      UNION ALL SELECT 'institution_fields', count(*) FILTER (k % 50 = 1) FROM c
      UNION ALL SELECT 'coordinate_pair', count(*) FILTER ((k % 50 = 2) OR (k % 50 = 3)) FROM c
      UNION ALL SELECT 'coordinate_range', count(*) FILTER (k % 50 = 3) FROM c
      UNION ALL SELECT 'institution_url', count(*) FILTER (k % 50 = 5) FROM c
      UNION ALL SELECT 'unknown_institution', count(*) FROM x
      UNION ALL SELECT 'meal_type', count(*) FILTER (k % 100 = 2) FROM o UNION ALL SELECT 'menu_items', count(*) FILTER (k % 100 = 3) FROM o UNION ALL SELECT 'document_links', count(*) FILTER (k % 100 = 4) FROM o
      UNION ALL SELECT 'unlinked_source', (SELECT count(*) FROM x) + (SELECT count(*) FROM (SELECT DISTINCT c, year(d), month(d) FROM o WHERE k % 100 = 4))
      UNION ALL SELECT 'unreferenced_source', count(*) FILTER (k % 100 IN (1, 4)) FROM o
      UNION ALL SELECT 'source_identity', count(*) FILTER (k % 100 = 5) FROM o UNION ALL SELECT 'duplicate_source', 0 UNION ALL SELECT 'availability_list', (SELECT count(*) FROM w)
      UNION ALL SELECT 'availability_months', (SELECT count(*) FROM (SELECT * FROM m EXCEPT SELECT * FROM s)) + (SELECT count(*) FROM g) + (SELECT count(*) FROM w) UNION ALL SELECT 'declared_stats', 1)
""")
def bundle_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a good bundle and of one with faults."""
    good = _bundle(spark, sf_dir, False)
    declared = {c: v for c, v in R.bundle_stats(*good[:2]).first().asDict().items()}
    ok = R.bundle_checks(*good, declared).withColumn("bundle", F.lit("good"))
    return ok.unionByName(R.bundle_checks(*_bundle(spark, sf_dir, True), declared | {"total_institutions": -1}).withColumn("bundle", F.lit("bad")))


@query("""
    SELECT (SELECT count(*) FROM customer) AS total_institutions, CAST((SELECT count(*) FROM customer WHERE c_custkey % 2 = 0) AS BIGINT) AS with_coordinates, count(DISTINCT o_custkey) AS collected_institutions, count(*) AS total_meal_records,
      count(DISTINCT (o_custkey, year(o_orderdate), month(o_orderdate))) AS institution_month_files, count(DISTINCT o_orderkey) AS structured_documents FROM orders
""")
def bundle_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.bundle_stats(*_bundle(spark, sf_dir, False)[:2])


@query("""
    SELECT 'google_api_key' AS finding, 'sources' AS table_name, count(*) AS n FROM orders WHERE o_orderkey % 40 = 0 UNION ALL SELECT 'local_path', 'sources', count(*) FROM orders WHERE o_orderkey % 40 IN (1, 2)
    UNION ALL SELECT 'local_path', 'slots', count(*) FROM orders WHERE o_orderkey % 40 = 5
    UNION ALL SELECT 'private_public_field', 'hosts', count(*) FROM nation UNION ALL SELECT 'artifact_price', 'slots', count(*) FROM orders WHERE o_orderkey % 40 = 3 UNION ALL SELECT 'artifact_subtotal', 'slots', count(*) FROM orders WHERE o_orderkey % 40 IN (3, 4)
""")
def release_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of three public tables, with a key, local paths (one deep inside a row), a private field and artifacts planted."""
    k = F.col("o_orderkey") % 40
    o = table(spark, sf_dir, "orders")
    note = F.when(k == 0, F.concat(F.lit("AIza"), F.repeat(F.lit("x"), 35))).when(k == 1, "data/raw/x.xls").when(k == 2, "D:\\x").otherwise("fine data/raw/")
    items = F.when(k == 3, F.array(F.lit("1,200원"), F.lit("합계"))).when(k == 4, F.array(F.lit("rice"), F.lit("소 계"))).otherwise(F.array(F.lit("rice")))
    tables = {"sources": o.select("o_orderkey", note.alias("note")), "slots": o.select("o_orderkey", items.alias("items"), F.array(F.struct(F.create_map(F.lit("file"), F.when(k == 5, "file:///x").otherwise("x")).alias("m"))).alias("nested")), "hosts": table(spark, sf_dir, "nation").select(F.col("n_name").alias("hostname"))}
    return R.release_audit(tables, {"slots": "items"})


@query("""
    SELECT 'contract_' || n AS finding, 'bundle' AS table_name, f AS n FROM (
      WITH c AS (SELECT c_custkey AS k FROM customer), o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d FROM orders), x AS (SELECT * FROM o WHERE k % 100 = 1),
        m AS (SELECT DISTINCT c, year(d) AS y, month(d) AS m FROM o), s AS (SELECT DISTINCT c, year(d) AS y, month(d) AS m FROM o WHERE k % 100 <> 1), g AS (SELECT DISTINCT year(d) AS y, month(d) AS m FROM x),
        w AS (SELECT DISTINCT c FROM m WHERE y = 1998 AND c % 50 = 7)
      SELECT 'duplicate_institution' AS n, 0::BIGINT AS f
      UNION ALL SELECT 'institution_fields', count(*) FILTER (k % 50 = 1) FROM c
      UNION ALL SELECT 'coordinate_pair', count(*) FILTER ((k % 50 = 2) OR (k % 50 = 3)) FROM c
      UNION ALL SELECT 'coordinate_range', count(*) FILTER (k % 50 = 3) FROM c
      UNION ALL SELECT 'institution_url', count(*) FILTER (k % 50 = 5) FROM c
      UNION ALL SELECT 'unknown_institution', count(*) FROM x
      UNION ALL SELECT 'meal_type', count(*) FILTER (k % 100 = 2) FROM o UNION ALL SELECT 'menu_items', count(*) FILTER (k % 100 = 3) FROM o UNION ALL SELECT 'document_links', count(*) FILTER (k % 100 = 4) FROM o
      UNION ALL SELECT 'unlinked_source', (SELECT count(*) FROM x) + (SELECT count(*) FROM (SELECT DISTINCT c, year(d), month(d) FROM o WHERE k % 100 = 4))
      UNION ALL SELECT 'unreferenced_source', count(*) FILTER (k % 100 IN (1, 4)) FROM o
      UNION ALL SELECT 'source_identity', count(*) FILTER (k % 100 = 5) FROM o UNION ALL SELECT 'duplicate_source', 0 UNION ALL SELECT 'availability_list', (SELECT count(*) FROM w)
      UNION ALL SELECT 'availability_months', (SELECT count(*) FROM (SELECT * FROM m EXCEPT SELECT * FROM s)) + (SELECT count(*) FROM g) + (SELECT count(*) FROM w) UNION ALL SELECT 'declared_stats', 1) WHERE f > 0
    UNION ALL SELECT 'tree_digest', unnest(['institutions', 'slots', 'sources']), 1 UNION ALL SELECT 'tree_digest', 'availability', 1 WHERE EXISTS (FROM orders WHERE o_custkey % 50 = 7 AND year(o_orderdate) = 1998)
    UNION ALL SELECT 'artifact_price', 'slots', count(*) FROM orders WHERE o_orderkey % 100 = 3 HAVING count(*) < 0
""")
def bundle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings about a faulty bundle in one table: contract, leaves, and the digests of the good bundle that it should be."""
    good, bad = (dict(zip(("institutions", "slots", "sources", "availability"), _bundle(spark, sf_dir, x), strict=True)) for x in (False, True))
    declared = {c: v for c, v in R.bundle_stats(good["institutions"], good["slots"]).first().asDict().items()} | {"total_institutions": -1}
    return R.bundle_audit({k: v for k, v in bad.items() if k != "availability"}, bad["availability"], declared, R.table_digests(good))


@query("""
    WITH o AS (SELECT c_nationkey AS n, o_orderdate::DATE AS d, ['breakfast', 'lunch', 'dinner'][o_orderkey % 3 + 1] AS m, min(o_orderpriority) AS p FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)
    SELECT n::VARCHAR AS institution_id, year(d)::INT AS year, month(d)::INT AS month, d::VARCHAR AS day, m AS meal, (i - 1)::INT AS position, [p, 'rice'][i] AS item, 1 AS n_documents FROM o, (SELECT unnest([1, 2]) AS i)
""")
def month_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as the menus of nations (institutions) in monthly JSON files, written and read back item by item."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    keys = [F.col("c_nationkey").cast("string").alias("institution_id"), F.to_date("o_orderdate").alias("day"), F.get(F.array(*map(F.lit, MEALS)), (F.col("o_orderkey") % 3).cast("int")).alias("meal")]
    slots = o.groupBy(*keys).agg(F.array(F.min("o_orderpriority"), F.lit("rice")).alias("items"), F.array(F.min("o_orderkey").cast("string")).alias("documents"))
    path = new_path(spark, "months")
    M.write_months(slots, path)
    return M.read_months(spark, path)


@query("""
    SELECT count(*) AS surveyed_files, count(*) FILTER (k % 5 > 1) AS successful_files, count(*) FILTER (k % 5 = 1) AS failed_files, count(*) FILTER (k % 5 = 0) AS missing_files FROM (SELECT DISTINCT p_partkey AS k FROM part WHERE p_partkey % 9 <> 0)
""")
def survey_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled paths, some twice and some empty, against files that were read, failed or are missing."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(k, F.when(k % 9 != 0, F.concat(F.lit("f"), k.cast("string"))).otherwise("").alias("path"))
    read = p.filter((k % 5 != 0) & (k % 9 != 0)).select("path", F.when(k % 5 == 1, "failed").otherwise("ok").alias("status"))
    return R.survey_totals(p.unionByName(p.filter(k % 2 == 0)), read)


@query("""
    SELECT s_suppkey, CASE v WHEN 0 THEN 'ready' ELSE 'review' END AS route, CASE v WHEN 0 THEN '' WHEN 1 THEN 'NEW_LAYOUT' WHEN 2 THEN 'NEW_LAYOUT' WHEN 3 THEN 'MISSING_DATE' WHEN 4 THEN 'MISSING_DATE,MISSING_MEAL' WHEN 5 THEN 'UNRESOLVED_FORMULA,EXCEL_ERROR' WHEN 6 THEN 'MENU_ARTIFACT' ELSE 'VALIDATION_FAILED' END AS reasons
    FROM (SELECT s_suppkey, s_suppkey % 8 AS v FROM supplier)
""")
def workbook_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, none = F.col("s_suppkey") % 8, F.array().cast("array<string>")
    some = lambda test, *x: F.when(test, F.array(*map(F.lit, x))).otherwise(none)
    r = R.workbook_reasons(
        F.when(v == 1, F.array(F.lit("UNSUPPORTED_LAYOUT"))).when(v == 3, F.array(F.lit("AMBIGUOUS_DATE"))).otherwise(none), F.when(v == 2, F.array(F.lit("other"))).otherwise(F.array(F.lit(G.FAMILIES[0]))), G.FAMILIES, v == 0,
        some(v == 4, "2024-05-01"), some(v == 4, "lunch"), {"UNRESOLVED_FORMULA": (v == 5).cast("int"), "EXCEL_ERROR": (v == 5).cast("int"), "MENU_ARTIFACT": (v == 6).cast("int")},
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", r.alias("r")).select("s_suppkey", "r.route", F.array_join("r.reasons", ",").alias("reasons"))


SHEET = (
    '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>{name}</t></is></c><c r="B1"><v>{key}</v></c></row>'
    '<row r="2" hidden="1"><c r="A2" t="str"><f>B1</f><v>ok {key}</v></c><c r="B2" t="e"><f>C1</f><v>#REF!</v></c><c r="C2"><f>D1</f></c></row><row r="3"><c r="A3" t="inlineStr"><is><t>m</t></is></c></row></sheetData><mergeCells><mergeCell ref="A3:B3"/></mergeCells></worksheet>'
)
MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
PARTS = {
    "xl/workbook.xml": f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="s" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>',
}
#: Styles 1 to 14 show the date format and 13 number formats; two sheets a workbook.
FORMATS = ["yyyy-mm-dd", *[f"0.{'0' * k}" for k in range(1, 14)]]
STYLED = {
    "xl/workbook.xml": PARTS["xl/workbook.xml"].replace("</sheets>", '<sheet name="t" r:id="r2"/></sheets>'),
    "xl/_rels/workbook.xml.rels": PARTS["xl/_rels/workbook.xml.rels"].replace("</Rel", '<Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Rel'),
    "xl/sharedStrings.xml": f"<sst {MAIN}><si><t>shared</t></si></sst>",
    "xl/styles.xml": f"<styleSheet {MAIN}><numFmts>" + "".join(f'<numFmt numFmtId="{170 + k}" formatCode="{f}"/>' for k, f in enumerate(FORMATS)) + "</numFmts><cellXfs>"
    + "".join(f'<xf numFmtId="{n}"/>' for n in [0, *range(170, 170 + len(FORMATS))]) + "</cellXfs></styleSheet>",
}


def _packed(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


@F.pandas_udf(BinaryType())
def _styled(keys: pd.Series) -> pd.Series:
    """A workbook of two sheets for each key k: 1 + k % 5 rows of a shared string, a date and two numbers; the second sheet has a row more."""

    def sheet(k: int, rows: int) -> str:
        row = '<row r="{0}"><c r="A{0}" t="s"><v>0</v></c><c r="B{0}" s="1"><v>{1}</v></c><c r="C{0}" s="{2}"><v>{3}</v></c><c r="D{0}"><v>{0}</v></c></row>'
        return f"<worksheet {MAIN}><sheetData>" + "".join(row.format(r, 45000 + k % 100, 2 + (k + r) % 13, k) for r in range(1, rows + 1)) + "</sheetData></worksheet>"

    return pd.Series([_packed(STYLED | {"xl/worksheets/sheet1.xml": sheet(k, 1 + k % 5), "xl/worksheets/sheet2.xml": sheet(k, 2 + k % 5)}) for k in keys])


def _styled_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("document_id"), _styled(F.col("s_suppkey")).alias("content"))
    return W.cells(files)


STYLED_SQL = """
    d AS (SELECT s_suppkey AS k, sheet, unnest(range(1, 2 + s_suppkey % 5 + n)) AS r FROM supplier, (VALUES ('s', 0), ('t', 1)) v(sheet, n)),
    f AS (SELECT k, sheet, r, unnest(['General', 'yyyy-mm-dd', '0.' || repeat('0', 1 + CAST((k + r) % 13 AS INT)), 'General']) AS number_format FROM d)
"""


@query(f"""
    WITH {STYLED_SQL}
    SELECT k::VARCHAR AS document_id, sheet, CAST(4 * max(r) AS BIGINT) AS n_cells, CAST(max(r) AS INT) AS max_row, 4 AS max_column, 0::BIGINT AS n_formulas, 0::BIGINT AS n_errors, max(r) AS n_dates, 2 * max(r) AS n_numbers,
           0::BIGINT AS n_merged, 0::BIGINT AS n_hidden_rows, count(DISTINCT number_format) AS n_formats FROM f GROUP BY ALL
""")
def sheet_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure of the sheets of workbooks: cells, range, dates, numbers, number formats."""
    return A.cell_structure(_styled_cells(spark, sf_dir))


@query(f"""
    WITH {STYLED_SQL}, c AS (SELECT sheet, number_format, count(*) AS count FROM f GROUP BY ALL)
    SELECT *, CAST(row_number() OVER (PARTITION BY sheet ORDER BY count DESC, number_format) AS INT) AS rank FROM c QUALIFY rank <= 12
""")
def top_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 12 most frequent number formats of the sheets of each name; on ties by the format."""
    return A.top_values(_styled_cells(spark, sf_dir).select("sheet", "number_format"), ["sheet"], "number_format", 12)


@F.pandas_udf(BinaryType())
def _workbook(names: pd.Series, keys: pd.Series) -> pd.Series:
    """A small workbook for each name and key."""

    return pd.Series([_packed(PARTS | {"xl/worksheets/sheet1.xml": SHEET.format(name=n, key=k)}) for n, k in zip(names, keys, strict=True)])


def _workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    content = F.when(F.col("s_suppkey") % 10 == 9, F.lit("no workbook").cast("binary")).otherwise(_workbook(F.col("s_name"), F.col("s_suppkey")))
    return s.select(F.col("s_suppkey").cast("string").alias("document_id"), content.alias("content"))


@query("""
    WITH d AS (SELECT s_suppkey::VARCHAR AS k, s_name AS n, s_suppkey % 10 < 9 AS good FROM supplier), c(coordinate, i) AS (VALUES ('A1', 1), ('B1', 2), ('A2', 3), ('B2', 4), ('C2', 5), ('A3', 6), ('B3', 7))
    SELECT k AS document_id, coordinate, [n, k, 'ok ' || k, '#REF!', '=D1', 'm', ''][i] AS text, [NULL, NULL, 'resolved', 'unresolved', 'unresolved', NULL, NULL][i] AS formula_cache_status, i IN (3, 4, 5) AS hidden_row, IF(i = 7, 'A3', NULL) AS merged_parent, FALSE AS failed FROM d, c WHERE good
    UNION ALL SELECT k, NULL, NULL, NULL, NULL, NULL, TRUE FROM d WHERE NOT good
""")
def workbook_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of workbooks with their texts and cached formulas; files that are none give a row with their error."""
    cells = W.resolved(W.cells(_workbooks(spark, sf_dir)))
    return cells.select("document_id", "coordinate", "text", "formula_cache_status", "hidden_row", "merged_parent", F.col("error").isNotNull().alias("failed"))


@query("SELECT CASE WHEN s_suppkey % 10 = 9 THEN 'unknown' WHEN s_suppkey % 10 = 8 THEN 'hwpx' WHEN s_suppkey % 10 = 7 THEN 'zip' ELSE 'ooxml' END AS format, count(*) AS n FROM supplier GROUP BY 1")
def package_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats by content: packages are told apart by their members."""

    @F.pandas_udf(BinaryType())
    def package(keys: pd.Series) -> pd.Series:
        def one(k: int) -> bytes:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w") as z:
                z.writestr({8: "mimetype", 7: "x.txt"}.get(k % 10, "[Content_Types].xml"), "application/hwp+zip" if k % 10 == 8 else "x")
            return b"none" if k % 10 == 9 else out.getvalue()

        return pd.Series([one(k) for k in keys])

    s = table(spark, sf_dir, "supplier").select(package(F.col("s_suppkey")).alias("content"))
    return s.select(S.detected_format(F.col("content")).alias("format")).groupBy("format").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'n' || n_nationkey AS stem, n_name AS name, n_regionkey AS region FROM nation")
def json_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a folder of JSON files, with other files in it; each document is known by its file's name."""
    path, n = new_path(spark, "json-folder"), table(spark, sf_dir, "nation")
    rows = n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("stem"), F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("value"))
    S.write_json_documents(rows, path)
    rows.select(F.lit("no document").alias("value")).write.text(f"{path}/notes")
    return S.read_json_documents(spark, path, "name string, region int").select("stem", "name", "region")


def _page(rows: DataFrame, *parts: object) -> DataFrame:
    return rows.withColumn("html", F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))


@query("""
    SELECT o_orderkey AS page_id, o_orderkey::VARCHAR AS post_id, o_orderpriority AS title, o_orderstatus AS department, o_orderdate::DATE::VARCHAR AS published_date FROM orders
    UNION ALL SELECT o_orderkey, 'x' || o_orderkey, 'second', NULL, NULL FROM orders WHERE FALSE
""")
def post_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as list pages: a heading, the post, and a second row with the same id."""
    o, k = table(spark, sf_dir, "orders").withColumn("page_id", F.col("o_orderkey")), F.col("o_orderkey").cast("string")
    day = F.date_format("o_orderdate", "yyyy.MM.dd")
    pages = _page(o, "<table><tr><th>No</th><th>Title</th></tr><tr><td>1</td><td><a href='/b/view?no=", k, "'>", F.col("o_orderpriority"), "</a></td><td>", F.col("o_orderstatus"), "</td><td>", day, "</td></tr>",
                  "<tr><td>1</td><td><a href='javascript:view(", k, ")'>again</a></td></tr></table>")
    posts = H.posts(H.table_rows(pages))
    return posts.select("page_id", "post_id", "title", "department", F.col("published_date").cast("string").alias("published_date"))


@query("""
    SELECT c_custkey AS page_id, IF(c_custkey % 3 = 0, NULL, c_mktsegment) AS department, 'f' || c_custkey || '.xlsx' AS filename, CASE c_custkey % 4 WHEN 0 THEN c_custkey::VARCHAR WHEN 1 THEN 'q' || c_custkey ELSE 'https://h.org/b/download.do' END AS attachment_id FROM customer
""")
def detail_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages: a labelled value (empty for some), and a file's link, twice and with the label for viewing."""
    c, k = table(spark, sf_dir, "customer").withColumn("page_id", F.col("c_custkey")), F.col("c_custkey").cast("string")
    value = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment"))
    link = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("/x/"), k, F.lit("/download.do"))).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("/atchFileDownload.do?atchFileId=q"), k)).otherwise("download.do")
    pages = _page(c, "<table><tr><th>작성자</th><td>x</td></tr><tr><th> 담당부서 </th><td>", value, "</td></tr></table><a href='/list.do'>list</a><a href='", link, "'>f", k, ".xlsx  바로보기</a><a href='", link, "'>again</a>")
    files = H.attachments(H.links(pages), F.lit("https://h.org/b/view.do"))
    return pages.select("page_id").join(H.labelled(H.table_rows(pages), "담당부서"), "page_id", "left").join(files, "page_id").select("page_id", F.col("value").alias("department"), "filename", "attachment_id")


@query("""
    SELECT s_suppkey AS page_id, IF(s_suppkey % 4 < 2, 37 + (s_suppkey % 7) / 10.0, NULL)::DOUBLE AS lat, IF(s_suppkey % 4 < 2, 127.5, NULL)::DOUBLE AS lon FROM supplier
""")
def marker_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose scripts set one marker, the same one twice, two, or only a map's centre."""
    s, v = table(spark, sf_dir, "supplier").withColumn("page_id", F.col("s_suppkey")), F.col("s_suppkey") % 4
    lat = F.format_string("%.1f", F.lit(37) + (F.col("s_suppkey") % 7) / 10)
    one = F.concat(F.lit("var position = new kakao.maps.LatLng("), lat, F.lit(", 127.5);"))
    script = F.when(v == 0, one).when(v == 1, F.concat(one, F.lit(" position=new daum.maps.LatLng( "), lat, F.lit(" ,127.50 )"))).when(v == 2, F.concat(one, F.lit("position = new kakao.maps.LatLng(35.0, 128.0)"))).otherwise("center: new kakao.maps.LatLng(37.0, 127.0)")
    pages = _page(s, "<script>", script, "</script>").select("page_id", H.marker(F.col("html")).alias("m"))
    return pages.select("page_id", "m.lat", "m.lon")


@query("""
    SELECT n_regionkey AS page_id, n_name AS name, '/' || n_nationkey AS href FROM nation WHERE n_nationkey % 3 < 2
""")
def named_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory pages of regions with links to nations: by name, by name and a parenthesis, and by a longer name that doesn't count."""
    n, k = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    text = F.when(k % 3 == 0, F.col("n_name")).when(k % 3 == 1, F.concat(F.regexp_replace("n_name", "_", " _ "), F.lit(" (x)"))).otherwise(F.concat("n_name", F.lit("office")))
    anchor = F.concat(F.lit("<a href='/"), k.cast("string"), F.lit("'>"), text, F.lit("</a><a href='/later'>"), text, F.lit("</a>"))
    pages = n.groupBy(F.col("n_regionkey").alias("page_id")).agg(F.concat_ws("", F.sort_array(F.collect_list(anchor))).alias("html"))
    return H.named_links(H.links(pages), n.select(F.col("n_name").alias("name")), "name").select("page_id", "name", "href")


def _folded(c: str) -> str:
    return f"translate({c}, 'ＡＢＣ１２', 'ABC12')"


@query(f"""
    WITH p AS (SELECT p_partkey AS k, p_name AS n, p_partkey % 6 AS v FROM part)
    SELECT k, n || ' ABC 12' AS spaced, replace(n, ' ', '') || 'ABC12' AS compact, ['서울구치소', '안양교도소', '평택지소', '소망교도소', '여주교도소', '학교'][v + 1] AS canonical, ['detention_center', 'prison', 'branch', 'private_prison', 'prison', 'other'][v + 1] AS kind,
      ['서울구', '안양교', '평택지소', '소망교', '여주교', '학교'][v + 1] AS short, ['서울 구치소(구)성동구치소,서울(구),서울구,서울구치소', '안양 교도소,안양(교),안양교,안양교도소', '평택 지소,평택지소', '소망 교도소(민영),소망(교),소망교,소망교도소', '여주 교도소,여주(교),여주교,여주교도소', '학교'][v + 1] AS aliases,
      'sheet#(#)' AS sheet, CASE v WHEN 0 THEN k::VARCHAR WHEN 1 THEN k::VARCHAR WHEN 2 THEN k::VARCHAR WHEN 3 THEN k::VARCHAR END AS link, IF(v < 2, 'https://h.org/' || k, NULL) AS shown, [0, 1, 6, 2, NULL, NULL][v + 1] AS weekday, ['breakfast', 'lunch', 'dinner', 'breakfast', NULL, 'lunch'][v + 1] AS meal FROM p
""")
def text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of names and texts: spaces and width, comparison form, canonical and short names, aliases, sheets, ids of links, URLs, weekdays, meals."""
    k = F.col("p_partkey")
    pick = lambda *x: F.get(F.array(*[F.lit(t) if isinstance(t, str) or t is None else t for t in x]), (k % 6).cast("int"))
    wide = F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("　 ")), F.lit("\t ＡＢＣ\n１２ "))
    raw = pick("서울 구치소(구)성동구치소", "안양 교도소", "평택 지소", "소망 교도소(민영)", "여주 교도소", "학교")
    key = k.cast("string")
    link = pick(F.concat(F.lit("javascript:jf_viewArtcl('x','"), key, F.lit("')")), F.concat(F.lit("/bbs/"), key, F.lit("/artclView.do")), F.concat(F.lit("/v?a=1&nttId="), key), F.concat(F.lit("x articleNo='"), key), "/view/none", "")
    url = pick(F.concat(F.lit(" https://h.org/"), key), F.concat(F.lit("https://h.org/"), key, F.lit(" ")), "file:///x", "C:\\x", "https://h.org/data/production/x", "ftp://h.org")
    base = table(spark, sf_dir, "part").select(k.alias("k"), wide.alias("wide"), raw.alias("raw"), link.alias("link"), url.alias("url"), pick("월", "火 요일".replace(" 요일", ""), "일 요일", "수요일/", "火요일", "주말").alias("day"), pick("조 식", "점심(A)", "저녁", "아침밥 점심", "간식", "중식").alias("meal"))
    named = base.withColumn("canonical", T.canonical_name(F.col("raw")))
    return named.select(
        "k", T.normalize_space(F.col("wide")).alias("spaced"), T.compact(F.col("wide")).alias("compact"), "canonical", T.name_type(F.col("canonical")).alias("kind"), T.short_name(F.col("canonical")).alias("short"),
        F.array_join(T.name_aliases(F.col("canonical"), F.col("raw")), ",").alias("aliases"), T.sheet_key(F.concat(F.lit("Sheet 1 ("), F.col("k").cast("string"), F.lit(")"))).alias("sheet"), T.post_id(F.col("link")).alias("link"), shown_url(F.col("url")).alias("shown"),
        G.weekday_of(F.col("day")).alias("weekday"), G.meal_of(F.col("meal")).alias("meal"),
    )
