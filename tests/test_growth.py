"""What must not grow with the tables faster than they do: expressions, broadcasts, results on keys of later copies."""

import pytest
from pyspark.sql import functions as F

from docledger.operators import geo, grid, periods, records, release
from docledger.plans import QUERIES, sheets


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_addresses_are_made_once_a_row(spark):
    df = spark.createDataFrame([("서울특별시 중구 세종대로 1", "서울특별시 중구 세종대로 1")], "address string, returned string")
    none = F.lit(None).cast("boolean")
    issues = geo.location_issues(F.col("address"), F.lit("37.56"), F.lit("126.97"), F.col("returned"), F.lit(geo.EXACT), none, none)
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    assert plan(df.select(issues)).count("우편번호") <= 4  # both addresses; 330 of each before
    assert df.select(issues.alias("x")).first()["x"] == []


def test_bare_digits_in_a_number_or_path_name_no_period(spark):
    texts = ["x0·20162", "rice/20245", "Supplier#000020113", "x0·201601", "202405", "식단 20245", "(202404)", "x/2024.5", "m·20246월", "2024년 7월 20258"]
    cells = spark.createDataFrame([(str(i), "s", 1, 1, t) for i, t in enumerate(texts)], "document_id string, sheet string, row int, column int, text string")
    got = sorted((int(r["document_id"]), r["year"], r["month"]) for r in periods.period_evidence(cells).collect())
    assert got == [(4, 2024, 5), (5, 2024, 5), (6, 2024, 4), (7, 2024, 5), (8, 2024, 6), (9, 2024, 7), (9, 2025, 8)]


def test_period_resolution_of_later_keys(spark, tmp_path):
    keys = (20162, 20258, 20282, 201601, 19164)
    spark.createDataFrame([(k, f"Supplier#{k:09d}", 1) for k in keys], "s_suppkey bigint, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    got = {int(r["document_id"]): (r["year"], r["month"], r["evidence"]) for r in QUERIES["period_resolution"](spark, str(tmp_path)).collect()}
    metadata = "historical metadata year/month"
    # remainders by 7: 2 (metadata of April 2023), 0, 3 (file name and publication), 1 (inferred year), 5 (a title, file name, publication)
    assert got[20162] == (2023, 4, metadata) and got[20258] == (2024, 5, metadata) and got[20282] == (2025, 11, "filename month;publication year")
    assert got[201601] == (2024, 5, metadata + ";publication fallback not confirmed")
    assert got[19164][:2] == (2024, 5)


def test_cells_are_not_broadcast_by_the_size_of_their_file(spark):
    """All joins of cells, records and sheets shuffle: tables written here are tiny as files, and stay so at any size."""
    cells = spark.range(8).selectExpr("cast(id AS string) AS document_id", "'s' AS sheet", "1 AS row", "1 AS `column`", "'조식' AS text")
    found = grid.extract(grid.with_merges(cells, cells.selectExpr("document_id", "sheet", "row AS top", "row AS bottom", "`column` AS left", "`column` AS right")), F.lit(2024), F.lit(5))
    judged = records.validate(records.menu_quality(found, cells).withColumn("attachment_id", F.lit("a")), cells, F.lit(2024), F.lit(5))
    physical = judged._jdf.queryExecution().sparkPlan().toString()
    sent = [line for line in physical.splitlines() if "BroadcastHashJoin" in line]
    assert "SortMergeJoin" in physical and all("__part" in line for line in sent)  # carries of blocks: two rows a range


def test_rows_of_an_audit_are_made_text_once(spark):
    df = spark.createDataFrame([(1, "AIza" + "x" * 35)], "k int, note string")
    out = release.release_audit({"t": df}, {})
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    analyzed = out._jdf.queryExecution().analyzed().toString()
    assert analyzed.count("to_json(") == 1  # seven times before
    assert [tuple(r) for r in out.select("finding", "n").collect()] == [("google_api_key", 1)]


SF = "/root/testdata/sf0.001"


def sent(df):
    """Broadcast joins of a plan but those with carries of blocks: two rows a range."""
    text = df._jdf.queryExecution().sparkPlan().toString()
    return [line for line in text.splitlines() if "Broadcast" in line and "__part" not in line]


@pytest.fixture(scope="module")
def written(spark):
    return sheets._records(spark, SF)


@pytest.mark.parametrize("name", ["menu_artifacts", "sheet_quality", "route_layouts", "route_tables", "version_compare", "suspicious_meals", "source_completeness", "scope_warnings"])
def test_queries_over_records_send_no_cells(spark, monkeypatch, written, name):
    """The written tables of ten sheets are as tiny as files as those of many: Spark would broadcast them."""
    monkeypatch.setattr(sheets, "_records", lambda *a: written)
    monkeypatch.setattr(sheets, "cut", lambda df, name: df)  # what a query writes on the way is looked at too
    assert sent(QUERIES[name](spark, SF)) == []


@pytest.mark.parametrize("name", ["document_templates", "header_row", "merged_parents"])
def test_queries_over_cells_send_no_cells(spark, monkeypatch, name):
    monkeypatch.setattr(sheets, "cut", lambda df, name: df)
    assert sent(QUERIES[name](spark, SF)) == []
