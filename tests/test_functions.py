"""Scalar functions and rules on small literal rows."""

from pyspark.sql import functions as F

from docledger.functions import dates as D
from docledger.functions import rules as R
from docledger.functions import text as T


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}").select("k", f(F.col("v")).alias("x")).orderBy("k").collect()
    return [r["x"] for r in rows]


def test_token_categories(spark):
    tokens = ["=[1]차림표!C35", "#REF!", "소 계", "414.3원", "0.0", "-", "예정인원", "3. 동일 식군내 상호 대체", "계란찜", "딸기잼(주식)", None, "1,200원", "김치"]
    want = ["formula_literal", "excel_error", "subtotal", "price", "placeholder", "placeholder", "cost_metadata", "instruction_note", None, None, None, "price", None]
    assert column(spark, tokens, R.token_category) == want


def test_split_items(spark):
    texts = ["밥/국,김치", "밥(쌀,콩)/국", "#DIV/0!", "a(b/c", "a)b/c", " · 밥 ·\n국 ", "", "=A1/B1", None, "#N/A,국"]
    want = [["밥", "국", "김치"], ["밥(쌀,콩)", "국"], ["#DIV/0!"], ["a(b/c"], ["a)b", "c"], ["밥", "국"], [], ["=A1/B1"], None, ["#N/A", "국"]]
    assert column(spark, texts, T.split_items) == want


def test_unsafe_slots(spark):
    items = [["소 계"], ["#REF!"], ["밥", "330원", "국"], ["0.0"], ["밥", "국"], ["밥", "330원"], []]
    got = column(spark, items, lambda c: R.split_artifacts(c)["unsafe"], "array<string>")
    assert got == [True, True, True, True, False, False, True]


def test_secrets(spark):
    texts = ["AIza" + "x" * 30, "ghp_" + "a" * 20, "-----BEGIN RSA PRIVATE KEY-----", "Bearer " + "b" * 20, 'password = "' + "c" * 20 + '"', "C:\\Users\\me", "nothing", ""]
    want = [["google_api_key"], ["github_token"], ["private_key"], ["bearer_credential"], ["assigned_credential"], ["private_windows_path"], [], []]
    assert column(spark, texts, R.secrets_in) == want


def test_roles(spark):
    rows = [
        ("수용자 직원 식단표.xlsx", "", []), ("수용자 식단표.xlsx", "", []), ("수용자 부식물.xlsx", "", []), ("직원 식단표.xlsx", "", []), ("빵표.xlsx", "", []), ("채용 공고.hwp", "", []),
        ("식단표.xlsx", "", ["식단표.xlsx", "직원.xlsx"]), ("x.xlsx", "수용자 직원", []), ("x.xlsx", "수용자", []), ("x.xlsx", "직원", []), ("차림표.xlsx", "", []), ("x.xlsx", "", []),
    ]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, name string, title string, siblings array<string>")
    got = [r["x"]["rule"] for r in df.select("k", R.document_role(F.col("name"), F.col("title"), F.col("siblings")).alias("x")).orderBy("k").collect()]
    assert got == [
        "filename_inmate_and_staff", "filename_inmate_keyword", "filename_inmate_with_supplementary_term", "filename_staff_keyword", "filename_supplementary_keyword", "filename_non_meal_admin_keyword",
        "generic_meal_table_with_staff_sibling", "ambiguous_title_context_inmate_and_staff", "ambiguous_title_context_inmate", "ambiguous_title_context_staff", "generic_meal_table_without_subject", "no_matching_rule",
    ]


def test_gate(spark):
    base = dict(
        status="PASS", failure_codes=[], invalid=0, coverage_complete=True, missing_dates=[], missing_meals=[], source_provenance_valid=True, institution_id="a", menu_quality_valid=True,
        source_completeness_valid=None, unresolved_formula_values=0, excel_error_menu_items=0, unresolved_non_menu_artifacts=0, items=["밥"], issue_codes=[],
    )
    changes = [({}, "ready"), ({"status": "FAIL"}, "failed"), ({"failure_codes": ["x"]}, "failed"), ({"invalid": 1}, "review"), ({"missing_dates": ["2026-01-06"]}, "review"), ({"institution_id": None}, "review")]
    changes += [({"menu_quality_valid": None}, "review"), ({"source_completeness_valid": False}, "review"), ({"items": ["#REF!"]}, "review"), ({"issue_codes": ["YEAR_INFERRED_FROM_PUBLICATION"]}, "review")]
    schema = (
        "k int, status string, failure_codes array<string>, invalid int, coverage_complete boolean, missing_dates array<string>, missing_meals array<string>, source_provenance_valid boolean, "
        "institution_id string, menu_quality_valid boolean, source_completeness_valid boolean, unresolved_formula_values int, excel_error_menu_items int, unresolved_non_menu_artifacts int, "
        "items array<string>, issue_codes array<string>"
    )
    df = spark.createDataFrame([(k, *(base | c).values()) for k, (c, _) in enumerate(changes)], schema)
    got = [r["x"] for r in df.select("k", R.publication_gate(**{c: F.col(c) for c in base}).alias("x")).orderBy("k").collect()]
    assert got == [want for _, want in changes]


def test_dates(spark):
    y, m = F.lit(2026), F.lit(1)
    assert column(spark, ["26년 1월", "2025.12월", "3월", "none"], lambda c: D.year_month(c, F.lit(2024))["year"]) == [2026, 2025, 2024, None]
    assert [str(x) for x in column(spark, ["2026-1-6", "1/6", "6일", "31", "32", "2026-13-1", "1-45", "x"], lambda c: D.cell_date(c, y, m))] == ["2026-01-06", "2026-01-06", "2026-01-06", "2026-01-31", "None", "None", "None", "None"]
    assert [str(x) for x in column(spark, [31.0, 32.0, 60.0, 45000.0], lambda c: D.serial_date(c, F.lit(2026), F.lit(4)), "double")] == ["None", "None", "1900-02-28", "2023-03-15"]


def test_names(spark):
    assert column(spark, ["[서울 구치소]", "서울.구치소", "A_b-C"], T.alias_key) == ["서울구치소", "서울구치소", "abc"]
    assert column(spark, ["a/b.PDF", "http://x.org/f.xlsx?y=1.zip", "noext", "x.exe", "http://x.com"], T.extension) == ["pdf", "xlsx", "unknown", "unknown", "unknown"]
    assert column(spark, ["ﾊﾝｶｸ　①", None], T.normalize_space) == ["ハンカク 1", None]
    assert column(spark, ["B12", "AA1", "ZZ", "a1"], T.a1_column) == [2, 27, 0, 0]
    assert column(spark, ["http://a.b/c/d?x", "http://a.b"], lambda c: T.absolute_url(F.lit("e.html"), c)) == ["http://a.b/c/e.html", "http://a.b/e.html"]
