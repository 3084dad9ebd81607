"""Operators on small literal tables."""

import hashlib
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from docledger.operators import catalog as C
from docledger.operators import contract as K
from docledger.operators import geo as G
from docledger.operators import grid as R
from docledger.operators import publish as P
from docledger.operators import quality as Q
from docledger.operators.registry import Handlers
from docledger.shared import cut, new_path
from docledger.sources import files as S
from docledger.sources import html as H
from docledger.sources import workbook as W


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


SLOTS = "doc string, slot string, item string"


def test_conflicts_and_merge(spark):
    df = spark.createDataFrame([("1-1", "a", "밥"), ("2-2", "a", "밥"), ("3-3", "b", "밥"), ("4-4", "b", "죽"), ("5-5", "b", "죽")], SLOTS)
    assert rows(P.conflicts(df, ["slot"], ["item"], "doc").select("slot", "n_variants", "n_rows", "duplicates")) == [("b", 2, 3, 1)]
    assert rows(P.conflicting_documents(df, ["slot"], ["item"], "doc"), "doc") == [("3-3",), ("4-4",), ("5-5",)]
    assert rows(P.merge_documents(df, ["slot"], ["item"], "doc"), "slot", "item") == [("a", "밥", "1-1", ["1-1", "2-2"]), ("b", "밥", "3-3", ["3-3"]), ("b", "죽", "4-4", ["4-4", "5-5"])]


@pytest.mark.parametrize(
    ("base", "incoming", "rejected"),
    [
        ([("1-1", "A", "밥")], [("1-1", "A", "죽"), ("2-2", "A", "죽"), ("3-3", "A", "국")], ["1-1", "2-2", "3-3"]),
        ([("1-1", "A", "밥"), ("9-9", "B", "y")], [("1-1", "A", "죽"), ("1-1", "B", "x"), ("2-2", "A", "죽")], ["1-1", "2-2"]),
        ([("1-1", "A", "밥")], [("1-1", "A", "죽")], []),
    ],
)
def test_merge_to_fixpoint(spark, base, incoming, rejected):
    """One round, two rounds (a rejected replacement restores the base, which conflicts anew), none."""
    a, r = P.merge_to_fixpoint(spark.createDataFrame(base, SLOTS), spark.createDataFrame(incoming, SLOTS), ["slot"], ["item"], "doc", lambda df: cut(df, "t"))
    assert [x for (x,) in rows(r, "doc")] == rejected
    assert {x for (x,) in rows(a)} == {d for d, _, _ in incoming} - set(rejected)


def test_fingerprints(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, None)], "p int, v string")
    same = P.changed_partitions(a, a.orderBy(F.desc("v")).repartition(3), ["p"], ["v"])
    assert rows(same) == []
    b = spark.createDataFrame([(1, "x"), (1, "z"), (3, None)], "p int, v string")
    assert rows(P.changed_partitions(a, b, ["p"], ["v"]), "p") == [(1, "changed"), (2, "dropped"), (3, "added")]


def test_published_versions(spark):
    store = S.Published(spark, new_path(spark, "store"))
    good = spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string")
    checks = {"null": lambda df: df.filter("v IS NULL")}
    store.publish(good, "v1", ["p"], checks)
    with pytest.raises(S.BadRows):
        store.publish(good.unionByName(spark.createDataFrame([(3, None)], "p int, v string")), "v2", ["p"], checks)
    with pytest.raises(S.BadRows):
        store.publish(good.limit(0), "v3", ["p"], checks)
    assert store.current() == "v1" and store.read().count() == 2
    store.publish(store.overwrite_touched(store.read(), spark.createDataFrame([("c", 2)], "v string, p int").select("v", "p"), ["p"]), "v4", ["p"], checks)
    assert rows(store.read().select("p", "v"), "p") == [(1, "a"), (2, "c")]


def test_jsonl(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a.jsonl").write_text('{"k": 1}\n\n  \n{"k": 2}\n')
    (tmp_path / "b.jsonl").write_text('{"k": 1}\n{"k": broken\n')
    schema = T.StructType([T.StructField("k", T.LongType())])
    assert rows(S.read_jsonl(spark, str(tmp_path / "a.jsonl"), schema), "k") == [(1,), (2,)]
    with pytest.raises(S.BadRows):
        S.read_jsonl(spark, str(tmp_path / "a.jsonl"), schema, F.col("k") < 2)
    with pytest.raises(S.BadRows):
        S.read_jsonl(spark, str(tmp_path / "b.jsonl"), schema)
    assert rows(S.read_jsonl(spark, str(tmp_path / "b.jsonl"), schema, strict=False)) == [(1,)]
    assert rows(S.dead_rows(spark, str(tmp_path / "b.jsonl"), schema)) == [('{"k": broken',)]


def test_catalog(spark):
    base = spark.createDataFrame([("p1", "a1", "s1"), ("p1", "a2", None), ("p2", "a3", "s3")], "post string, doc string, sha string")
    new = spark.createDataFrame([("p1", "a1", "s1"), ("p1", "a2", "s2"), ("p1", "a9", "s9"), ("p3", "a4", "s4"), ("p2", "a3", "sX")], "post string, doc string, sha string")
    got = C.change_class(new, base, "doc", "post", "sha").select("doc", "change_type")
    assert dict(rows(got)) == {"a1": "UNCHANGED", "a2": "NEW_ATTACHMENT", "a9": "NEW_ATTACHMENT", "a4": "NEW_POST", "a3": "ATTACHMENT_CHANGED"}
    events = C.change_events(base, new, ["doc"], "sha")
    assert rows(events) == [("a3", "s3", "sX")]
    assert rows(C.append_new(events, events.unionByName(events), ["doc", "old_digest", "new_digest"])) == []
    aliases = spark.createDataFrame([("서울", 1), ("서울", 2), ("부산", 3)], "alias string, id int")
    assert rows(C.ambiguous_aliases(aliases, "alias", "id")) == [("서울", 2)]


def test_upsert_keeps_the_old_row_of_a_failed_refresh(spark):
    base = spark.createDataFrame([(1, "s1", "ok"), (2, "s2", "ok"), (3, "s3", "ok")], "k int, sha string, status string")
    new = spark.createDataFrame([(1, None, "failed"), (2, "sX", "ok"), (4, "s4", "ok")], "k int, sha string, status string")
    got = C.upsert(base, new, ["k"], F.col("new_status") == "failed", ["sha", "status"])
    assert rows(got, "k") == [(1, "s1", "ok"), (2, "sX", "ok"), (3, "s3", "ok"), (4, "s4", "ok")]


def test_canonical_copy_prefers_good_rows(spark):
    df = spark.createDataFrame([(1, "x", "failed", "f1"), (2, "x", "ok", "f2"), (3, "x", "ok", "f3"), (4, "y", "failed", "f4")], "pos int, sha string, status string, path string")
    got = C.canonical_copy(df, F.col("sha"), F.col("status") == "ok", "pos", "path").select("path", "canonical", "duplicate")
    assert rows(got, "path") == [("f1", "f2", True), ("f2", "f2", False), ("f3", "f2", True), ("f4", "f4", False)]


def test_refresh_counts_existing_rows_only(spark):
    df = spark.createDataFrame([(0, "new", False), (1, "1", True), (2, "2", True), (3, "3", True)], "pos int, k string, old boolean")
    assert {r[1] for r in rows(C.refresh(df, F.col("old"), "pos", 2))} == {"new", "1", "2"}


def test_coverage(spark):
    slots = [(1, f"2026-01-{d:02d}", m) for d in range(1, 32) if d != 6 for m in ("b", "l", "d")]
    df = spark.createDataFrame(slots, "doc int, day string, meal string").withColumn("day", F.to_date("day"))
    missing = Q.missing_slots(df, ["doc"], "day", "meal", ["b", "l", "d"], "2026-01-01", "2026-01-31")
    assert {str(r["day"]) for r in missing.collect()} == {"2026-01-06"} and missing.count() == 3
    assert rows(Q.coverage(df, ["doc"], "day", "meal", ["b", "l", "d"], "2026-01-01", "2026-01-31")) == [(1, 31, 30, 93, 90)]


def test_multisets(spark):
    a = spark.createDataFrame([(1, "국"), (1, "국"), (1, "밥")], "k int, item string")
    b = spark.createDataFrame([(1, "국"), (1, "김치")], "k int, item string")
    assert rows(Q.multiset_difference(a, b, ["k"], "item"), "item") == [(1, "국", 1, 0), (1, "김치", 0, 1), (1, "밥", 1, 0)]
    assert rows(Q.multiset_overlap(a, b, ["k"], "item")) == [(1, 3, 2, 1)]


def test_geo(spark):
    points = [(91.0, 127.0), (37.0, 181.0), (float("nan"), 127.0), (None, None), (35.6, 139.7), (40.0, 127.0), (37.0, 123.0), (30.0, 127.0), (37.5, 127.0), (33.4, 126.5)]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(points)], "k int, lat double, lon double")
    got = [r["x"] for r in df.select("k", G.coordinate_issue(F.col("lat"), F.col("lon")).alias("x")).orderBy("k").collect()]
    assert got == ["INVALID_COORDINATE_RANGE"] * 4 + ["OUTSIDE_KOREA_OR_OFFSHORE"] * 4 + [None, None]
    at = spark.createDataFrame([(1, 1.0, 2.0, "a"), (2, 1.0, 2.0, "b"), (3, 3.0, 4.0, "c"), (4, 3.0, 4.0, "c")], "id int, lat double, lon double, address string")
    assert rows(G.shared_points(at, "lat", "lon", "id", "address"), "lat") == [(1.0, 2.0, 2, 1, False), (3.0, 4.0, 2, 3, True)]
    held = {r["id"]: (r["lat"], r["status"]) for r in G.withhold_shared(at, "lat", "lon", "id", "address").collect()}
    assert held == {1: (None, "REVIEW"), 2: (None, "REVIEW"), 3: (3.0, "PASS"), 4: (3.0, "PASS")}


def test_contract(spark):
    df = spark.sql("SELECT named_struct('a', 'C:/x', 'b', array(named_struct('c', 'ok'), named_struct('c', 'C:/y'))) AS s, 'n' AS t")
    assert K.forbidden_keys(df, {"c", "zz"}) == ["c"] and K.exact_fields(df, {"s", "u"}) == (["u"], ["t"])
    clean = df.select(K.redact(F.col("s"), df.schema["s"].dataType, "^C:").alias("s")).first()["s"]
    assert clean["a"] == "[redacted]" and [x["c"] for x in clean["b"]] == ["ok", "[redacted]"]
    assert df.select(K.any_leaf(F.col("s"), df.schema["s"].dataType, lambda c: c.startswith("C:/y"))).first()[0]


def test_handlers(spark):
    def boom(row):
        raise ValueError(row["document_id"])

    h = Handlers({"a": lambda row: ("ready", []), "b": boom})
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "z"), ("4", None)], "document_id string, format string")
    got = {r["document_id"]: (r["route"], list(r["reasons"]), r["error"]) for r in h.process(df).collect()}
    assert got == {"1": ("ready", [], None), "2": ("failed", ["PARSE_ERROR"], "ValueError: 2"), "3": ("unsupported", ["UNSUPPORTED_FORMAT"], None), "4": ("failed", ["UNKNOWN_FORMAT"], None)}


def test_html_posts(spark):
    page = """<table><tr><th>No</th><th>Title</th></tr>
    <tr><td>1</td><td><a href="javascript:view('77')">[서울] 식단표</a></td><td>과</td><td>2026.1.5</td></tr>
    <tr><td>1</td><td><a href="/x?id=77">again</a></td><td>과</td><td>2026-01-06</td></tr>
    <tr><td>2</td><td><a href="/b/view?no=78">B &amp; C</a></td><td>총무</td><td>2026/1/7</td></tr></table>"""
    got = H.posts(H.table_rows(spark.createDataFrame([(1, page), (2, None)], "page_id int, html string")).withColumn("cells", F.col("cells")))
    assert [(r["post_id"], r["title"], r["department"]) for r in got.orderBy("post_id").collect()] == [("77", "[서울] 식단표", "과"), ("78", "B & C", "총무")]


def workbook():
    sheet = """<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><cols><col min="3" max="3" hidden="1"/></cols><sheetData>
    <row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>중식</t></is></c></row>
    <row r="2" hidden="1"><c r="A2"><v>3</v></c><c r="B2" t="str"><f>C1</f><v>밥</v></c><c r="C2" t="e"><f>D1</f><v>#REF!</v></c><c r="D2"><f>E1</f></c></row>
    <row r="3"><c r="A3" s="1"><v>45000</v></c><c r="B3" t="b"><v>1</v></c></row></sheetData>
    <mergeCells><mergeCell ref="A1:A2"/><mergeCell ref="B1:C1"/></mergeCells></worksheet>"""
    files = {
        "xl/workbook.xml": '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="식단" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>조식</t></si></sst>',
        "xl/styles.xml": '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": sheet,
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


def test_workbook(spark):
    df = spark.createDataFrame([("d1", bytearray(workbook())), ("d2", bytearray(b"no zip"))], "document_id string, content binary")
    got = {(r["document_id"], r["coordinate"]): r for r in W.resolved(W.cells(df)).collect()}
    d1 = {c: r for (d, c), r in got.items() if d == "d1"}
    assert {c: r["text"] for c, r in d1.items()} == {"A1": "조식", "B1": "중식", "C1": "", "A2": "3", "B2": "밥", "C2": "#REF!", "D2": "=E1", "A3": "2023-03-15", "B3": "True"}
    assert {c: r["formula_cache_status"] for c, r in d1.items() if r["is_formula"]} == {"B2": "resolved", "C2": "unresolved", "D2": "unresolved"}
    assert d1["A2"]["merged_parent"] == "A1" and d1["C1"]["merged_parent"] == "B1" and d1["A1"]["merged_parent"] is None and d1["A1"]["merged_range"] == "A1:A2"
    assert d1["A2"]["hidden_row"] and d1["C2"]["hidden_column"] and d1["C2"]["is_excel_error"] and d1["A3"]["raw_type"] == "date"
    assert "BadZipFile" in got[("d2", None)]["error"]
    assert rows(df.select("document_id", S.detected_format(F.col("content"))), "document_id") == [("d1", "ooxml"), ("d2", "unknown")]


def cells_of(spark, grid):
    return spark.createDataFrame([("d", "s", r, c, t) for r, line in enumerate(grid, 1) for c, t in enumerate(line, 1) if t], "document_id string, sheet string, row int, column int, text string")


def test_date_rows(spark):
    grid = [["", "", "조식", "중식", "석식"]] + [[str(d), "월화수목금토일"[d % 7], f"밥/국{d}", "1,200", "죽\n김치(배추,무)"] for d in range(1, 8)]
    cells = cells_of(spark, grid)
    lay = R.layout(cells).first()
    assert (lay["family"], lay["header_row"], lay["n_days"]) == ("weekday_blocks_meal_columns", 1, 7) or lay["family"] == "date_rows_meal_columns"
    got = {(str(r["day"]), r["meal"]): r["items"] for r in R.date_rows(cells, F.lit(2026), F.lit(1)).collect()}
    assert got[("2026-01-03", "breakfast")] == ["밥", "국3"] and got[("2026-01-07", "dinner")] == ["죽", "김치(배추,무)"] and ("2026-01-01", "lunch") not in got and len(got) == 14


def test_weekday_blocks(spark):
    grid = [["요일", "조식", "중식", "석식"], ["월", "밥", "면", "죽"], ["", "국", "", ""], ["화요일", "빵", "밥", "국"]]
    cells = cells_of(spark, grid)
    assert R.layout(cells).first()["family"] == "weekday_blocks_meal_columns"
    got = {(str(r["day"]), r["meal"]): r["items"] for r in R.weekday_blocks(cells, F.lit(2026), F.lit(1)).collect()}
    assert got[("2026-01-05", "breakfast")] == ["밥", "국"] and got[("2026-01-26", "lunch")] == ["면"] and got[("2026-01-06", "breakfast")] == ["빵"]
    assert len(got) == 4 * 3 + 4 * 3


def test_covered_cells(spark):
    cells = cells_of(spark, [["a", "b"], ["c", "d"]])
    merges = spark.createDataFrame([("d", "s", 1, 2, 1, 1, "A1")], "document_id string, sheet string, top int, bottom int, left int, right int, parent string")
    got = {(r["row"], r["column"]): r["parent"] for r in R.covered_by(cells, merges).collect()}
    assert got == {(1, 1): "A1", (2, 1): "A1", (1, 2): None, (2, 2): None}


def test_directory_of_suppliers_with_large_keys(spark, tmp_path):
    from docledger.plans.files import html_directory

    keys = [1, 999, 9_999, 10_000, 14_286, 123_456, 98_770_000, 5_000_000_000]
    spark.createDataFrame([(k, f"s{k}") for k in keys], "s_suppkey bigint, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    got = {r["s_suppkey"]: r for r in html_directory(spark, str(tmp_path)).collect()}
    assert sorted(got) == keys and all(got[k]["name"] == f"s{k}" and got[k]["postal_code"] == str(k * 7).rjust(5, "0")[:5] for k in keys)
    assert [got[k]["phone"] for k in keys[:6]] == ["02-123-0001", "01-123-0999", "01-123-9999", "02-124-0000", "04-124-4286", "04-135-3456"]
    assert all(len(got[k]["phone"].split("-")[2]) == 4 for k in keys)


def test_integrity_of_all_files(spark, tmp_path):
    """Files of 4 MB and more count, wrong digests fail, and chunks give the digest of the whole."""
    from docledger.plans.files import file_integrity

    sizes = {"a.parquet": 100, "b.parquet": (4 << 20) + 1, "c d.parquet": (9 << 20) + 5}
    want = {}
    for name, n in sizes.items():
        data = b"PAR1" + random.Random(n).randbytes(n - 4)
        (tmp_path / name).write_bytes(data)
        want[name] = (n, hashlib.sha256(data).hexdigest())
    assert rows(file_integrity(spark, str(tmp_path)), "name") == [(k, "parquet", n) for k, n in sorted(sizes.items())]
    for large in (1000, 1 << 40):
        f = S.digests(spark, f"{tmp_path}/*.parquet", "*.parquet", large)
        found = {r["path"].rpartition("/")[2]: (r["length"], r["digest"]) for r in f.collect()}
        assert found == want and {bytes(r["head"][:4]) for r in f.collect()} == {b"PAR1"}
    bad = spark.createDataFrame([(k, n, d if k != "b.parquet" else "0" * 64) for k, (n, d) in want.items()], "name string, file_size bigint, sha256 string")
    assert [x for (x,) in rows(S.verified(f, bad).select("name"), "name")] == ["a.parquet", "c d.parquet"]


def test_record_validate_keeps_null_texts(spark, tmp_path):
    import duckdb

    from docledger.plans import ORACLES, QUERIES

    docs = [(1, None, "en", None), (2, None, None, 5), (3, "a text of twenty characters", "en", 27), (4, "a text of twenty characters", "en", 9), (5, "", "en", 0)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(con.sql(f"select doc_id, issues, status from ({ORACLES['record_validate']})").fetchall())
    got = rows(QUERIES["record_validate"](spark, str(tmp_path)).select("doc_id", "issues", "status"), "doc_id")
    assert got == want and len(got) == 5 and got[0] == (1, "DUPLICATE", "invalid")


def test_deliveries_keep_their_partitions(spark):
    """One micro-batch for each delivery, an empty one too, over as many files as it has partitions."""
    from docledger.streaming import core

    seen = []

    def each(batch, k):
        files = batch.select(F.input_file_name().alias("f")).distinct().count()
        seen.append((k, batch.count(), batch.agg(F.sum("id")).first()[0], files))

    a = spark.range(0, 3000, 1, 3)
    core.run_deliveries(spark, [a, a.filter("id < 0"), spark.range(3000, 5000, 1, 5)], each, "t")
    assert seen == [(0, 3000, sum(range(3000)), 3), (1, 0, None, 0), (2, 2000, sum(range(3000, 5000)), 5)]
