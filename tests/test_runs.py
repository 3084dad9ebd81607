"""Workbooks sheet by sheet, audits and runs: results against plain versions, and what stays bounded."""

from __future__ import annotations

import gzip
import io
import random
import tracemalloc
import zipfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from docledger.operators import audit as A
from docledger.operators import publish as P
from docledger.operators import release as R
from docledger.operators.registry import Handlers, IncrementalRun
from docledger.sources import workbook as W

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def sheet_xml(cells, merges=(), hidden=()):
    rows = {}
    for (r, c), v in sorted(cells.items()):
        rows.setdefault(r, []).append(f'<c r="{W.column_letters(c)}{r}" t="str"><v>{v}</v></c>')
    body = "".join(f'<row r="{r}"{" hidden=" + chr(34) + "1" + chr(34) if r in hidden else ""}>{"".join(x)}</row>' for r, x in rows.items())
    boxes = "".join(f'<mergeCell ref="{W.column_letters(a)}{t}:{W.column_letters(b)}{u}"/>' for t, u, a, b in merges)
    return f'<worksheet {MAIN}><cols><col min="2" max="2" hidden="1"/></cols><sheetData>{body}</sheetData><mergeCells>{boxes}</mergeCells></worksheet>'


def test_cells_and_merges_in_row_order():
    """Random sheets with merges over rows that aren't there, against a dictionary."""
    rnd = random.Random(1)
    for _ in range(30):
        cells = {(rnd.randint(1, 12), rnd.randint(1, 8)): f"v{n}" for n in range(rnd.randint(0, 30))}
        merges, taken = [], set()
        for _ in range(6):
            t, a = rnd.randint(1, 14), rnd.randint(1, 8)
            box = t, t + rnd.randint(0, 4), a, a + rnd.randint(0, 2)
            inside = {(r, c) for r in range(box[0], box[1] + 1) for c in range(box[2], box[3] + 1)}
            if not inside & taken:
                merges.append(box)
                taken |= inside
        want = {at: (v, None) for at, v in cells.items()}
        for t, u, a, b in merges:
            if (t, a) in cells:
                for r in range(t, u + 1):
                    for c in range(a, b + 1):
                        want[r, c] = (cells.get((r, c), ""), None if (r, c) == (t, a) else f"{W.column_letters(a)}{t}")
        found = list(W.read_sheet(gzip.compress(sheet_xml(cells, merges, {3}).encode()), None, None))
        assert [(c["row"], c["column"]) for c in found] == sorted(want)
        assert {(c["row"], c["column"]): (c["raw_text"], c["merged_parent"]) for c in found} == want
        assert all(c["hidden_row"] == (c["row"] == 3 and any(r == 3 for r, _ in cells)) and c["hidden_column"] == (c["column"] == 2) for c in found)


def test_memory_of_a_sheet_does_not_grow_with_its_rows():
    peaks = []
    for n in (2_000, 20_000):
        packed = gzip.compress(sheet_xml({(r, c): r for r in range(1, n + 1) for c in range(1, 6)}).encode())
        tracemalloc.start()
        assert sum(1 for _ in W.read_sheet(packed, None, None)) == 5 * n
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < peaks[0] + 500_000 and peaks[1] < 2_000_000


def package(*sheets):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{rel}"><sheets>{"".join(f"<sheet name={chr(34)}s{n}{chr(34)} r:id={chr(34)}r{n}{chr(34)}/>" for n in range(len(sheets)))}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{''.join(f'<Relationship Id={chr(34)}r{n}{chr(34)} Target={chr(34)}worksheets/sheet{n}.xml{chr(34)}/>' for n in range(len(sheets)))}</Relationships>")
        for n, x in enumerate(sheets):
            z.writestr(f"xl/worksheets/sheet{n}.xml", x)
    return bytearray(out.getvalue())


def test_sheets_are_read_one_by_one(spark):
    """A broken sheet fails alone; rows come in batches however many a sheet has."""
    good = sheet_xml({(r, 1): r for r in range(1, 2501)})
    files = spark.createDataFrame([("a", package(good, good[: len(good) // 2], sheet_xml({(1, 1): "x"}))), ("b", bytearray(b"no")), ("c", None)], "document_id string, content binary")
    assert sorted((r["document_id"], r["sheet_index"]) for r in W.sheets(files).filter("error IS NULL").collect()) == [("a", 0), ("a", 1), ("a", 2)]
    found = W.cells(files, size=1000)
    whole = found.filter("error IS NULL").groupBy("sheet").count().collect()
    assert {r["sheet"]: r["count"] for r in whole if r["sheet"] != "s1"} == {"s0": 2500, "s2": 1}
    errors = {(r["document_id"], r["sheet"]): r["error"] for r in found.filter("error IS NOT NULL").collect()}
    assert set(errors) == {("a", "s1"), ("b", None), ("c", None)} and "ParseError" in errors["a", "s1"]


def test_route_tables(spark):
    rows = [("ready", "xlsx", ["a", "b", "a"]), ("review", "xls", []), ("review", None, None), ("failed", "xls", [None, "a"])]
    df = spark.createDataFrame(rows, "r string, e string, l array<string>")
    found = {(x["dimension"], x["value"]): (x["documents"], x["ready"], x["review"], x["failed"]) for x in A.route_tables(df, "r", ["ready", "review", "failed"], {"extension": F.col("e"), "layout": F.col("l")}).collect()}
    assert found == {
        ("extension", "xlsx"): (1, 1, 0, 0), ("extension", "xls"): (2, 0, 1, 1), ("extension", "undetected"): (1, 0, 1, 0),
        ("layout", "a"): (2, 1, 0, 1), ("layout", "b"): (1, 1, 0, 0), ("layout", "undetected"): (3, 0, 2, 1),
    }
    assert A.route_tables(df.limit(0), "r", ["ready"], {"e": F.col("e")}).collect() == []


def test_unknown_roles(spark):
    df = spark.createDataFrame([(1, [("menu",), (None,), ("odd",)]), (2, [("odd",)]), (3, None)], "post int, files array<struct<role:string>>")
    assert sorted(tuple(r) for r in A.unknown_roles(df, "post", "files", ["menu"]).collect()) == [("odd", 1, 2, 2), ("odd", 2, 0, 2), ("unknown", 1, 1, 1)]


def test_months_changed_sees_content(spark):
    before = spark.createDataFrame([("m1", 1, "a"), ("m2", 2, "b"), ("m3", 3, None)], "month string, id int, price string")
    after = spark.createDataFrame([("m1", 1, "a"), ("m2", 2, "other"), ("m3", 3, None), ("m4", 4, "d")], before.schema)
    assert {tuple(r) for r in P.months_changed(before, after, ["month"], ["id", "price"]).collect()} == {("m1", "same"), ("m2", "updated"), ("m3", "same"), ("m4", "added")}


def test_bundle_audit(spark):
    institutions = spark.createDataFrame([("i1", "A", "t", "addr", 37.0, 127.0, "https://x.org/")], "institution_id string, name string, type string, address string, latitude double, longitude double, source_url string")
    slots = spark.sql("SELECT 'i1' AS institution_id, DATE '2024-05-01' AS day, 'lunch' AS meal, array('rice') AS items, 'p1-a1' AS document_id, array('p1-a1') AS document_ids")
    sources = spark.createDataFrame([("i1", 2024, 5, "p1-a1", "p1", "a1", "https://x.org/p", "2024-05-01")], "institution_id string, year int, month int, document_id string, post_id string, attachment_id string, post_url string, published_date string")
    available = spark.createDataFrame([("i1", 2024, [5])], "institution_id string, year int, months array<int>")
    bundle = {"institutions": institutions, "slots": slots, "sources": sources}
    declared = R.bundle_stats(institutions, slots).first().asDict()
    digests = R.table_digests(bundle | {"availability": available})
    assert R.bundle_audit(bundle, available, declared, digests).collect() == []
    bad = bundle | {"slots": slots.withColumn("items", F.array(F.lit("1,200원")))}
    notes = spark.createDataFrame([(1, [{"a": "C:\\x"}])], "k int, deep array<map<string, string>>")
    found = {(r["finding"], r["table_name"]) for r in R.bundle_audit(bad, available, declared | {"total_meal_records": 5}, digests, {"notes": notes}).collect()}
    assert found == {("contract_declared_stats", "bundle"), ("artifact_price", "slots"), ("local_path", "notes"), ("tree_digest", "slots"), ("tree_digest", "notes")}


def test_consistent_builds(spark):
    t = lambda d: datetime(2026, 1, 1) + timedelta(days=d)
    pointers = spark.createDataFrame([(t(0), "v1"), (t(10), "v2")], "at timestamp, version string")
    rows = [(1, t(1), t(2), "v1"), (2, t(5), t(15), "v2"), (3, t(11), t(12), "v1"), (4, t(-5), t(-4), "v1"), (5, t(10), t(10), "v2"), (6, t(12), t(13), None)]
    found = R.consistent_builds(spark.createDataFrame(rows, "build int, began timestamp, ended timestamp, report string"), pointers)
    assert {r["build"]: (r["seen_before"], r["seen_after"], r["consistent"]) for r in found.collect()} == {
        1: ("v1", "v1", True), 2: ("v1", "v2", False), 3: ("v2", "v2", False), 4: (None, None, False), 5: ("v2", "v2", True), 6: ("v2", "v2", False),
    }


def test_incremental_run(spark):
    """Accepted sources aren't handled again; a source that fails later leaves what was accepted; a repeated run changes nothing."""
    deliveries = [[("a", "1", "ok"), ("b", "1", "bad"), ("c", "1", "none")], [("a", "1", "bad"), ("b", "2", "ok"), ("d", "1", None)], [("b", "3", "bad")]]

    def fails(row):
        raise ValueError("no")

    collect = lambda k: spark.createDataFrame(deliveries[k], "document_id string, sha256 string, format string")
    judge = lambda rows: rows.withColumn("status", F.when(F.col("route") == "ready", "accepted").otherwise("held"))
    run = IncrementalRun(spark, collect, Handlers({"ok": lambda row: ("ready", []), "bad": fails}), judge)
    for k in (0, 1, 1, 2):
        run.run(k)
    assert sorted(map(tuple, run.result().collect())) == [("a", "1", "ready", "accepted", 0), ("b", "2", "ready", "accepted", 1), ("c", "1", "unsupported", "held", 0), ("d", "1", "failed", "held", 1)]
