"""OOXML workbooks as long-form cells, parsed in the tasks with the standard library."""

from __future__ import annotations

import gzip
import io
import math
import re
import shutil
import zipfile
from collections.abc import Iterator
from datetime import date, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.rules import EXCEL_ERRORS

CELL_SCHEMA = (
    "document_id string, sheet string, sheet_index int, coordinate string, row int, `column` int, raw_type string, raw_double double, raw_text string, number_format string, "
    "is_formula boolean, formula string, cached_text string, is_excel_error boolean, hidden_row boolean, hidden_column boolean, merged_parent string, merged_range string, error string"
)
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Built-in number formats that show dates.
DATE_FORMATS = frozenset((14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47))


def column_number(letters: str) -> int:
    n = 0
    for c in letters:
        n = 26 * n + ord(c) - 64
    return n


def column_letters(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def _range(text: str) -> tuple[int, int, int, int]:
    a, _, b = text.partition(":")
    parts = [re.fullmatch(r"([A-Z]+)(\d+)", x) for x in (a, b or a)]
    return int(parts[0][2]), int(parts[1][2]), column_number(parts[0][1]), column_number(parts[1][1])


def _text(node: ElementTree.Element | None) -> str:
    return "" if node is None else "".join(t.text or "" for t in node.iter(f"{MAIN}t"))


def _plain(x: float) -> str:
    return str(int(x)) if x.is_integer() else repr(x)


SHEET_SCHEMA = "document_id string, sheet string, sheet_index int, part binary, strings binary, styles binary, error string"


def _squeezed(z: zipfile.ZipFile, name: str) -> bytes:
    """A member of the package, packed anew while it is read."""
    out = io.BytesIO()
    with z.open(name) as source, gzip.GzipFile(fileobj=out, mode="wb", compresslevel=1) as target:
        shutil.copyfileobj(source, target, 1 << 20)
    return out.getvalue()


def read_sheets(content: bytes) -> Iterator[dict]:
    """A package's sheets: name, index, the packed XML of the sheet, of the shared strings and of the styles."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        xml = lambda name: ElementTree.fromstring(z.read(name))  # noqa: E731  small parts
        shared = {key: _squeezed(z, name) if name in names else None for key, name in (("strings", "xl/sharedStrings.xml"), ("styles", "xl/styles.xml"))}
        targets = {r.get("Id"): r.get("Target") for r in xml("xl/_rels/workbook.xml.rels")}
        for index, sheet in enumerate(xml("xl/workbook.xml").iter(f"{MAIN}sheet")):
            target = targets[sheet.get(f"{REL}id")].lstrip("/")
            part = _squeezed(z, target if target.startswith("xl/") else f"xl/{target}")
            yield {"sheet": sheet.get("name"), "sheet_index": index, "part": part, **shared}


def _elements(packed: bytes | None, *tags: str) -> Iterator[ElementTree.Element]:
    """Elements of these names when they end; what has been passed is let go, so that one of them is in memory at a time."""
    if packed is None:
        return
    wanted, inside, open_tags = {f"{MAIN}{t}" for t in tags}, 0, []
    with gzip.GzipFile(fileobj=io.BytesIO(packed)) as source:
        for event, node in ElementTree.iterparse(source, ("start", "end")):
            if event == "start":
                inside += node.tag in wanted
                open_tags.append(node)
                continue
            open_tags.pop()
            if node.tag in wanted:
                inside -= 1
                if not inside:
                    yield node
            if not inside:
                node.clear()
                if open_tags:
                    open_tags[-1].remove(node)


def _formats(packed: bytes | None) -> list[tuple[str, bool]]:
    """Number format and whether it shows a date, by cell style."""
    own, ids = {}, []
    for node in _elements(packed, "numFmts", "cellXfs"):
        if node.tag == f"{MAIN}numFmts":
            own = {int(n.get("numFmtId")): n.get("formatCode") for n in node}
        else:
            ids = [int(x.get("numFmtId", 0)) for x in node]
    dated = lambda i: i in DATE_FORMATS or bool(re.search(r"[ymd]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", own.get(i, "")), re.I))
    return [(own.get(i, "General" if i == 0 else f"#{i}"), dated(i)) for i in ids] or [("General", False)]


def _cell(c: ElementTree.Element, strings: list[str], formats: list[tuple[str, bool]]) -> dict | None:
    """A cell's fields; None if it has neither text nor formula."""
    value, formula = c.findtext(f"{MAIN}v"), c.find(f"{MAIN}f")
    kind, style = c.get("t", "n"), int(c.get("s", 0))
    number_format, dated = formats[style] if style < len(formats) else ("General", False)
    out = {"raw_type": "empty", "raw_double": None, "number_format": number_format, "is_excel_error": kind == "e", "cached_text": None, "is_formula": formula is not None, "formula": None}
    text = strings[int(value)] if kind == "s" and value else _text(c.find(f"{MAIN}is")) if kind == "inlineStr" else value or ""
    if kind == "n" and value:
        x = float(value)
        if dated and 60 <= x < 2958466:
            out |= {"raw_type": "date", "raw_double": x}
            text = (date(1899, 12, 30) + timedelta(days=int(x))).isoformat()
        else:
            out |= {"raw_type": "number", "raw_double": x if math.isfinite(x) else None}
            text = _plain(x) if math.isfinite(x) else value
    elif kind == "b":
        out["raw_type"], text = "boolean", "True" if value == "1" else "False"
    elif text:
        out["raw_type"] = "error" if kind == "e" else "string"
    if formula is not None:
        out |= {"formula": f"={formula.text or ''}", "cached_text": text.strip() if value is not None else None}
    return out | {"raw_text": text.strip()} if text or formula is not None else None


EMPTY = {"raw_type": "empty", "raw_double": None, "raw_text": "", "number_format": "General", "is_excel_error": False, "cached_text": None, "is_formula": False, "formula": None}


def read_sheet(part: bytes, strings: bytes | None, styles: bytes | None) -> Iterator[dict]:
    """Cells with a value, and cells that a merge with a value covers, in row order.

    The XML is read twice: for merges and hidden columns, which stand around the rows, then for the rows. In memory are the shared
    strings, the sheet's merges and one row.
    """
    texts, formats = [_text(s) for s in _elements(strings, "si")], _formats(styles)
    hidden, boxes = set(), []
    for node in _elements(part, "col", "mergeCell", "row"):
        if node.tag == f"{MAIN}col" and node.get("hidden") == "1":
            hidden.update(range(int(node.get("min")), int(node.get("max")) + 1))
        elif node.tag == f"{MAIN}mergeCell":
            boxes.append((*_range(node.get("ref")), node.get("ref")))
    boxes.sort(key=lambda b: b[0], reverse=True)
    live: list[tuple] = []

    def row_cells(r: int, own: dict[int, dict], off: bool) -> Iterator[dict]:
        while boxes and boxes[-1][0] <= r:
            box = boxes.pop()
            if box[0] == r and box[2] in own:
                live.append(box)
        live[:] = [b for b in live if b[1] >= r]
        covered = {c: b for b in live for c in range(b[2], b[3] + 1)}
        for c in sorted(own.keys() | covered.keys()):
            coordinate, box = f"{column_letters(c)}{r}", covered.get(c)
            parent = f"{column_letters(box[2])}{box[0]}" if box else None
            place = {"coordinate": coordinate, "row": r, "column": c, "hidden_row": off, "hidden_column": c in hidden}
            yield own.get(c, EMPTY) | place | {"merged_parent": parent if parent != coordinate else None, "merged_range": box[4] if box else None}

    at = 0
    for node in _elements(part, "row"):
        own = {column_number(re.match("[A-Z]+", c.get("r"))[0]): _cell(c, texts, formats) for c in node.iter(f"{MAIN}c")}
        r = int(node.get("r"))
        for between in range(at + 1, r):
            if not live and not (boxes and boxes[-1][0] <= between):
                break
            yield from row_cells(between, {}, False)
        yield from row_cells(r, {c: x for c, x in own.items() if x is not None}, node.get("hidden") == "1")
        at = r
    while live:
        at += 1
        yield from row_cells(at, {}, False)


def _failure(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"[:500]


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def sheets(files: DataFrame, id_col: str = "document_id", content: str = "content") -> DataFrame:
    """A row a sheet, with the parts of the package that it needs. A file that can't be read gives one row with its error."""
    schema = to_arrow_schema(StructType.fromDDL(SHEET_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                try:
                    rows = list(read_sheets(data.as_py() or b""))
                except Exception as e:  # noqa: BLE001  any failure is this file's outcome
                    rows = [{"error": _failure(e)}]
                yield from _batches(({"document_id": key} | r for r in rows), schema, 1)

    return files.select(F.col(id_col).cast("string").alias("id"), F.col(content).alias("content")).mapInArrow(run, SHEET_SCHEMA)


def cells(files: DataFrame, id_col: str = "document_id", content: str = "content", size: int = 10_000) -> DataFrame:
    """Long-form cells of workbooks, `size` at a time. A sheet that can't be read gives one row with its error and no coordinate.

    Sheets are dealt out one by one, so the sheets of a large workbook are read side by side. A task holds a sheet's packed XML, the
    shared strings and merges, a row and `size` cells, however many cells the sheet has.
    """
    schema = to_arrow_schema(StructType.fromDDL(CELL_SCHEMA))

    def rows_of(x: dict) -> Iterator[dict]:
        head = {k: x[k] for k in ("document_id", "sheet", "sheet_index", "error")}
        if x["error"]:
            yield head
            return
        try:
            for c in read_sheet(x["part"], x["strings"], x["styles"]):
                yield head | c
        except Exception as e:  # noqa: BLE001  any failure is this sheet's outcome
            yield head | {"error": _failure(e)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                yield from _batches(rows_of(b.slice(k, 1).to_pylist()[0]), schema, size)

    return sheets(files, id_col, content).repartition("document_id", "sheet_index").mapInArrow(run, CELL_SCHEMA)


def resolved(rows: DataFrame) -> DataFrame:
    """cells with text and formula_cache_status: a cached scalar counts if it isn't empty, an error token or another formula."""
    cached: Column = F.coalesce("cached_text", F.lit(""))
    error = F.upper(cached).isin(*EXCEL_ERRORS) | F.col("is_excel_error")
    good = F.col("is_formula") & (cached != "") & ~error & ~cached.startswith("=")
    text = F.when(good | (F.col("is_formula") & error), cached).when(F.col("is_formula"), F.col("formula")).otherwise(F.col("raw_text"))
    return rows.withColumns({"text": text, "formula_cache_status": F.when(F.col("is_formula"), F.when(good, "resolved").otherwise("unresolved"))})
