"""A hundred random sheets with days in rows against an extractor in plain Python that reads the cells by itself."""

from __future__ import annotations

import calendar
import random
import re

from pyspark.sql import functions as F

from docledger.operators import grid as G

NAMES = {"breakfast": ["조식", "아침"], "lunch": ["중식", "점심"], "dinner": ["석식", "저녁"]}
FOOD = ["rice", "soup 3", "egg (hot, cold)", "김치[배추,무]", "fish", "밥", "tea"]
WEEK = "월화수목금토일"


def sheet(rnd):
    """cells: (row, column) -> text, and merges (top, bottom, left, right)."""
    cells, merges = {}, []
    header, dc = rnd.randint(2, 6), rnd.randint(1, 4)
    cells[1, rnd.randint(1, 3)] = "식단표"
    meals = rnd.sample(list(NAMES), 3)
    at = {m: dc + 1 + rnd.randint(0, 1) + 2 * k for k, m in enumerate(meals)}
    for m, c in at.items():
        cells[header, c] = rnd.choice(NAMES[m])
    row, labels = header + 1 + rnd.randint(0, 2), dc > 1 and rnd.random() < 0.7
    days = rnd.sample(range(1, 32), rnd.randint(9, 20))
    for d in days:
        height = rnd.choice([1, 1, 2, 3])
        cells[row, dc] = rnd.choice([str(d), f"{d}일", f" {d} "])
        if height > 1:
            merges.append((row, row + height - 1, dc, dc))
        if labels:
            cells[row, rnd.randint(1, dc - 1)] = WEEK[calendar.weekday(2024, 5, d)]
        for c in at.values():
            for r in range(row, row + height):
                if rnd.random() < 0.75:
                    cells[r, c] = rnd.choice(["/", ",", "\n"]).join(rnd.sample(FOOD, rnd.randint(1, 3))) if rnd.random() < 0.85 else rnd.choice(["1,200", "350", " ", "12.5"])
        row += height + rnd.choice([0, 0, 1])
    if rnd.random() < 0.5:
        cells[row, 1] = "note"
        merges.append((row, row, 1, max(at.values())))
        cells[row + 1, dc] = "31"
        cells[row + 1, at["lunch"]] = "ghost"
    return cells, merges


def items_of(text):
    out, depth, now = [], 0, ""
    for x in text:
        depth += x in "([" or -(x in ")]" and depth > 0)
        if not depth and x in "/,\n":
            out.append(now)
            now = ""
        else:
            now += x
    return [x.strip() for x in [*out, now] if x.strip()]


def number(text):
    return re.fullmatch(r"\s*[\d,]*\.?\d+\s*", text) is not None


def extracted(cells, merges):
    """(day, meal) -> items, or several lists if a day stands twice."""
    meal_of = {n: m for m, names in NAMES.items() for n in names}
    for header in range(1, 40):
        at = {meal_of[t]: c for (r, c), t in sorted(cells.items()) if r == header and t in meal_of}
        if len(at) == 3:
            break
    first, last = min(at.values()), max(r for r, _ in cells)
    for t, _, a, b in sorted(merges):
        if a < first <= b:
            last = t - 1
            break
    day = lambda t: int(m[1]) if (m := re.fullmatch(r"\s*(\d{1,2})일?\s*", t)) else None
    columns = [c for c in range(1, first) if any(k == c and r > header and day(t) for (r, k), t in cells.items())]
    dc = max(columns, key=lambda c: (sum(1 for (r, k), t in cells.items() if k == c and r > header and day(t)), -c))
    height = {(t, a): b - t for t, b, a, _ in merges}
    out = {}
    for (r, c), t in sorted(cells.items()):
        if c == dc and header < r <= last and day(t) and day(t) <= 31:
            for m, k in at.items():
                found = [x for q in range(r, r + height.get((r, c), 0) + 1) for x in items_of(cells.get((q, k), "")) if not number(cells[q, k])]
                if found:
                    out.setdefault((day(t), m), []).append(found)
    return out


def test_random_date_rows(spark):
    rnd = random.Random(11)
    sheets = {f"d{n}": sheet(rnd) for n in range(100)}
    rows = [(d, "s", r, c, t) for d, (cells, _) in sheets.items() for (r, c), t in cells.items()]
    boxes = [(d, "s", *m) for d, (_, merges) in sheets.items() for m in merges]
    cells = spark.createDataFrame(rows, "document_id string, sheet string, row int, column int, text string").withColumns({"formula": F.lit(False), "resolved": F.lit(True), "error": F.lit(False)})
    merged = G.with_merges(cells, spark.createDataFrame(boxes, "document_id string, sheet string, top int, bottom int, left int, right int"))
    found = {}
    for r in G.extract(merged, F.lit(2024), F.lit(5)).collect():
        found.setdefault(r["document_id"], {}).setdefault((r["day"].day, r["meal"]), []).append(list(r["items"]))
    for d, (own, merges) in sheets.items():
        assert found.get(d, {}) == extracted(own, merges), d
