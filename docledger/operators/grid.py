"""Cell-table operators: layout, inheritance, extraction, diagnosis.

Cells: document_id, sheet, row, column, text, one row each. More columns tell of merges and formulas where there are any:
child (covered by another cell's merge), bottom and right (end of the cell's own merge), parent_text (text of the merge that covers
it), formula, resolved (its cached value is good), error. complete() gives their defaults.

Cells and what is made of them repeat much, so that they are far smaller as files than as rows: a broadcast that Spark chooses by the
size of files can outgrow the driver. Joins of a row per sheet or more are therefore merges, on both sides spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_in_text, made_date, weekday_dates
from ..functions.rules import menu_tokens, token_category
from ..functions.text import a1, bound, contains_label, squeeze
from ..shared import cut
from . import layout as L

SHEET = ["document_id", "sheet"]
# Names of meals and weekdays in sheets.
MEALS = {"breakfast": ("조식", "아침"), "lunch": ("중식", "점심"), "dinner": ("석식", "저녁")}
WEEKDAYS = {
    "월": 0, "월요일": 0, "月": 0, "화": 1, "화요일": 1, "火": 1, "수": 2, "수요일": 2, "水": 2, "목": 3, "목요일": 3, "木": 3,
    "금": 4, "금요일": 4, "金": 4, "토": 5, "토요일": 5, "土": 5, "일": 6, "일요일": 6, "日": 6,
}
# Words above a block that are headings; beginnings of notes below a table; words of staff and inmate sheets.
HEADINGS = ("식단명", "품명", "가격", "금액", "중량", "수량", "아침", "점심", "저녁", "조식", "중식", "석식")
NOTES = ("※", "♧", "▣", "◈", "[ 원산지", "원산지")
INMATE_WORD, STAFF_WORDS = "수용자", ("직원", "교도관")
FAMILIES = ("date_rows_meal_columns", "weekday_blocks_meal_columns", "meal_rows_weekday_columns")
_KINDS = {"child": "boolean", "bottom": "int", "right": "int", "parent_text": "string", "formula": "boolean", "resolved": "boolean", "error": "boolean"}
_VALUES = {"child": False, "formula": False, "resolved": True, "error": False}


def complete(cells: DataFrame) -> DataFrame:
    """cells with all columns; those of merges and formulas say that there are none."""
    missing = {c: F.lit(_VALUES.get(c)).cast(kind) for c, kind in _KINDS.items() if c not in cells.columns}
    return cells.withColumns(missing) if missing else cells


def meal_of(text: Column) -> Column:
    return bound(squeeze(text), lambda t: contains_label(t, MEALS))


def weekday_of(text: Column) -> Column:
    """Number of a weekday's name (Monday 0), with or without the word for day."""
    names = F.create_map(*[F.lit(x) for pair in WEEKDAYS.items() for x in pair])
    return names[F.replace(squeeze(text), F.lit("/"), F.lit(""))]


def used_range(cells: DataFrame) -> DataFrame:
    """First and last row and column of each sheet, of cells with text or in a merge, and its shape."""
    c = complete(cells)
    used = c.filter((F.col("text") != "") | F.col("child") | F.col("bottom").isNotNull())
    out = used.groupBy(*SHEET).agg(F.min("row").alias("min_row"), F.max("row").alias("max_row"), F.min("column").alias("min_column"), F.max("column").alias("max_column"))
    return out.withColumns({"rows": F.col("max_row") - F.col("min_row") + 1, "columns": F.col("max_column") - F.col("min_column") + 1})


def effective_text(cells: DataFrame, keys: list[str], at: str, text: str, parent: str) -> DataFrame:
    """Text of a cell, or of its merged parent where it has none."""
    p = cells.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(at).alias("__at"), F.col(text).alias("__text"))
    on = (cells[parent] == p["__at"]) & F.expr("true")
    for k in keys:
        on = on & (cells[k] == p[f"__{k}"])
    return cells.hint("merge").join(p, on, "left").withColumn("effective", F.coalesce(F.nullif(F.col(text), F.lit("")), F.col("__text")))


#: Rows and columns of a tile of a sheet.
TILE = 16, 8


def covered_by(cells: DataFrame, merges: DataFrame) -> DataFrame:
    """Cells with the merge that covers them. merges: document_id, sheet, top, bottom, left, right, parent.

    A merge stands in each tile of the sheet that it touches, a cell in one. As merges don't overlap, a cell meets at most as many
    as a tile has cells, however large the sheet is.
    """
    tiles = lambda low, high, size: F.explode(F.sequence(F.floor(F.col(low) / size), F.floor(F.col(high) / size)))
    m = merges.select(*[F.col(k).alias(f"__{k}") for k in SHEET], "top", "bottom", "left", "right", "parent").withColumn("__down", tiles("top", "bottom", TILE[0])).withColumn("__across", tiles("left", "right", TILE[1]))
    own = cells.withColumns({"__tile_row": F.floor(F.col("row") / TILE[0]), "__tile_column": F.floor(F.col("column") / TILE[1])})
    on = (own["document_id"] == m["__document_id"]) & (own["sheet"] == m["__sheet"]) & (own["__tile_row"] == m["__down"]) & (own["__tile_column"] == m["__across"])
    on = on & own["row"].between(m["top"], m["bottom"]) & own["column"].between(m["left"], m["right"])
    return own.hint("merge").join(m, on, "left").drop("__document_id", "__sheet", "__down", "__across", "__tile_row", "__tile_column")


def with_merges(cells: DataFrame, merges: DataFrame) -> DataFrame:
    """cells with child, bottom, right and parent_text from merges: document_id, sheet, top, bottom, left, right."""
    ranges = merges.withColumn("parent", F.struct(F.col("top").alias("row"), F.col("left").alias("column")))
    own = cells.select(*[F.col(k).alias(f"__{k}") for k in SHEET], F.struct("row", "column").alias("__at"), F.col("text").alias("parent_text"))
    c = covered_by(cells, ranges)
    head = (F.col("row") == F.col("top")) & (F.col("column") == F.col("left"))
    c = c.hint("merge").join(own, (c["document_id"] == own["__document_id"]) & (c["sheet"] == own["__sheet"]) & (c["parent"] == own["__at"]), "left")
    out = c.withColumns({
        "child": F.coalesce(~head, F.lit(False)), "bottom": F.when(head, F.col("bottom")), "right": F.when(head, F.col("right")), "parent_text": F.when(~head, F.col("parent_text")),
    })
    return out.select(*cells.columns, "child", "bottom", "right", "parent_text")


def _named(cells: DataFrame) -> DataFrame:
    return cells.filter((F.col("text") != "") & ~F.col("child"))


def headers(cells: DataFrame) -> DataFrame:
    """First row of each sheet that names all three meals: header_row, and the column of each (the last, if named twice)."""
    named = _named(complete(cells)).withColumn("meal", meal_of(F.col("text"))).filter("meal IS NOT NULL")
    rows = named.groupBy(*SHEET, "row").agg(*[F.max(F.when(F.col("meal") == m, F.col("column"))).alias(m) for m in MEALS])
    full = rows.filter(" AND ".join(f"{m} IS NOT NULL" for m in MEALS))
    return full.groupBy(*SHEET).agg(F.min_by(F.struct(*MEALS), "row").alias("columns"), F.min("row").alias("header_row"))


def body_ends(cells: DataFrame, starts: DataFrame, notes: bool = False) -> DataFrame:
    """starts with body_end: the row before the first footer below `start` and left of `first_meal`, else the last used row.

    A footer is a merge from the labels into the meal columns, or an instruction or cost note among the labels; with
    `notes`, cells that begin like one too.
    """
    c = complete(cells)
    last = used_range(c).select(*SHEET, F.col("max_row").alias("__last"))
    rows = c.hint("merge").join(starts.select(*SHEET, "start", "first_meal"), SHEET).filter((F.col("text") != "") & (F.col("row") > F.col("start")) & (F.col("column") < F.col("first_meal")))
    footer = ~F.col("child") & ((F.coalesce(F.col("right") >= F.col("first_meal"), F.lit(False))) | token_category(F.col("text")).isin("instruction_note", "cost_metadata"))
    if notes:
        for n in NOTES:
            footer = footer | F.col("text").startswith(n)
    first = rows.filter(footer).groupBy(*SHEET, "start").agg((F.min("row") - 1).alias("__foot"))
    out = starts.hint("merge").join(last, SHEET).hint("merge").join(first, [*SHEET, "start"], "left")
    return out.withColumn("body_end", F.coalesce(F.least("__foot", "__last"), F.col("__last"))).drop("__foot", "__last")


def layout(cells: DataFrame) -> DataFrame:
    """Family of each sheet that has one, with its evidence.

    With a full header row: day numbers or weekdays are counted left of the meals, from the header to the footer. Five to
    seven anchors of at least five weekdays over more than seven rows make a week of blocks even where days are numbered.
    Without: meals that stand below each other in a column with weekdays over five columns or more right of it.
    """
    c = complete(cells)
    heads = headers(c).withColumns({"first_meal": F.least(*[F.col(f"columns.{m}") for m in MEALS]), "start": F.col("header_row")})
    tops = body_ends(c, heads)
    left = _named(c).hint("merge").join(tops.select(*SHEET, "header_row", "body_end", "first_meal"), SHEET)
    left = left.filter("row > header_row AND row <= body_end AND `column` < first_meal").withColumns({"is_day": (F.size(days_in_text(F.col("text"))) > 0) & ~F.col("formula"), "weekday": weekday_of(F.col("text"))})
    at = F.when(F.col("weekday").isNotNull(), F.col("row"))
    counted = left.groupBy(*SHEET).agg(
        F.count_if("is_day").alias("n_days"), F.count("weekday").alias("n_anchors"), F.countDistinct("weekday").alias("n_weekdays"), (F.max(at) - F.min(at)).alias("span")
    )
    out = tops.hint("merge").join(counted, SHEET, "left").fillna(0, ["n_days", "n_anchors", "n_weekdays"])
    weekly = F.col("n_anchors").between(5, 7) & (F.col("n_weekdays") >= 5) & (F.coalesce("span", F.lit(0)) > 7)
    family = F.when((F.col("n_days") >= 5) & ~weekly, FAMILIES[0]).otherwise(FAMILIES[1])
    confidence = F.when((F.col("n_days") >= 5) | (F.col("n_anchors") >= 5), "high").otherwise("medium")
    none = F.lit(None).cast("struct<breakfast:int,lunch:int,dinner:int>")
    out = out.withColumns({"family": family, "confidence": confidence, "rows": none, "label_column": F.lit(None).cast("int")})

    named = _named(c).withColumns({"meal": meal_of(F.col("text")), "weekday": weekday_of(F.col("text"))}).hint("merge").join(heads.select(*SHEET), SHEET, "left_anti")
    labels = named.filter("meal IS NOT NULL").groupBy(*SHEET, "column").agg(
        F.min(F.struct("row", "column")).alias("first"), *[F.max(F.when(F.col("meal") == m, F.col("row"))).alias(m) for m in MEALS]
    )
    days = named.filter("weekday IS NOT NULL").groupBy(*SHEET).agg(F.collect_set("column").alias("days"))  # columns of a sheet
    right = F.size(F.filter("days", lambda x: x > F.col("column")))
    across = labels.filter(" AND ".join(f"{m} IS NOT NULL" for m in MEALS)).hint("merge").join(days, SHEET).withColumn("n_weekdays", right.cast("long")).filter("n_weekdays >= 5")
    best = across.groupBy(*SHEET).agg(F.min_by(F.struct(F.struct(*MEALS).alias("rows"), F.col("column").alias("label_column"), "n_weekdays"), "first").alias("b")).select(*SHEET, "b.*")
    lower = best.withColumns({"family": F.lit(FAMILIES[2]), "confidence": F.lit("high"), "header_row": F.least(*[F.col(f"rows.{m}") for m in MEALS])})
    names = [*SHEET, "family", "confidence", "header_row", "columns", "body_end", "rows", "label_column", "n_days", "n_anchors", "n_weekdays", "span"]
    return out.select(*names).unionByName(lower.select(*[x for x in names if x in lower.columns]), allowMissingColumns=True)


def choose_sheets(sheets: DataFrame, position: str = "sheet") -> DataFrame:
    """One sheet per document: the first for inmates and not for staff, else the first not for staff, else the first."""
    staff = F.col("sheet").contains(STAFF_WORDS[0])
    any_staff = staff | F.col("sheet").contains(STAFF_WORDS[1])
    tier = F.when(F.col("sheet").contains(INMATE_WORD) & ~staff, 0).when(~any_staff, 1).otherwise(2)
    best = sheets.groupBy("document_id").agg(F.min_by("sheet", F.struct(tier.alias("tier"), F.col(position).alias("at"))).alias("sheet"))
    return sheets.hint("merge").join(best, SHEET, "left_semi")


def menu_cells(cells: DataFrame) -> DataFrame:
    """Cells of a meal column that may hold items: some text, no merged child, no number but a placeholder.

    An unresolved formula stays, so that the audit sees it.
    """
    c = complete(cells)
    text = F.col("text")
    number = F.regexp_replace(text, ",", "").try_cast("double").isNotNull() & text.rlike(r"[\d.]\s*$")
    open_formula = F.col("formula") & ~F.coalesce("resolved", F.lit(False))
    placeholder = F.coalesce(token_category(text) == "placeholder", F.lit(False))
    return _named(c).filter(open_formula | ~number | placeholder)


def _records(cells: DataFrame, blocks: DataFrame) -> DataFrame:
    """Records of blocks (document_id, sheet, top, bottom, at, meal, day, weekday): the items of their cells in order.

    Blocks without items have no record. source holds the coordinates of the cells, raw_text their lines.
    """
    keys = [*SHEET, "day", "meal", "weekday", "top", "bottom", "at"]
    c = menu_cells(cells).select(*[F.col(k).alias(f"__{k}") for k in SHEET], "row", "column", F.trim("text").alias("text"), menu_tokens(F.trim("text")).alias("tokens"))
    on = (blocks["document_id"] == c["__document_id"]) & (blocks["sheet"] == c["__sheet"]) & (blocks["at"] == c["column"]) & c["row"].between(blocks["top"], blocks["bottom"])
    rows = blocks.hint("merge").join(c, on).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("row", "column", "text", "tokens"))).alias("cells"))
    items = F.flatten(F.col("cells.tokens"))
    source = F.transform("cells", lambda x: a1(x["row"], x["column"]))
    return rows.select(*keys, items.alias("items"), F.array_join(F.col("cells.text"), "\n").alias("raw_text"), source.alias("source")).filter("size(items) > 0")


def _by_meal(rows: DataFrame, columns: str = "columns") -> DataFrame:
    """A row per meal: meal, at (its column)."""
    meals = F.array(*[F.struct(F.lit(m).alias("meal"), F.col(f"{columns}.{m}").alias("at")) for m in MEALS])
    return rows.withColumn("__meal", F.explode(meals)).withColumns({"meal": F.col("__meal.meal"), "at": F.col("__meal.at")}).drop("__meal", columns)


def _first_meal() -> Column:
    return F.least(*[F.col(f"columns.{m}") for m in MEALS])


def day_columns(cells: DataFrame, sheets: DataFrame) -> DataFrame:
    """The column left of the meals with most day numbers below the header, the leftmost on a tie: day_column."""
    left = complete(cells).hint("merge").join(sheets.select(*SHEET, "header_row", "columns"), SHEET).filter(F.col("row") > F.col("header_row")).filter(F.col("column") < _first_meal())
    per = left.filter(F.size(days_in_text(F.col("text"))) > 0).groupBy(*SHEET, "column").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(*SHEET).agg(F.min_by("column", F.struct((-F.col("n")).alias("a"), "column")).alias("day_column"), F.max("n").alias("n"))


def date_rows(cells: DataFrame, year: Column, month: Column, sheets: DataFrame | None = None) -> DataFrame:
    """Records of sheets with a day per row, or per merged rows. The weekday is the nearest one left of the day."""
    c = complete(cells)
    sheets = cut((layout(c) if sheets is None else sheets).filter(F.col("family") == FAMILIES[0]), "sheets")  # a row per sheet, used several times
    best = sheets.hint("merge").join(day_columns(c, sheets), SHEET).select(*SHEET, "header_row", "body_end", "columns", "day_column")
    inside = c.hint("merge").join(best, SHEET).filter("row > header_row AND row <= body_end AND `column` <= day_column")
    days = inside.filter("`column` = day_column AND NOT child").withColumn("days", days_in_text(F.col("text"))).filter("size(days) > 0")
    shown = F.when((F.col("text") == "") & F.col("child"), F.col("parent_text")).otherwise(F.col("text"))
    week = inside.filter("`column` < day_column").withColumn("w", weekday_of(shown)).filter("w IS NOT NULL").groupBy(*SHEET, "row").agg(F.max_by("w", "column").alias("weekday"))
    rows = days.hint("merge").join(week, [*SHEET, "row"], "left").select(*SHEET, "columns", "weekday", F.col("row").alias("top"), F.coalesce("bottom", "row").alias("bottom"), F.explode("days").alias("d"))
    blocks = rows.withColumn("day", made_date(year, month, F.col("d"))).filter("day IS NOT NULL").drop("d")
    return _records(c, _by_meal(blocks))


def weekday_blocks(cells: DataFrame, year: Column, month: Column, sheets: DataFrame | None = None) -> DataFrame:
    """Records of sheets with a block of rows per weekday: its day numbers, or else every such weekday of the month.

    Where the row above the first anchor holds food, all blocks start a row above their anchors.
    """
    c = complete(cells)
    sheets = cut((layout(c) if sheets is None else sheets).filter(F.col("family") == FAMILIES[1]), "sheets")
    facts = sheets.select(*SHEET, "header_row", "body_end", "columns", _first_meal().alias("first_meal"))
    labels = c.hint("merge").join(facts, SHEET).filter("row > header_row AND `column` < first_meal AND NOT child")
    anchors = labels.filter("row <= body_end").withColumn("weekday", weekday_of(F.col("text"))).filter("weekday IS NOT NULL").groupBy(*SHEET, "row").agg(F.min_by("weekday", "column").alias("weekday"))
    first = anchors.groupBy(*SHEET).agg((F.min("row") - 1).alias("row")).hint("merge").join(facts.select(*SHEET, "columns"), SHEET)
    above = menu_cells(c).hint("merge").join(first, [*SHEET, "row"]).filter(F.col("column").isin(*[F.col(f"columns.{m}") for m in MEALS]))
    food = above.groupBy(*SHEET).agg(F.bool_or(~F.regexp_replace(F.trim("text"), " ", "").isin(*HEADINGS)).alias("shift"))
    placed = anchors.hint("merge").join(food, SHEET, "left").hint("merge").join(facts.select(*SHEET, "header_row", "first_meal"), SHEET)
    shift = F.coalesce("shift", F.lit(False)) & (F.col("row") - 1 > F.col("header_row"))
    starts = placed.select(*SHEET, "first_meal", "weekday", (F.col("row") - shift.cast("int")).alias("start"))
    last = body_ends(c, starts.groupBy(*SHEET, "first_meal").agg(F.max("start").alias("start")), notes=True).select(*SHEET, F.col("body_end").alias("last_end"))
    blocks = L.blocks(starts.hint("merge").join(last, SHEET), SHEET, "start", F.col("last_end")).select(*SHEET, F.col("start").alias("top"), F.col("block_end").alias("bottom"), "weekday")
    numbers = labels.filter("NOT formula").select(*[F.col(k).alias(f"__{k}") for k in SHEET], "row", days_in_text(F.col("text")).alias("days"))
    inside = blocks.hint("merge").join(numbers, (F.col("document_id") == F.col("__document_id")) & (F.col("sheet") == F.col("__sheet")) & F.col("row").between(F.col("top"), F.col("bottom")), "left")
    per = inside.groupBy(*SHEET, "top", "bottom", "weekday").agg(F.array_distinct(F.flatten(F.collect_list("days"))).alias("days"))
    named = F.filter(F.transform("days", lambda d: made_date(year, month, d)), lambda d: d.isNotNull())
    dates = F.when(F.size("days") > 0, named).otherwise(weekday_dates(year, month, F.col("weekday")))
    return _records(c, _by_meal(per.withColumn("day", F.explode(dates)).drop("days").hint("merge").join(facts.select(*SHEET, "columns"), SHEET)))


def meal_rows(cells: DataFrame, year: Column, month: Column, sheets: DataFrame | None = None) -> DataFrame:
    """Records of sheets with a block of rows per meal and a column per weekday, for every such weekday of the month."""
    c = complete(cells)
    sheets = cut((layout(c) if sheets is None else sheets).filter(F.col("family") == FAMILIES[2]), "sheets")
    meals = _by_meal(sheets.select(*SHEET, "label_column", "rows"), "rows").withColumnRenamed("at", "start")
    starts = meals.groupBy(*SHEET).agg(F.max("start").alias("start"), (F.max("label_column") + 1).alias("first_meal"))
    last = body_ends(c, starts, notes=True).select(*SHEET, F.col("body_end").alias("last_end"))
    blocks = L.blocks(meals.hint("merge").join(last, SHEET), SHEET, "start", F.col("last_end")).select(*SHEET, "label_column", "meal", F.col("start").alias("top"), F.col("block_end").alias("bottom"))
    week = c.withColumn("w", weekday_of(F.col("text"))).filter("w IS NOT NULL").groupBy(*SHEET, F.col("column").alias("at")).agg(F.max_by("w", "row").alias("weekday"))
    slots = blocks.hint("merge").join(week, SHEET).filter("at > label_column").withColumn("day", F.explode(weekday_dates(year, month, F.col("weekday"))))
    return _records(c, slots.drop("label_column"))


def extract(cells: DataFrame, year: Column, month: Column) -> DataFrame:
    """Records of all families, with family."""
    c = complete(cells)
    sheets = cut(layout(c), "layouts")
    ways = zip(FAMILIES, (date_rows, weekday_blocks, meal_rows), strict=True)
    first, second, third = (way(c, year, month, sheets).withColumn("family", F.lit(name)) for name, way in ways)
    return first.unionByName(second).unionByName(third)


def diagnose(cells: DataFrame, keywords: tuple[str, ...], samples: int = 20) -> DataFrame:
    """Sheets without a known layout: used range, merges, keywords found, up to `samples` date-like texts, closest family.

    The closest family is that of meals in columns if all three meals are named anywhere, else none.
    """
    c = complete(cells)
    lost = c.hint("merge").join(layout(c).select(*SHEET), SHEET, "left_anti")
    words = F.array_sort(F.array_compact(F.array(*[F.when(F.bool_or(F.col("text").contains(w)), F.lit(w)) for w in keywords])))
    date_like = F.when(F.size(days_in_text(F.col("text"))) > 0, F.struct("row", "column", "text"))
    named = [F.bool_or(F.coalesce(meal_of(F.col("text")) == m, F.lit(False))) for m in MEALS]
    per = lost.groupBy(*SHEET).agg(
        F.count_if(F.col("bottom").isNotNull()).alias("n_merges"), words.alias("keywords"),
        F.slice(F.array_sort(F.collect_list(date_like)), 1, samples).alias("found"), (named[0] & named[1] & named[2]).alias("all_meals"),
    )
    near = F.when(F.col("all_meals"), F.lit(FAMILIES[0])).otherwise(F.lit("none"))
    return used_range(lost).hint("merge").join(per, SHEET).select(*SHEET, "min_row", "max_row", "min_column", "max_column", "n_merges", "keywords", F.col("found.text").alias("samples"), near.alias("closest"))
