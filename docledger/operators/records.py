"""Record operators: quality with cell origins, validation, document issues, suspicion, scope, status.

Records as extract() gives them: document_id, sheet, day, meal, weekday, top, bottom, at, items, raw_text, source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import codes, menu_tokens, token_category
from ..functions.text import a1
from .grid import MEALS, SHEET, STAFF_WORDS, complete

RECORD = [*SHEET, "day", "meal", "top", "at"]
# Issue code of each artifact category; titles that tell what a table covers; drinks that aren't a breakfast.
ISSUES = {
    "formula_literal": "UNRESOLVED_FORMULA_VALUE", "excel_error": "EXCEL_ERROR_VALUE", "subtotal": "NON_MENU_SUBTOTAL", "price": "NON_MENU_PRICE", "placeholder": "NON_MENU_PLACEHOLDER",
    "cost_metadata": "NON_MENU_COST_METADATA", "instruction_note": "NON_MENU_INSTRUCTION",
}
ADDS_TO_MENU, JUVENILE, DAIRY = r"(?s)기존\s*식단.{0,40}추가", "소년수용자", ("우유", "두유")
UNSAFE = ("formula_literal", "excel_error")


def menu_quality(records: DataFrame, cells: DataFrame) -> DataFrame:
    """records with clean items, artifacts (raw_text, classification, source_cell, action), unresolved, and formula counts.

    An item whose token comes from an error cell is an error. A slot is unresolved if an artifact threatens it (see
    split_artifacts) or one of its formulas has no good cached value.
    """
    c = complete(cells).select(*[F.col(k).alias(f"__{k}") for k in SHEET], a1(F.col("row"), F.col("column")).alias("__at"), menu_tokens(F.trim("text")).alias("tokens"), "error", "formula", "resolved")
    each = records.select(*RECORD, F.posexplode("source").alias("pos", "coordinate"))
    on = (each["document_id"] == c["__document_id"]) & (each["sheet"] == c["__sheet"]) & (each["coordinate"] == c["__at"])
    own = each.hint("merge").join(c, on).groupBy(*RECORD).agg(F.array_sort(F.collect_list(F.struct("pos", "coordinate", "tokens", "error", "formula", "resolved"))).alias("cells"))
    joined = records.hint("merge").join(own, RECORD, "left").withColumn("cells", F.coalesce("cells", F.array().cast(own.schema["cells"].dataType)))

    def category(item: Column) -> Column:
        bad = F.exists("cells", lambda x: x["error"] & F.array_contains(x["tokens"], item))
        return F.when(bad, F.lit("excel_error")).otherwise(token_category(item))

    def origin(item: Column) -> Column:
        return F.get(F.filter("cells", lambda x: F.array_contains(x["tokens"], item)), 0)["coordinate"]

    tagged = joined.withColumn("tagged", F.transform("items", lambda x: F.struct(x.alias("raw_text"), category(x).alias("classification"), origin(x).alias("source_cell"))))
    first = F.array_position(F.transform("tagged", lambda x: x["classification"].isNotNull()), True)
    behind = (first > 0) & F.exists(F.slice("tagged", F.greatest(first, F.lit(1)).cast("int"), F.size("tagged")), lambda x: x["classification"].isNull())
    clean = F.transform(F.filter("tagged", lambda x: x["classification"].isNull()), lambda x: x["raw_text"])
    unsafe = (F.size(clean) == 0) | F.exists("tagged", lambda x: F.coalesce(x["classification"].isin(*UNSAFE), F.lit(False))) | F.coalesce(behind, F.lit(False))
    flagged = tagged.withColumns({"clean": clean, "unsafe": unsafe})
    action = F.when(F.col("unsafe"), F.lit("quarantined")).otherwise(F.lit("excluded_from_menu"))
    artifacts = F.transform(F.filter("tagged", lambda x: x["classification"].isNotNull()), lambda x: F.struct(x["raw_text"].alias("raw_text"), x["classification"].alias("classification"), x["source_cell"].alias("source_cell"), action.alias("action")))
    formulas = F.filter("cells", lambda x: x["formula"])
    open_formulas = F.size(F.filter(formulas, lambda x: ~F.coalesce(x["resolved"], F.lit(False))))
    out = flagged.withColumns({"artifacts": artifacts, "n_formulas": F.size(formulas), "open_formulas": open_formulas})
    unresolved = (F.col("unsafe") & (F.size("artifacts") > 0)) | (F.col("open_formulas") > 0)
    return out.withColumn("unresolved", unresolved).drop("cells", "tagged", "unsafe")


def quality_summary(judged: DataFrame) -> DataFrame:
    """Per document: artifacts by action, error items, unresolved slots and formulas, and whether the menu is valid."""
    n = lambda test: F.sum(F.size(F.filter("artifacts", test))).cast("long")
    return judged.groupBy("document_id").agg(
        n(lambda x: x["action"] == "excluded_from_menu").alias("excluded_artifacts"),
        n(lambda x: x["classification"] == "excel_error").alias("excel_error_menu_items"),
        n(lambda x: (x["action"] == "quarantined") & ~x["classification"].isin(*UNSAFE)).alias("unresolved_non_menu_artifacts"),
        F.sum("open_formulas").cast("long").alias("unresolved_formula_values"),
        F.countDistinct(F.when(F.col("unresolved"), F.struct("day", "meal"))).alias("unresolved_slots"),
        (~F.bool_or("unresolved")).alias("menu_quality_valid"),
    )


def validate(records: DataFrame, cells: DataFrame, year: Column, month: Column) -> DataFrame:
    """records with issues (sorted codes) and status: invalid, warning (only a date outside the month) or valid.

    records: also clean, unresolved and attachment_id.
    """
    known = complete(cells).select(*SHEET, a1(F.col("row"), F.col("column")).alias("coordinate"))
    lost = records.select(*RECORD, F.explode("source").alias("coordinate")).hint("merge").join(known, [*SHEET, "coordinate"], "left_anti").select(*RECORD).distinct().withColumn("__lost", F.lit(True))
    many = records.groupBy("document_id", "day", "meal").agg((F.count(F.lit(1)) > 1).alias("__many"))
    day = F.col("day")
    joined = records.hint("merge").join(lost, RECORD, "left").hint("merge").join(many, ["document_id", "day", "meal"], "left")
    issues = codes(
        {
            "INVALID_DATE": day.isNull(),
            "DATE_OUTSIDE_MEAL_MONTH": (F.year(day) != year) | (F.month(day) != month),
            "WEEKDAY_MISMATCH": F.weekday(day) != F.col("weekday"),
            "DUPLICATE_DATE_MEAL": F.col("__many"),
            "BLANK_MEAL": F.size("clean") == 0,
            "UNRESOLVED_MENU_SLOT": F.col("unresolved"),
            "INVALID_SOURCE_CELL": (F.size("source") == 0) | F.col("__lost"),
            "MISSING_INPUT_LINK": F.coalesce("attachment_id", F.lit("")) == "",
        }
    )
    out = joined.withColumn("issues", issues).drop("__lost", "__many")
    status = F.when(F.size(F.array_except("issues", F.array(F.lit("DATE_OUTSIDE_MEAL_MONTH")))) > 0, "invalid").when(F.size("issues") > 0, "warning").otherwise("valid")
    return out.withColumn("status", status)


def document_issues(records: DataFrame, year: int, month: int) -> DataFrame:
    """document_id, code, message: dates of the month without any meal, and days that lack some."""
    good = records.filter((F.size("clean") > 0) & ~F.col("unresolved"))
    days = F.sequence(F.make_date(F.lit(year), F.lit(month), F.lit(1)), F.last_day(F.make_date(F.lit(year), F.lit(month), F.lit(1))))
    expected = records.select("document_id").distinct().withColumn("day", F.explode(days))
    seen = good.groupBy("document_id", "day").agg(F.collect_set("meal").alias("meals"))
    missing = expected.hint("merge").join(seen, ["document_id", "day"], "left_anti").select("document_id", F.lit("MISSING_MEAL_DATE").alias("code"), F.col("day").cast("string").alias("message"))
    lacks = F.array_sort(F.array_except(F.array(*map(F.lit, MEALS)), F.col("meals")))
    part = seen.withColumn("lacks", lacks).filter("size(lacks) > 0")
    message = F.concat(F.col("day").cast("string"), F.lit(": missing "), F.array_join("lacks", ","))
    return missing.unionByName(part.select("document_id", F.lit("MISSING_DAILY_MEAL").alias("code"), message.alias("message")))


def suspicious_meals(records: DataFrame, share: float = 0.9, repeats: int = 15) -> DataFrame:
    """document_id, code, detail: days of three equal meals, several cells that make one item, documents of single items, one single item again and again."""
    single = F.size("clean") == 1
    doc = lambda df, code, detail: df.select("document_id", code.alias("code"), detail.cast("string").alias("detail"))
    days = records.groupBy("document_id", "day").agg(F.countDistinct("meal").alias("n"), F.min("clean").alias("a"), F.max("clean").alias("b")).filter("n = 3 AND a = b")
    equal = doc(days, F.when(F.size("a") == 1, F.lit("IDENTICAL_SINGLE_ITEM_THREE_MEALS")).otherwise(F.lit("IDENTICAL_THREE_MEALS")), F.col("day"))
    cells = doc(records.filter(single & (F.size("source") > 1)), F.lit("MULTIPLE_CELLS_SINGLE_ITEM"), F.concat_ws(" ", "day", "meal"))
    mostly = records.groupBy("document_id").agg(F.count_if(single).alias("k"), F.count(F.lit(1)).alias("n")).filter(F.col("k") >= share * F.col("n"))
    again = records.filter(single).groupBy("document_id", F.get("clean", 0).alias("item")).agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") >= repeats)
    out = equal.unionByName(cells).unionByName(doc(mostly, F.lit("MOSTLY_SINGLE_ITEM"), F.col("k")))
    return out.unionByName(doc(again, F.lit("LONG_SINGLE_ITEM_REPETITION"), F.concat_ws(" x", "item", "k")))


def scope_warnings(cells: DataFrame, records: DataFrame, rows: int = 6, least: int = 14) -> DataFrame:
    """document_id, sheet, warnings: what title rows say about whom and what a table covers.

    A staff table; a table that adds to an existing menu; a juvenile table with `least` breakfasts or more that are all one drink.
    """
    top = complete(cells).filter((F.col("row") <= rows) & (F.col("text") != "") & ~F.col("child"))
    titles = top.groupBy(*SHEET).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "column", "text"))), lambda x: x["text"]), " ").alias("title"))
    morning = records.filter("meal = 'breakfast'").groupBy(*SHEET).agg(F.count(F.lit(1)).alias("n"), F.bool_and((F.size("clean") == 1) & F.get("clean", 0).isin(*DAIRY)).alias("dairy"))
    joined = titles.hint("merge").join(morning, SHEET, "left")
    staff, adds = F.lit(False), F.col("title").rlike(ADDS_TO_MENU)
    for w in STAFF_WORDS:
        staff = staff | F.col("sheet").contains(w) | F.col("title").contains(w)
    drink = F.replace("title", F.lit(" "), F.lit("")).contains(JUVENILE) & (F.coalesce("n", F.lit(0)) >= least) & F.col("dairy") & ~adds
    found = codes({"STAFF_TABLE_SELECTED": staff, "SUPPLEMENTARY_ONLY_TABLE": adds, "SUPPLEMENTARY_SCOPE_UNCERTAIN": drink})
    return joined.select(*SHEET, found.alias("warnings")).filter("size(warnings) > 0")


def document_status(records: Column, failures: Column, invalid: Column, issues: Column, complete_month: Column, provenance: Column) -> Column:
    """FAIL without records; PARTIAL with anything amiss; else PASS."""
    amiss = (failures > 0) | (invalid > 0) | (issues > 0) | ~F.coalesce(complete_month, F.lit(False)) | ~F.coalesce(provenance, F.lit(False))
    return F.when(records == 0, "FAIL").when(amiss, "PARTIAL").otherwise("PASS")


def coverage_verdict(observed: Column, expected: Column, failed: Column) -> Column:
    """full / partial / failed of a checked document."""
    return F.when(failed | (observed == 0), "failed").when(observed == expected, "full").otherwise("partial")


def ready_issues(schema: Column, meal: Column, status: Column, items: Column, provenance: list[Column], family: Column, families: tuple[str, ...], version: str = "1.0") -> Column:
    """Codes of the contract that a published record breaks."""
    missing = F.lit(False)
    for p in provenance:
        missing = missing | (F.coalesce(p.cast("string"), F.lit("")) == "")
    return codes(
        {
            "SCHEMA_VERSION": ~F.coalesce(schema == version, F.lit(False)),
            "MEAL_TYPE": ~F.coalesce(meal.isin(*MEALS), F.lit(False)),
            "STATUS": ~F.coalesce(status == "valid", F.lit(False)),
            "EMPTY_ITEMS": F.coalesce(F.size(items), F.lit(0)) < 1,
            "PROVENANCE": missing,
            "LAYOUT": ~F.coalesce(family.isin(*families), F.lit(False)),
        }
    )
