"""Monthly JSON files: menus/<institution>/<year>/<month>.json, written a file per month and read back flat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.display import MEALS

SLOT = "struct<menu_items:array<struct<name:string>>,source_document_ids:array<string>>"
MONTH = f"struct<institution_id:string,year:int,month:int,days:map<string,map<string,{SLOT}>>>"
KEYS = ["institution_id", "year", "month"]


def month_name(month: Column) -> Column:
    """Two digits of a month from 1 to 12; anything else is an error."""
    good = month.between(1, 12)
    return F.when(good, F.lpad(month.cast("string"), 2, "0")).otherwise(F.raise_error(F.lit("a month is a number from 1 to 12")).cast("string"))


def write_months(slots: DataFrame, path: str) -> None:
    """slots: institution_id, day (date), meal, items, documents; one row each. A folder of institution, year and month per file.

    Slots of a month come together, a month being one file; a row holds a month at most.
    """
    slot = F.struct(F.transform("items", lambda x: F.struct(x.alias("name"))).alias("menu_items"), F.col("documents").alias("source_document_ids"))
    per_day = slots.groupBy("institution_id", "day").agg(F.map_from_entries(F.collect_list(F.struct("meal", slot.alias("slot")))).alias("meals"))
    dated = per_day.withColumns({"year": F.year("day"), "month": F.month("day"), "date": F.col("day").cast("string")})
    months = dated.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(F.struct("date", "meals"))).alias("days"))
    text = F.to_json(F.struct(*KEYS, "days"))
    rows = months.select(F.col("institution_id").alias("inst"), F.col("year").alias("yyyy"), month_name(F.col("month")).alias("MM"), text.alias("value"))
    rows.write.mode("overwrite").partitionBy("inst", "yyyy", "MM").text(path)


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """institution_id, year, month, day, meal, position, item, n_documents: every item of every month below a folder."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).filter(F.trim("value") != "")
    rows = files.select(F.from_json("value", MONTH).alias("m")).select(*[f"m.{k}" for k in KEYS], F.explode("m.days").alias("day", "meals"))
    slots = rows.select(*KEYS, "day", F.explode("meals").alias("meal", "slot")).filter(F.col("meal").isin(*MEALS))
    return slots.select(*KEYS, "day", "meal", F.size("slot.source_document_ids").alias("n_documents"), F.posexplode("slot.menu_items.name").alias("position", "item"))
