"""Period of a document from its metadata, sheets, file name and date of publication, with evidence and warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import codes

# Patterns of periods in title rows and of months in file names; years that are believed.
# Year and month without anything between or behind them count at the start of a word only, not inside a number, a path or a joined item.
BARE = r"(?:(?=20\d{2}[\s년./-])|(?=20\d{2}(?:1[0-2]|0?[1-9])\s*월)|(?<![^\s\p{L}(\[（【~_-]))"
PERIOD = BARE + r"(20\d{2})\s*년?\s*[./-]?\s*(1[0-2]|0?[1-9])\s*월?"
ISO_DAY = r"20\d{2}-\d{2}-\d{2}(?:T.*)?"
FILE_MONTH = r"(?<!\d)(1[0-2]|0?[1-9])\s*월"
YEARS = (2010, 2035)


def period_evidence(cells: DataFrame, rows: int = 4, most: int = 500) -> DataFrame:
    """document_id, position, year, month: every period that the title rows name, in order of sheet, row and column.

    Of a document's title cells the first `most` count.
    """
    from .layout import top_per

    titles = cells.filter((F.col("row") <= rows) & (F.col("text") != ""))
    ranked = top_per(titles, ["document_id"], [F.col(c) for c in ("sheet", "row", "column")], most)
    pairs = F.arrays_zip(*[F.regexp_extract_all("text", F.lit(PERIOD), F.lit(k)) for k in (1, 2)])
    named = F.filter(F.transform(pairs, lambda x: F.struct(x["0"].cast("int").alias("year"), x["1"].cast("int").alias("month"))), lambda x: x["year"].between(*YEARS))
    day = F.when(F.col("text").rlike(rf"\A(?:{ISO_DAY})\z"), F.array(F.struct(F.substring("text", 1, 4).cast("int").alias("year"), F.substring("text", 6, 2).cast("int").alias("month"))))
    both = F.concat(named, F.coalesce(day, F.array().cast("array<struct<year:int,month:int>>")))
    return ranked.select("document_id", "rank", F.posexplode(both).alias("k", "x")).select("document_id", F.struct("rank", "k").alias("position"), "x.year", "x.month")


def resolve_period(samples: DataFrame, evidence: DataFrame) -> DataFrame:
    """samples with year, month, evidence and warnings.

    samples: document_id, meal_year, meal_month, filename, published_date, year_inferred, filename_year, filename_month. Metadata
    counts if it has both parts, else the period named most often (the first on a tie) replaces both; a month may come from the file
    name, a year from the publication. What titles say against the result is a conflict.
    """
    counts = evidence.groupBy("document_id", "year", "month").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("first"))
    rank = F.struct((-F.col("n")).alias("n"), "first")
    named = counts.groupBy("document_id").agg(F.min_by(F.struct("year", "month"), rank).alias("mode"), F.collect_set(F.struct("year", "month")).alias("named"))
    s = samples.hint("merge").join(named, "document_id", "left")
    number = lambda c: F.nullif(F.col(c).cast("int"), F.lit(0))
    year0, month0 = number("meal_year"), number("meal_month")
    given = year0.isNotNull() & month0.isNotNull()
    from_sheet = ~given & F.col("mode").isNotNull()
    s = s.withColumns({"__given": given, "__sheet": from_sheet, "__y": F.when(from_sheet, F.col("mode.year")).otherwise(year0), "__m": F.when(from_sheet, F.col("mode.month")).otherwise(month0)})
    file_month = F.regexp_extract(F.coalesce("filename", F.lit("")), FILE_MONTH, 1).try_cast("int")
    published = F.regexp_extract(F.coalesce("published_date", F.lit("")), r"^(20\d{2})", 1).try_cast("int")
    s = s.withColumns({"month": F.coalesce("__m", file_month), "year": F.coalesce("__y", published)})
    from_file, from_post = F.col("__m").isNull() & F.col("month").isNotNull(), F.col("__y").isNull() & F.col("year").isNotNull()
    pair = F.struct("year", "month")
    whole = F.col("year").isNotNull() & F.col("month").isNotNull()
    stated = F.coalesce(F.array_contains("named", pair), F.lit(False))
    conflict = whole & F.col("named").isNotNull() & ~stated
    in_name = F.coalesce((number("filename_year") == F.col("year")) & (number("filename_month") == F.col("month")), F.lit(False))
    inferred = F.coalesce("year_inferred", F.lit(False))
    s = s.withColumns({"__file": from_file, "__post": from_post, "__confirmed": inferred & (stated | in_name), "__open": inferred & ~(stated | in_name) & ~from_post, "__conflict": conflict})
    tell: dict[str, Column] = {
        "historical metadata year/month": F.col("__given"), "workbook cell year/month": F.col("__sheet"), "filename month": F.col("__file"), "publication year": F.col("__post"),
        "publication fallback confirmed": F.col("__confirmed"), "publication fallback not confirmed": F.col("__open"),
    }
    said = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tell.items()]))
    warn = codes({"YEAR_INFERRED_FROM_PUBLICATION": F.col("__post") | F.col("__open"), "PERIOD_CONFLICT": F.col("__conflict")})
    return s.select(*samples.columns, "year", "month", said.alias("evidence"), warn.alias("warnings"))
