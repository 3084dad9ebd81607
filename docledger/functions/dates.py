"""Date functions; bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of periods and dates in Korean and plain texts.
YEAR_MONTH = r"(?:(20\d{2}|\d{2})\s*[년.\-/]\s*)?(1[0-2]|0?[1-9])\s*월"
YEAR_MONTH_DAY = r"(\d{4})[-./년]\s*(\d{1,2})[-./월]\s*(\d{1,2})"
MONTH_DAY = r"(\d{1,2})[-./월]\s*(\d{1,2})"


def made_date(y: Column, m: Column, d: Column) -> Column:
    """A date from its parts, or null."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", y.cast("int"), m.cast("int"), d.cast("int")), "yyyy-MM-dd")


def year_month(c: Column, fallback_year: Column | None = None) -> Column:
    """struct(year, month) from free text; two-digit years are of this century; no month: both null."""
    month = F.regexp_extract(c, YEAR_MONTH, 2).try_cast("int")
    year = F.coalesce(F.regexp_extract(c, YEAR_MONTH, 1).try_cast("int"), fallback_year if fallback_year is not None else F.lit(None).cast("int"))
    return F.struct(F.when(month.isNotNull(), F.when(year < 100, year + 2000).otherwise(year)).alias("year"), month.alias("month"))


def loose_date(c: Column) -> Column:
    """First y-m-d in a text, whatever separates the parts."""
    parts = [F.regexp_extract(c, YEAR_MONTH_DAY, k).try_cast("int") for k in (1, 2, 3)]
    return F.when(parts[0].isNotNull(), made_date(*parts))


def days_in_text(c: Column) -> Column:
    """Day numbers 1 to 31 in a text; none if three digits stand together."""
    runs = F.filter(F.split(c, r"\D+"), lambda x: x != "")
    days = F.filter(F.transform(runs, lambda x: x.try_cast("int")), lambda d: d.between(1, 31))
    return F.when(c.rlike(r"\d{3,}") | c.isNull(), F.array().cast("array<int>")).otherwise(days)


def serial_date(n: Column, year: Column, month: Column) -> Column:
    """A number as a date: 1 to 31 is a day of the month, from 60 a spreadsheet serial."""
    whole = n.cast("long")
    return F.when((n == whole) & whole.between(1, 31), made_date(year, month, whole)).when(n >= 60, F.date_add(F.to_date(F.lit("1899-12-30")), whole.cast("int")))


def cell_date(text: Column, year: Column, month: Column) -> Column:
    """Date of a cell's text: y-m-d, else m-d of the year, else a single day number of the month."""
    md = [F.regexp_extract(text, MONTH_DAY, k).try_cast("int") for k in (1, 2)]
    days = days_in_text(text)
    return F.when(text.rlike(YEAR_MONTH_DAY), loose_date(text)).when(md[0].isNotNull(), made_date(year, md[0], md[1])).when(
        F.size(days) == 1, made_date(year, month, F.get(days, 0))
    )


def month_days(year: Column, month: Column) -> Column:
    """All dates of a month."""
    first = F.make_date(year, month, F.lit(1))
    return F.sequence(first, F.last_day(first))


def weekday_dates(year: Column, month: Column, weekday: Column) -> Column:
    """Dates of a month on one weekday (Monday 0)."""
    return F.filter(month_days(year, month), lambda d: F.weekday(d) == weekday)


def stale(last: Column, now: Column, days: int = 7) -> Column:
    """Nothing yet, or whole days since then reach the limit."""
    return last.isNull() | (F.floor((now.cast("timestamp").cast("double") - last.cast("timestamp").cast("double")) / 86400) >= days)
