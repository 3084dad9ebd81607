"""Ordered-row operators: as-of anchors, blocks, range joins, calendar expansion, nearest rows, inheritance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import cut


def in_ranges(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """df with __part: rows in order of keys and `order`, dealt out by ranges of both, so that a hot key spreads over many parts.

    The ranges are written once: what is computed from them twice then sees the same ones.
    """
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    return cut(ranged.withColumn("__part", F.spark_partition_id()), "ranges")


def carried(ranged: DataFrame, keys: list[str], order: list[str], value: Column, out: str, own: bool = True, back: bool = False) -> DataFrame:
    """ranged (from in_ranges) with the last non-null value of the same key up to each row; own: the row's included; back: the next one instead.

    First each part by itself, then the last value of each part and key is carried over to the key's later parts. A key that
    spans parts has a carry in each, which makes two carries a part at most: these are broadcast.
    """
    turned = [F.col(c).desc_nulls_last() if back else F.col(c).asc_nulls_first() for c in order]
    last = (Window.unboundedPreceding, Window.currentRow if own else -1)
    inside = F.last(value, ignorenulls=True).over(Window.partitionBy("__part", *keys).orderBy(*turned).rowsBetween(*last))
    at = F.struct(*order)
    pick = F.min_by if back else F.max_by
    ends = ranged.groupBy(*keys, "__part").agg(pick(value, F.when(value.isNotNull(), at)).alias("__end"))
    parts = Window.partitionBy(*keys).orderBy(F.col("__part").desc() if back else F.col("__part")).rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.withColumn("__carry", F.last("__end", ignorenulls=True).over(parts)).filter("__carry IS NOT NULL")
    carry = carry.select(*[F.col(k).alias(f"__key_{k}") for k in keys], F.col("__part").alias("__of"), "__carry")
    on = F.col("__part") == F.col("__of")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    joined = ranged.withColumn(out, inside).join(F.broadcast(carry), on, "left")
    return joined.withColumn(out, F.coalesce(out, "__carry")).drop("__carry", "__of", *[f"__key_{k}" for k in keys])


def asof_anchor(df: DataFrame, keys: list[str], order: list[str], anchor: Column, out: str = "anchor") -> DataFrame:
    """Each row with the last anchor at or above it; anchor is null on rows that are none."""
    return carried(in_ranges(df, keys, order), keys, order, anchor, out).drop("__part")


def blocks(df: DataFrame, keys: list[str], start: str, last: Column) -> DataFrame:
    """Block of each start: to the row before the next one, the last block to `last`."""
    found = carried(in_ranges(df, keys, [start]), keys, [start], F.col(start), "__next", own=False, back=True)
    return found.withColumn("block_end", F.coalesce(F.col("__next") - 1, last)).drop("__part", "__next")


def nearest_before(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """Last non-null value strictly before each row."""
    return carried(in_ranges(df, keys, order), keys, order, value, out, own=False).drop("__part")


def place(c: Column, kind: str) -> Column:
    """A date, a time or a number as a number."""
    return F.unix_date(c) if kind == "date" else F.unix_seconds(c.cast("timestamp")) if kind.startswith("timestamp") else c


def range_join(points: DataFrame, ranges: DataFrame, keys: list[str], value: str, low: str, high: str, how: str = "inner", width: float = 64) -> DataFrame:
    """Points inside ranges of the same key (bounds included).

    The line is cut into bins of `width` (days, seconds or units). A range stands in each bin that it touches, a point in one: an
    equi join on key and bin leaves pairs of one bin, the exact condition stands behind it. So a hot key spreads over
    its bins, and candidates grow with the ranges of a bin, not of the key. how: inner or left.
    """
    kinds = dict(points.dtypes) | dict(ranges.dtypes)
    cell = lambda c: F.floor(place(F.col(c), kinds[c]) / width).cast("long")
    r = ranges.filter(F.col(low) <= F.col(high)).select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in ranges.columns if c not in keys], F.explode(F.sequence(cell(low), cell(high))).alias("__bin"))
    p = points.withColumn("__at", cell(value))
    on = (F.col("__at") == F.col("__bin")) & F.col(value).between(F.col(low), F.col(high))
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    return p.join(r, on, how).drop("__at", "__bin", *[f"__{k}" for k in keys])


def calendar_expand(df: DataFrame, year: Column, month: Column, weekday: Column, out: str = "day") -> DataFrame:
    """A row per date of the month that falls on the weekday (Monday 0)."""
    first = F.make_date(year, month, F.lit(1))
    days = F.filter(F.sequence(first, F.last_day(first)), lambda d: F.weekday(d) == weekday)
    return df.withColumn(out, F.explode(days))


def mode_first_seen(df: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """Most frequent value per key; on a tie the one seen first."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("__first"))
    rank = F.struct(F.col("n"), (-F.col("__first").cast("long")).alias("f"))
    return counts.groupBy(*keys).agg(F.max_by(value, rank).alias("mode"), F.max("n").alias("n"))


def top_per(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The n first rows of each key, with their rank."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= n)
