"""Quality operators: coverage, multisets, metrics, constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_slots(observed: DataFrame, scope: list[str], day: str, kind: str, kinds: list[str], first: str, last: str) -> DataFrame:
    """Expected (scope, day, kind) that weren't observed. The calendar and kinds are literals, so nothing is cross-joined."""
    days = F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    expected = observed.select(*scope).distinct().withColumn(day, F.explode(days)).withColumn(kind, F.explode(F.array(*map(F.lit, kinds))))
    return expected.join(observed.select(*scope, day, kind).distinct(), [*scope, day, kind], "left_anti")


def coverage(observed: DataFrame, scope: list[str], day: str, kind: str, kinds: list[str], first: str, last: str) -> DataFrame:
    """Expected and observed days and slots per scope. Days outside the period count in observed_slots only."""
    inside = F.col(day).between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    n = F.datediff(F.to_date(F.lit(last)), F.to_date(F.lit(first))) + 1
    return observed.groupBy(*scope).agg(
        n.cast("long").alias("expected_days"),
        F.countDistinct(F.when(inside, F.col(day))).alias("observed_days"),
        (n * len(kinds)).cast("long").alias("expected_slots"),
        F.countDistinct(day, kind).alias("observed_slots"),
    )


def multiset_difference(a: DataFrame, b: DataFrame, key: list[str], item: str) -> DataFrame:
    """Items with their surplus in a (missing from b) and in b (extra)."""
    left = a.groupBy(*key, item).agg(F.count(F.lit(1)).alias("__a"))
    right = b.groupBy(*key, item).agg(F.count(F.lit(1)).alias("__b"))
    d = F.coalesce("__a", F.lit(0)) - F.coalesce("__b", F.lit(0))
    out = left.join(right, [*key, item], "full_outer").select(*key, item, F.greatest(d, F.lit(0)).alias("missing"), F.greatest(-d, F.lit(0)).alias("extra"))
    return out.filter("missing > 0 OR extra > 0")


def multiset_overlap(a: DataFrame, b: DataFrame, key: list[str], item: str) -> DataFrame:
    """Per key: items in a, in b, in both (with multiplicity)."""
    left = a.groupBy(*key, item).agg(F.count(F.lit(1)).alias("__a"))
    right = b.groupBy(*key, item).agg(F.count(F.lit(1)).alias("__b"))
    x, y = F.coalesce("__a", F.lit(0)), F.coalesce("__b", F.lit(0))
    return left.hint("merge").join(right, [*key, item], "full_outer").groupBy(*key).agg(F.sum(x).alias("n_a"), F.sum(y).alias("n_b"), F.sum(F.least(x, y)).alias("n_both"))


def metrics(truth: Column, found: Column) -> list[Column]:
    """Precision and recall of a 0/1 prediction, with 0 for nothing to divide by."""
    hit = F.sum(F.when((truth == 1) & (found == 1), 1).otherwise(0))
    safe = lambda n: F.round(F.coalesce(hit / F.nullif(n, F.lit(0)), F.lit(0.0)), 6)
    return [hit.alias("hits"), safe(F.sum(found)).alias("precision"), safe(F.sum(truth)).alias("recall"), F.sum((truth == found).cast("int")).alias("exact")]


def suspicious_days(df: DataFrame, scope: list[str], day: str, content: str) -> DataFrame:
    """Scopes' days whose rows are three or more and all have the same content."""
    return df.groupBy(*scope, day).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(content).alias("n_contents")).filter("n >= 3 AND n_contents = 1")


def repeated_single(df: DataFrame, scope: list[str], content: str, least: int = 15) -> DataFrame:
    """Content that a scope repeats at least so many times."""
    return df.groupBy(*scope, content).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
