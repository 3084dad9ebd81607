"""Public contract: field sets, forbidden keys and values anywhere in nested rows, redaction."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_leaves(kind: T.DataType, path: str = "") -> Iterator[tuple[str, bool]]:
    """Paths of string leaves, and whether they lie in an array."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from string_leaves(f.dataType, f"{path}.{f.name}" if path else f.name)
    elif isinstance(kind, T.ArrayType):
        for inner, _ in string_leaves(kind.elementType, path):
            yield inner, True
    elif isinstance(kind, T.StringType):
        yield path, False


def field_names(kind: T.DataType) -> Iterator[str]:
    """Names of all fields, at any depth."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield f.name
            yield from field_names(f.dataType)
    elif isinstance(kind, T.ArrayType):
        yield from field_names(kind.elementType)
    elif isinstance(kind, T.MapType):
        yield from field_names(kind.valueType)


def forbidden_keys(df: DataFrame, keys: set[str]) -> list[str]:
    return sorted({n for n in field_names(df.schema) if n in keys})


def exact_fields(df: DataFrame, fields: set[str]) -> tuple[list[str], list[str]]:
    """Fields that are missing and fields too many at the top level."""
    own = set(df.columns)
    return sorted(fields - own), sorted(own - fields)


def any_leaf(c: Column, kind: T.DataType, test: Callable[[Column], Column]) -> Column:
    """Whether a string leaf of a nested column passes a test."""
    if isinstance(kind, T.StringType):
        return F.coalesce(test(c), F.lit(False))
    if isinstance(kind, T.StructType):
        out = F.lit(False)
        for f in kind.fields:
            out = out | any_leaf(c[f.name], f.dataType, test)
        return out
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.exists(c, lambda x: any_leaf(x, kind.elementType, test)), F.lit(False))
    if isinstance(kind, T.MapType):
        return F.coalesce(F.exists(F.map_values(c), lambda x: any_leaf(x, kind.valueType, test)), F.lit(False))
    return F.lit(False)


def forbidden_values(df: DataFrame, pattern: str) -> DataFrame:
    """path, n: string leaves outside arrays that match the pattern in some rows."""
    leaves = [p for p, in_array in string_leaves(df.schema) if not in_array]
    counts = df.agg(*[F.count_if(F.col(p).rlike(pattern)).alias(f"c{k}") for k, p in enumerate(leaves)])
    rows = F.array(*[F.struct(F.lit(p).alias("path"), F.col(f"c{k}").alias("n")) for k, p in enumerate(leaves)])
    return counts.select(F.explode(rows).alias("x")).select("x.*").filter("n > 0")


def redact(c: Column, kind: T.DataType, pattern: str, literal: str = "[redacted]") -> Column:
    """c with every string leaf that matches replaced, inside structs, arrays and map values."""
    if isinstance(kind, T.StringType):
        return F.when(c.rlike(pattern), F.lit(literal)).otherwise(c)
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[redact(c[f.name], f.dataType, pattern, literal).alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: redact(x, kind.elementType, pattern, literal))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda k, v: redact(v, kind.valueType, pattern, literal))
    return c
