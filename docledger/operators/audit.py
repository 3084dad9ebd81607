"""Audit operators: distributions, shares, template families, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def domain_counts(df: DataFrame, column: Column, domain: list[str]) -> DataFrame:
    """Count per value of a fixed domain; values that don't occur count 0."""
    spark = df.sparkSession
    values = spark.createDataFrame([(v,) for v in domain], "value string")
    counts = df.groupBy(column.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return values.join(counts, "value", "left").select("value", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def grouped_counts(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Both margins and the cross-tab in one pass: GROUPING SETS."""
    rows = df.select(a.alias("a"), b.alias("b"))
    return rows.groupingSets([["a", "b"], ["a"], ["b"]], "a", "b").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


def share_change(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Share of each key in two snapshots in percent, and the difference in points."""
    total = Window.partitionBy()
    side = lambda df, x: df.groupBy(key).agg(F.count(F.lit(1)).alias(f"{x}_n")).withColumn(f"{x}_total", F.sum(f"{x}_n").over(total))
    joined = side(old, "old").join(side(new, "new"), key, "full_outer")
    share = lambda x: F.round(F.coalesce(F.col(f"{x}_n") * 100.0 / F.col(f"{x}_total"), F.lit(0.0)), 2)
    return joined.select(
        key, F.coalesce("old_n", F.lit(0)).alias("old_n"), F.coalesce("new_n", F.lit(0)).alias("new_n"), share("old").alias("old_share"), share("new").alias("new_share")
    )


def priority(df: DataFrame, key: str) -> DataFrame:
    """Counts by falling size with rank and share; the window runs over the few groups, not the rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    share = F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 2)
    return counts.withColumn("share", share).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), key)))


def families(df: DataFrame, row_id: str, group: str, features: Column) -> DataFrame:
    """Rows by feature vector: family rank inside a group by falling size, then by the vector's text; size; example."""
    sized = df.withColumn("features", features).groupBy(group, "features").agg(F.count(F.lit(1)).alias("n"), F.min(row_id).alias("example"))
    return sized.withColumn("family", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), "features")))


def prefix_rollup(df: DataFrame, path: Column, size: Column, depth: int = 2) -> DataFrame:
    """Sum of sizes and count for each path prefix of 0 to depth segments."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    levels = F.transform(F.sequence(F.lit(0), F.least(F.size(parts), F.lit(depth))), lambda k: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, k), "/")))
    return df.select(size.alias("size"), F.explode(levels).alias("prefix")).groupBy("prefix").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("files"))


def tag_profile(html: Column, tags: tuple[str, ...]) -> list[Column]:
    return [F.regexp_count(html, F.lit(rf"(?i)<{t}[\s>]")).alias(f"n_{t}") for t in tags]


def compare_versions(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys, before_n, after_n, added: counts of two versions side by side."""
    count = lambda df, x: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(x))
    both = count(new, "after_n").join(count(old, "before_n"), keys, "full_outer").fillna(0, ["before_n", "after_n"])
    return both.select(*keys, "before_n", "after_n", (F.col("after_n") - F.col("before_n")).alias("added"))


def sheet_profile(cells: DataFrame, keywords: tuple[str, ...]) -> DataFrame:
    """Per document and sheet: cells with text, used range, formulas, numbers, keywords found."""
    from .grid import SHEET, complete, used_range

    c = complete(cells).filter("text <> ''")
    number = F.regexp_replace("text", ",", "").try_cast("double").isNotNull() & F.col("text").rlike(r"[\d.]\s*$")
    found = F.lit(0)
    for w in keywords:
        found = found + F.max(F.col("text").contains(w).cast("int"))
    per = c.groupBy(*SHEET).agg(F.count(F.lit(1)).alias("n_cells"), F.count_if("formula").alias("n_formulas"), F.count_if(number).alias("n_numbers"), found.cast("long").alias("n_keywords"))
    return used_range(cells).hint("merge").join(per, SHEET)


def top_values(df: DataFrame, keys: list[str], value: str, n: int = 12) -> DataFrame:
    """keys, value, count, rank: the n most frequent values of each key, by count and then by value."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("count"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("count"), value))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= n)


def sheet_features(cells: DataFrame, keywords: tuple[str, ...]) -> DataFrame:
    """document_id, features: what sheets look like, as one text: number, names without digits, shapes, merges, keywords, in order of sheets."""
    from ..functions.text import sheet_key
    from .grid import SHEET, complete, used_range

    c = complete(cells)
    found = F.array_sort(F.array_compact(F.array(*[F.when(F.bool_or(F.col("text").contains(w)), F.lit(w)) for w in keywords])))
    per = c.groupBy(*SHEET).agg(F.count_if(F.col("bottom").isNotNull()).alias("merges"), F.array_join(found, ",").alias("keywords"))
    shaped = used_range(cells).hint("merge").join(per, SHEET)
    one = F.concat_ws("|", sheet_key(F.col("sheet")), F.concat_ws("x", "rows", "columns"), F.concat(F.lit("m"), F.col("merges").cast("string")), "keywords")
    sheets = shaped.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("sheet", one.alias("x")))).alias("s"))
    return sheets.select("document_id", F.concat_ws(";", F.concat(F.lit("n"), F.size("s").cast("string")), F.array_join(F.col("s.x"), ";")).alias("features"))


def page_features(blocks: Column, characters: Column, images: Column) -> Column:
    """Features of a paged document, in buckets."""
    from ..functions.rules import bucket

    return F.concat_ws("|", bucket(blocks, (20, 60, 120, 240)), bucket(characters, (100, 500, 1000, 2500, 5000)), bucket(images, (0, 2, 6, 12)))


def template_families(df: DataFrame, row_id: str, extension: str, features: str) -> DataFrame:
    """extension, template (short hash of the features), n, example, family (rank by falling size, then by hash)."""
    hashed = df.withColumn("template", F.substring(F.sha2(features, 256), 1, 12))
    sized = hashed.groupBy(extension, "template").agg(F.count(F.lit(1)).alias("n"), F.min(row_id).alias("example"))
    return sized.withColumn("family", F.row_number().over(Window.partitionBy(extension).orderBy(F.desc("n"), "template")))


def route_tables(documents: DataFrame, route: str, routes: list[str], values: dict[str, Column]) -> DataFrame:
    """dimension, value, documents, and a column a route: documents by route against each dimension, in one pass.

    values: a column for each dimension, an array where a document may have several values (each counts once), null where it
    has none ('undetected'). Counts are taken per route and value and turned, so that a row a task and pair is shuffled.
    """
    none = F.lit("undetected")
    each = []
    for name, value in values.items():
        listed = value if isinstance(documents.select(value).schema[0].dataType, ArrayType) else F.array(value)
        kept = F.array_distinct(F.transform(F.coalesce(listed, F.array(none)), lambda v: F.coalesce(v.cast("string"), none)))
        filled = F.when(F.size(kept) == 0, F.array(none)).otherwise(kept)
        each.append(F.arrays_zip(F.array_repeat(F.lit(name), F.size(filled)).alias("dimension"), filled.alias("value")))
    rows = documents.select(F.col(route).alias("__route"), F.explode(F.concat(*each)).alias("x")).select("__route", "x.dimension", "x.value")
    counted = rows.groupBy("dimension", "value").pivot("__route", routes).agg(F.count(F.lit(1))).fillna(0, routes)
    return counted.withColumn("documents", sum(F.col(r) for r in routes)).select("dimension", "value", "documents", *routes)


def cell_structure(cells: DataFrame, keys: tuple[str, ...] = ("document_id", "sheet")) -> DataFrame:
    """What sheets of workbook cells (sources.workbook.cells) hold, without their contents: counts by kind, used range, number formats."""
    full = (F.col("raw_text") != "") | F.col("is_formula")
    count = lambda test: F.count_if(test)
    return cells.filter("coordinate IS NOT NULL").groupBy(*keys).agg(
        count(full).alias("n_cells"),
        F.max(F.when(full, F.col("row"))).alias("max_row"),
        F.max(F.when(full, F.col("column"))).alias("max_column"),
        count(F.col("is_formula")).alias("n_formulas"),
        count(F.col("is_excel_error")).alias("n_errors"),
        count(F.col("raw_type") == "date").alias("n_dates"),
        count(F.col("raw_type") == "number").alias("n_numbers"),
        count(F.col("merged_parent").isNotNull()).alias("n_merged"),
        F.countDistinct(F.when(F.col("hidden_row"), F.col("row"))).alias("n_hidden_rows"),
        F.countDistinct(F.when(full, F.col("number_format"))).alias("n_formats"),
    )


def unknown_roles(posts: DataFrame, post: str, attachments: str, known: list[str]) -> DataFrame:
    """role, post, pos, n: attachments (array of structs with a role) whose role isn't known, a row each, with how many have the same.

    A missing role is 'unknown'. Counts are taken before they are joined back, so that a role that most have splits like any key.
    """
    each = posts.select(post, F.posexplode(attachments).alias("pos", "x")).select(F.coalesce("x.role", F.lit("unknown")).alias("role"), post, "pos").filter(~F.col("role").isin(known))
    return each.join(each.groupBy("role").agg(F.count(F.lit(1)).alias("n")), "role")
