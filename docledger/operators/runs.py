"""Run operators: contracts of catalog rows, counters of runs, samples, selections for display, versions of inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import MEAL_TITLES, codes
from ..functions.text import normalize_space

SOURCE_FIELDS = ("document_id", "post_id", "attachment_id", "original_filename", "published_date")


def meal_plan_title(title: Column) -> Column:
    """Whether a title names a meal plan for inmates, by any of the fixed patterns after normalisation."""
    t, out = normalize_space(title), F.lit(False)
    for p in MEAL_TITLES:
        out = out | t.rlike(p)
    return F.coalesce(out, F.lit(False))


def _empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")) == ""


def post_issues(post_id: Column, title: Column, url: Column, published: Column, count: Column, attachments: Column) -> Column:
    """Codes of the constraints that a catalog row breaks. attachments: array of struct(attachment_id, url, status, sha256)."""
    dated = ~_empty(published) & F.try_to_date(published, "yyyy-MM-dd").isNull()
    return codes(
        {
            "REQUIRED_FIELD": _empty(post_id) | _empty(title) | _empty(url),
            "INVALID_DATE": dated,
            "ATTACHMENT_COUNT": ~count.eqNullSafe(F.size(attachments)),
            "ATTACHMENT_FIELD": F.exists(attachments, lambda a: _empty(a["attachment_id"]) | _empty(a["url"])),
            "DOWNLOAD_WITHOUT_DIGEST": F.exists(attachments, lambda a: (a["status"] == "downloaded") & _empty(a["sha256"])),
        }
    )


def source_issues(df: DataFrame) -> Column:
    """Codes of the public source contract that a row breaks: fields, http(s) URLs with a host, identity."""
    missing, bad = F.lit(False), {}
    for c in SOURCE_FIELDS:
        missing = missing | _empty(df[c])
    for c in ("post_url", "download_url"):
        bad[f"INVALID_{c.upper()}"] = ~F.coalesce(df[c].rlike(r"^https?://[^\s/?#]+"), F.lit(False))
    return codes({"MISSING_METADATA": missing, **bad, "IDENTITY": ~F.coalesce(df["document_id"] == F.concat_ws("-", df["post_id"], df["attachment_id"]), F.lit(False))})


def catalog_order(day: str, row_id: str) -> list[Column]:
    """Newest first, rows without a date last, larger ids first."""
    return [F.desc(F.coalesce(F.col(day).cast("string"), F.lit(""))), F.desc(row_id)]


def failures(df: DataFrame, stage: str, key: str, error: str = "_error") -> DataFrame:
    """stage, key, error_class, message of rows that failed: dead letters."""
    e = df.filter(F.col(error).isNotNull())
    kind = F.regexp_extract(F.col(error), r"^([A-Za-z_][\w.]*):", 1)
    return e.select(F.lit(stage).alias("stage"), F.col(key).cast("string").alias("key"), F.coalesce(F.nullif(kind, F.lit("")), F.lit("Error")).alias("error_class"), F.regexp_replace(error, r"^[A-Za-z_][\w.]*:\s*", "").alias("message"))


def run_counters(candidates: DataFrame, change: str = "change_type", download: str = "download_status", outcome: str = "outcome") -> DataFrame:
    """One row: attachments new, changed, unchanged, failed to download; documents ready, review, failed; the run's status."""
    c, o = F.col(change), F.col(outcome)
    n = lambda test: F.count_if(F.coalesce(test, F.lit(False)))
    out = candidates.agg(
        n(c.startswith("NEW_")).alias("new"), n(c == "ATTACHMENT_CHANGED").alias("changed"), n(c == "UNCHANGED").alias("unchanged"), n(F.col(download) == "failed").alias("download_failed"),
        n(o == "ready").alias("ready"), n(o == "review").alias("review"), n(o == "failed").alias("failed"),
    )
    status = F.when(F.col("download_failed") + F.col("failed") + F.col("review") > 0, "PARTIAL_SUCCESS").when(F.col("new") + F.col("changed") == 0, "NO_CHANGES").otherwise("SUCCESS")
    return out.withColumn("status", status)


def download_summary(manifest: DataFrame, status: str = "status") -> DataFrame:
    """One row: downloaded, reused, duplicate, failed, pending, and whether all came to an end."""
    s = F.col(status)
    out = manifest.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.coalesce(s == x, F.lit(False))).alias(x) for x in ("downloaded", "reused", "duplicate", "failed")])
    done = F.col("downloaded") + F.col("reused") + F.col("duplicate") + F.col("failed")
    return out.withColumns({"pending": F.col("total") - done, "complete": F.col("total") == done})


def sample_summary(documents: DataFrame) -> DataFrame:
    """format, documents, passed, partial, failed, valid, warnings, invalid, eligible; the row of no format is the total.

    documents: format, status, valid, warnings, invalid, eligible.
    """
    s = F.col("status")
    parts = [F.count_if(s == x).alias(y) for x, y in (("PASS", "passed"), ("PARTIAL", "partial"), ("FAIL", "failed"))]
    sums = [F.sum(x).cast("long").alias(x) for x in ("valid", "warnings", "invalid")]
    return documents.rollup("format").agg(F.count(F.lit(1)).alias("documents"), *parts, *sums, F.count_if("eligible").alias("eligible"))


def topped_up(df: DataFrame, taken: DataFrame, group: str, row_id: str, label: str, order: list[Column], limit: int) -> DataFrame:
    """row_id, reason: the taken rows, then one row of each group that has several labels, in order, up to a limit.

    A group's row is its first that isn't taken.
    """
    mixed = df.groupBy(group).agg(F.min(label).alias("a"), F.max(label).alias("b")).filter("a <> b").select(group)
    left = df.join(mixed, group, "left_semi").join(taken.select(row_id), row_id, "left_anti")
    first = left.withColumn("__n", F.row_number().over(Window.partitionBy(group).orderBy(*order, row_id))).filter("__n = 1")
    # no more rows than the limit are wanted, whatever the number taken
    best = first.orderBy(*order, row_id).limit(limit).select(row_id, F.lit("multi-role post coverage").alias("reason"), F.lit(1).alias("__stage"), F.monotonically_increasing_id().alias("__at"))
    kept = taken.select(row_id, "reason", F.lit(0).alias("__stage"), F.lit(0).cast("long").alias("__at"))
    return kept.unionByName(best).orderBy("__stage", "__at", row_id).limit(limit).select(row_id, "reason")


def search(df: DataFrame, query: str, columns: list[str]) -> DataFrame:
    """Rows in which a column holds the query, whatever its case; all rows for a blank query."""
    q = query.strip().lower()
    hit = F.lit(not q)
    for c in columns:
        hit = hit | F.coalesce(F.lower(c).contains(q), F.lit(False))
    return df.filter(hit)


def displayed(df: DataFrame, available: DataFrame, key: str, only_available: bool, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows with a point; on request only those with data."""
    placed = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    return placed.join(available.select(key).distinct(), key, "left_semi") if only_available else placed


def has_meals(slots: list[Column]) -> Column:
    """Whether any slot of a day has items."""
    out = F.lit(False)
    for s in slots:
        out = out | (F.coalesce(F.size(s), F.lit(0)) > 0)
    return out


def day_sources(days: DataFrame, sources: DataFrame, month: list[str], row_id: str) -> DataFrame:
    """row_id, step, document_id: sources of a day by its ids, else those inline, else all of its month.

    days: row_id, month keys, ids and inline (arrays of document ids). sources: month keys, document_id. Ids that the month's list lacks
    don't count.
    """
    own = days.select(row_id, *month, F.explode("ids").alias("document_id")).join(sources.select(*month, "document_id").distinct(), [*month, "document_id"])
    by_id = own.select(row_id, F.lit("by_id").alias("step"), "document_id").distinct()
    rest = days.join(by_id.select(row_id).distinct(), row_id, "left_anti")
    inline = rest.filter(F.size("inline") > 0).select(row_id, F.lit("inline").alias("step"), F.explode("inline").alias("document_id"))
    whole = rest.filter(F.coalesce(F.size("inline"), F.lit(0)) < 1).join(sources.select(*month, "document_id").distinct(), month).select(row_id, F.lit("month").alias("step"), "document_id")
    return by_id.unionByName(inline).unionByName(whole)


def golden_compare(golden: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """keys, state, n_expected, n_found, n_both of each golden slot: exact (same items in order), differs or missing."""
    joined = golden.select(*keys, F.col("items").alias("e")).join(found.select(*keys, F.col("items").alias("a")), keys, "left")
    state = F.when(F.col("a").isNull(), "missing").when(F.col("a") == F.col("e"), "exact").otherwise("differs")
    count = lambda arr, x: F.size(F.filter(arr, lambda y: y == x))
    both = F.aggregate(F.array_distinct("e"), F.lit(0), lambda s, x: s + F.least(count("e", x), count(F.coalesce("a", F.array().cast("array<string>")), x)))
    return joined.select(*keys, state.alias("state"), F.size("e").alias("n_expected"), F.coalesce(F.size("a"), F.lit(0)).alias("n_found"), both.alias("n_both"))


def canonical_json(*columns: str) -> Column:
    """JSON of columns with sorted names, nulls included: the same text for the same values."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def input_version(tables: dict[str, DataFrame], code_version: str, n: int = 10) -> DataFrame:
    """One row: a short version of all inputs and the code. Any change of any row of a table changes it.

    Row digests are summed in the tasks, so that no table's rows come together.
    """
    parts = None
    for name in sorted(tables):
        df = tables[name]
        row = F.sha2(canonical_json(*df.columns), 256)
        sums = [F.sum(F.conv(F.substring(row, 1 + 14 * k, 14), 16, 10).cast("decimal(38,0)")).cast("string") for k in range(4)]
        one = df.agg(F.concat_ws(":", F.lit(name), F.count(F.lit(1)).cast("string"), *sums).alias("x"))
        parts = one if parts is None else parts.unionByName(one)
    return parts.agg(F.substring(F.sha2(F.concat_ws("|", F.lit(code_version), F.array_join(F.array_sort(F.collect_list("x")), "|")), 256), 1, n).alias("version"))


def backfill_counts(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """column_name, changed, unresolved: how many values a backfill changed, and how many are still empty."""
    both = before.select(key, *[F.col(c).alias(f"__{c}") for c in columns]).join(after.select(key, *columns), key)
    parts = []
    for c in columns:
        parts.append(F.struct(F.lit(c).alias("column_name"), F.count_if(~F.col(c).eqNullSafe(F.col(f"__{c}"))).alias("changed"), F.count_if(_empty(F.col(c))).alias("unresolved")))
    return both.agg(F.array(*parts).alias("x")).select(F.explode("x").alias("x")).select("x.*")
