"""Release operators: the contract of a public bundle, its statistics, and the audit of all its rows.

A bundle is three tables. institutions: institution_id, name, type, address, latitude, longitude, source_url. slots:
institution_id, day (date), meal, items, document_id, document_ids. sources: institution_id, year, month, document_id, post_id,
attachment_id, post_url, published_date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.display import MEALS
from ..functions.rules import secrets_in, token_category
from ..functions.text import bound
from .contract import any_leaf
from .layout import asof_anchor
from .publish import check, fingerprints, one_sided

# Names of fields and beginnings of values that no public row has.
PRIVATE_FIELDS = r"(?i)\"(?:local_path|traceback|hostname|developer_username)\"\s*:"
LOCAL_VALUE = r"^(?:[A-Za-z]:[\\/]|file://|\\\\|data/raw/|data/samples/)"
MONTH = ["institution_id", "year", "month"]


def http(url: Column) -> Column:
    return F.coalesce(url.rlike(r"^https?://[^\s/?#]+"), F.lit(False))


def months_of(slots: DataFrame) -> DataFrame:
    return slots.select("institution_id", F.year("day").alias("year"), F.month("day").alias("month")).distinct()


def bundle_stats(institutions: DataFrame, slots: DataFrame) -> DataFrame:
    """One row: institutions, those with data, documents, slots, month files, those with a point."""
    per = slots.agg(
        F.countDistinct("institution_id").alias("collected_institutions"),
        F.count(F.lit(1)).alias("total_meal_records"),
        F.countDistinct("institution_id", F.year("day"), F.month("day")).alias("institution_month_files"),
    )
    documents = slots.select(F.explode("document_ids").alias("d")).agg(F.countDistinct("d").alias("structured_documents"))
    all_of = institutions.agg(F.count(F.lit(1)).alias("total_institutions"), F.count_if(F.col("latitude").isNotNull()).alias("with_coordinates"))
    one = lambda df: df.withColumn("__one", F.lit(1))  # noqa: E731  three rows of one side each
    return one(all_of).join(one(per), "__one").join(one(documents), "__one").drop("__one")


def bundle_checks(institutions: DataFrame, slots: DataFrame, sources: DataFrame, availability: DataFrame, declared: dict[str, int]) -> DataFrame:
    """check_name, failures for each part of the contract; a bundle is good if all are 0. availability: institution_id, year, months."""
    lat, lon = F.col("latitude"), F.col("longitude")
    pair = lat.isNull() != lon.isNull()
    out_of = lat.isNotNull() & ~(lat.between(-90, 90) & lon.between(-180, 180))
    blank = F.lit(False)
    for c in ("institution_id", "name", "type", "address"):
        blank = blank | (F.coalesce(F.col(c), F.lit("")) == "")
    ids = institutions.groupBy("institution_id").count()
    bad_items = (F.coalesce(F.size("items"), F.lit(0)) < 1) | F.exists("items", lambda x: F.trim(F.coalesce(x, F.lit(""))) == "")
    linked = F.array_contains("document_ids", F.col("document_id")) & (F.size("document_ids") == F.size(F.array_distinct("document_ids")))
    used = slots.select("institution_id", F.year("day").alias("year"), F.month("day").alias("month"), F.explode("document_ids").alias("document_id"))
    sides = one_sided(used, sources, [*MONTH, "document_id"])
    listed = availability.select("institution_id", "year", F.explode("months").alias("month"))
    wrong_list = (F.size("months") < 1) | (F.col("months") != F.sort_array(F.array_distinct("months"))) | F.exists("months", lambda m: ~m.between(1, 12))
    named = F.col("document_id") != F.concat_ws("-", "post_id", "attachment_id")
    dated = F.try_to_date("published_date", "yyyy-MM-dd").isNull()
    stats = bundle_stats(institutions, slots)
    differs = F.lit(False)
    for name, value in declared.items():
        differs = differs | (F.col(name) != value)
    parts = [
        check(ids, "duplicate_institution", F.col("count") > 1),
        check(institutions, "institution_fields", blank),
        check(institutions, "coordinate_pair", pair),
        check(institutions, "coordinate_range", F.coalesce(out_of, F.lit(False))),
        check(institutions, "institution_url", ~http(F.col("source_url"))),
        check(slots.join(institutions.select("institution_id"), "institution_id", "left_anti"), "unknown_institution", F.lit(True)),
        check(slots, "meal_type", ~F.coalesce(F.col("meal").isin(*MEALS), F.lit(False))),
        check(slots, "menu_items", bad_items),
        check(slots, "document_links", ~F.coalesce(linked, F.lit(False))),
        check(sides, "unlinked_source", F.col("side") == "left"),
        check(sides, "unreferenced_source", F.col("side") == "right"),
        check(sources, "source_identity", F.coalesce(named, F.lit(True)) | dated | ~http(F.col("post_url"))),
        check(sources.groupBy(*MONTH, "document_id").count(), "duplicate_source", F.col("count") > 1),
        check(availability, "availability_list", F.coalesce(wrong_list, F.lit(True))),
        check(one_sided(listed, months_of(slots), MONTH), "availability_months", F.lit(True)),
        check(stats, "declared_stats", differs),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def release_audit(tables: dict[str, DataFrame], items: dict[str, str]) -> DataFrame:
    """finding, table_name, n over every row of every public table: secrets, private fields, local paths, artifacts among items.

    items: the item column of tables that have one. Rows are judged as the JSON text that would be published.
    """
    out = None
    for name, df in tables.items():
        text = F.to_json(F.struct(*df.columns))
        local = F.lit(False)
        for field in df.schema.fields:
            local = local | any_leaf(F.col(field.name), field.dataType, lambda x: x.rlike(LOCAL_VALUE))
        none = F.array().cast("array<string>")
        words = lambda t: F.concat(secrets_in(t), F.when(t.rlike(PRIVATE_FIELDS), F.array(F.lit("private_public_field"))).otherwise(none))
        found = [bound(text, words), F.when(local, F.array(F.lit("local_path")))]  # the JSON text is made once a row
        if name in items:
            found.append(F.transform(F.filter(items[name], lambda x: token_category(x).isNotNull()), lambda x: F.concat(F.lit("artifact_"), token_category(x))))
        rows = df.select(F.explode(F.concat(*[F.coalesce(x, none) for x in found])).alias("finding"))
        part = rows.groupBy("finding").agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def table_digests(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, digest: of all rows of each table, whatever their order."""
    out = None
    for name, df in tables.items():
        one = fingerprints(df, [], df.columns)
        part = one.select(F.lit(name).alias("table_name"), F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in one.columns]), 256).alias("digest"))
        out = part if out is None else out.unionByName(part)
    return out


def bundle_audit(bundle: dict[str, DataFrame], availability: DataFrame, declared: dict[str, int], digests: DataFrame, more: dict[str, DataFrame] | None = None) -> DataFrame:
    """finding, table_name, n: all that keeps a bundle from being released, in one table; empty for a good one.

    bundle: institutions, slots, sources. The contract's failed checks ('contract_...'), secrets, private fields, local paths and
    artifacts in any leaf of any row (`more`: further public tables), and tables whose rows aren't those of the digests
    that the build declared (table_name, digest): 'tree_digest', for missing and undeclared tables as well.
    """
    tables = bundle | {"availability": availability} | (more or {})
    checks = bundle_checks(bundle["institutions"], bundle["slots"], bundle["sources"], availability, declared).filter("failures > 0")
    contract = checks.select(F.concat(F.lit("contract_"), "check_name").alias("finding"), F.lit("bundle").alias("table_name"), F.col("failures").alias("n"))
    own = table_digests(tables).withColumnRenamed("digest", "own").join(digests, "table_name", "full_outer").filter("NOT (own <=> digest)")
    moved = own.select(F.lit("tree_digest").alias("finding"), "table_name", F.lit(1).cast("long").alias("n"))
    return contract.unionByName(release_audit(tables, {"slots": "items"})).unionByName(moved)


def consistent_builds(builds: DataFrame, pointers: DataFrame) -> DataFrame:
    """builds with seen_before, seen_after and consistent: the version that the pointer named when a build began and when it ended.

    builds: build, began, ended, report; pointers: at, version. A build saw one version if the pointer stood still and the report is
    of the version it names. Pointer moves and both ends of builds stand in one order, dealt out by ranges.
    """
    none = F.lit(None).cast("string")
    moves = pointers.select(F.col("at"), F.lit(0).alias("kind"), none.alias("build"), F.col("version"))
    ends = [builds.select(F.col(c).alias("at"), F.lit(n + 1).alias("kind"), F.col("build").cast("string").alias("build"), none.alias("version")) for n, c in enumerate(("began", "ended"))]
    seen = asof_anchor(moves.unionByName(ends[0]).unionByName(ends[1]), [], ["at", "kind", "build"], F.col("version"), "seen").filter("kind > 0")
    pairs = seen.groupBy("build").agg(F.max(F.when(F.col("kind") == 1, F.col("seen"))).alias("seen_before"), F.max(F.when(F.col("kind") == 2, F.col("seen"))).alias("seen_after"))
    joined = builds.join(pairs.withColumnRenamed("build", "__build"), F.col("build").cast("string") == F.col("__build"), "left").drop("__build")
    same = (F.col("seen_before") == F.col("seen_after")) & (F.col("report") == F.col("seen_after"))
    return joined.withColumn("consistent", F.coalesce(same, F.lit(False)))


def workbook_reasons(failures: Column, families: Column, known: tuple[str, ...], ready: Column, missing_dates: Column, missing_meals: Column, counts: dict[str, Column]) -> Column:
    """struct(route, reasons) of a parsed workbook: an unknown layout is for review as such; else what keeps it from being ready.

    counts: for each reason, how many values stand for it.
    """
    none = F.array().cast("array<string>")
    lost = F.array_contains(failures, "UNSUPPORTED_LAYOUT") | (F.size(F.array_except(families, F.array(*map(F.lit, known)))) > 0)
    tests = {"MISSING_DATE": (F.size(missing_dates) > 0) | F.array_contains(failures, "AMBIGUOUS_DATE"), "MISSING_MEAL": F.size(missing_meals) > 0} | {k: c > 0 for k, c in counts.items()}
    why = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(k)) for k, t in tests.items()]))
    reasons = F.when(lost, F.array(F.lit("NEW_LAYOUT"))).when(ready, none).when(F.size(why) > 0, why).otherwise(F.array(F.lit("VALIDATION_FAILED")))
    return F.struct(F.when(~lost & ready, "ready").otherwise("review").alias("route"), reasons.alias("reasons"))


def survey_totals(samples: DataFrame, surveyed: DataFrame, path: str = "path") -> DataFrame:
    """One row: sampled paths, files read, files that failed, files that are missing. surveyed: path, status. Paths count once."""
    once = samples.filter(F.coalesce(F.col(path), F.lit("")) != "").select(path).distinct()
    joined = once.join(surveyed.select(path, "status"), path, "left")
    good = F.col("status") == "ok"
    return joined.agg(
        F.count(F.lit(1)).alias("surveyed_files"),
        F.count_if(good).alias("successful_files"),
        F.count_if(F.col("status").isNotNull() & ~good).alias("failed_files"),
        F.count_if(F.col("status").isNull()).alias("missing_files"),
    )
