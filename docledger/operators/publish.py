"""Publication operators: conflicts, merging, fingerprints, reconciliation, versioned writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import cut
from ..streaming.state import BucketedTable


def variants(df: DataFrame, slot: list[str], content: list[str], document: str) -> DataFrame:
    """One row per slot and content: its documents' number, primary (smallest) and rows."""
    return df.groupBy(*slot, *content).agg(F.min(document).alias("primary"), F.countDistinct(document).alias("n_documents"), F.count(F.lit(1)).alias("n_rows"))


def conflicts(df: DataFrame, slot: list[str], content: list[str], document: str) -> DataFrame:
    """Slots with more than one content: number of variants, of rows beyond them, first and last document.

    Two levels of aggregation, both combined before the shuffle.
    """
    return (
        variants(df, slot, content, document)
        .groupBy(*slot)
        .agg(F.count(F.lit(1)).alias("n_variants"), F.sum("n_rows").alias("n_rows"), F.min("primary").alias("first_document"), F.max("primary").alias("last_primary"))
        .filter("n_variants > 1")
        .withColumn("duplicates", F.col("n_rows") - F.col("n_variants"))
    )


def conflicting_documents(df: DataFrame, slot: list[str], content: list[str], document: str) -> DataFrame:
    """Documents that touch a conflicting slot."""
    bad = conflicts(df, slot, content, document).select(*slot)
    return df.join(bad, slot, "left_semi").select(document).distinct()


def merge_documents(df: DataFrame, slot: list[str], content: list[str], document: str) -> DataFrame:
    """One row per slot and content: the lowest document is primary, all documents are kept, sorted."""
    return df.groupBy(*slot, *content).agg(F.min(document).alias("primary"), F.sort_array(F.collect_set(document)).alias("documents"))


def merge_to_fixpoint(base: DataFrame, incoming: DataFrame, slot: list[str], content: list[str], document: str, cut, most: int = 1000, buckets: int = 32) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected incoming documents (one column each).

    Incoming documents replace those of the same id. Incoming ones in a conflict are rejected, which restores their
    base version, which may conflict anew; base documents are never rejected.

    Only the first round looks at all slots. From then on each accepted document's slots have one content each, and a conflict
    can come from a restored base version only. So a round goes from the documents rejected last to the slots of their base versions
    (`restorable`, bucketed by document), and from these to the incoming documents there with another content
    (`challenged`, bucketed by slot): it reads the buckets of the last rejections, not the tables. Many versions of a hot slot
    meet as its smallest and largest content. `cut` writes a small table of ids per round and reads it back.
    """
    spark = base.sparkSession
    everyone = cut(incoming.select(document).distinct())
    now = base.join(everyone, document, "left_anti").unionByName(incoming)
    last = cut(conflicting_documents(now, slot, content, document).join(everyone, document, "left_semi"))
    rejected, parts = last, [everyone, last]
    value = F.struct(*content).alias("content")
    old = base.join(everyone, document, "left_semi").select(document, *slot, value).distinct()
    restorable = BucketedTable(spark, "restorable", old.schema, [document], buckets)
    restorable.merge(old, 0, lambda _, rows: rows)
    new = incoming.join(old.select(*slot).distinct(), slot, "left_semi").select(document, *slot, value).distinct()
    challenged = BucketedTable(spark, "challenged", new.schema, slot, buckets)
    challenged.merge(new, 0, lambda _, rows: rows)
    for _ in range(most):
        if last.isEmpty():
            return everyone.join(rejected, document, "left_anti"), rejected
        back = restorable.near(last).join(last, document, "left_semi")
        edges = cut(back.groupBy(*slot).agg(F.min("content").alias("low"), F.max("content").alias("high")))
        hit = challenged.near(edges).join(edges, slot).filter("content <> low OR content <> high").select(document).distinct()
        last = cut(hit.join(rejected, document, "left_anti"))
        rejected = cut(rejected.unionByName(last))
        parts += [last, rejected]
    raise RuntimeError("the merge did not settle")


def touched(base: DataFrame, accepted: DataFrame, document: str, keys: list[str]) -> DataFrame:
    """Partitions of accepted documents and of the versions that they replace."""
    old = base.join(accepted.select(document).distinct(), document, "left_semi")
    return accepted.select(*keys).unionByName(old.select(*keys)).distinct()


def fingerprints(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per partition a digest of its rows that doesn't depend on their order, and their number.

    Row digests are summed as numbers in map-side partial aggregates; no partition's rows are collected.
    """
    row = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    part = lambda k: F.conv(F.substring("__row", 1 + 14 * k, 14), 16, 10).cast("decimal(38,0)")
    rows = df.select(*keys, row.alias("__row"))  # made once, read by four sums
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(part(k)).alias(f"digest_{k}") for k in range(4)])


def digest_tree(df: DataFrame, keys: list[str], row_id: str, digest: str, fanout: int = 1000) -> DataFrame:
    """keys, level, node, digest, n: a Merkle tree over rows in order of their ids, with as many levels as the ids ask for.

    A node of level 0 covers `fanout` ids, one of level k + 1 `fanout` nodes of level k, so no list is longer than the fan-out (rows that
    repeat an id count as one entry, if they have one digest). All keys' trees have the height of the highest; it has two levels at least.
    """
    line = F.concat_ws(":", row_id, digest)
    rows = df.filter(F.col(row_id).isNotNull()).select(*keys, F.floor(F.col(row_id) / fanout).alias("node"), F.struct(F.col(row_id).alias("i"), line.alias("x")).alias("s"))
    level = cut(_joined_digests(rows.groupBy(*keys, "node", "s").agg(F.count(F.lit(1)).alias("n")), keys), "digests")
    out, height = level.select(*keys, F.lit(0).alias("level"), "node", "digest", "n"), 0
    while height < 1 or level.select("node").distinct().limit(2).count() > 1:
        height += 1
        entry = F.struct(F.col("node").alias("i"), F.concat_ws(":", "node", "digest").alias("x")).alias("s")
        level = cut(_joined_digests(level.select(*keys, F.floor(F.col("node") / fanout).alias("node"), entry, "n"), keys), "digests")
        out = out.unionByName(level.select(*keys, F.lit(height).alias("level"), "node", "digest", "n"))
    return out


def _joined_digests(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys, "node").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("s"))["x"], ","), 256).alias("digest"), F.sum("n").alias("n"))


def ordered_versions(df: DataFrame, keys: list[str], row_id: str, digest: str, fanout: int = 1000, n: int = 24) -> DataFrame:
    """version, keys, n: the root of each key's digest tree."""
    tree = digest_tree(df, keys, row_id, digest, fanout)
    top = tree.agg(F.max("level")).first()[0]
    return tree.filter(F.col("level") == F.lit(top)).select(F.substring("digest", 1, n).alias("version"), *keys, "n")


def tree_difference(old: DataFrame, new: DataFrame, before: DataFrame, after: DataFrame, keys: list[str], row_id: str, digest: str, fanout: int = 1000) -> DataFrame:
    """keys, row_id, state (added, dropped, changed) of rows that differ between two versions (before, after) with digest trees old and new.

    Walks down from the roots: a level compares the children of nodes that differ, and only rows under leaves that differ are read
    side by side. Where the trees' heights differ, the walk starts at the lower one's top.
    """
    tops = [t.agg(F.max("level")).first()[0] for t in (old, new)]
    if None in tops:
        level, open_nodes = None, None
    else:
        level, open_nodes = min(tops), None
    while level is not None and level >= 0:
        sides = []
        for name, tree in (("a", old), ("b", new)):
            at = tree.filter(F.col("level") == F.lit(level)).select(*keys, "node", F.col("digest").alias(name))
            sides.append(at if open_nodes is None else at.withColumn("up", F.floor(F.col("node") / fanout)).join(open_nodes, [*keys, "up"], "left_semi").drop("up"))
        differ = sides[0].join(sides[1], [*keys, "node"], "full_outer").filter("NOT (a <=> b)").select(*keys, F.col("node").alias("up"))
        open_nodes, level = cut(differ, "differing"), level - 1
    under = lambda df, name: _under(df, open_nodes, keys, row_id, fanout).select(*keys, row_id, F.col(digest).alias(name)).distinct()
    both = under(before, "a").join(under(after, "b"), [*keys, row_id], "full_outer")
    state = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "dropped").when(F.col("a") != F.col("b"), "changed")
    return both.select(*keys, row_id, state.alias("state")).filter("state IS NOT NULL")


def _under(df: DataFrame, leaves: DataFrame | None, keys: list[str], row_id: str, fanout: int) -> DataFrame:
    df = df.filter(F.col(row_id).isNotNull())
    if leaves is None:
        return df
    return df.withColumn("up", F.floor(F.col(row_id) / fanout)).join(leaves, [*keys, "up"], "left_semi")


def months_changed(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """keys, state of each partition after a delivery: added, updated (the content of `columns` differs), same."""
    a, b = fingerprints(after, keys, columns), fingerprints(before, keys, columns)
    names = [c for c in a.columns if c not in keys]
    both = a.select(*keys, F.struct(*names).alias("a")).join(b.select(*keys, F.struct(*names).alias("b")), keys, "left")
    return both.select(*keys, F.when(F.col("b").isNull(), "added").when(F.col("a") == F.col("b"), "same").otherwise("updated").alias("state"))


def changed_partitions(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Partitions that were added, dropped or whose content differs."""
    a, b = fingerprints(old, keys, columns), fingerprints(new, keys, columns)
    names = [c for c in a.columns if c not in keys]
    joined = a.select(*keys, F.struct(*names).alias("a")).join(b.select(*keys, F.struct(*names).alias("b")), keys, "full_outer")
    state = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "dropped").when(F.col("a") != F.col("b"), "changed")
    return joined.select(*keys, state.alias("state")).filter("state IS NOT NULL")


def one_sided(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Keys that only one side has: empty for equal sets."""
    x = a.select(*key, F.lit(1).alias("__a")).distinct()
    y = b.select(*key, F.lit(1).alias("__b")).distinct()
    return x.join(y, key, "full_outer").filter("__a IS NULL OR __b IS NULL").select(*key, F.when(F.col("__b").isNull(), "left").otherwise("right").alias("side"))


def state_difference(a: DataFrame, b: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Rows in which two states differ, apart from volatile columns; side tells where a row stands."""
    columns = [c for c in a.columns if c not in ignore]
    x, y = a.select(*columns), b.select(*columns)
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))


def check(df: DataFrame, name: str, bad: Column) -> DataFrame:
    """One row: the name of a check and how many rows fail it."""
    return df.agg(F.count(F.when(F.coalesce(bad, F.lit(False)), 1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures")


def reconcile_dataset(manifest: DataFrame, routes: DataFrame, public: DataFrame, key: str, report: dict[str, int]) -> DataFrame:
    """check_name, failures: ids are unique, each has one route, ready ones are public and only those, the report counts as many."""
    per = routes.groupBy(key).agg(F.countDistinct("route").alias("n"))
    ready = routes.filter("route = 'ready'").select(key).distinct()
    once = per.filter("n = 1")
    sides = one_sided(ready.join(once.select(key), key, "left_semi"), public.join(once.select(key), key, "left_semi"), [key])
    counts = routes.groupBy("route").agg(F.countDistinct(key).alias("n"))
    wrong = F.lit(False)
    for route, n in report.items():
        wrong = wrong | ((F.col("route") == route) & (F.col("n") != n))
    parts = [
        check(manifest.groupBy(key).count(), "duplicate_id", F.col("count") > 1),
        check(per, "routed_twice", F.col("n") > 1),
        check(manifest.join(per, key, "left_anti"), "not_routed", F.lit(True)),
        check(sides, "ready_not_public", F.col("side") == "left"),
        check(sides, "public_not_ready", F.col("side") == "right"),
        check(counts, "report_count", wrong),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
