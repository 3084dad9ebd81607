"""Catalog operators: resolution, upsert, change classes, canonical copies, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__n", n).filter("__n = 1").drop("__n")


def later_wins(sources: list[DataFrame], key: list[str]) -> DataFrame:
    """Union by key; of equal keys the row of the later source stays."""
    out = None
    for k, df in enumerate(sources):
        df = df.withColumn("__source", F.lit(k))
        out = df if out is None else out.unionByName(df)
    return first_per(out, key, [F.desc("__source")]).drop("__source")


def ambiguous_aliases(aliases: DataFrame, key: str, value: str) -> DataFrame:
    """Alias keys that lead to more than one id; a resolver must have none."""
    return aliases.groupBy(key).agg(F.countDistinct(value).alias("n_ids")).filter("n_ids > 1")


def resolve(df: DataFrame, aliases: DataFrame, key: Column, alias_key: str = "alias", value: str = "id", out: str = "resolved") -> DataFrame:
    """Equi lookup on a normalised alias. The bridge is made unambiguous by the caller; AQE picks the join."""
    bridge = aliases.select(F.col(alias_key).alias("__alias"), F.col(value).alias(out))
    return df.withColumn("__key", key).join(bridge, F.col("__key") == F.col("__alias"), "left").drop("__key", "__alias")


def resolve_any(df: DataFrame, aliases: DataFrame, keys: Column, row_id: str, alias_key: str = "alias", value: str = "id", out: str = "resolved") -> DataFrame:
    """First of an array of keys, in order, that an alias resolves."""
    each = df.select(row_id, F.posexplode(keys).alias("__pos", "__key"))
    bridge = aliases.select(F.col(alias_key).alias("__key"), F.col(value).alias("__value"))
    hit = each.join(bridge, "__key").groupBy(row_id).agg(F.min_by("__value", "__pos").alias(out))
    return df.join(hit, row_id, "left")


def old_row_wins(new: DataFrame, old: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Columns of the old row where it exists, even where they are null there; else the new row's."""
    prior = old.select(*key, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__old"))
    joined = new.join(prior, key, "left")
    return joined.select(*[F.when(F.col("__old"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in new.columns])


def preserve(new: DataFrame, old: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Columns of the old row where they aren't null; else the new row's."""
    prior = old.select(*key, *[F.col(c).alias(f"__{c}") for c in columns])
    return new.join(prior, key, "left").select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in new.columns])


def upsert(base: DataFrame, incoming: DataFrame, key: list[str], keep_old: Column, columns: list[str]) -> DataFrame:
    """Merge by key. keep_old, over columns `old_*` and `new_*`, tells where a refreshed row keeps its old columns."""
    b = base.select(*key, *[F.col(c).alias(f"old_{c}") for c in columns], F.lit(True).alias("has_old"))
    n = incoming.select(*key, *[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("has_new"))
    joined = b.join(n, key, "full_outer")
    old = F.col("has_new").isNull() | (F.col("has_old").isNotNull() & F.coalesce(keep_old, F.lit(False)))
    return joined.select(*key, *[F.when(old, F.col(f"old_{c}")).otherwise(F.col(f"new_{c}")).alias(c) for c in columns])


def change_events(base: DataFrame, incoming: DataFrame, key: list[str], digest: str, failed: Column | None = None) -> DataFrame:
    """Keys whose digest changed: both known and different, and the incoming row didn't fail."""
    incoming = incoming.filter(~failed) if failed is not None else incoming
    b = base.select(*key, F.col(digest).alias("old_digest"))
    return b.join(incoming.select(*key, F.col(digest).alias("new_digest")), key).filter("old_digest <> new_digest")


def append_new(history: DataFrame, events: DataFrame, key: list[str]) -> DataFrame:
    """Events that history doesn't have yet, each once."""
    return events.dropDuplicates(key).join(history, key, "left_anti")


def change_class(incoming: DataFrame, base: DataFrame, document: str, post: str, digest: str) -> DataFrame:
    """incoming with change_type: NEW_POST, NEW_ATTACHMENT, UNCHANGED or ATTACHMENT_CHANGED."""
    known = base.select(F.col(document).alias("__document"), F.col(digest).alias("__digest"))
    posts = base.select(F.col(post).alias("__post")).distinct()
    joined = incoming.join(known, incoming[document] == F.col("__document"), "left").join(posts, incoming[post] == F.col("__post"), "left")
    kind = (
        F.when(F.col("__post").isNull(), "NEW_POST")
        .when(F.col("__digest").isNull(), "NEW_ATTACHMENT")
        .when(F.col("__digest") == F.col(digest), "UNCHANGED")
        .otherwise("ATTACHMENT_CHANGED")
    )
    return joined.withColumn("change_type", kind).drop("__document", "__digest", "__post")


def canonical_copy(df: DataFrame, digest: Column, good: Column, position: str, value: str) -> DataFrame:
    """df with canonical (the value of each digest's first good row, else first row) and duplicate.

    The choice is an aggregate with map-side partial results, joined back: a digest that many rows share doesn't pass
    through one task's sort.
    """
    rank = F.struct(F.when(good, 0).otherwise(1).alias("bad"), F.col(position).alias("position"))
    tagged = df.withColumn("__digest", digest).withColumn("__rank", rank)
    best = tagged.groupBy("__digest").agg(F.min_by(value, "__rank").alias("canonical"))
    return tagged.join(best, "__digest").withColumn("duplicate", F.col(value) != F.col("canonical")).drop("__digest", "__rank")


def newest_and_oldest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key with the newest and oldest row's id, the last of `order` being the id."""
    rank = F.struct(*order)
    return df.groupBy(key).agg(F.max_by(order[-1], rank).alias("newest"), F.min_by(order[-1], rank).alias("oldest"))


def cover_values(df: DataFrame, stages: list[tuple[str, Column]], row_id: str, position: str, limit: int) -> DataFrame:
    """Greedy sample in stages: the first row of each value that rows taken so far don't show, with the reason.

    A stage's rows are chosen at once, as taking one of them covers its own value only. The limit is applied last, in
    stage order.
    """
    taken = None
    for k, (reason, value) in enumerate(stages):
        rows = df.withColumn("__value", value).filter(F.col("__value").isNotNull())
        if taken is not None:
            seen = rows.join(taken, row_id, "left_semi").select("__value").distinct()
            rows = rows.join(seen, "__value", "left_anti").join(taken, row_id, "left_anti")
        new = rows.groupBy("__value").agg(F.min_by(row_id, position).alias(row_id), F.min(position).alias("position"))
        new = new.select(row_id, F.lit(reason).alias("reason"), F.lit(k).alias("stage"), "position")
        taken = new if taken is None else taken.unionByName(new)
    return taken.orderBy("stage", "position", row_id).limit(limit)


def refresh(df: DataFrame, existing: Column, position: str, n: int) -> DataFrame:
    """All new rows, and the n first existing ones: new rows don't use the budget."""
    old = df.filter(existing).orderBy(position).limit(n)
    return df.filter(~existing).unionByName(old)


def merge_attachments(old: DataFrame, new: DataFrame, refreshed: DataFrame, key: list[str]) -> DataFrame:
    """Attachments after a refresh of posts. Both sides: key, sha256, status and more; refreshed: keys of posts that came again.

    The old row stays if its refresh failed, or if that found the same content and calls it a duplicate of what is there;
    else the new row counts. Old rows of refreshed posts that came without them are dropped, all others stay.
    """
    names = [c for c in old.columns if c not in key]
    a, b = (df.select(*key, F.struct(*names).alias(side)) for df, side in ((old, "a"), (new, "b")))
    gone = refreshed.select(*key).distinct().withColumn("__came", F.lit(True))
    both = a.join(b, key, "full_outer").join(gone, key, "left")
    had = F.col("a.sha256").isNotNull()
    failed = had & (F.col("b.status") == "failed")
    again = had & (F.col("a.sha256") == F.col("b.sha256")) & (F.col("a.status") == "downloaded") & (F.col("b.status") == "duplicate")
    keep = F.col("b").isNull() | F.coalesce(F.col("a").isNotNull() & (failed | again), F.lit(False))
    out = both.filter(F.col("b").isNotNull() | F.col("__came").isNull()).withColumn("x", F.when(keep, F.col("a")).otherwise(F.col("b")))
    return out.select(*key, "x.*")


def unprocessed(df: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Rows that were not processed with this content yet."""
    return df.join(done.select(*key).distinct(), key, "left_anti")


def verified_rows(df: DataFrame, digest: str, stored: str) -> DataFrame:
    """Rows whose stored content has the digest that they claim."""
    return df.filter(F.coalesce(F.col(digest) == F.col(stored), F.lit(False)))
