"""Exact dedup by a log-structured merge index of digests, in DataFrame operations only.

A scan task is the memtable: it flushes its rows as part of a run, sorted by digest. Each flush is a run of level 0.
Compaction merges the runs of level 0 and the run of level 1, if there is one, into a new run of level 1, cut by a hash of the
digest and sorted: for each digest it keeps the smallest and the largest identifier and the number of rows, combined inside
each run before anything is shuffled, so a text that a third of all rows share sends one row per task.

A filter is a bit set of digest hashes of fixed size (2 ** FILTER_BITS bits, 2 MiB), so that it may be broadcast whatever
the size of the index. It is consulted before a run is read: digests that aren't in it are new, and neither their rows nor their
texts are shuffled. Where an index holds more digests than an eighth of the bits, more rows pass it than need to; results stay the same.

Rows that share a digest (hits) are read again and their bytes verified: the smallest and the largest text of a digest
must be equal. They too are combined in the tasks first. Texts that only share the digest are told apart by grouping on the text itself.

Defined results: a null text counts as the empty text. Rows with a null id take part; the null id is the smallest.
Of repeated rows (same id, same text) one stays. Extra columns are ignored by the operator. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, new_path, release

FILTER_BITS = 24


class DigestIndex:
    """Runs in one folder of the shared store. add() flushes runs, compact() merges them, lookup() finds hits.

    fanout: so many runs of level 0 are merged at once by add().
    """

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = 8):
        self.spark, self.path, self.fanout = spark, path or new_path(spark, "digest-index"), fanout
        self.level0: list[str] = []
        self.level1: DataFrame | None = None
        self.flushed = 0

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Flushes docs as a run; its rows (digest, id)."""
        run = f"{self.path}/level0-{self.flushed}"
        entries(docs, id_col, text_col).sortWithinPartitions("digest").write.parquet(run)
        self.level0.append(run)
        self.flushed += 1
        if len(self.level0) >= self.fanout:
            self.compact()
        return self.spark.read.parquet(run)

    def compact(self) -> DataFrame:
        """The run of level 1: one row per digest with smallest and largest id and rows."""
        if self.level0:
            merged = self.spark.read.parquet(*self.level0).groupBy("digest").agg(F.min("id").alias("min_id"), F.max("id").alias("max_id"), F.count(F.lit(1)).alias("n"))
            if self.level1 is not None:
                both = merged.unionByName(self.level1)
                merged = both.groupBy("digest").agg(F.min("min_id").alias("min_id"), F.max("max_id").alias("max_id"), F.sum("n").alias("n"))
            before, self.level1 = self.level1, cut(merged.sortWithinPartitions("digest"), "digest-level1")
            self.level0 = []
            if before is not None:
                release(before)
        return self.level1

    def lookup(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Rows of docs whose digest is in the index already, with the smallest id that it holds there."""
        run = self.compact()
        return passing(entries(docs, id_col, text_col), filter_of(run)).join(run, "digest")


def _slot() -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(1 << FILTER_BITS)) + 1


def filter_of(run: DataFrame) -> DataFrame:
    """The bit set of a run's digests: at most 2 ** (FILTER_BITS - 15) rows of bucket and bits (4 KiB)."""
    return run.groupBy(F.bitmap_bucket_number(_slot()).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(_slot())).alias("bits"))


def marked(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """rows with the column __hit: whether the filter has their digest (if not, no run has it)."""
    at = F.bitmap_bit_position(_slot())
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0, F.lit(False))
    held = rows.withColumn("__bucket", F.bitmap_bucket_number(_slot())).join(F.broadcast(bits.withColumnRenamed("bucket", "__bucket")), "__bucket", "left")
    return held.withColumn("__hit", hit).drop("__bucket", "bits")


def passing(rows: DataFrame, bits: DataFrame) -> DataFrame:
    return marked(rows, bits).filter("__hit").drop("__hit")


def entries(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.unhex(F.sha2(body(F.col(text_col)), 256)).alias("digest"), F.col(id_col).alias("id"))


def body(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", index: DigestIndex | None = None) -> DataFrame:
    """One row per row of docs: id, keep_id (largest id of the equal texts), group_size, kept, digest (32 bytes).

    With an index that holds earlier rows, groups and ids to keep are those of all rows so far.
    """
    found = _groups(docs, id_col, text_col, index)
    return found.select(
        "id",
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id"))).alias("stays"),
        "digest",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).select("id", "keep_id", "group_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"), "digest")


def _groups(docs: DataFrame, id_col: str, text_col: str, index: DigestIndex | None = None) -> DataFrame:
    """digest, id, copies (equal rows), keep_id, group_size, verified byte by byte."""
    index = index or DigestIndex(docs.sparkSession)
    rows = index.add(docs, id_col, text_col)
    hits = cut(index.compact().filter("n > 1").select("digest", F.col("max_id").alias("keep_id"), F.col("n").alias("group_size")), "digest-hits")
    flagged = marked(rows, filter_of(hits))
    new = flagged.filter("NOT __hit").select("digest", "id", F.lit(1).cast("long").alias("copies"), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    # Equal ids with equal texts first become one row with a count, so that a repeated row can't be kept twice.
    old = flagged.filter("__hit").groupBy("digest", "id").agg(F.count(F.lit(1)).alias("copies")).join(hits, "digest", "left")
    one = F.col("group_size").isNull()
    old = old.select("digest", "id", "copies", F.when(one, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"))
    found = cut(old.unionByName(new), "digest-groups")
    differ = cut(_differing(docs, found, id_col, text_col), "digest-differing")
    return found if differ.isEmpty() else _regrouped(docs, found, differ, id_col, text_col)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), body(F.col(text_col)).alias("own")).withColumn("digest", F.unhex(F.sha2("own", 256)))


def _differing(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Digests under which texts differ. Only texts that pass the filter of the hits are compared."""
    hits = found.filter("group_size > 1").select("digest")
    own = passing(_texts(docs, id_col, text_col).select("digest", "own"), filter_of(hits))
    return own.groupBy("digest").agg(F.min("own").alias("a"), F.max("own").alias("b")).filter("a <> b").select("digest")


def _regrouped(docs: DataFrame, found: DataFrame, differ: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """found, with the digests in differ grouped by the texts themselves."""
    own = _texts(docs, id_col, text_col).join(differ, "digest", "left_semi")
    rows = own.groupBy("digest", "own", "id").agg(F.count(F.lit(1)).alias("copies"))
    groups = rows.groupBy("digest", "own").agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    again = rows.join(groups, ["digest", "own"]).select(*found.columns)
    return found.join(differ, "digest", "left_anti").select(*found.columns).unionByName(again)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns. Only rows that pass the filter of the hits are shuffled."""
    found = _groups(docs, id_col, text_col)
    hits = found.filter("group_size > 1")
    bits = cut(filter_of(hits.select("digest")), "digest-filter")
    own = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("__row"), F.col(id_col).alias("__id"), F.unhex(F.sha2(body(F.col(text_col)), 256)).alias("digest"))
    rows = marked(own, bits)
    # what passes the filter by chance has no group; of repeated rows the first stays
    groups = hits.select("digest", F.col("id").alias("__id"), F.col("id").eqNullSafe(F.col("keep_id")).alias("__kept"))
    one = rows.filter("__hit").groupBy("digest", "__id").agg(F.first("__row").alias("__row"), F.count(F.lit(1)).alias("__n"))
    same = (one["digest"] == groups["digest"]) & one["__id"].eqNullSafe(groups["__id"])
    stay = one.join(groups, same, "left").filter(F.coalesce("__kept", F.lit(True)))
    return rows.filter("NOT __hit").select("__row.*").unionByName(stay.select("__row.*"))
