"""Keyed state: bucketed tables merged batch by batch, and a review queue as a state machine."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType

from ..shared import new_path, remove

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class BucketedTable:
    """A keyed table in the shared folder, copied on write by hash buckets.

    Rows stand in the bucket of their keys' hash, in a folder of the version that wrote it. A version is a manifest: one row a
    bucket with the version whose files hold it. Version k + 1 is made from version k and batch k: only buckets that
    the batch's keys fall into are read and written again, the manifest takes the others over. The manifest is written last, so a
    version is complete before it can be read, and a batch that runs again makes the same version again. Folders that versions k
    and k + 1 don't name any more are removed then: no batch can ask for them.

    Only the manifest (one row a bucket) comes to the driver.
    """

    def __init__(self, spark: SparkSession, name: str, schema, keys: list[str], buckets: int = 32):
        self.spark, self.keys, self.buckets, self.path = spark, keys, buckets, new_path(spark, name)
        self.schema = spark.createDataFrame([], schema).schema
        self.last = 0
        self._store(0, {})

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def manifest(self, version: int) -> dict[int, int]:
        """The version that wrote each bucket."""
        rows = self.spark.read.schema("bucket int, version int").parquet(f"{self.path}/manifest/{version}").collect()
        return {r["bucket"]: r["version"] for r in rows}

    def _store(self, version: int, held: dict[int, int]) -> None:
        self.spark.createDataFrame(sorted(held.items()), "bucket int, version int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{version}")

    def _read(self, held: dict[int, int]) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{v}/bucket={b}" for b, v in sorted(held.items())])

    def at(self, version: int) -> DataFrame:
        return self._read(self.manifest(version))

    def near(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The rows of the buckets that some keys fall into."""
        held = self.manifest(self.last if version is None else version)
        wanted = {r[0] for r in keys.select(self.bucket().alias("bucket")).distinct().collect()}
        return self._read({b: v for b, v in held.items() if b in wanted})

    def merge(self, batch: DataFrame, k: int, f: Callable[[DataFrame, DataFrame], DataFrame]) -> set[int]:
        """Version k + 1 = f(version k, batch); f gets the touched buckets' rows and may return rows of their keys only. The touched buckets."""
        held = self.manifest(k)
        hit = {r[0] for r in batch.select(self.bucket().alias("bucket")).distinct().collect()}
        now = f(self._read({b: v for b, v in held.items() if b in hit}), batch).select(*self.schema.names)
        folder = f"{self.path}/data/{k + 1}"
        now.withColumn("bucket", self.bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        full = {r[0] for r in self.spark.read.schema(StructType([*self.schema.fields, StructField("bucket", IntegerType())])).parquet(folder).select("bucket").distinct().collect()}
        if full - hit:
            raise ValueError("a merge gave rows of keys that its batch didn't have")
        after = {b: v for b, v in held.items() if b not in hit} | dict.fromkeys(full, k + 1)
        self._store(k + 1, after)
        self.last = k + 1
        if k:
            before = self.manifest(k - 1) if self._there(f"{self.path}/manifest/{k - 1}") else {}
            for b, v in before.items():
                if held.get(b) != v:
                    remove(self.spark, f"{self.path}/data/{v}/bucket={b}")
            remove(self.spark, f"{self.path}/manifest/{k - 1}")
        return hit

    def _there(self, folder: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def observed_once(observations: DataFrame, at: str, columns: list[str], keep: str) -> DataFrame:
    """The first observation of each value; a value leaves the state when the stream's time is `keep` past it, and counts anew then."""
    return observations.withWatermark(at, keep).dropDuplicatesWithinWatermark(columns)


# An action on a review item is a function of the item's status, and so is a run of actions. As a row: what each status
# becomes (end_*), when an action last had an effect on an item that had this status (last_*), the first 'add' and their number.
STATUSES = ("NONE", "OPEN", "RESOLVED", "IGNORED")
STEP = "struct<" + ", ".join(f"end_{s}: string, last_{s}: timestamp" for s in STATUSES) + ", first: timestamp, n: bigint>"


def action_step(action: Column, ts: Column) -> Column:
    """One action as a function of the status."""
    add, resolve, ignore = (action == a for a in ("add", "resolve", "ignore"))
    ends = {
        "NONE": F.when(add, "OPEN").otherwise("NONE"),
        "OPEN": F.when(resolve, "RESOLVED").when(ignore, "IGNORED").otherwise("OPEN"),
        "RESOLVED": F.when(add, "OPEN").when(ignore, "IGNORED").otherwise("RESOLVED"),
        "IGNORED": F.lit("IGNORED"),
    }
    seen = {s: F.when(add | resolve if s == "OPEN" else add, ts) for s in STATUSES}
    fields = [x for s in STATUSES for x in (ends[s].alias(f"end_{s}"), seen[s].alias(f"last_{s}"))]
    return F.struct(*fields, F.when(add, ts).alias("first"), F.when(add, 1).otherwise(0).cast("bigint").alias("n"))


def composed(f: Column, g: Column) -> Column:
    """The function that applies f, then g. Composition is associative, so runs may be composed in any grouping that keeps their order."""
    fields = []
    for s in STATUSES:
        end, last = g["end_NONE"], g["last_NONE"]
        for t in STATUSES[1:]:
            end, last = F.when(f[f"end_{s}"] == t, g[f"end_{t}"]).otherwise(end), F.when(f[f"end_{s}"] == t, g[f"last_{t}"]).otherwise(last)
        fields += [end.alias(f"end_{s}"), F.coalesce(last, f[f"last_{s}"]).alias(f"last_{s}")]
    return F.struct(*fields, F.coalesce(f["first"], g["first"]).alias("first"), (f["n"] + g["n"]).alias("n"))


def action_runs(actions: DataFrame, key: str, at: str, tie: str, slices: list[int]) -> DataFrame:
    """One function a key: its actions in order of `at` and `tie`, composed by time slice, then by slices of slices.

    slices: lengths in seconds, from short to long. No task holds more of a key than a slice's actions, then a longer slice's
    shorter ones; the last list has one entry for each of the longest slices.
    """
    place = F.struct(F.col(at).alias("at"), F.col(tie).alias("tie"))
    now = actions.select(key, F.col(at).alias("at"), place.alias("place"), action_step(F.col("action"), F.col(at)).cast(STEP).alias("step"))
    for length in [*slices, None]:
        part = F.lit(0).cast("bigint") if length is None else F.floor(F.unix_timestamp("at") / length)
        listed = now.groupBy(key, part.alias("__slice")).agg(F.sort_array(F.collect_list(F.struct("place", "at", "step"))).alias("x"))
        whole = F.aggregate(F.slice("x", 2, F.size("x")), F.col("x")[0]["step"], lambda f, x: composed(f, x["step"]).cast(STEP))
        now = listed.select(key, F.col("x")[0]["at"].alias("at"), F.col("x")[0]["place"].alias("place"), whole.alias("step"))
    return now.select(key, "step")


class ReviewItems(StatefulProcessor):
    """An item's state: status, first_seen, last_seen, n_seen. A row's function leads from one state to the next."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.item = handle.getValueState("item", "status string, first timestamp, last timestamp, n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        status, first, last, n = self.item.get() if self.item.exists() else ("NONE", None, None, 0)
        for frame in rows:
            for step in frame.sort_values("batch").to_dict("records"):
                first = step["first"] if first is None and not pd.isna(step["first"]) else first
                seen = step[f"last_{status}"]
                last, status, n = seen if not pd.isna(seen) else last, step[f"end_{status}"], n + step["n"]
        if status != "NONE":
            self.item.update((status, first, last, n))
            yield pd.DataFrame({"key": [key[0]], "status": [status], "first_seen": [first], "last_seen": [last], "n_seen": [n]})

    def close(self) -> None:
        pass


def review_items(steps: DataFrame) -> DataFrame:
    """Stream of key, status, first_seen, last_seen, n_seen from a stream of key, batch and functions (the fields of STEP), one row a key and batch.

    The session's state store has to be RocksDB (STORE, ROCKS).
    """
    out = f"key {steps.schema['key'].dataType.simpleString()}, status string, first_seen timestamp, last_seen timestamp, n_seen bigint"
    return steps.groupBy("key").transformWithStateInPandas(statefulProcessor=ReviewItems(), outputStructType=out, outputMode="Update", timeMode="None")
