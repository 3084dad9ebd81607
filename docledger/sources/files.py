"""File sources and sinks: JSON lines, binary files with integrity, routed and versioned writes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
#: Stores whose paths pyarrow opens as Spark names them, and bytes read at once.
CHUNKED = ("file", "hdfs")
CHUNK = 4 << 20


class BadRows(ValueError):
    """Rows that don't parse or fail their constraint."""


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, valid: Column | None = None, strict: bool = True) -> DataFrame:
    """JSON lines with a fixed schema; blank lines are skipped.

    strict: any row that doesn't parse or fails `valid` is an error that names the first one. Otherwise such rows are
    left out (dead_rows() has them).
    """
    rows = _parsed(spark, path, schema)
    bad = F.col(CORRUPT).isNotNull()
    if valid is not None:
        bad = bad | ~F.coalesce(valid, F.lit(False))
    if strict:
        first = rows.filter(bad).limit(1).collect()
        if first:
            raise BadRows(f"{path}: {first[0].asDict()}")
    return rows.filter(~bad).drop(CORRUPT)


def dead_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lines that don't parse: the dead letters of a lenient read."""
    return _parsed(spark, path, schema).filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"))


def _parsed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r")).select("r.*")


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder of JSON files, one document each, with the name of its file."""
    rows = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return rows.select("*", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("stem"))


def write_json_documents(rows: DataFrame, path: str) -> None:
    """rows: stem and value (JSON text); the tasks write a file <stem>.json each into a folder of a store that pyarrow opens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = pa_fs.FileSystem.from_uri(path)
        store.create_dir(folder)
        for b in batches:
            for stem, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with store.open_output_stream(f"{folder}/{stem}.json") as out:
                    out.write(value.encode())
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    rows.select("stem", "value").mapInArrow(run, "n bigint").agg(F.sum("n")).collect()


def read_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)


def _package(content: Column) -> Column:
    """Kind of a zip package by the name of its first members: the local headers near its start hold them."""
    start = F.decode(F.substring(content, 1, 4096), "ISO-8859-1")
    return F.when(start.contains("mimetypeapplication/hwp+zip"), "hwpx").when(start.contains("[Content_Types].xml") | start.contains("xl/workbook.xml"), "ooxml").otherwise("zip")


def detected_format(content: Column) -> Column:
    """Format by signature and first members, whatever the name says. Four kilobytes of the content are enough."""
    head = F.hex(F.substring(content, 1, 8))
    return (
        F.when(head.startswith("25504446"), "pdf")
        .when(head.startswith("D0CF11E0A1B11AE1"), "ole")
        .when(head.startswith("504B0304"), _package(content))
        .when(head.startswith("50415231"), "parquet")
        .otherwise("unknown")
    )


def digests(spark: SparkSession, path: str, glob: str = "*", large: int = 64 << 20) -> DataFrame:
    """path, length, head (the first eight bytes) and digest of every file.

    Sizes come from the listing. Contents below `large` are Spark's; larger files are read in chunks by the task that has
    their row, from stores that pyarrow opens, so that no row holds a large content. In other stores Spark reads all.
    """
    files = read_binary(spark, path, glob)
    row = ["path", "length", F.substring("content", 1, 8).alias("head"), F.sha2("content", 256).alias("digest")]
    first = files.select("path").first()
    if first is None or first["path"].partition(":")[0] not in CHUNKED:
        return files.select(*row)
    listed = files.filter(F.col("length") >= large).select("path", "length")
    return files.filter(F.col("length") < large).select(*row).unionByName(listed.mapInArrow(_chunk_digests, "path string, length bigint, head binary, digest string"))


def _chunk_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        heads, found = [], []
        for path in b.column(0).to_pylist():
            store, at = pa_fs.FileSystem.from_uri(quote(re.sub("^file:/+", "file:///", path), safe="/:"))
            sha, head = hashlib.sha256(), b""
            with store.open_input_stream(at) as f:
                while chunk := f.read(CHUNK):
                    head = head or chunk[:8]
                    sha.update(chunk)
            heads.append(head)
            found.append(sha.hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(heads, pa.binary()), pa.array(found, pa.string())], ["path", "length", "head", "digest"])


def verified(files: DataFrame, manifest: DataFrame, name: str = "name") -> DataFrame:
    """Files (of read_binary or digests) whose size (where the manifest has one) and digest are those of the manifest."""
    digest = F.col("digest") if "digest" in files.columns else F.sha2("content", 256)
    joined = files.withColumn(name, F.element_at(F.split("path", "/"), -1)).join(manifest, name)
    return joined.filter((F.col("file_size").isNull() | (F.col("length") == F.col("file_size"))) & (digest == F.col("sha256")))


def write_routes(df: DataFrame, path: str, route: str = "route") -> None:
    """One folder per route."""
    df.write.partitionBy(route).parquet(path)


def split_dead(df: DataFrame, error: str = "_error") -> tuple[DataFrame, DataFrame]:
    """Good rows without the error column, and the failed ones."""
    return df.filter(F.col(error).isNull()).drop(error), df.filter(F.col(error).isNotNull())


class Published:
    """Versions of a dataset in one folder and a pointer to the current one, in any store that Spark writes.

    publish() writes a version, runs all checks on what was written, and only then appends the pointer; a version that
    fails is never current.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def pointers(self) -> DataFrame:
        schema = "version string, sequence bigint"
        try:
            return self.spark.read.schema(schema).json(f"{self.path}/pointers")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def current(self) -> str | None:
        last = self.pointers().orderBy(F.desc("sequence")).limit(1).collect()
        return last[0]["version"] if last else None

    def read(self, version: str | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/runs/{version or self.current()}")

    def publish(self, df: DataFrame, version: str, partition_by: list[str], checks: dict) -> None:
        """checks: name -> function(written DataFrame) -> DataFrame of violations, which must be empty."""
        self._publish(df, df.repartition(*partition_by).write.partitionBy(*partition_by), version, checks)

    def publish_sorted(self, df: DataFrame, version: str, order: list[Column], checks: dict) -> None:
        """As publish(), in files that hold ranges of an order, sorted."""
        self._publish(df, df.orderBy(*order).write, version, checks)

    def _publish(self, df: DataFrame, writer: DataFrameWriter, version: str, checks: dict) -> None:
        before = self.current()
        writer.parquet(f"{self.path}/runs/{version}")
        written = self.spark.read.schema(df.schema).parquet(f"{self.path}/runs/{version}")
        if before and written.isEmpty():
            raise BadRows("an empty version may not replace a published one")
        failed = [name for name, f in checks.items() if not f(written).isEmpty()]
        if failed:
            raise BadRows(f"version {version} fails {failed}")
        if self.current() != before:
            raise BadRows("another version was published meanwhile")
        n = self.pointers().agg(F.max("sequence")).first()[0]
        self.spark.createDataFrame([(version, (n or 0) + 1)], "version string, sequence bigint").coalesce(1).write.mode("append").json(f"{self.path}/pointers")

    def overwrite_touched(self, old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
        """A version's rows: those of untouched partitions as they were, touched ones from new."""
        touched = new.select(*keys).distinct()
        return old.join(touched, keys, "left_anti").unionByName(new)
