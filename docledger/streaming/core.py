"""Running streams to completion: micro-batches over files, state in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..shared import new_path


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables as a stream of its files."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # a table is a file or a folder of files
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{path}*")


def run(stream: DataFrame, each: Callable[[DataFrame, int], None], mode: str = "append", name: str = "stream", log: str | None = None) -> None:
    """each(batch, id) for every micro-batch until the input is used up. Batches may come again after a failure, with their id.

    log: the checkpoint of a stream that goes on from an earlier run.
    """
    query = stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", log or new_path(stream.sparkSession, f"{name}-log")).trigger(availableNow=True).start()
    query.awaitTermination()


def run_deliveries(spark: SparkSession, deliveries: list[DataFrame], each: Callable[[DataFrame, int], None], name: str) -> None:
    """each(batch, k) for the given DataFrames one after the other, delivery k as one micro-batch.

    A delivery is a folder of as many files as it has partitions; the stream goes on from its checkpoint when one has come.
    """
    path, log = new_path(spark, name), new_path(spark, f"{name}-log")
    for k, df in enumerate(deliveries):
        df.write.parquet(f"{path}/{k:04d}")
        run(spark.readStream.schema(deliveries[0].schema).parquet(f"{path}/*"), each, log=log)


def collect_append(stream: DataFrame, name: str) -> DataFrame:
    """All rows that a stream appends, as a written table."""
    path = new_path(stream.sparkSession, name)
    run(stream, lambda df, k: df.write.mode("overwrite").parquet(f"{path}/batch={k}"), "append", name)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/*")


def collect_complete(stream: DataFrame, name: str) -> DataFrame:
    """The last state of an aggregate in complete mode, as a written table."""
    path, last = new_path(stream.sparkSession, name), []

    def each(df: DataFrame, k: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={k}")
        last.append(k)

    run(stream, each, "complete", name)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/batch={last[-1]}")
