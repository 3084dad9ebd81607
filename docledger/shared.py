"""Written intermediate tables: the lineage ends there, and lost executors repeat little."""

from __future__ import annotations

import gc
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-docledger-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one where it is unset and the session is local."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = _local_folder()
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/docledger/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back; release() removes it.

    Spark removes shuffle files when the driver collects the plan that made them. The plan that was just written isn't
    needed any more, so the driver is asked to collect now, which keeps the disks of a long job from filling up.
    """
    spark, schema = df.sparkSession, df.schema
    path = new_path(spark, name)
    df.write.parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(schema).parquet(path)
    out.cut_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Removes tables that cut() wrote and that no plan reads any more."""
    for t in tables:
        remove(t.sparkSession, t.cut_path)


def remove(spark: SparkSession, folder: str) -> None:
    """Removes a folder of the shared store, if it is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
