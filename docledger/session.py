"""Session defaults for local work and tests; a cluster brings its own settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session with AQE and UTC, as the tests and the bench use it."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docledger")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. The path goes to Spark unchanged, so any store that Spark reads will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

