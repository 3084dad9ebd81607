"""Handlers per format, with failures isolated per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.state import BucketedTable

Outcome = tuple[str, list[str]]


class IncrementalRun:
    """One run over a delivery, put together from callables: what collects sources, what handles them, what judges the outcomes.

    collect(delivery) -> DataFrame of sources (id, sha256, format and what handlers need); handlers: a Handlers; judge(rows) -> rows
    with `status`: 'accepted' or anything else. Sources whose id and digest were accepted before aren't handled again; what
    isn't accepted is tried again when it is delivered again, and never replaces what was accepted. State is a BucketedTable, so
    a run that is repeated with the same number gives the same state.
    """

    SCHEMA = "document_id string, sha256 string, route string, status string, run int"

    def __init__(self, spark: SparkSession, collect: Callable[[int], DataFrame], handlers: Handlers, judge: Callable[[DataFrame], DataFrame]):
        self.collect, self.handlers, self.judge = collect, handlers, judge
        self.state = BucketedTable(spark, "runs", self.SCHEMA, ["document_id"])

    def run(self, k: int) -> None:
        sources = self.collect(k)

        def step(old: DataFrame, batch: DataFrame) -> DataFrame:
            known = old.filter("status = 'accepted'").select("document_id", "sha256")
            todo = batch.join(known, ["document_id", "sha256"], "left_anti")
            done = self.handlers.process(todo).join(todo.select("document_id", "sha256"), "document_id")
            new = self.judge(done).select("document_id", F.struct("sha256", "route", "status", F.lit(k).alias("run")).alias("new"))
            both = old.select("document_id", F.struct("sha256", "route", "status", "run").alias("old")).join(new, "document_id", "full_outer")
            keep = (F.col("old.status") == "accepted") & (F.coalesce(F.col("new.status"), F.lit("")) != "accepted")
            return both.select("document_id", F.when(F.coalesce(keep, F.lit(False)), F.col("old")).otherwise(F.coalesce("new", "old")).alias("x")).select("document_id", "x.*")

        self.state.merge(sources, k, step)

    def result(self) -> DataFrame:
        return self.state.at(self.state.last)


class Handlers:
    """format -> function(row as dict) -> (route, reasons). A format without a handler is unsupported, null is failed."""

    def __init__(self, handlers: dict[str, Callable[[dict], Outcome]]):
        self.handlers = dict(handlers)

    def register(self, name: str, handler: Callable[[dict], Outcome]) -> None:
        self.handlers[name] = handler

    def process(self, rows: DataFrame, id_col: str = "document_id", format_col: str = "format") -> DataFrame:
        """document id, format, route, reasons, error. An exception fails its row only; Spark deals out the rows."""
        handlers = self.handlers

        def one(row: dict) -> tuple[str, list[str], str | None]:
            name = row[format_col]
            if name is None:
                return "failed", ["UNKNOWN_FORMAT"], None
            if name not in handlers:
                return "unsupported", ["UNSUPPORTED_FORMAT"], None
            try:
                return *handlers[name](row), None
            except Exception as e:  # noqa: BLE001  any failure of a handler is this row's outcome
                return "failed", ["PARSE_ERROR"], f"{type(e).__name__}: {e}"[:500]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = [one(r) for r in b.to_dict("records")]
                yield pd.DataFrame({id_col: b[id_col], format_col: b[format_col], "route": [o[0] for o in out], "reasons": [o[1] for o in out], "error": [o[2] for o in out]})

        return rows.mapInPandas(run, f"{id_col} string, {format_col} string, route string, reasons array<string>, error string")
