"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A stage
works on all rows that the one before it kept. run() writes each result to the shared folder as Parquet and reads it
again, so that lineage is cut and a lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.llm.common import cut
from docledger.llm.exact_dedup import keep_first
from docledger.llm.langid import fit, keep_known
from docledger.llm.ngram_join import keep_smallest
from docledger.llm.packing import pack
from docledger.llm.substring import remove_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; those that it rejects go. Held-out rows teach it nothing."""
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    return keep_known(docs, fit(docs.filter(~held)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return keep_first(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the smallest doc_id stays."""
    return keep_smallest(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 20 that stand earlier in the corpus are cut from the texts."""
    return remove_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_join", ngram_join),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: Several stages can't be expressed in SQL; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
