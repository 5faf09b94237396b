"""A corpus pipeline over ``documents``: quality, near-duplicates, benchmark
leaks, mixing, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's docs. All but the last return the columns of
documents. No stage has a form in SQL: the first learns from labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scrubjay.llm.common import materialise, ship_package, table
from scrubjay.llm.decontam import remove_contaminated
from scrubjay.llm.minhash import drop_near_duplicates
from scrubjay.llm.mixing import mixed_copies
from scrubjay.llm.quality import fit, learnable, score_quality
from scrubjay.llm.sharding import shard_documents

QUALITY = 0.3                 # documents with a lower score are rejected
WIDTH, PERCENT = 5, 80        # words in a shingle, least similarity
WINDOW = 10                   # benchmark words in a row that count as a leak
SHARDS = 24


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at least ``QUALITY`` stay. Null and empty texts
    get the share of good labels; null labels and ids are not learned from."""
    ship_package(spark)
    model = fit(docs.select("doc_id", "text"), learnable(spark, sf_dir))
    return score_quality(docs, model, output="__score").where(f"__score >= {QUALITY}").drop("__score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest
    doc_id. Documents without words all stay."""
    ship_package(spark)
    return drop_near_duplicates(docs, width=WIDTH, percent=PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Null and empty texts hold none and stay."""
    ship_package(spark)
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"), width=WINDOW)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it, 0 to 3 times. Documents without
    words stay once; a null source is a source of its own."""
    ship_package(spark)
    return mixed_copies(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``size``, ``shard`` and ``slot``; equal texts share a shard, null ones too."""
    ship_package(spark)
    return shard_documents(docs, shards=SHARDS)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
