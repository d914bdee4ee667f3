"""The corpus pipeline: filter, deduplicate, decontaminate and pack all documents.

Each stage takes ``(spark, docs, sf_dir)`` and works on everything its
predecessor kept; ``run`` writes every stage's result as Parquet in the shared
folder and reads it back as the next stage's documents.  All stages but the
last return the columns of ``documents`` as they came.

Nulls, empty texts, repeated rows and clashing column names behave as the
operators' docstrings state; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapewise.llm import decontaminate, jaccard, linededup, packing, toxicity
from tapewise.llm.common import materialize, small_batches, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores below 0.5; it learns from the labelled documents of the stage's input."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; those of which nothing is left go."""
    return linededup.drop_repeated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies."""
    small_batches(spark)
    return jaccard.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 ids."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_repeated_lines), ("near copies", drop_near_copies),
          ("decontamination", drop_leaks), ("packing", pack)]

#: The first stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
