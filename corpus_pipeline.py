"""A training corpus from raw documents: quality, exact and near copies, mixing, packing.

Each stage works on all that the one before it has kept; the driver, or run(), writes a stage's rows as
Parquet and reads them again for the next. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from civicspark.llm import exact_dedup, mixing, near_dedup, packing, quality
from civicspark.llm.common import materialise, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, doesn't reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.deduplicate(docs, keep="max")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id."""
    return near_dedup.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once, or up to three times."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remember=100_000)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing sources", mixing_stage),
    ("best-fit packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Subset-sum fitting, signatures, learned scores and packing can't be said in SQL.
ORACLE_SQL = None
