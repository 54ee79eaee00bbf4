"""The corpus pipeline: documents through five stages to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
All but the last return the columns of ``documents``, and further columns that come
with them, whatever their names. Null and empty texts are kept by the first four stages
unless the classifier rejects them, and packed as their final 0; repeated rows are one
group of copies; empty tables pass through; texts of any length are taken whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stationflow.llm import boilerplate, importance, jaccard, packing, tiling
from stationflow.llm.staging import staged


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling rejects go."""
    return importance.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that too many documents of a source share go; every document stays."""
    return boilerplate.drop_boilerplate(docs).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, 80 hundredths."""
    return jaccard.one_of_each(docs).select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return tiling.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of at most 1024 tokens: a row for each piece."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("packing", pack),
]

#: The classifier is no SQL; tests/llm/test_pipeline.py holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
