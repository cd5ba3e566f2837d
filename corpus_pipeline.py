"""From raw documents to token files: quality rules, near duplicates, benchmark decontamination, source mix, token ids.

Each stage reads what the one before it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from peerglass.llm import decontaminate, jaccard, mixing, quality, tokens
from peerglass.llm.scratch import Scratch
from peerglass.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the limits of their language and source."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without much benchmark text."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeat(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: one row for each document in them."""
    return tokens.round_trip(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: SQL has no tokenizer; the pipeline is tested stage by stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir))
    return docs
