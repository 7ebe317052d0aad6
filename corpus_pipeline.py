"""The corpus pipeline: five stages over documents, each written as Parquet before the next one reads it.

quality rules -> line deduplication -> one document of every near-duplicate class -> source mix -> packed sequences.
All stages but the last return the columns of documents; decisions take effect (rejected documents, failing and
repeated lines and near copies are gone, mixed documents stand as often as the mix takes them). An empty or missing
text goes through every stage as the stages' own docstrings define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from equisite.llm import chosen_path, line_dedup, mixing, packing, quality_rules
from equisite.plans.session import materialise


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules, without their failing lines."""
    return quality_rules.cleaned(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least three documents share, but for their last holder."""
    return line_dedup.cleaned(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies."""
    return chosen_path.one_of_each(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the shares of their sources' targets."""
    return mixing.mixed_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and place."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("jaccard_join", near_stage),
          ("source_mix", mix_stage), ("best_fit_packing", pack_stage)]

ORACLE_SQL = None
"""Tokenising and packing have no SQL; tests hold the stages against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the documents table to the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
