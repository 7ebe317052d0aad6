"""The registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from equisite.llm import (anchor_tree, chosen_path, conversation, cover_tree, fingerprints, html_text, language, line_dedup, mixing, packing,
                          private_data, quality_classifier, quality_rules)
from equisite.llm.base import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn
    return add


@query(quality_rules.oracle_sql())
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


@query(line_dedup.oracle_sql())
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, sf_dir, "documents"))


@query(mixing.oracle_sql())
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query()
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents"))


@query()
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(table(spark, sf_dir, "documents"))


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query()
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query()
def op6_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.find(table(spark, sf_dir, "documents"))


@query(cover_tree.oracle_sql())
def op11_cover_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.join(table(spark, sf_dir, "embeddings"))


@query(conversation.oracle_sql())
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.repair(table(spark, sf_dir, "conversations"))


@query(anchor_tree.oracle_sql())
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_tree.mine(table(spark, sf_dir, "embeddings"))
