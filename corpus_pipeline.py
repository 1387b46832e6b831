"""From raw documents to packed sequences: classify, drop copies, drop near copies, mix sources, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelmint.llm import exact_dedup, mixing, near_dedup, packing, quality
from panelmint.llm.common import land, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject (score of 0.3 or more); it learns from the labelled ones among `docs`."""
    model = quality.learn_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs.select(COLUMNS), model).where("__score >= 0.3").select(COLUMNS)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal normalised texts."""
    return exact_dedup.drop_exact(docs.select(COLUMNS))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.drop_near(docs.select(COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to shares that grow with the root of their size; rows repeat as often as their source's rate says."""
    return mixing.poisson_mix(docs.select(COLUMNS), alpha=0.5).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", good), ("exact", unique), ("near", distinct), ("mix", mixed), ("pack", packed)]

# Training a model, sketches and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
