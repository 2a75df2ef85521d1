"""Corpus pipeline: quality rules, language ID, near-dedup, decontamination, packing. See STAGES.

Each stage is written before the next one reads it, so a lost executor costs parts of one stage.

Defined cases: documents with a null, empty or letterless text go in the first stage; a null language is judged by the
reference of all texts, and isn't learned from; a corpus without any labelled language loses no text with letters in the
second stage; documents with a null id are kept by near-dedup and packed; rows that repeat an id are kept or dropped
together by near-dedup, and packed each for itself; of equal texts that with the smallest id stays; without benchmark
items nothing is contaminated; empty tables give empty results; other columns pass through the first four stages,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillframe.llm import decontamination, language_id, near_dedup, packing, quality_rules
from rillframe.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose text less than half reads clearly as one of the languages that the corpus is labelled with."""
    return language_id.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest id."""
    return near_dedup.keep(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.keep(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as pieces of token sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality), ("language_id", language), ("near_dedup", near_duplicates), ("decontamination", decontaminated), ("packing", packed)]
ORACLE_SQL = None  # stages 2, 3 and 5 are models, set similarities over components and an order-dependent packing


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to documents; each stage's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
