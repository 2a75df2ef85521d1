"""Queries on documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillframe.llm import decontamination, language_id, near_dedup, oracles, packing, quality_classifier, quality_rules, sharding
from rillframe.llm.common import crc_fold, table


def _held_out(docs: DataFrame) -> DataFrame:
    return docs.withColumn("held_out", F.coalesce(crc_fold() == 2, F.lit(False)))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.judge(docs, without="text").select(*columns)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs)
    return _held_out(language_id.predict(docs.select("doc_id", "text"), model)).select("doc_id", "held_out", "lang_pred", "score")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return _held_out(quality_classifier.classify(docs, labels)).select("doc_id", "held_out", "score", "predicted")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_language_id, op3_best_fit_packing, op4_quality_classifier, op5_decontamination, op7_near_dedup, op8_sharding)}

ORACLES = {"op1_quality_rules": oracles.OP1, "op7_near_dedup": oracles.OP7}
