"""The operators' queries, with production parameters over whole tables, and the SQL to hold them against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rillframe.llm import q_documents, q_pages

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return q_documents.QUERIES | q_pages.QUERIES


def oracle_sql() -> dict[str, str]:
    return q_documents.ORACLES | q_pages.ORACLES
