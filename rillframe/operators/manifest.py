"""The manifest's difference between two discoveries: joins of tables, without reading files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillframe import schemas as S
from rillframe.functions.expressions import diffed_status


def one_per_key(previous: DataFrame, keys: list[str]) -> DataFrame:
    """The largest known fingerprint of each key: orphans of two cameras are two rows of a key."""
    return previous.groupBy(*keys).agg(F.max("fingerprint").alias("fingerprint_prev"))


def with_status(current: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    rows = current.join(one_per_key(previous, keys), keys, "left")
    return rows.withColumn("status", diffed_status(F.col("fingerprint"), F.col("fingerprint_prev"), F.col("status"))).drop("fingerprint_prev").select(*current.columns)


def deleted(current: DataFrame, previous: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are gone, once: those that the previous manifest already calls deleted or orphans aren't reported again."""
    known = previous.where(~F.col("status").isin(S.DELETED, S.ORPHAN_VIDEO)).select(*keys).distinct()
    return known.join(current.select(*keys), keys, "left_anti")


def orphans(videos: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Videos without an episode, a row per file."""
    return videos.join(current.select(*keys), keys, "left_anti")


def delta(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("status").isin(*S.DELTA))


def actionable(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("status").isin(*S.ACTIONABLE))
