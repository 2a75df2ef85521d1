"""Listings of files as DataFrames, through Spark's file systems."""

from __future__ import annotations

import tempfile
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillframe import schemas as S
from rillframe.functions.expressions import chunk_id, episode_index


def hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def scratch(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names, else a temporary one in local runs."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or f"file://{tempfile.gettempdir()}").rstrip("/")


def matches(spark: SparkSession, pattern: str) -> bool:
    fs, path = hadoop_path(spark, pattern)
    return bool(fs.globStatus(path))


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """path, length, modificationTime of the files that match; contents aren't read. Empty if none does."""
    if not matches(spark, pattern):
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return spark.read.format("binaryFile").load(pattern).select("path", "length", "modificationTime")


class EpisodeFiles:
    """A dataset's files: data/chunk-*/episode_*.parquet and videos/chunk-*/<view>/episode_*.mp4."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def chunks(self) -> list[str]:
        fs, path = hadoop_path(self.spark, f"{self.root}/data/chunk-*")
        return sorted(f.getPath().getName().rsplit("-", 1)[-1] for f in fs.globStatus(path) or [] if f.isDirectory())

    def parquets(self, since: datetime | None = None, only_chunks: list[str] | None = None) -> DataFrame:
        rows = list_files(self.spark, f"{self.root}/data/chunk-*/episode_*.parquet")
        if since is not None:
            rows = rows.where(F.col("modificationTime") >= F.lit(since))
        return self._keyed(rows, only_chunks)

    def videos(self, only_chunks: list[str] | None = None) -> DataFrame:
        rows = self._keyed(list_files(self.spark, f"{self.root}/videos/chunk-*/*/episode_*.mp4"), only_chunks)
        return rows.withColumn("view", F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)).where(F.col("view").isin(*S.VIEWS) & F.col("episode_index").isNotNull())

    def _keyed(self, rows: DataFrame, only_chunks: list[str] | None) -> DataFrame:
        rows = rows.select(chunk_id(F.col("path")).alias("chunk"), episode_index(F.col("path")).alias("episode_index"), "path", "length", "modificationTime")
        return rows if only_chunks is None else rows.where(F.col("chunk").isin(only_chunks))


def normalized_episodes(spark: SparkSession, root: str) -> list[str]:
    """The globs under which a step finds its episodes: chunk directories, else a flat directory. Raises if there are none."""
    for pattern in (f"{root}/chunk-*/episode_*.parquet", f"{root}/chunk=*/episode_index=*/*.parquet", f"{root}/episode_*.parquet"):
        if matches(spark, pattern):
            return [pattern]
    raise FileNotFoundError(f"no episodes under {root}")
