"""JSON lines and JSON files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillframe import schemas as S
from rillframe.functions.expressions import float_list, frame_count
from rillframe.sources.files import hadoop_path, matches


def episodes_meta(spark: SparkSession, path: str) -> DataFrame:
    """One row per episode index (the first met has no order in a distributed read: the smallest length); empty without a file."""
    if not matches(spark, path):
        return spark.createDataFrame([], "episode_index bigint, length bigint")
    rows = spark.read.schema(S.EPISODES_META).json(path)
    return rows.where(F.col("episode_index").isNotNull()).groupBy("episode_index").agg(F.min("length").alias("length"))


def valid_ids(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Distinct ids of JSON-object lines (episode_index, else episode) or of lines' last comma field; bad lines are ignored.

    None, for no filter, without a path or file.
    """
    if not path or not matches(spark, path):
        return None
    return parse_ids(spark.read.text(path))


def parse_ids(lines: DataFrame) -> DataFrame:
    line = F.trim("value")
    whole = lambda c: F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
    named = F.coalesce(F.get_json_object(line, "$.episode_index"), F.get_json_object(line, "$.episode"))
    last = F.trim(F.element_at(F.split(line, ","), -1)).try_cast("bigint")
    return lines.where(line != "").select(F.when(line.startswith("{"), whole(named)).otherwise(last).alias("episode_index")).where(F.col("episode_index").isNotNull()).distinct()


def episode_stats(spark: SparkSession, path: str, features: list[str]) -> DataFrame:
    """Per episode and feature (episode_index, n, feature, mean, std, min, max); vectors are null where unusable.

    n is the episode's frame count: of action, else of observation.state, else of the first feature that has one.
    """
    if not matches(spark, path):
        raise FileNotFoundError(path)
    lines = spark.read.text(path).where(F.trim("value") != "")
    rows = lines.select(F.from_json("value", "episode_index bigint, stats map<string,string>", {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return parse_stats(rows, features)


def parse_stats(rows: DataFrame, features: list[str]) -> DataFrame:
    one = lambda name: F.try_element_at("stats", F.lit(name))
    positive = lambda c: F.when(c > 0, c)
    filled = lambda c: F.when(~F.coalesce(c, F.lit("{}")).isin("{}", "null"), c)
    reference = F.coalesce(filled(one("action")), filled(one("observation.state")))
    n = F.coalesce(positive(frame_count(reference)), *[positive(frame_count(one(f))) for f in features])
    vector = lambda k: float_list(F.get_json_object("s", f"$.{k}"))
    rows = rows.withColumn("n", n).where(F.col("n") > 0).select("episode_index", "n", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), one(f).alias("s")) for f in features])).alias("e")).select("episode_index", "n", "e.*")
    rows = rows.select("episode_index", "n", "feature", *[vector(k).alias(k) for k in ("mean", "std", "min", "max")])
    fits = (F.size("mean") == F.size("std")) & (F.size("mean") == F.size("min")) & (F.size("mean") == F.size("max"))
    return rows.select("episode_index", "n", "feature", *[F.when(fits, F.col(k)).alias(k) for k in ("mean", "std", "min", "max")])


def read_json(spark: SparkSession, path: str) -> dict | None:
    """A small JSON file, on the driver; None if it is missing or malformed."""
    fs, where = hadoop_path(spark, path)
    if not fs.exists(where):
        return None
    try:
        return json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))
    except ValueError:
        return None
