"""Weighted reduction of per-episode statistics to global ones: sums that Spark combines before it shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reduce_moments(stats: DataFrame, by: list[str]) -> DataFrame:
    """From rows (by..., n, mean, std, min, max), the last four arrays of one length: (by..., dim, count, mean, std, min, max).

    mean = sum(n * mean) / N; std = sqrt(max(sum(n * (std^2 + mean^2)) / N - mean^2, 0)), the population's.
    """
    rows = stats.select(*by, "n", F.posexplode(F.arrays_zip("mean", "std", "min", "max")).alias("dim", "v"))
    n, mu, sd = F.col("n"), F.col("v.mean"), F.col("v.std")
    sums = rows.groupBy(*by, "dim").agg(F.sum("n").alias("count"), F.sum(n * mu).alias("s1"), F.sum(n * (sd * sd + mu * mu)).alias("s2"), F.min("v.min").alias("min"), F.max("v.max").alias("max"))
    mean = F.col("s1") / F.col("count")
    spread = F.sqrt(F.greatest(F.col("s2") / F.col("count") - mean * mean, F.lit(0.0)))
    return sums.where(F.col("count") > 0).select(*by, "dim", "count", mean.alias("mean"), spread.alias("std"), "min", "max")


def usable(stats: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to reduce, rows left out): left out are rows with NaN, and rows whose width isn't their group's most frequent."""
    whole = ~F.exists(F.concat("mean", "std", "min", "max"), lambda x: x.isNull() | F.isnan(x))
    widths = stats.where(whole).groupBy(*by, F.size("mean").alias("width")).count()
    usual = widths.groupBy(*by).agg(F.max(F.struct("count", (-F.col("width")).alias("narrow"))).alias("best")).select(*by, (-F.col("best.narrow")).alias("usual"))
    rows = stats.withColumn("_whole", whole).join(F.broadcast(usual), by, "left")  # a row per feature
    good = F.col("_whole") & (F.size("mean") == F.col("usual"))
    return rows.where(good).drop("_whole", "usual"), rows.where(~F.coalesce(good, F.lit(False))).drop("_whole", "usual")
