"""Cleaning of frames: types, vector widths, duplicates, numbering, bad rows, normalization, in this order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillframe.functions.expressions import zscore
from rillframe.operators.ordered import first_of_duplicates, numbered, unused


def cast_to(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Strict casts: a value that doesn't fit raises."""
    return df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in types.items()})


def exact_width(df: DataFrame, vectors: list[str], width: int) -> DataFrame:
    """Rows whose vectors all have this width; a null vector doesn't."""
    keep = F.lit(True)
    for c in vectors:
        keep = keep & (F.size(F.col(f"`{c}`")) == width)
    return df.where(keep)


def dedupe_and_number(df: DataFrame, keys: list[str], order: str, tie: str) -> DataFrame:
    """The first row (by ``tie``) of each order value, renumbered from 0 in order; a null order value comes first."""
    (old,) = unused(df, "order")
    rows = first_of_duplicates(df, keys, order, tie).withColumnRenamed(order, old)
    return numbered(rows, keys, old, order).select(*[F.col(f"`{c}`") for c in df.columns])


def complete(df: DataFrame, not_null: list[str], not_nan: list[str]) -> DataFrame:
    keep = F.lit(True)
    for c in not_null:
        keep = keep & F.col(f"`{c}`").isNotNull()
    for c in not_nan:
        keep = keep & ~F.isnan(F.col(f"`{c}`"))
    return df.where(keep)


def normalize(df: DataFrame, stats: dict[str, tuple[Column, Column]], width: int) -> DataFrame:
    """z-scores of each vector whose mean and deviation have the width; others stay."""
    made = {}
    for c, (mean, std) in stats.items():
        fits = (F.size(mean) == width) & (F.size(std) == width)
        made[c] = F.when(fits, zscore(F.col(f"`{c}`"), mean, std)).otherwise(F.col(f"`{c}`").cast("array<float>"))
    return df.withColumns(made)
