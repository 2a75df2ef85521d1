"""Operators over rows in order, in which no key has to fit a task.

``order`` is a whole-number column. Rows are taken in blocks of ``width`` order values; windows run within (key,
block), and a row per block carries what crosses its borders. So a key that holds a third of all rows is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 1_000_000


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until ``df`` has no column of that name in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out


def _block(order: str, width: int) -> Column:
    return F.coalesce(F.floor(F.col(f"`{order}`") / width), F.lit(-(2**62)))


def ordering_summary(df: DataFrame, keys: list[str], order: str, strict: list[str] = (), ascending: list[str] = (), ends: list[str] = (), aggregates: list[Column] = (), width: int = WIDTH) -> DataFrame:
    """Per key: <c>_sorted for the ``strict`` (each value larger than the one before) and ``ascending`` (no value
    smaller) columns, <c>_first and <c>_last for ``ends``, and the ``aggregates``, which must be sums, minima or maxima
    named by an alias: they are combined over blocks by a function that their prefix n_, min_, max_, any_ or all_ names.

    A comparison with a null counts as sorted, as does a NaN after anything.
    """
    watched = dict.fromkeys([*strict, *ascending])
    at, head, tail, prior = unused(df, "block", "head", "tail", "prior")
    befores, goods = (unused(df, *[f"{what}_{i}" for i in range(len(watched))]) for what in ("before", "good"))
    w = Window.partitionBy(*keys, at).orderBy(order)
    rows = df.withColumn(at, _block(order, width))
    before = {c: F.lag(F.col(f"`{c}`")).over(w) for c in watched}
    rows = rows.withColumns(dict(zip(befores, before.values(), strict=True)))
    good = {c: F.bool_and(F.coalesce(_after(F.col(f"`{c}`"), F.col(befores[i]), c in strict), F.lit(True))) for i, c in enumerate(watched)}
    edge = list(dict.fromkeys([*watched, *ends]))
    sums = [F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(edge)])] if edge else []
    made = [g.alias(n) for n, g in zip(goods, good.values(), strict=True)]
    made += [F.min_by(s, F.col(f"`{order}`")).alias(head) for s in sums] + [F.max_by(s, F.col(f"`{order}`")).alias(tail) for s in sums]
    blocks = rows.groupBy(*keys, at).agg(*made, *aggregates) if made or aggregates else rows.select(*keys, at).distinct()
    over = Window.partitionBy(*keys).orderBy(at)
    if edge:
        blocks = blocks.withColumn(prior, F.lag(tail).over(over))
    out = []
    for i, c in enumerate(watched):
        crossing = F.coalesce(_after(F.col(f"{head}.v{edge.index(c)}"), F.col(f"{prior}.v{edge.index(c)}"), c in strict), F.lit(True))
        out.append(F.bool_and(F.col(goods[i]) & crossing).alias(f"{c}_sorted"))
    out += [x for c in ends for x in (F.min_by(F.col(f"{head}.v{edge.index(c)}"), at).alias(f"{c}_first"), F.max_by(F.col(f"{tail}.v{edge.index(c)}"), at).alias(f"{c}_last"))]
    combine = {"n": F.sum, "min": F.min, "max": F.max, "any": F.bool_or, "all": F.bool_and}
    names = [c for c in blocks.columns if c not in (*keys, at, head, tail, prior, *goods)]
    return blocks.groupBy(*keys).agg(*out, *[combine[c.split("_")[0]](c).alias(c) for c in names])


def _after(value: Column, before: Column, strictly: bool) -> Column:
    return value > before if strictly else value >= before


def first_of_duplicates(df: DataFrame, keys: list[str], order: str, tie: str) -> DataFrame:
    """One row per (key, order value): that of the smallest ``tie``. Combined before the shuffle; nulls are one value."""
    rest = [c for c in df.columns if c not in keys and c not in (order, tie)]
    (own,) = unused(df, "first")
    first = df.groupBy(*keys, order).agg(F.min(F.struct(tie, *[F.col(f"`{c}`") for c in rest])).alias(own))
    return first.select(*[F.col(f"`{c}`") if c in keys or c == order else F.col(f"{own}.`{c}`").alias(c) for c in df.columns])


def numbered(df: DataFrame, keys: list[str], order: str, into: str, width: int = WIDTH) -> DataFrame:
    """``df`` with ``into``: the row's place, from 0, within its key by order (nulls first; order values are distinct)."""
    at, n, start, place = unused(df, "block", "n", "start", "place")
    rows = df.withColumn(at, _block(order, width))
    counts = rows.groupBy(*keys, at).agg(F.count("*").alias(n))
    over = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, at, F.coalesce(F.sum(n).over(over), F.lit(0)).alias(start))
    order_in = F.row_number().over(Window.partitionBy(*keys, at).orderBy(F.asc_nulls_first(order))) - 1
    rows = rows.withColumn(place, order_in).alias("r").join(starts.alias("s"), [F.col(f"r.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in [*keys, at]])
    kept = [F.col(f"r.`{c}`") for c in df.columns if c != into]
    return rows.select(*kept, (F.col(f"s.{start}") + F.col(f"r.{place}")).cast("bigint").alias(into))
