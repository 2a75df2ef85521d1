"""Writers. Tables replace their target by a rename, small documents are written from the driver."""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillframe.sources.files import hadoop_path

ASIDE = ".before"  # what a table is called while another takes its place

LINKS = ("symlink", "hardlink", "copy", "manifest-only")


def replace_table(df: DataFrame, path: str, partition_by: list[str] = (), compression: str = "zstd") -> None:
    """Write beside the target, then put it in the target's place; the target may be an input of ``df``.

    A folder can't replace another in one step, so the old table is moved aside, the new one in, and the old one deleted.
    Whatever step fails, a whole table is left: at the target, or else the old one aside, which ``recovered`` moves back.
    """
    spark, target = df.sparkSession, recovered(df.sparkSession, path)
    beside, aside = f"{target}.tmp-{uuid.uuid4().hex}", f"{target}{ASIDE}"
    df.write.option("compression", compression).partitionBy(*partition_by).parquet(beside) if partition_by else df.write.option("compression", compression).parquet(beside)
    fs, old = hadoop_path(spark, target)
    if fs.exists(old):
        _move(spark, target, aside)
    try:
        _move(spark, beside, target)
    except Exception:
        recovered(spark, target)
        raise
    fs.delete(hadoop_path(spark, aside)[1], True)


def recovered(spark: SparkSession, path: str) -> str:
    """The path of a table, after a replacement that was broken off is undone: the old table comes back if the new one isn't there."""
    target = path.rstrip("/")
    fs, there = hadoop_path(spark, target)
    _, aside = hadoop_path(spark, f"{target}{ASIDE}")
    if fs.exists(aside):
        if fs.exists(there):
            fs.delete(aside, True)
        else:
            _move(spark, f"{target}{ASIDE}", target)
    return target


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, where = hadoop_path(spark, source)
    if not fs.rename(where, hadoop_path(spark, target)[1]):
        raise OSError(f"can't move {source} to {target}")


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    fs, where = hadoop_path(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_summary(summary: DataFrame, path: str) -> dict[str, int]:
    """A one-row table of numbers as lines of YAML."""
    found = summary.first().asDict()
    write_text(summary.sparkSession, "".join(f"{k}: {v}\n" for k, v in found.items()), path)
    return found


def stats_json(stats: DataFrame, meta: dict) -> dict:
    """The global statistics, a row per feature and dimension, as the nested document that other tools read."""
    out: dict = {"meta": meta}
    for r in stats.orderBy("feature", "dim").toLocalIterator():
        f = out.setdefault(r["feature"], {"count": r["count"], "mean": [], "std": [], "min": [], "max": []})
        for k in ("mean", "std", "min", "max"):
            f[k].append(r[k])
    return out


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    write_text(spark, json.dumps(value, indent=2), path)


def json_rows(df: DataFrame) -> Iterator[str]:
    """Rows as JSON lines with their nulls, a partition at a time on the driver."""
    for row in df.toLocalIterator():
        yield json.dumps(row.asDict(recursive=True), default=str)


def link(source: str, target: str, method: str) -> None:
    """Make a local video's link or copy; nothing for manifest-only."""
    if method not in LINKS:
        raise ValueError(f"unknown link method: {method}")
    if method == "manifest-only":
        return
    os.makedirs(os.path.dirname(target), exist_ok=True)
    if method != "copy" and os.path.lexists(target):
        os.unlink(target)
    if method == "symlink":
        os.symlink(os.path.relpath(source, os.path.dirname(target)), target)
    elif method == "hardlink":
        os.link(source, target)
    else:
        shutil.copy2(source, target)


def link_all(links: DataFrame, method: str) -> None:
    """Links of (source, target) paths, made where the rows are: the folder must be shared."""
    plain = lambda p: p.removeprefix("file://").removeprefix("file:")

    def run(rows: Iterator) -> None:
        for r in rows:
            link(plain(r["source"]), plain(r["target"]), method)

    if method not in LINKS:
        raise ValueError(f"unknown link method: {method}")
    if method != "manifest-only":
        links.where(F.col("source").isNotNull()).foreachPartition(run)
