"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as a character class body for Java and RE2 patterns.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound to a variable, so that it is evaluated once however often it is used."""
    return F.transform(F.array(value), body).getItem(0)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; one of this process where that is unset (local runs)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="rillframe-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{root}")
    return f"file://{root}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives the loss of executors.

    The files go when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/rillframe-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until no column of ``df`` has that name (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def crc_fold(column: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 4; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4
