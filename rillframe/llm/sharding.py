"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Rows of equal text are a group, which goes to one shard. Groups are placed largest first, each into the shard where
the dot product of its (bytes, tokens, rows), as shares of a shard, with the shard's residual capacity is highest. Bytes
are those of the text and 8 more, tokens the ids of a public tokenizer.

A group of at least ``unit`` of a shard in some dimension (at most 3 / unit * shards of them) is placed on the driver; one
beyond ``split`` of a shard is dealt by row to parts of about that size, as no shard could hold a third of all rows.
All other groups are dealt by hash to blocks of about ``block_groups`` groups, and each block is placed by the same rule,
in a task, into its share of the capacity that the large groups leave. So every group is placed by itself, however many
there are; blocks differ by chance, and what each leaves uneven is smaller than its smallest groups.

Sums are made before they are shuffled; no task holds a group's rows, and slots are numbered in pieces of about
``piece_rows`` rows by a number that each row gets when it is staged, so rows without an id or with the same one are
spread like others.

The law that holds is ``bytes``: shards have near equal sizes, as near as the groups are small.

Defined cases: a null text has size 8 and no token and is a group of its own kind, apart from empty texts; rows that
repeat or lack an id are placed like others and get slots of their own; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillframe.llm import packing
from rillframe.llm.common import staged, unused

DIMENSIONS = ("size", "tokens", "rows")


@dataclass(frozen=True)
class Config:
    shards: int = 24
    unit: float = 1 / 64
    split: float = 1 / 4
    block_groups: int = 20_000
    piece_rows: int = 200_000


def place(shares: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """The shard of each group (n, dimensions), given in shares of a shard; ``residual`` (shards, dimensions) is used up.

    Largest first by the largest share; ties by place; the first of equally good shards.
    """
    out = np.zeros(len(shares), np.int64)
    for i in np.argsort(-shares.max(axis=1), kind="stable"):
        out[i] = int(np.argmax(residual @ shares[i]))
        residual[out[i]] -= shares[i]
    return out


def text_key(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: packing.Config | None = None) -> DataFrame:
    """doc_id, size, tokens, rows (1), text_crc32, text_key and row, the row's number, staged."""
    vocabulary = vocabulary or packing.public_config()
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    own = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), value.alias("text"), (F.octet_length(value).cast("long") + 8).alias("size"), F.crc32(value.cast("binary")).alias("text_crc32"), text_key(text).alias("text_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = pa.array([sum(map(len, packing.ids(t.as_py(), vocabulary))) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], tokens], names=["doc_id", "size", "text_crc32", "text_key", "tokens"])

    counted = rows.mapInArrow(run, f"doc_id {own}, size bigint, text_crc32 bigint, text_key bigint, tokens bigint")
    return staged(counted.withColumns({"rows": F.lit(1).cast("long"), "row": F.monotonically_increasing_id()}), "measured")


def part_of(row: str, parts: str | Column) -> Column:
    return F.pmod(F.xxhash64(row, F.lit("part")), F.col(parts) if isinstance(parts, str) else parts).cast("int")


def shards_of(rows: DataFrame, config: Config = Config()) -> tuple[list[tuple[int, list[int]]], DataFrame]:
    """Of ``measured`` rows: (text_key, the shards of its parts) of each large group, and (text_key, shard) of the others."""
    spark = rows.sparkSession
    groups = staged(rows.groupBy("text_key").agg(*[F.sum(d).alias(d) for d in DIMENSIONS]), "groups")
    total = groups.agg(F.count("*").alias("n"), *[F.sum(d).alias(d) for d in DIMENSIONS]).first()
    unit = [max(1, total[d] or 0) / config.shards for d in DIMENSIONS]  # what a shard would hold of each
    share = F.greatest(*[F.col(d) / F.lit(u) for d, u in zip(DIMENSIONS, unit, strict=True)])
    large = sorted(groups.where(share >= config.unit).collect(), key=lambda r: r["text_key"])  # at most 3 / unit * shards
    shares = np.array([[r[d] for d in DIMENSIONS] for r in large], float).reshape(-1, len(DIMENSIONS)) / unit
    parts = np.ceil(shares.max(axis=1, initial=0) / config.split).astype(int)
    of = {r["text_key"]: k for k, r in enumerate(large)}
    starts = np.cumsum(parts) - parts
    held = np.zeros(parts.sum())  # rows of each part, as its hash deals them
    table = F.broadcast(spark.createDataFrame([(key, int(parts[k])) for key, k in of.items()], "text_key bigint, parts int"))  # bounded as above
    for r in rows.join(table, "text_key").groupBy("text_key", part_of("row", "parts").alias("part")).count().collect():
        held[starts[of[r["text_key"]]] + r["part"]] = r["count"]
    residual = np.ones((config.shards, len(DIMENSIONS)))
    each = shares / np.array([r["rows"] for r in large]).reshape(-1, 1)
    placed = place(np.repeat(each, parts, axis=0) * held[:, None], residual).tolist()
    own = [(key, placed[starts[k] : starts[k] + parts[k]]) for key, k in of.items()]
    blocks = max(1, -(-total["n"] // config.block_groups))
    rest = groups.where(share < config.unit).withColumn("block", F.pmod(F.xxhash64("text_key", F.lit("block")), F.lit(blocks)).cast("int"))

    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("text_key")
        order = np.roll(np.arange(config.shards), key[0])  # so that no shard is the first of equals in every block
        found = place(block[list(DIMENSIONS)].to_numpy(float) / unit, residual[order] / blocks)
        return pd.DataFrame({"text_key": block["text_key"], "shard": order[found].astype(np.int32)})

    return own, spark.createDataFrame([], "text_key bigint, shard int") if not total["n"] else staged(rest.groupBy("block").applyInPandas(run, "text_key bigint, shard int"), "placed")


def with_shard(rows: DataFrame, large: list[tuple[int, list[int]]], others: DataFrame, shard: str = "shard", key: str = "text_key", row: str = "row") -> DataFrame:
    """``rows`` with their shard; rows of a large group are dealt to its parts by their number."""
    known, parts, other, its = unused(rows, "known", "parts", "other", "its")
    table = F.broadcast(rows.sparkSession.createDataFrame(large, f"{known} bigint, {parts} array<int>"))  # bounded, see shards_of
    rows = rows.join(table, F.col(key) == F.col(known), "left")
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in (known, parts)]
    dealt = F.get(F.col(parts), part_of(row, F.size(parts)))
    first = rows.where(F.col(parts).isNotNull()).select(*kept, dealt.alias(shard))
    others = others.select(F.col("text_key").alias(other), F.col("shard").alias(its))
    return first.unionByName(rows.where(F.col(parts).isNull()).join(others, F.col(key) == F.col(other)).select(*kept, F.col(its).alias(shard)))


def assign(docs: DataFrame, config: Config = Config(), doc_id: str = "doc_id", text: str = "text", vocabulary: packing.Config | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard (null under this law)."""
    rows = measured(docs, doc_id, text, vocabulary)
    rows = staged(with_shard(rows, *shards_of(rows, config)).select("doc_id", "size", "text_crc32", "row", "shard"), "sharded")
    most = rows.groupBy("shard").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    pieces = max(1, -(-most // config.piece_rows))
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("row", F.lit("piece")), F.lit(pieces)).cast("int"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = rows.groupBy("shard", "piece").agg(F.count("*").alias("n")).select("shard", "piece", before.alias("start"))
    numbered = rows.withColumn("at", F.row_number().over(Window.partitionBy("shard", "piece").orderBy("row")))
    return numbered.join(starts, ["shard", "piece"]).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("at") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, config: Config = Config(), doc_id: str = "doc_id", text: str = "text", vocabulary: packing.Config | None = None) -> None:
    """Write the documents with all their columns, a folder shard=... for each shard."""
    key, row, shard = unused(docs, "text_key", "row", "shard")
    large, others = shards_of(measured(docs, doc_id, text, vocabulary), config)
    rows = docs.withColumns({key: text_key(text), row: F.monotonically_increasing_id()})
    with_shard(rows, large, others, shard, key, row).drop(key, row).write.partitionBy(shard).parquet(path)
