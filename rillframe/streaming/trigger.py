"""New episode files as a trigger of the batch steps.

A file stream sees a path once, so it can neither see a rewritten file nor a deleted one: the manifest stays the state
of record, and each batch only starts a discovery.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery



def on_new_episodes(spark: SparkSession, root: str, checkpoint: str, action: Callable[[DataFrame, int], None], available_now: bool = True) -> StreamingQuery:
    """Call ``action`` with the paths and lengths of each batch of new episode files."""
    schema = spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, content binary").schema
    found = spark.readStream.format("binaryFile").schema(schema).load(f"{root}/data/chunk-*/episode_*.parquet").select("path", "length")
    writer = found.writeStream.option("checkpointLocation", checkpoint).foreachBatch(action)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
