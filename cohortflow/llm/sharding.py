"""Sharding by jump consistent hashing: a stable key and the number of shards decide, without a ring table.

A key jumps through ever higher shard numbers and stays in the last one below the number of shards,
so one more shard takes about its fair share of the keys into itself and moves no other key.

Rows of one key, a null key included, share a shard; each has a slot of its own, also where rows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortflow.llm.common import BROADCAST_KEYS, stage

SHARDS = 8
# Fixed values of the published algorithm: multiplier of its generator, bits dropped from and left in a state.
MULTIPLIER = np.uint64(2862933555777941757)
DROPPED_BITS = np.uint64(33)
SPAN = float(1 << 31)
#: Tasks whose counts one window group adds up.
TASK_BLOCK = 1024
FILE_ROWS = 1_000_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard (from 0) of each 64-bit key, all keys jumping together until each has passed ``shards``."""
    if shards < 1:
        raise ValueError("there must be one shard at least")
    state = keys.view(np.uint64).copy()
    shard, going = np.zeros(len(keys), np.int64), np.arange(len(keys))
    while len(going):
        state = state * MULTIPLIER + np.uint64(1)
        reach = SPAN / ((state >> DROPPED_BITS).astype(np.float64) + 1.0)
        target = ((shard[going] + 1) * reach).astype(np.int64)
        within = target < shards
        going, state = going[within], state[within]
        shard[going] = target[within]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a key column. The type counts too: the same number as int and as bigint is not one key."""

    @F.pandas_udf("int")
    def jumped(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy(np.int64), shards).astype(np.int32))

    return jumped(F.xxhash64(key))


def moves(df: DataFrame, key: str, shards: int, more: int = 1) -> DataFrame:
    """The rows of ``df`` that change their shard when ``more`` are appended: columns ``shard`` and ``grown_shard`` say from where to where."""
    both = df.withColumns({"shard": shard_of(F.col(key), shards), "grown_shard": shard_of(F.col(key), shards + more)})
    return both.where("shard <> grown_shard")


def with_slots(df: DataFrame, shards: int) -> DataFrame:
    """``df`` with a ``slot`` in its ``shard``, from 0 without gaps; a column of that name is replaced.

    Each task numbers its own rows by shard, and the numbered rows are written once, which fixes them. A shard's
    first slot of each task then follows from the tasks' counts alone: no row is shuffled, no task sees a whole shard.
    """
    df = df.drop("slot")
    task_name = "task"
    while task_name in df.columns:
        task_name += "_"
    schema = df.withColumns({task_name: F.lit(0), "slot": F.lit(0).cast("bigint")}).schema

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(shards, np.int64)
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=shards)
            slot = np.empty(len(shard), np.int64)
            slot[order] = np.arange(len(shard)) + np.repeat(seen - (np.cumsum(counts) - counts), counts)
            seen += counts
            extra = [pa.array(np.full(len(shard), task, np.int32)), pa.array(slot)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], schema=pa.schema([*batch.schema, (task_name, pa.int32()), ("slot", pa.int64())]))

    rows = stage(df.mapInArrow(numbered, schema), "numbered")
    counts = rows.groupBy("shard", F.col(task_name).alias("task")).agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.expr(f"task div {TASK_BLOCK}"))
    before = (Window.unboundedPreceding, -1)
    blocks = counts.groupBy("shard", "block").agg(F.sum("n").alias("n"))
    blocks = blocks.select("shard", "block", F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(*before)).alias("base"))
    within = F.sum("n").over(Window.partitionBy("shard", "block").orderBy("task").rowsBetween(*before))
    firsts = counts.select("shard", "block", "task", within.alias("within")).join(blocks, ["shard", "block"])
    firsts = stage(firsts.select("shard", F.col("task").alias(task_name), (F.coalesce("within", F.lit(0)) + F.coalesce("base", F.lit(0))).alias("first")), "firsts")
    few = firsts.count() <= BROADCAST_KEYS
    placed = rows.join(F.broadcast(firsts) if few else firsts, ["shard", task_name])
    return placed.withColumn("slot", F.col("slot") + F.col("first")).select([c for c in schema.names if c != task_name])


def assign(df: DataFrame, key: str, shards: int = SHARDS) -> DataFrame:
    """``df`` with ``shard``, ``slot`` and ``grown_shard``, its shard if there were one more. An empty table gives an empty one."""
    both = df.withColumns({"shard": shard_of(F.col(key), shards), "grown_shard": shard_of(F.col(key), shards + 1)})
    return with_slots(both, shards)


def write_shards(assigned: DataFrame, path: str, file_rows: int = FILE_ROWS) -> DataFrame:
    """Assigned rows as one folder per shard, in slot order within files of ``file_rows`` rows, so a large shard is many tasks' work."""
    dealt = assigned.repartition("shard", F.expr(f"slot div {file_rows}")).sortWithinPartitions("shard", "slot")
    dealt.write.mode("overwrite").option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path)
    return assigned.sparkSession.read.schema(assigned.schema).parquet(path)


def shard_documents(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """A row per document: doc_id, size (UTF-8 bytes and one), text_crc32, law, shard, slot, grown_shard.

    ``doc_id`` is the key; a null text is empty. Other columns of ``documents`` are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    return assign(rows, "doc_id", shards).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
