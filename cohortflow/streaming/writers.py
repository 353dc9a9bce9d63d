"""Triggers, checkpoints and idempotent load folders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..sources.files import SHUFFLES_END, load_if_present, read_optional, settings


def with_trigger(writer, mode: str = "availablenow", interval: str = "0 seconds"):
    """Bounded ("availablenow" or "once") or continuous micro-batches."""
    bounded = mode.lower() in ("availablenow", "once")
    return writer.trigger(availableNow=True) if bounded else writer.trigger(processingTime=interval)


def with_checkpoint(writer, path: str):
    return writer.option("checkpointLocation", path)


def stream_to_table(
    df: DataFrame, path: str, checkpoint: str, mode: str = "availablenow",
    partition_by: Sequence[str] = (),
):
    """Append a stream to a Parquet table; the file sink's log keeps it exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return with_checkpoint(with_trigger(writer, mode), checkpoint).start()


@dataclass(frozen=True)
class Load:
    """One micro-batch of one streaming query.

    Every table it touches gets a folder of its own, ``run_id=.../batch_id=...``, which a
    retry overwrites as a whole. What earlier loads wrote is read without it, so a
    retried batch sees exactly what its first attempt saw.
    """

    run_id: str
    batch_id: int

    def folder(self, table: str) -> str:
        return f"{table}/run_id={self.run_id}/batch_id={self.batch_id}"

    def write(
        self, df: DataFrame, table: str, partition_by: Sequence[str] = (), keep: str | None = None, unwritten: Sequence[str] = (), **counts: Column
    ) -> dict:
        """Overwrite the load's folder; partitions get few files, large ones are split.

        Rows where ``keep`` is not true are counted only; neither it nor the columns ``unwritten`` reach the table.

        ``counts`` are aggregates of the rows written, gathered as they are written: in the tasks of the
        last stage, whose results count once however often a task is run.
        """
        if partition_by:
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        seen = Observation() if counts else None
        if seen is not None:
            df = df.observe(seen, *[count.alias(name) for name, count in counts.items()])
        df = (df if keep is None else df.where(keep).drop(keep)).drop(*unwritten)
        with settings(df.sparkSession, SHUFFLES_END):
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.folder(table))
        return seen.get if seen is not None else {}

    def own(self, spark: SparkSession, table: str, schema: StructType | None = None) -> DataFrame | None:
        """What this load has written; with its ``schema`` given, no file is opened to learn it."""
        if schema is None:
            return read_optional(spark, self.folder(table))
        return load_if_present(spark.read.schema(schema), self.folder(table), "parquet")

    def earlier(self, spark: SparkSession, table: str, columns: str | None = None) -> DataFrame | None:
        """Rows of all other loads. ``columns`` (DDL) are those needed: then no footer of a past load is read for its schema."""
        if columns is None:
            rows = read_optional(spark, table, merge_schema=True)
        else:
            rows = load_if_present(spark.read.schema(f"{columns}, run_id string, batch_id bigint"), table, "parquet")
        if rows is None:
            return None
        mine = (F.col("run_id") == self.run_id) & (F.col("batch_id") == self.batch_id)
        return rows.where(~mine)


def run_id_of(spark: SparkSession) -> str:
    """Id of the running streaming query: the same after a restart from its checkpoint.

    Outside a stream there is none; two batches under one made-up id would overwrite each other.
    """
    run_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run_id:
        raise ValueError("give a run_id: this is not a streaming query")
    return run_id
