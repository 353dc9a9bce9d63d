"""Upserts as DataFrames; writing and committing is the table format's job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .sequence import latest_per_key


def align(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target with the source's new columns added as typed NULLs."""
    missing = [f for f in source.schema.fields if f.name not in target.columns]
    return target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def _same_keys(keys: Sequence[str], null_safe: bool) -> Column:
    def same(k: str) -> Column:
        a, b = F.col(f"t.{k}"), F.col(f"s.{k}")
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(lambda a, b: a & b, [same(k) for k in keys])


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Target rows without a match in the source, plus all source rows.

    The source is unique per key. Columns missing on either side become NULL. With
    ``null_safe`` a NULL key matches a NULL key.
    """
    kept = target.alias("t").join(
        source.select(*keys).alias("s"), _same_keys(keys, null_safe), "left_anti"
    )
    return kept.unionByName(source, allowMissingColumns=True)


def upsert_if_newer(
    target: DataFrame, source: DataFrame, keys: Sequence[str], at: str
) -> DataFrame:
    """Source wins where its date is not older than the target's; other keys stay or enter."""
    both = target.withColumn("_from_source", F.lit(0)).unionByName(
        source.withColumn("_from_source", F.lit(1)), allowMissingColumns=True
    )
    return latest_per_key(both, keys, [at, "_from_source"]).drop("_from_source")


def current_rows(
    log: DataFrame, keys: Sequence[str], order: Sequence[str] = ("loaded_at", "batch_id", "run_id")
) -> DataFrame:
    """Current state of an append-only table: the last load of each key wins.

    Loads of two runs at one time are told apart by ``run_id``, where the table has it.
    """
    return latest_per_key(log, keys, [c for c in order if c != "run_id" or c in log.columns])


def state_updates(silver: DataFrame, key: str = "patient_id") -> DataFrame:
    """Latest encounter per patient as a state row."""
    latest = latest_per_key(
        silver.select(key, "encounter_id", "admission_date", "discharge_date", "los_days"),
        [key],
        ["admission_date", "encounter_id"],
    )
    return latest.select(
        key,
        F.col("encounter_id").alias("last_encounter_id"),
        F.col("admission_date").cast("date").alias("last_admission_date"),
        F.col("discharge_date").cast("date").alias("last_discharge_date"),
        F.col("los_days").cast("int").alias("last_los_days"),
    )


def file_ledger(df: DataFrame, status: str | Column, source: str = "source_file") -> DataFrame:
    """Rows per source, with a hash of the source's name."""
    return (
        df.groupBy(F.col(source).alias("file_name"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumns(
            {
                "file_name_hash": F.sha2("file_name", 256),
                "status": F.lit(status) if isinstance(status, str) else status,
            }
        )
    )


#: Offsets of a log partition that one window group numbers.
OFFSET_BLOCK = 1 << 16


def block_start(offset: Column, block: int = OFFSET_BLOCK) -> Column:
    """First offset of the block of offsets that ``offset`` lies in."""
    return offset - F.pmod(offset, F.lit(block))


def in_blocks(ranges: DataFrame, block: int = OFFSET_BLOCK) -> DataFrame:
    """Ranges cut at the ends of blocks, with the first offset of their ``_block``; a range's first piece keeps its records."""
    starts = F.sequence(block_start(F.col("first_offset"), block), block_start(F.col("last_offset"), block), F.lit(block).cast("bigint"))
    cut = ranges.withColumn("_block", F.explode(starts))
    begin = F.greatest("first_offset", "_block")
    return cut.withColumns(
        {
            "record_count": F.when(begin == F.col("first_offset"), F.col("record_count")).otherwise(F.lit(0)),
            "first_offset": begin,
            "last_offset": F.least(F.col("last_offset"), F.col("_block") + block - 1),
        }
    )


def offset_runs(df: DataFrame, block: int = OFFSET_BLOCK) -> DataFrame:
    """Ranges of consecutive offsets per log partition, without gaps, and the records of each.

    Offsets are numbered within blocks of their values, so a log partition that fills the batch is not one
    task's; ranges that touch across blocks are merged.
    """
    place = ["kafka_topic", "kafka_partition"]
    rows = df.where(F.col("kafka_offset").isNotNull()).groupBy(*place, "kafka_offset").agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.withColumn("_block", block_start(F.col("kafka_offset"), block))
    number = F.row_number().over(Window.partitionBy(*place, "_block").orderBy("kafka_offset"))
    runs = rows.withColumn("_run", F.col("kafka_offset") - number).groupBy(*place, "_block", "_run")
    found = runs.agg(
        F.sum("_n").alias("record_count"), F.min("kafka_offset").alias("first_offset"), F.max("kafka_offset").alias("last_offset")
    )
    return merge_runs(found.drop("_block", "_run"), block)


def merge_runs(runs: DataFrame, block: int = OFFSET_BLOCK) -> DataFrame:
    """Ranges per log partition that neither overlap nor touch.

    A log with gaps may have as many ranges as records, so they are merged within blocks of offsets; only those that
    reach a block's end, two a block at most, meet the others of their log partition.
    """
    place = ["kafka_topic", "kafka_partition"]
    merged = _joined_runs(in_blocks(runs, block), [*place, "_block"])
    at_end = (F.col("first_offset") == F.col("_block")) | (F.col("last_offset") == F.col("_block") + block - 1)
    across = _joined_runs(merged.where(at_end).drop("_block"), place)
    return merged.where(~at_end).drop("_block").unionByName(across)


def _joined_runs(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ranges of the same keys that overlap or touch, as one."""
    ordered = Window.partitionBy(*keys).orderBy("first_offset", "last_offset")
    reached = F.max("last_offset").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = runs.withColumn("_opens", F.when(F.col("first_offset") <= reached + 1, F.lit(0)).otherwise(F.lit(1)))
    numbered = opens.withColumn("_range", F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_range").agg(
        F.sum("record_count").alias("record_count"), F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset")
    ).drop("_range")
