"""Keyed state across micro-batches: one row per key, in hash buckets that are rewritten when touched."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.joins import STATE_COLUMNS
from ..sources.files import SHUFFLES_END, load_if_present, settings

BUCKETS = 64
MARKS = "loaded_at timestamp, run_id string, batch_id bigint"


@dataclass(frozen=True)
class KeyedState:
    """The latest row of each key under ``path``.

    A batch reads and rewrites the buckets of its own keys alone, whatever the number of batches before it; with
    keys spread by their hash a bucket holds about 1/``buckets`` of all keys. The number of buckets is the table's
    for good. A row keeps the load that wrote it and what stood there before, so a load that is
    repeated sees, and leaves, what its first try saw and left.
    """

    path: str
    key: str = "patient_id"
    at: str = "last_admission_date"
    fields: Sequence[str] = STATE_COLUMNS
    types: str = "last_encounter_id string, last_admission_date date, last_discharge_date date, last_los_days int"
    buckets: int = BUCKETS

    def schema(self) -> StructType:
        own = f"{self.types}, {MARKS}"
        return StructType.fromDDL(f"{self.key} string, {own}, before struct<{own}>, bucket int")

    def bucket(self, key: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key) if key is None else key), F.lit(self.buckets)).cast("int")

    def touched(self) -> Column:
        """Aggregate of a batch: its buckets, ``buckets`` numbers at most."""
        return F.collect_set(F.when(F.col(self.key).isNotNull(), self.bucket()))

    def _rows(self, spark: SparkSession, touched: Sequence[int] | None) -> DataFrame:
        rows = load_if_present(spark.read.schema(self.schema()), self.path, "parquet")
        rows = spark.createDataFrame([], self.schema()) if rows is None else rows
        return rows if touched is None else rows.where(F.col("bucket").isin([*touched]))

    def now(self, spark: SparkSession, touched: Sequence[int] | None = None) -> DataFrame:
        """Current rows; of the buckets named, where they are."""
        return self._rows(spark, touched).drop("before", "bucket")

    def earlier(self, spark: SparkSession, load, touched: Sequence[int] | None = None) -> DataFrame:
        """Rows as they stood before ``load``, also when it has written already."""
        mine = (F.col("run_id") == load.run_id) & (F.col("batch_id") == load.batch_id)
        own = [f.name for f in self.schema().fields if f.name not in (self.key, "before", "bucket")]
        rows = self._rows(spark, touched).select(
            self.key, *[F.when(mine, F.col("before")[c]).otherwise(F.col(c)).alias(c) for c in own]
        )
        return rows.where(F.col("run_id").isNotNull())

    def update(self, spark: SparkSession, load, updates: DataFrame, loaded_at: Column, touched: Sequence[int] | None = None) -> None:
        """Rows of ``updates``, unique per key, take their keys' places where their date is not older.

        ``touched`` names the buckets of ``updates`` at least; without it all are rewritten.
        """
        own = [f.name for f in self.schema().fields if f.name not in (self.key, "before", "bucket")]
        marked = updates.where(F.col(self.key).isNotNull()).select(
            self.key,
            F.struct(*self.fields, loaded_at.alias("loaded_at"), F.lit(load.run_id).alias("run_id"), F.lit(load.batch_id).cast("bigint").alias("batch_id")).alias("new"),
        )
        stood = self.earlier(spark, load, touched).select(self.key, F.struct(*own).alias("old"))
        both = marked.join(stood, self.key, "full")
        wins = F.col("new").isNotNull() & ~F.coalesce(F.col(f"old.{self.at}") > F.col(f"new.{self.at}"), F.lit(False))
        wins = wins & ~(F.col(f"new.{self.at}").isNull() & F.col(f"old.{self.at}").isNotNull())
        current = F.when(wins, F.col("new")).otherwise(F.col("old"))
        rows = both.select(self.key, current.alias("row"), F.when(wins, F.col("old")).alias("before"))
        rows = rows.select(self.key, *[F.col("row")[c].alias(c) for c in own], "before", self.bucket().alias("bucket"))
        with settings(spark, SHUFFLES_END):
            (
                rows.repartition("bucket")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("bucket")
                .parquet(self.path)
            )
