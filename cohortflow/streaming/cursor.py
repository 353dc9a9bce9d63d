"""Bounded incremental slices by a saved cursor."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.tables import merge_upsert
from ..sources.files import read_optional, read_version, write_version

CURSOR_SCHEMA = "source_name string, last_key bigint, updated_at timestamp"


def above(df: DataFrame, key: str, after: Column | int | None) -> DataFrame:
    """Rows above the cursor; all rows that have a key where there is no cursor yet."""
    return df.where(F.col(key).isNotNull() if after is None else F.col(key) > after)


def incremental_slice(df: DataFrame, key: str, after: Column | int | None, max_rows: int) -> DataFrame:
    """The next ``max_rows`` rows above the cursor, by a unique, growing key.

    The filter reaches the scan; each task keeps at most ``max_rows`` rows.
    """
    return above(df, key, after).orderBy(key).limit(max_rows)


def next_cursor(part: DataFrame, key: str, source: str, now: Column) -> DataFrame:
    """Cursor row after a slice; no row when the slice is empty."""
    return (
        part.agg(F.max(key).cast("bigint").alias("last_key"))
        .where(F.col("last_key").isNotNull())
        .select(F.lit(source).alias("source_name"), "last_key", now.alias("updated_at"))
    )


def load_cursors(spark: SparkSession, path: str, below: int | None = None) -> DataFrame:
    """Cursors of all sources: one small table, its latest version or the latest below ``below``."""
    cursors = read_version(spark, path, below)
    return spark.createDataFrame([], CURSOR_SCHEMA) if cursors is None else cursors


def cursor_of(cursors: DataFrame, source: str, default: int | None = None) -> int | None:
    """Last key on record; ``default``, by which nothing is skipped, for a source without a cursor."""
    row = cursors.where(F.col("source_name") == source).first()
    return default if row is None else int(row["last_key"])


def save_cursors(cursors: DataFrame, changed: DataFrame, path: str, version: int) -> None:
    """Write the merged cursors as a new version; the old one is never overwritten.

    Cursors that were read from this very version, as by a retry, are read anew from below it.
    """
    if any(f"/version={int(version)}/" in file for file in cursors.inputFiles()):
        cursors = load_cursors(changed.sparkSession, path, below=version)
    merged = merge_upsert(cursors, changed, ["source_name"])
    write_version(merged.coalesce(1), path, version)


def drain(
    spark: SparkSession,
    sources: Mapping[str, tuple[DataFrame, str]],
    path: str,
    max_rows: Mapping[str, int],
    now: Column,
    deliver: Callable[[str, DataFrame], None],
) -> int:
    """Deliver every source in slices until nothing is left above its cursor; returns how many rounds that took.

    ``sources`` names a table and its unique, growing key, ``max_rows`` the rows of a slice. Cursors of all sources are
    saved after each round, so what was delivered before a failure is not read again but for the
    last round's slices: ``deliver`` has to be safe to repeat, or to be told apart by key.
    """
    before = read_optional(spark, path)
    version = -1 if before is None else before.agg(F.max("version").alias("v")).first()["v"]
    rounds = 0
    while True:
        cursors = load_cursors(spark, path)
        moved = []
        for name, (table, key) in sources.items():
            at = cursor_of(cursors, name)
            row = next_cursor(incremental_slice(table, key, at, max_rows[name]), key, name, now).first()
            if row is not None:
                deliver(name, above(table, key, at).where(F.col(key) <= row["last_key"]))
                moved.append(row)
        if not moved:
            return rounds
        version, rounds = version + 1, rounds + 1
        save_cursors(cursors, spark.createDataFrame(moved, CURSOR_SCHEMA), path, version)
