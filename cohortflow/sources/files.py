"""Delimited files and tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.tables import merge_upsert

CORRUPT = "_corrupt_record"

# Column names of the patient file.
PATIENT_FIELDS = [
    "ID",
    "BIRTHDATE",
    "DEATHDATE",
    "SSN",
    "DRIVERS",
    "PASSPORT",
    "PREFIX",
    "FIRST",
    "LAST",
    "SUFFIX",
    "MAIDEN",
    "MARITAL",
    "RACE",
    "ETHNICITY",
    "GENDER",
    "BIRTHPLACE",
    "ADDRESS",
]


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for a while; those before come back."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: For a write whose shuffles nobody reads again: their files go as it ends, not when the driver's garbage is next collected.
SHUFFLES_END = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def text_schema(fields: Sequence[str]) -> StructType:
    return StructType([StructField(f, StringType(), True) for f in fields])


# Conditions under which a table or file counts as absent.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def load_if_present(reader: DataFrameReader, path: str, fmt: str) -> DataFrame | None:
    """Load a path on whatever file system it names; None when there is nothing there."""
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return None
        raise


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one the cluster names.

    Only in a local session where ``spark.checkpoint.dir`` is unset, as in tests, a temporary
    folder is made, once, and set as the session's checkpoint folder. On a cluster an unset
    folder is an error: executors would each write to a disk of their own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not named:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cohortflow-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def _header_groups(spark: SparkSession, path: str) -> list[str | list[str]]:
    """What to read together: the whole path, or its files grouped by their header lines.

    One pass over the text in which only the first line of each file leaves its task. Files
    that differ are listed on the driver, where Spark's own file index holds them already.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"),
    )
    headers = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("header"))
    if headers.select("header").distinct().limit(2).count() < 2:
        return [path]
    groups: dict[str, list[str]] = {}
    for row in headers.orderBy("file").toLocalIterator():
        plain = re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(row["file"]))
        groups.setdefault(row["header"], []).append(plain)
    return list(groups.values())


def _read_groups(spark: SparkSession, path: str, read: Callable[..., DataFrame]) -> DataFrame | None:
    """``read`` applied to each group of files with one header; absent columns become NULL."""
    if load_if_present(spark.read, path, "text") is None:
        return None
    parts = [read(group) for group in _header_groups(spark, path)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _with_fields(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    absent = {f: F.lit(None).cast("string") for f in fields if f not in rows.columns}
    return rows.withColumns(absent) if absent else rows


def read_csv_upper(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame | None:
    """Header CSV as text columns with upper-case names; None when the path is absent.

    Columns are bound by the header of their own file, so files of one folder may order them
    differently. A given schema adds absent columns as NULL.
    """

    def read(files) -> DataFrame:
        raw = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(files)
        return raw.toDF(*[c.upper() for c in raw.columns])

    rows = _read_groups(spark, path, read)
    if rows is None or schema is None:
        return rows
    return _with_fields(rows, schema.names).select(*schema.names)


def read_csv_tagged(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame | None:
    """Rows of a header CSV with ``_corrupt_record``, the whole line of a malformed row; None when the path is absent.

    Each file's header names its columns, so a re-ordered file reads right.
    """

    def read(files) -> DataFrame:
        header = spark.read.option("header", True).csv(files).columns
        rows = (
            spark.read.schema(text_schema([*[c.upper() for c in header], CORRUPT]))
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(files)
        )
        # Always true, but it keeps every field in the scan: a pruned row is not seen to be malformed.
        return rows.where(F.length(F.concat_ws("", *rows.columns[:-1])) >= 0)

    rows = _read_groups(spark, path, read)
    return None if rows is None else _with_fields(rows, fields).select(*fields, CORRUPT)


def read_csv_with_quarantine(
    spark: SparkSession, path: str, fields: Sequence[str], now: Column
) -> tuple[DataFrame, DataFrame] | None:
    """Readable rows and malformed rows of a header CSV; None when the path is absent.

    Both parts can be counted or narrowed without a change of the rows they hold.
    """
    rows = read_csv_tagged(spark, path, fields)
    if rows is None:
        return None
    good = rows.where(F.col(CORRUPT).isNull()).select(*fields)
    bad = rows.where(F.col(CORRUPT).isNotNull()).select(*fields, CORRUPT)
    return good, bad.withColumn("quarantine_timestamp", now)


def read_optional(
    spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False
) -> DataFrame | None:
    """A table, or None when it has not been written yet or holds no data file.

    ``merge_schema`` reads every file's footer; ask for it only after a schema change.
    """
    reader = spark.read.option("mergeSchema", True) if merge_schema else spark.read
    return load_if_present(reader, path, fmt)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").option("mergeSchema", True).save(path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite rows and schema; ``df`` must not read from ``path``."""
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", True).save(path)


def write_partitioned(
    df: DataFrame, path: str, columns: Sequence[str], fmt: str = "parquet"
) -> None:
    """Replace only the partitions the frame holds.

    Rows are rebalanced by partition first, so each partition gets few, large files and
    a dominant one is still split over tasks.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in columns])
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .save(path)
    )


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Write a table as a version next to older ones, which ``df`` may read.

    ``df`` must not read the version itself: a retry replaces what the first try left of it.
    """
    df.write.mode("overwrite").parquet(f"{path}/version={int(version)}")


def read_version(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    """The latest version of a table, or the latest one below ``below``, with its own schema.

    A job that writes version n reads versions below n, so its retry sees what its first try saw.
    """
    versions = read_optional(spark, path)
    if versions is None:
        return None
    if below is not None:
        versions = versions.where(F.col("version") < below)
    latest = versions.agg(F.max("version").alias("v")).first()["v"]
    return None if latest is None else spark.read.parquet(f"{path}/version={latest}")


BUCKET = "_bucket"
KEY_BUCKETS = 64


def read_buckets(spark: SparkSession, path: str, touched: Sequence[int] | None = None) -> DataFrame | None:
    """A table kept in buckets of its keys, or those of its buckets that are named; None when there is none yet."""
    rows = read_optional(spark, path, merge_schema=True)
    if rows is None:
        return None
    return (rows if touched is None else rows.where(F.col(BUCKET).isin([*touched]))).drop(BUCKET)


def publish_upsert(source: DataFrame, path: str, keys: Sequence[str], buckets: int = KEY_BUCKETS) -> list[int]:
    """Upsert rows, unique per key, into a table kept in hash buckets of its keys; returns the buckets rewritten.

    Buckets that hold no key of ``source`` are neither read nor written. A NULL key matches a NULL key; columns that
    one side lacks become NULL. The number of buckets is the table's for good. Repeating the upsert leaves the same
    rows, also after a try that broke off between two buckets. ``source`` is written once beforehand, so it
    is not worked out again to learn its buckets.
    """
    spark = source.sparkSession
    staged = f"{work_dir(spark)}/cohortflow/{spark.sparkContext.applicationId}/upsert-{uuid.uuid4().hex}"
    placed = source.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    seen = Observation()
    placed.observe(seen, F.collect_set(BUCKET).alias("touched")).write.parquet(staged)
    touched = sorted(seen.get["touched"])  # ``buckets`` numbers at most
    fresh = spark.read.schema(placed.schema).parquet(staged).drop(BUCKET)
    standing = read_buckets(spark, path, touched)
    merged = fresh if standing is None else merge_upsert(standing, fresh, keys, null_safe=True)
    if touched:
        write_partitioned(merged.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), path, [BUCKET])
    return touched


def merge_into(source: DataFrame, table: str, keys: Sequence[str]) -> None:
    """The same upsert into a catalog table whose format has MERGE, by Spark's own ``mergeInto``."""
    same = reduce(lambda a, b: a & b, [F.col(f"source.{k}").eqNullSafe(F.col(f"{table}.{k}")) for k in keys])
    source.alias("source").mergeInto(table, same).whenMatched().updateAll().whenNotMatched().insertAll().withSchemaEvolution().merge()


def register_views(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> list[str]:
    """Temporary views over the tables that exist; returns the names registered."""
    made = []
    for name, path in paths.items():
        table = read_optional(spark, path, fmt)
        if table is not None:
            table.createOrReplaceTempView(name)
            made.append(name)
    return made
