"""Helpers shared by the operators: shared folder, staged tables, bounded Arrow slices, words."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

SLICE_BYTES = 4 << 20
#: So many 64-bit keys, some MB, may be broadcast.
BROADCAST_KEYS = 200_000
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where all runs on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="llm-"))
    return spark.conf.get("spark.checkpoint.dir")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends at files all executors see."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing will read again."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``text`` alone, a null text as the empty one."""
    return documents.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in row ranges of about ``limit`` bytes of ``column``, so a task holds little at once."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths.astype(np.int64)) // limit
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    for start, end in zip(starts, np.r_[starts[1:], batch.num_rows]):
        yield batch.slice(int(start), int(end - start))


def tidied(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` of a task, after which its worker gives the memory it no longer holds back to the system.

    Spark keeps Python workers for later tasks and stages; without this each keeps the most that any of them took.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(AttributeError, OSError):  # only where the C library can
                ctypes.CDLL(None).malloc_trim(0)

    return run


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased, as UTF-8.

    ``bytes.lower`` touches A-Z alone and ``bytes.split`` cuts at just these white-space bytes.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(31))) * MIX
    return (x ^ (x >> np.uint64(29))) * ODD


def list_column(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """Arrow lists over one flat array."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def without(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``gone``; few keys are broadcast, more are met in a shuffled join."""
    gone = stage(gone.select(key).distinct(), "gone")
    few = gone.count() <= BROADCAST_KEYS
    return df.join(F.broadcast(gone) if few else gone, key, "left_anti")
