"""Packing of tokenised documents into sequences of bounded length by best-two-fit.

Pieces of one length are interchangeable, so the plan is made on the histogram of lengths: at most
``capacity`` counts, whatever the number of documents. A bin is filled greedily with the longest
pieces that fit; then its smallest piece gives way to the two unpacked ones that fill the widened
gap best, if they fill it more tightly. The bin found so is repeated as often as the counts allow.
Pieces then take the plan's places by their rank within their length, all in Spark.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortflow.llm.bpe import library_encoder
from cohortflow.llm.common import slices, stage, texts_of, tidied

CAPACITY = 1024
END_ID = 2
#: Rows that one window task ranks; longer runs of one length are dealt to several groups.
RANK_ROWS = 512

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row per piece of each whole text's ids and ``end_id``.

    Documents of up to ``capacity`` ids are one piece. Longer ones are cut into full pieces
    and one shorter piece, which comes first. A null text is empty: one piece, the end id alone.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path)
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[tuple[int, int, int, int, int]] = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = encoder(text or "") + end
                    n = len(ids) // 4
                    edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:])):
                        rows.append((doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return texts_of(df).mapInArrow(tidied(cut), PIECES)


def best_pair(counts: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two available lengths whose sum is the largest that fits ``room``."""
    lengths = np.flatnonzero(counts[: max(room, 0)])
    if not len(lengths):
        return None
    partner = np.searchsorted(lengths, room - lengths, "right") - 1
    good = np.flatnonzero((partner >= 0))
    best = None
    for i in good:
        a, b = int(lengths[i]), int(lengths[partner[i]])
        if a == b and counts[a] < 2:
            if not partner[i]:
                continue
            b = int(lengths[partner[i] - 1])
        if best is None or a + b > best[0] + best[1]:
            best = (a, b)
            if a + b == room:
                break
    return best


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how often), together holding every piece of the histogram once."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] += n
    bins: list[tuple[list[int], int]] = []
    while (left := np.flatnonzero(counts)).size:
        longest = int(left[-1])
        chosen, gap = [longest], capacity - longest
        counts[longest] -= 1
        while gap > 0 and (fits := np.flatnonzero(counts[: gap + 1])).size:
            chosen.append(int(fits[-1]))
            counts[chosen[-1]] -= 1
            gap -= chosen[-1]
        if gap and len(chosen) > 1:
            smallest = chosen[-1]
            pair = best_pair(counts, gap + smallest)
            if pair and sum(pair) > smallest:
                chosen[-1:] = sorted(pair, reverse=True)
                counts[smallest] += 1
                for length in pair:
                    counts[length] -= 1
        used = np.bincount(chosen, minlength=capacity + 1)
        which = np.flatnonzero(used)
        more = int((counts[which] // used[which]).min())
        counts -= more * used
        bins.append((chosen, more + 1))
    return bins


def places(bins: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """For each length its places in rank order: (first rank, first sequence, offset) of every run."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for lengths, times in bins:
        offset = 0
        for length in lengths:
            rank = taken.get(length, 0)
            runs.setdefault(length, []).append((rank, sequence, offset))
            taken[length] = rank + times
            offset += length
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in runs.items()}


def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``rank`` (from 0) of each piece within its length, without a task that sees a whole length."""
    spark = pieces.sparkSession
    split = spark.createDataFrame(
        [(length, -(-n // RANK_ROWS)) for length, n in histogram.items()], "length bigint, groups bigint"
    )
    dealt = pieces.join(F.broadcast(split), "length").withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "piece"), F.col("groups"))
    )
    sizes = dealt.groupBy("length", "group").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "group").orderBy("doc_id", "piece", "start")
    return (
        dealt.withColumn("rank", F.row_number().over(own) - 1)
        .join(bases, ["length", "group"])
        .withColumn("rank", F.col("rank") + F.col("base"))
        .drop("group", "groups", "base")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs doc_id, piece, start and length (1 to ``capacity``).

    ``pieces`` is read three times, so give a written table. Repeated rows are packed each for itself.
    An empty table gives an empty result.
    """
    histogram = {
        row.length: row.n
        for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # capacity rows at most
    }
    runs = places(plan_bins(histogram, capacity))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            values, first = np.unique(lengths[order], return_index=True)
            for length, rows in zip(values.tolist(), np.split(order, first[1:])):
                table = runs[length]
                run = np.searchsorted(table[:, 0], ranks[rows], "right") - 1
                sequence[rows] = table[run, 1] + ranks[rows] - table[run, 0]
                offset[rows] = table[run, 2]
            keep = [name for name in batch.schema.names if name != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), pa.array(sequence), pa.array(offset)],
                [*keep, "sequence_id", "offset"],
            )

    if not histogram:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")})
    rows = ranked(pieces, histogram)
    schema = rows.drop("rank").withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")}).schema
    return rows.mapInArrow(tidied(placed), schema)


def pack_documents(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """All documents in as few sequences of at most ``capacity`` ids as best-two-fit finds.

    A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    return pack(stage(cut_pieces(documents, path, capacity, end_id), "pieces"), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
