"""Latest-per-key, top-N per group and previous-event sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scores import flag
from .skew import HOT_SHARE, MIN_HOT_ROWS, PIECES, piece_rows

# Rankings up to this size are cut on the map side by the optimizer itself
# (default of spark.sql.optimizer.windowGroupLimitThreshold).
MAP_SIDE_LIMIT = 1000
RETURN_WINDOW_DAYS = 30


def _desc(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc() for c in columns]


def top_n_per_group(
    df: DataFrame,
    groups: Sequence[Column | str],
    order: Sequence[Column],
    n: int,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """First ``n`` rows of each group under a total order.

    Up to ``MAP_SIDE_LIMIT`` rows the plan cuts every group in each map task, so a hot
    group never travels whole. Larger ``n`` gets the same effect from a first cut
    within (group, piece); ``spread`` names the columns that deal rows to pieces.
    """

    def cut(frame: DataFrame, by) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order)
        return frame.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n)

    if n > MAP_SIDE_LIMIT:
        cols = spread or [c for c, t in df.dtypes if not t.startswith("map")]
        piece = F.pmod(F.xxhash64(*cols), F.lit(256))
        df = cut(df.withColumn("_piece", piece), [*groups, "_piece"]).drop("_rank", "_piece")
    return cut(df, groups).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values of each key."""
    return top_n_per_group(df, keys, _desc(order), 1)


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the smallest under a total order (not an arbitrary survivor)."""
    return top_n_per_group(df, keys, [F.col(c).asc() for c in order], 1)


def dedup_events(
    df: DataFrame, key: str = "event_id", order=("kafka_timestamp", "kafka_offset")
) -> DataFrame:
    """Latest delivery per event id; rows without an id are all kept for validation.

    Such rows get their own log coordinates as key, so they neither collapse to one
    row nor meet in one task.
    """
    no_id = F.col(key).isNull() | (F.trim(F.col(key)) == "")
    own = F.when(no_id, F.concat_ws("/", "kafka_topic", "kafka_partition", "kafka_offset"))
    return top_n_per_group(df, [F.when(~no_id, F.col(key)), own], _desc(order), 1)


def latest_by_natural_key(
    df: DataFrame,
    fields: Sequence[str],
    payload: str = "payload",
    order=("kafka_timestamp", "kafka_partition", "kafka_offset"),
) -> DataFrame:
    """Latest payload per natural key, with hashes of the key and of the record.

    The key hash covers the JSON array of the key fields (NULL reads as empty text); the
    record hash covers the payload's entries in key order.
    """
    values = [F.coalesce(F.col(payload).getItem(f), F.lit("")) for f in fields]
    entries = F.map_from_entries(F.array_sort(F.map_entries(payload)))
    keyed = df.withColumns(
        {
            "record_key": F.sha2(F.to_json(F.array(*values)), 256),
            "record_hash": F.sha2(F.to_json(entries), 256),
        }
    )
    return latest_per_key(keyed, ["record_key"], order)


#: Rows of a hot key looked at for each cut of its order.
ROWS_PER_CUT = 32


def range_cuts(df: DataFrame, key: str, order: Sequence[str], share: float, min_rows: int, few: bool = True) -> DataFrame:
    """Hot keys of ``df`` (NULL may be one) as ``_hot``, with values of ``order`` that cut their rows into ranges of like size.

    Cuts come from a part of the rows, taken by their hash so that a re-run takes the same; they decide where a
    range ends and never what is in the result. Hot keys are few and the cuts of all of them are some
    thousand, so the table may be broadcast; unless ``few`` is false, for a ``share`` that bounds neither: then rows
    meet their hot keys by a shuffle. Cuts lie in groups, so a row is compared with few of them.
    """
    counts = df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    rows = piece_rows(counts, share, min_rows)
    pieces, every = F.ceil(F.col("_n") / rows).cast("int"), F.greatest((rows / ROWS_PER_CUT).cast("bigint"), F.lit(1))
    hot = counts.where(F.col("_n") > rows).select("_hot", pieces.alias(PIECES), every.alias("_every"))
    met = df.select(F.col(key).alias("_key"), F.struct(*order).alias("_at"))
    met = met.join(F.broadcast(hot), F.col("_key").eqNullSafe(F.col("_hot"))) if few else met.join(hot, F.col("_key") == F.col("_hot"))
    part = met.where(F.pmod(F.xxhash64("_at"), F.col("_every")) == 0).groupBy("_hot")
    sampled = part.agg(F.array_sort(F.collect_set("_at")).alias("_all"), F.max(PIECES).alias(PIECES))
    step = F.greatest(F.ceil(F.size("_all") / F.col(PIECES)).cast("int"), F.lit(1))
    cuts = F.filter("_all", lambda x, i: (i > 0) & (i % step == 0))
    cut = sampled.select("_hot", cuts.alias("_cuts"), F.ceil(F.sqrt(PIECES)).cast("int").alias("_width")).where(F.size("_cuts") > 0)
    firsts = F.sequence(F.lit(1), F.size("_cuts"), F.col("_width"))
    return cut.select("_hot", "_width", F.transform(firsts, lambda i: F.slice("_cuts", i, F.col("_width"))).alias("_groups"))


def _piece(at: Column) -> Column:
    """How many of its key's cuts a row has reached: its range, from 0."""
    group = F.size(F.filter("_groups", lambda g: g[0] <= at))
    inside = F.size(F.filter(F.get("_groups", group - 1), lambda cut: cut <= at))
    return F.when(F.col("_groups").isNotNull(), F.when(group > 0, (group - 1) * F.col("_width") + inside).otherwise(F.lit(0)))


def _within_ranges(rows: DataFrame, key: str, at: str, tie: str, row: Column, share: float, min_rows: int) -> DataFrame:
    """``rows`` with ``_within``, the row before in the same key and ``_piece``, from ranges of every key and piece that is hot by ``share``.

    Cuts and last rows are as many as the hot keys, so rows meet them by shuffles: once by key and piece, once by range. A key
    and piece has no more rows than ``HOT_SHARE`` of all, so no task gets a large part of them.
    """
    # A struct equals another with NULL in the same place, so rows without a key meet theirs.
    told = rows.withColumn("_group", F.struct(key, "_piece"))
    cuts = range_cuts(told, "_group", [at, tie], share, min_rows, few=False)
    met = told.join(cuts, F.col("_group") == F.col("_hot"), "left")
    is_hot = F.col("_hot").isNotNull().alias("_is_hot")
    dealt = met.select(*rows.columns, "_group", is_hot, _piece(F.struct(at, tie)).alias("_part")).repartition("_group", "_part")
    within = dealt.withColumn("_within", F.lag(row).over(Window.partitionBy("_group", "_part").orderBy(at, tie)))

    last = dealt.where("_is_hot").groupBy("_group", "_part").agg(F.max_by(row, F.struct(at, tie)).alias("_last"))
    before = F.lag("_last").over(Window.partitionBy("_group").orderBy("_part"))
    handed = last.select(F.col("_group").alias("_of"), F.col("_part").alias("_after"), before.alias("_from")).where("_from is not null")
    own = (F.col("_group") == F.col("_of")) & (F.col("_part") == F.col("_after"))
    return within.join(handed, own, "left").select(*rows.columns, F.coalesce("_within", "_from").alias("_within"))


def previous_event(
    df: DataFrame,
    key: str,
    at: str,
    tie: str,
    carry: Sequence[str],
    prefix: str = "prev_",
    share: float = HOT_SHARE,
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Columns of the key's previous row, in (``at``, ``tie``) order; rows without a key follow each other too.

    An ordinary key is one window group. A hot key's order is cut into ranges of like size, also
    within one day: each range is its own window group, and the last row of the range before is
    handed to a range's first row through a table of one row per range. The rows are shuffled once.

    With a ``share`` below ``HOT_SHARE`` as many keys may be hot as the data has. Ranges of ``HOT_SHARE`` are cut first, by a table
    that is small whatever the data; within them keys are cut by ``share``, and nothing of that is broadcast.
    """
    few = max(share, HOT_SHARE)
    cuts = F.broadcast(range_cuts(df, key, [at, tie], few, min_rows))
    hot = F.col(key).eqNullSafe(F.col("_hot"))
    piece = _piece(F.struct(at, tie)).alias("_piece")
    row = F.struct(*carry)
    rows = df.join(cuts, hot, "left").select(*df.columns, piece)
    if share < HOT_SHARE:
        within = _within_ranges(rows, key, at, tie, row, share, min_rows)
    else:
        within = rows.withColumn("_within", F.lag(row).over(Window.partitionBy(key, "_piece").orderBy(at, tie)))

    last = df.join(cuts, hot).select("_hot", piece, row.alias("_row"), F.struct(at, tie).alias("_at"))
    last = last.groupBy("_hot", "_piece").agg(F.max_by("_row", "_at").alias("_last"))
    before = F.lag("_last").over(Window.partitionBy("_hot").orderBy("_piece"))
    handed = last.select("_hot", F.col("_piece").alias("_after"), before.alias("_handed"))

    own = hot & (F.col("_piece") == F.col("_after"))
    before = F.coalesce("_within", "_handed")
    return within.join(F.broadcast(handed), own, "left").select(
        *df.columns, *[before.getField(c).alias(f"{prefix}{c}") for c in carry]
    )


def is_return(gap_days: Column, last_stay: Column, window_days: int = RETURN_WINDOW_DAYS) -> Column:
    """1 when a stay begins 1..window days after the last discharge from a real stay."""
    return flag(gap_days.between(1, window_days) & (last_stay > 0))


def return_sequence(
    df: DataFrame,
    key: str = "patient_id",
    window_days: int = RETURN_WINDOW_DAYS,
    share: float = HOT_SHARE,
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Previous admission, discharge and stay of the same patient, gaps and return flag."""
    carry = ["admission_date", "discharge_date", "los_days"]
    paired = previous_event(
        df, key, "admission_date", "encounter_id", carry, "_p_", share, min_rows
    )
    since = F.datediff("admission_date", "_p_discharge_date")
    return paired.select(
        *df.columns,
        F.col("_p_admission_date").alias("prev_admission"),
        F.col("_p_discharge_date").alias("prev_discharge"),
        F.col("_p_los_days").alias("prev_los"),
        F.datediff("admission_date", "_p_admission_date").alias("return_gap_days"),
        since.alias("days_since_discharge"),
        is_return(since, F.col("_p_los_days"), window_days).alias("is_readmitted_30d"),
    )


def balanced_top_n(
    df: DataFrame, band: str = "risk_band", score: str = "risk_score", tie: str = "patient_id",
    n: int = 250,
) -> DataFrame:
    """Up to ``n`` highest-scored rows of every band, NULL bands as one band."""
    group = F.coalesce(F.col(band), F.lit("UNKNOWN"))
    return top_n_per_group(df, [group], [F.col(score).desc(), F.col(tie)], n, spread=[tie])
