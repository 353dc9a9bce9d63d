"""Enrichment, restriction, rate and keyed-state joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scores import percentage
from .sequence import RETURN_WINDOW_DAYS, is_return
from .skew import hot_keys, salted_join
from .tables import OFFSET_BLOCK, block_start, in_blocks


def combine_features(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """One wide table from feature tables that are unique per key."""
    return reduce(lambda a, b: a.join(b, key, "full"), tables)


def enrich(
    rows: DataFrame,
    by_row: Sequence[DataFrame] = (),
    by_subject: Sequence[DataFrame] = (),
    row_key: str = "encounter_id",
    subject_key: str = "patient_id",
    hot: DataFrame | None = None,
    **skew,
) -> DataFrame:
    """Left-join feature tables, all unique per key, so no row is multiplied.

    Subject tables are first combined among themselves; the rows meet them, while they are narrow, in a single join that
    splits hot subjects. ``rows`` is unique per ``row_key``, so the other joins cannot be skewed and share one
    partitioning. Hot subjects are counted on ``rows``; ``hot`` gives them where a cheaper frame than ``rows`` tells them.
    """
    out, order = rows, rows.columns
    if by_row:
        order = [row_key, *[c for t in (rows, *by_row) for c in t.columns if c != row_key]]
    if by_subject:
        wide = combine_features(by_subject, subject_key)
        hot = hot_keys(rows, [subject_key], **skew) if hot is None else hot
        out = salted_join(out, wide, [subject_key], "left", spread=[row_key], hot=hot)
        order = [subject_key, *[c for c in (*order, *wide.columns) if c != subject_key]]
    return reduce(lambda a, b: a.join(b, row_key, "left"), by_row, out).select(*order)


#: Tasks over which a source that fills most of a batch is spread when it meets a ledger.
SEEN_PIECES = 32
SEEN = "_seen"


def mark_seen(
    df: DataFrame, ledger: DataFrame, columns: Sequence[str], within: Column | None = None, pieces: int = SEEN_PIECES
) -> DataFrame:
    """``df`` with ``_seen``: whether the ledger, which has columns of the same names, knows a row's source.

    ``within`` is a further condition on the ledger's columns, true for one of its rows at most. The
    ledger is small beside a batch, so it is copied to fixed pieces and every source is dealt over
    them: one that fills most of the batch is split without a pass that counts it first.
    """
    known = ledger.withColumns({SEEN: F.lit(True), "_deal": F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))})
    named = {c: f"_of_{c}" for c in columns}
    known = known.withColumnsRenamed(named)
    on = [F.col(c) == F.col(n) for c, n in named.items()] + [F.col("_row_deal") == F.col("_deal")] + ([] if within is None else [within])
    spread = [c for c, t in df.dtypes if not t.startswith("map")]
    dealt = df.withColumn("_row_deal", F.pmod(F.xxhash64(*spread), F.lit(pieces)).cast("int"))
    met = dealt.join(known, reduce(lambda a, b: a & b, on), "left")
    return met.select(*df.columns, F.coalesce(SEEN, F.lit(False)).alias(SEEN))


def skip_seen(df: DataFrame, ledger: DataFrame, column: str, ledger_column: str) -> DataFrame:
    """Rows whose source is not in the ledger; one file may hold most of the batch."""
    seen = ledger.select(F.col(ledger_column).alias(column)).distinct()
    return mark_seen(df, seen, [column]).where(~F.col(SEEN)).drop(SEEN)


LOG_PLACE = ("kafka_topic", "kafka_partition")


def mark_seen_offsets(df: DataFrame, ranges: DataFrame, block: int = OFFSET_BLOCK) -> DataFrame:
    """``df`` with ``_seen``: whether a row's offset lies in one of the ranges, which do not overlap.

    A log with gaps may have as many ranges as records, so they are not copied: rows and ranges are dealt by blocks of
    offsets, and in a block's order the furthest end so far tells. Rows without a place in the log are dealt by their hash.
    """
    offset = F.col("kafka_offset")
    placed = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in (*LOG_PLACE, "kafka_offset")))
    spread = [c for c, t in df.dtypes if not t.startswith("map")]
    rows = df.withColumns(
        {
            "_deal": F.when(placed, F.lit(0)).otherwise(F.pmod(F.xxhash64(*spread), F.lit(1 << 30)).cast("int")),
            "_block": block_start(offset.cast("bigint"), block),
            "_at": offset.cast("bigint"),
            "_is_row": F.lit(True),
        }
    )
    known = in_blocks(ranges.select(*LOG_PLACE, "record_count", "first_offset", "last_offset"), block).select(
        *LOG_PLACE, F.lit(0).alias("_deal"), "_block", F.col("first_offset").alias("_at"), F.col("last_offset").alias("_end"), F.lit(False).alias("_is_row")
    )
    ordered = Window.partitionBy(*LOG_PLACE, "_block", "_deal").orderBy("_at", "_is_row")
    reached = F.max("_end").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    met = rows.unionByName(known, allowMissingColumns=True).withColumn(SEEN, placed & F.coalesce(reached >= F.col("_at"), F.lit(False)))
    return met.where("_is_row").select(*df.columns, SEEN)


def upsert_counts(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many source rows update an existing key and how many insert a new one.

    The source is unique per key. The target is the streamed side: a source small enough
    to be broadcast spares it the shuffle.
    """
    keys = list(keys)
    matched = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    updated = matched.agg(F.count(F.lit(1))).scalar()
    return source.agg(F.count(F.lit(1)).alias("_n")).select(
        updated.alias("records_updated"), (F.col("_n") - updated).alias("records_inserted")
    )


def restrict_to(df: DataFrame, population: DataFrame, key: str, **skew) -> DataFrame:
    """Rows whose key occurs in the population."""
    return salted_join(df, population.select(key).distinct(), [key], "left_semi", **skew)


def before_event(
    history: DataFrame, events: DataFrame, key: str, at: str, event_at: str, **skew
) -> DataFrame:
    """History rows that began by the key's event; an unknown start counts as before it.

    ``events`` has one row per key.
    """
    joined = salted_join(history, events, [key], "inner", **skew)
    return joined.where(F.col(at).isNull() | (F.col(at) <= F.col(event_at)))


def with_rate(
    base: DataFrame, part: DataFrame, key: str, whole: str, count: str, rate: str
) -> DataFrame:
    """Attach a partial count (0 where absent) and its percentage of the whole."""
    filled = base.join(part, key, "left").withColumn(count, F.coalesce(F.col(count), F.lit(0)))
    return filled.withColumn(rate, percentage(F.col(count), F.col(whole)))


STATE_COLUMNS = ("last_encounter_id", "last_admission_date", "last_discharge_date", "last_los_days")


def attach_state(
    df: DataFrame,
    state: DataFrame | None,
    key: str = "patient_id",
    window_days: int = RETURN_WINDOW_DAYS,
    **skew,
) -> DataFrame:
    """Gap to the last discharge on record and the return flag known on arrival."""
    if state is None:
        nothing = [F.lit(None).cast("date"), F.lit(None).cast("int"), F.lit(0)]
        return df.select("*", *_state_outputs(*nothing))
    joined = salted_join(df, state.select(key, *STATE_COLUMNS), [key], "left", **skew)
    return state_told(joined, window_days)


def _state_outputs(discharge: Column, gap: Column, flagged: Column) -> list[Column]:
    return [
        discharge.alias("previous_discharge_date"),
        gap.alias("days_since_previous_discharge"),
        flagged.alias("is_readmitted_online"),
    ]


def state_told(joined: DataFrame, window_days: int = RETURN_WINDOW_DAYS) -> DataFrame:
    """Rows that carry their subject's state with what it tells in its place."""
    gap = F.datediff("admission_date", "last_discharge_date")
    told = _state_outputs(F.col("last_discharge_date"), gap, is_return(gap, F.col("last_los_days"), window_days))
    return joined.select(*[c for c in joined.columns if c not in STATE_COLUMNS], *told)
