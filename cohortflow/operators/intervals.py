"""Events against date intervals of the same key, without pairing whole groups.

Only dates between the first and the last event matter, so days are numbered from the first
event and intervals are cut to that range. The days form a tree of fan-out 4: a node of
level k spans 4**k days. An interval is the disjoint union of a few nodes (its cover), a
day lies in exactly one node per level (its path). So "interval holds day" turns into
equality of one node id, matched exactly once: a plain hash join with no range residual.
Because either side can first be combined per (key, node), a key with a third of all rows
costs no more than its number of distinct days.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .skew import salted_join

LEVELS = 12  # enough for every date from year 1 to 9999
WIDTH = 4**LEVELS  # distance between the node ids of two levels
LAST_DAY = "9999-12-31"


@dataclass(frozen=True)
class Calendar:
    """The range of event dates, as scalars of the plan: nothing is collected."""

    first: Column
    last: Column

    @classmethod
    def of(cls, events: DataFrame, at: str) -> Calendar:
        dates = events.select(F.col(at).cast("date").alias("d"))
        return cls(dates.agg(F.min("d")).scalar(), dates.agg(F.max("d")).scalar())

    def number(self, col: Column) -> Column:
        return F.datediff(col, self.first)

    @property
    def days(self) -> Column:
        return F.coalesce(F.datediff(self.last, self.first), F.lit(0)) + 1


def _levels(days: Column) -> Column:
    """Levels of the tree whose nodes are no longer than ``days``, and one more."""
    fitting = F.log(4.0, F.greatest(days, F.lit(1))).cast("int") + 1
    return F.sequence(F.lit(0), F.least(fitting, F.lit(LEVELS - 1)))


def with_path(df: DataFrame, at: str, calendar: Calendar, out: str = "_node") -> DataFrame:
    """One row per tree node on the path of the row's date."""
    day = calendar.number(F.col(at))
    located = df.withColumns({"_d": day, "_k": F.explode(_levels(calendar.days))})
    node = F.expr(f"_k * {WIDTH} + shiftright(_d, 2 * _k)")
    return located.withColumn(out, node).drop("_d", "_k")


def with_cover(
    df: DataFrame, start: str, stop: str, calendar: Calendar, out: str = "_node"
) -> DataFrame:
    """One row per tree node of the interval [start, stop]; none if it misses the calendar.

    On level k the interval still to be covered is [lo, hi); the nodes left and right of the
    part that whole parents cover, at most three on either side, belong to the cover.
    """
    begin = F.greatest(calendar.number(F.col(start)), F.lit(0))
    end = F.least(calendar.number(F.col(stop)) + 1, calendar.days)
    cut = df.withColumns({"_b": begin, "_e": end}).where("_b < _e")
    at = cut.withColumn("_k", F.explode(_levels(F.col("_e") - F.col("_b")))).selectExpr(
        "*",
        "shiftright(_b + shiftleft(1, 2 * _k) - 1, 2 * _k) as _lo",
        "shiftright(_e, 2 * _k) as _hi",
        "4 * shiftright(_b + shiftleft(1, 2 * _k + 2) - 1, 2 * _k + 2) as _up",
        "4 * shiftright(_e, 2 * _k + 2) as _down",
    )
    lo, hi, up, down = (F.col(c) for c in ("_lo", "_hi", "_up", "_down"))
    left_end = F.least(up, hi)
    right = F.greatest(down, left_end)
    ids = [F.when(lo + i < left_end, lo + i) for i in range(3)]
    ids += [F.when(right + i < hi, right + i) for i in range(3)]
    nodes = at.where(lo < hi).withColumn("_id", F.explode(F.array(*ids)))
    return (
        nodes.where(F.col("_id").isNotNull())
        .withColumn(out, F.col("_k") * WIDTH + F.col("_id"))
        .select(*df.columns, out)
    )


def closed(spans: DataFrame, start: str, stop: str) -> DataFrame:
    """Usable spans: a start, and a stop that is open (taken as the last day) or not earlier."""
    end = F.coalesce(F.col(stop), F.lit(LAST_DAY).cast("date"))
    return spans.withColumn(stop, end).where(F.col(start) <= F.col(stop))


#: Events of a key, and its spans, up to which every date is held against every span of the key.
PAIRED_EVENTS = 256
PAIRED_SPANS = 1_000_000


def active_interval_join(
    events: DataFrame,
    spans: DataFrame,
    key: str,
    event_id: str,
    at: str,
    start: str,
    stop: str,
    how: str = "left",
    paired_events: int = PAIRED_EVENTS,
    paired_spans: int = PAIRED_SPANS,
) -> DataFrame:
    """Every (event, span) of one key where the span holds the event's date.

    A key's dates meet its spans in one join by key, so either side is shuffled once, as it is. Keys of more than
    ``paired_events`` events or ``paired_spans`` spans could make that work grow with its square; theirs go through the tree, where
    it follows the number of matches, as do events whose id comes again. ``left`` keeps events without any span.
    ``event_id`` has to be unique; spans must not share column names with events
    other than ``key``.
    """
    if how not in ("inner", "left"):
        return _tree_join(events, spans, key, event_id, at, start, stop, how)

    def over(df: DataFrame, column: str, most: int) -> DataFrame:
        counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        return counts.where(F.col("_n") > most).select(column)

    large = over(events, key, paired_events).unionByName(over(spans, key, paired_spans)).distinct()
    again = over(events, event_id, 1)
    apart, rest, ordinary = [], events, spans
    if not again.isEmpty():
        apart.append(events.join(again, event_id, "left_semi"))
        rest = rest.join(again, event_id, "left_anti")
    if not large.isEmpty():
        apart.append(rest.join(large, key, "left_semi"))
        rest, ordinary = rest.join(large, key, "left_anti"), spans.join(large, key, "left_anti")
    found = _paired_join(rest, ordinary, key, event_id, at, start, stop, how)
    for some in apart:
        theirs = spans.join(some.select(key).distinct(), key, "left_semi")
        found = found.unionByName(_tree_join(some, theirs, key, event_id, at, start, stop, how))
    return found


def _paired_join(
    events: DataFrame, spans: DataFrame, key: str, event_id: str, at: str, start: str, stop: str, how: str
) -> DataFrame:
    """The same by one join by key. Events without id, key or date meet nothing and stay where they are."""
    values = [c for c in spans.columns if c != key]
    usable = closed(spans.withColumn("_stop", F.col(stop)), start, "_stop").where(F.col(key).isNotNull())
    placed = F.col(event_id).isNotNull() & F.col(key).isNotNull() & F.col(at).isNotNull()
    held = (F.col(key) == F.col("_of")) & (F.col(at) >= F.col(start)) & (F.col(at) <= F.col("_stop"))
    columns = [event_id, *[c for c in events.columns if c != event_id], *values]
    found = events.where(placed).join(usable.withColumnRenamed(key, "_of"), held, how).select(*columns)
    if how == "inner":
        return found
    types = dict(spans.dtypes)
    nothing = [F.lit(None).cast(types[c]).alias(c) for c in values]
    return found.unionByName(events.where(~placed).select("*", *nothing).select(*columns))


def _tree_join(
    events: DataFrame, spans: DataFrame, key: str, event_id: str, at: str, start: str, stop: str, how: str
) -> DataFrame:
    """The same by the tree: its work follows the number of matches."""
    calendar = Calendar.of(events, at)
    usable = closed(spans.withColumn("_stop", F.col(stop)), start, "_stop")
    pairs = salted_join(
        with_path(events.select(key, event_id, at).dropna(), at, calendar).drop(at),
        with_cover(usable, start, "_stop", calendar).drop("_stop"),
        [key, "_node"],
        "inner",
        spread=[event_id],
    ).drop("_node", key)
    return events.join(pairs, [event_id], how)


@dataclass(frozen=True)
class Measure:
    """An aggregate over the spans active on a date: per-span value, combined by a function."""

    value: Column
    combine: str  # "sum", "min" or "max"

    def of(self, col: Column) -> Column:
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.combine](col)


def active_aggregates(
    events: DataFrame,
    spans: DataFrame,
    key: str,
    at: str,
    start: str,
    stop: str,
    measures: Mapping[str, Measure],
    **skew,
) -> DataFrame:
    """Events with aggregates over the spans active on their date; no pair is ever built.

    ``start`` and ``stop`` are usable dates (see :func:`closed`). Spans are combined per
    (key, node), events per (key, date); each date then folds the few nodes on its path.
    Equal spans are combined before they are covered.
    """
    calendar = Calendar.of(events, at)
    valued = (
        spans.select(key, start, stop, *[m.value.alias(n) for n, m in measures.items()])
        .groupBy(key, start, stop)
        .agg(*[m.of(F.col(n)).alias(n) for n, m in measures.items()])
    )
    nodes = (
        with_cover(valued, start, stop, calendar)
        .groupBy(key, "_node")
        .agg(*[m.of(F.col(n)).alias(n) for n, m in measures.items()])
    )
    dates = events.select(key, at).dropna().distinct()
    per_date = (
        with_path(dates, at, calendar)
        .join(nodes, [key, "_node"])
        .groupBy(key, at)
        .agg(*[m.of(F.col(n)).alias(n) for n, m in measures.items()])
    )
    return salted_join(events, per_date, [key, at], "left", **skew)


def merge_spans(
    spans: DataFrame,
    keys: Sequence[str],
    start: str = "start",
    stop: str = "stop",
    carry: Mapping[str, Callable[[str], Column]] | None = None,
) -> DataFrame:
    """Union of overlapping intervals per key: disjoint intervals, each day covered once.

    Spans are first reduced to one per (key, start), so a group never holds more rows
    than there are calendar days, however many rows share the key. ``carry`` folds further
    columns along with the intervals, each by its aggregate function.
    """
    carry = carry or {}
    folds = [fold(c).alias(c) for c, fold in carry.items()]
    widest = spans.groupBy(*keys, start).agg(F.max(stop).alias(stop), *folds)
    before = Window.partitionBy(*keys).orderBy(start)
    reach = F.max(stop).over(before.rowsBetween(Window.unboundedPreceding, -1))
    opened = widest.withColumn("_reach", reach)
    opens = F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach")), 1).otherwise(0)
    islands = opened.withColumn("_opens", opens).withColumn(
        "_island", F.sum("_opens").over(before.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        islands.groupBy(*keys, "_island")
        .agg(F.min(start).alias(start), F.max(stop).alias(stop), *folds)
        .drop("_island")
    )
