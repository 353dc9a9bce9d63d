"""Aggregates over the spans that are active on a date, by one sweep over each key's days.

A span adds to its sums on its first day and takes off after its last; the running sums over a key's days are
the sums over the spans active on each. What begins, ends and is asked for is combined per (key, day) before any
key's days meet, so a key has one row per calendar day at most, however many rows share it.

* The latest end of the spans begun so far belongs to an active span exactly where it is not before the
  day; the earliest begin of the spans that end from the day on likewise.
* The longest active span: with lengths taken by powers of two, a span of 2**j to 2**(j + 1) - 1 days that holds a day
  begins less than 2**j days before it or ends less than 2**j days after it, and every span that does so
  holds the day. So each class needs two maxima over days near by.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Classes of lengths: 2**16 days are longer than any life.
CLASSES = 16


def _struct(day: Column, values: Mapping[str, Column], kinds: Mapping[str, str]) -> Column:
    """A row of the sweep: its day and some values, NULL for the others."""
    filled = [values[c].cast(t).alias(c) if c in values else F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
    return F.struct(day.cast("int").alias("_day"), *filled)


def active_sweep(
    events: DataFrame,
    spans: DataFrame,
    key: str,
    at: str,
    start: str,
    stop: str,
    sums: Mapping[str, Column] | None = None,
    earliest: str | None = None,
    latest: tuple[str, Column] | None = None,
    longest: tuple[str, Column] | None = None,
    steps: DataFrame | None = None,
    step_sums: Sequence[str] = (),
    classes: int = CLASSES,
) -> DataFrame:
    """``events`` with aggregates over the spans of their key that hold their date.

    ``start`` and ``stop`` are usable dates of a span (see ``intervals.closed``). ``sums`` are whole numbers per span;
    ``steps`` are further changes of sums named ``step_sums``, by (key, ``day``). ``earliest`` names the
    first start; ``latest`` and ``longest`` name the last of a date, and the largest of a length in days, given
    for each span: the span's own stop and ``stop - start``, or NULL where it is not to count. Sums are 0 on dates without
    an active span, the others NULL; events without a key or date get no aggregates at all.
    """
    sums = dict(sums or {})
    totals = [*sums, *step_sums]
    kinds = {c: "bigint" for c in totals} | {"_asked": "int", "_first": "date", "_last": "date"}
    if longest:
        kinds |= {f"_{side}{j}": "int" for side in ("from", "to") for j in range(classes)}
    first, last = F.unix_date(F.col(start)), F.unix_date(F.col(stop))
    begins, ends = dict(sums), {}
    if latest:
        begins["_last"] = latest[1]
    if earliest:
        ends["_first"] = F.col(start)
    if longest:
        length = longest[1]
        of_class = F.floor(F.log2(length + 1)).cast("int")
        for j in range(classes):
            begins[f"_from{j}"] = ends[f"_to{j}"] = F.when(of_class == j, length)
    rows = [_struct(first, begins, kinds), _struct(last + 1, {c: -v for c, v in sums.items()}, kinds)]
    if ends:
        rows.append(_struct(last, ends, kinds))
    held = spans.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.explode(F.array(*rows)).alias("_row")).select("_key", "_row.*")
    dates = events.select(F.col(key).alias("_key"), F.unix_date(F.col(at).cast("date")).alias("_at")).dropna()
    asked = dates.select("_key", _struct(F.col("_at"), {"_asked": F.lit(1)}, kinds).alias("_row")).select("_key", "_row.*")
    parts = held.unionByName(asked)
    if steps is not None:
        values = {c: F.col(c) for c in step_sums}
        changed = steps.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), _struct(F.unix_date("day"), values, kinds).alias("_row"))
        parts = parts.unionByName(changed.select("_key", "_row.*"))

    folds = [F.sum(c).alias(c) for c in totals] + [F.max("_asked").alias("_asked"), F.min("_first").alias("_first"), F.max("_last").alias("_last")]
    folds += [F.max(c).alias(c) for c in kinds if c.startswith(("_from", "_to"))]
    days = parts.groupBy("_key", "_day").agg(*folds)
    by_day = Window.partitionBy("_key").orderBy("_day")
    until = by_day.rowsBetween(Window.unboundedPreceding, 0)
    day = F.date_from_unix_date("_day")
    found = [F.coalesce(F.sum(c).over(until), F.lit(0)).alias(c) for c in totals]
    if earliest:
        begun = F.min("_first").over(by_day.rowsBetween(0, Window.unboundedFollowing))
        found.append(F.when(begun <= day, begun).alias(earliest))
    if latest:
        ended = F.max("_last").over(until)
        found.append(F.when(ended >= day, ended).alias(latest[0]))
    if longest:
        near = []
        for j in range(classes):
            reach = 2**j - 1
            near += [F.max(f"_from{j}").over(by_day.rangeBetween(-reach, 0)), F.max(f"_to{j}").over(by_day.rangeBetween(0, reach))]
        found.append(F.greatest(*near).alias(longest[0]))
    on_dates = days.select("_key", "_day", "_asked", *found).where("_asked = 1").drop("_asked")
    own = (F.col(key) == F.col("_key")) & (F.unix_date(F.col(at).cast("date")) == F.col("_day"))
    return events.join(on_dates, own, "left").drop("_key", "_day")
