"""Tolerant typing, ages and duration buckets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Age bands and return-gap buckets as (exclusive / inclusive upper edge, label).
AGE_BANDS = ((18, "0-17"), (40, "18-39"), (60, "40-59"))
OLDEST_BAND = "60+"
GAP_BUCKETS = ((7, "0-7 days"), (30, "8-30 days"), (90, "31-90 days"))
LONGEST_GAP = "90+ days"
DEFAULT_BIRTHDATE = "1980-01-01"


def try_date(col: Column) -> Column:
    """Date, or NULL when the text is no date (never an error)."""
    return col.try_cast("date")


def try_timestamp(col: Column) -> Column:
    """Wall-clock time in the session's zone (UTC); an offset in the text is honoured."""
    return col.try_cast("timestamp").cast("timestamp_ntz")


def utc_iso(at: Column) -> Column:
    """ISO text with an offset; fractions of a second only where there are any."""
    micros = F.date_format(at, "SSSSSS")
    fraction = F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit(""))
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def try_double(col: Column) -> Column:
    return col.try_cast("double")


def whole_years(birth: Column, as_of: Column) -> Column:
    return F.floor(F.months_between(as_of, birth) / 12).cast("int")


def age_band(age: Column) -> Column:
    """Age band; an unknown age falls into the last band."""
    branches = [F.when(age < edge, F.lit(label)) for edge, label in AGE_BANDS]
    return F.coalesce(*branches, F.lit(OLDEST_BAND))


def gap_bucket(days: Column) -> Column:
    branches = [F.when(days <= edge, F.lit(label)) for edge, label in GAP_BUCKETS]
    return F.coalesce(*branches, F.lit(LONGEST_GAP))


def gap_order(bucket: Column) -> Column:
    """Rank of a bucket for display; unknown buckets come last."""
    labels = [label for _, label in GAP_BUCKETS] + [LONGEST_GAP]
    return rank_of(bucket, labels)


def rank_of(col: Column, values) -> Column:
    """1-based position of a value in a list; values outside it come last."""
    branches = [F.when(col == v, F.lit(i)) for i, v in enumerate(values, 1)]
    return F.coalesce(*branches, F.lit(len(values) + 1))
