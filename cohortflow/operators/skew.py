"""Hot-key handling: find keys that hold a large share of the rows and split them.

A key is hot when it holds more than ``share`` of all rows, so there can never be
more than ``1 / share`` of them. That proven bound is what makes the hot-key
table (and only that table) safe to broadcast whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HOT_SHARE = 1 / 1024
MIN_HOT_ROWS = 1_000_000
PIECES = "_pieces"
SALT = "_salt"


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    share: float = HOT_SHARE,
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Keys holding more than ``share`` of the rows, with the pieces to split each into.

    Counting reads the key columns only and combines before the shuffle. The result
    has at most ``1 / share`` rows and the pieces add up to at most ``2 / share``.
    """
    counts = df.dropna(how="any", subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return hot_counts(counts, keys, share, min_rows)


def hot_counts(
    counts: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, min_rows: int = MIN_HOT_ROWS
) -> DataFrame:
    """The same where the rows ``_n`` of each key have been counted already."""
    rows = piece_rows(counts, share, min_rows)
    return counts.where(F.col("_n") > rows).select(*keys, F.ceil(F.col("_n") / rows).cast("int").alias(PIECES))


def piece_rows(counts: DataFrame, share: float = HOT_SHARE, min_rows: int = MIN_HOT_ROWS) -> Column:
    """Rows beyond which a key is hot, and which each of its pieces has at most on average."""
    return F.greatest(counts.agg(F.sum("_n")).scalar() * F.lit(share), F.lit(float(min_rows)))


def mark_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Add the piece count to rows of hot keys, NULL for all others."""
    return df.join(F.broadcast(hot), list(keys), "left")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    spread: Sequence[str] | None = None,
    share: float = HOT_SHARE,
    min_rows: int = MIN_HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join that splits the left side's hot keys over many tasks.

    Left rows of a hot key are dealt to pieces by a hash of ``spread`` (stable, so a
    re-run task deals them the same way); the right rows of those few keys are copied
    to each piece. Rows with a NULL key match nothing and are dealt by that hash alone, however
    many they are. ``hot`` gives the hot keys where a cheaper frame than ``left`` tells
    them. Left rows are kept, dropped or repeated exactly as in a plain
    ``inner`` / ``left`` / ``left_semi`` / ``left_anti`` join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join does not support {how!r}")
    keys = list(keys)
    spread = list(spread or [c for c, t in left.dtypes if not t.startswith("map")])
    hot = hot_keys(left, keys, share, min_rows) if hot is None else hot
    hashed = F.xxhash64(*spread)
    unmatched = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    dealt = mark_hot(left, keys, hot).withColumn(
        SALT,
        F.when(unmatched, F.pmod(hashed, F.lit(1 << 30)).cast("int")).otherwise(
            F.coalesce(F.pmod(hashed, F.col(PIECES)).cast("int"), F.lit(0))
        ),
    )
    copied = mark_hot(right, keys, hot).withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(PIECES), F.lit(1)) - 1))
    )
    return dealt.drop(PIECES).join(copied.drop(PIECES), keys + [SALT], how).drop(SALT)
