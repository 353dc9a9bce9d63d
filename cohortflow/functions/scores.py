"""Scores, bands, flags and reasons, declared as data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

# Score bands, highest first.
RISK_BANDS = ((60, "HIGH"), (30, "MEDIUM"))
LOWEST_BAND = "LOW"
BAND_ORDER = ("HIGH", "MEDIUM", "LOW")


def flag(predicate: Column) -> Column:
    """1 when the predicate holds, 0 when it is false or NULL."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def threshold_count(predicates: Iterable[Column]) -> Column:
    return reduce(add, [flag(p) for p in predicates])


def additive_score(rules: Iterable[tuple[Column, int]], cap: int = 100) -> Column:
    """Sum of points for every predicate that holds, capped."""
    points = [F.when(p, F.lit(n)).otherwise(F.lit(0)) for p, n in rules]
    return F.least(F.lit(cap), reduce(add, points)).cast("int")


def capped_sum(caps: Mapping[str, int]) -> Column:
    parts = [F.least(F.coalesce(F.col(c), F.lit(0)), F.lit(cap)) for c, cap in caps.items()]
    return reduce(add, parts).cast("int")


def band(score: Column, cuts=RISK_BANDS, default: str = LOWEST_BAND) -> Column:
    return F.coalesce(*[F.when(score >= edge, F.lit(name)) for edge, name in cuts], F.lit(default))


def first_match(rules: Iterable[tuple[Column, str]], default: str | None = None) -> Column:
    """Label of the first predicate that holds (NULL counts as false)."""
    branches = [F.when(p, F.lit(label)) for p, label in rules]
    return F.coalesce(*branches, F.lit(default))


def joined(rules: Iterable[tuple[Column, str]], separator: str = ", ") -> Column:
    """Labels of all predicates that hold; empty text when none does."""
    return F.concat_ws(separator, *[F.when(p, F.lit(label)) for p, label in rules])


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage, 0.0 for an empty whole."""
    safe = F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))
    return F.round(safe, digits)
