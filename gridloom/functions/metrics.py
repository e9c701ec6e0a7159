"""Rates, gates and tiers. Division by zero gives null; a sample below its gate gives null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def plus(*parts: Column) -> Column:
    """Sum in which a null counts as 0."""
    total = F.coalesce(parts[0], F.lit(0))
    for p in parts[1:]:
        total = total + F.coalesce(p, F.lit(0))
    return total


def rate(numerator: Column, denominator: Column, times: float = 100.0) -> Column:
    """``times`` numerator over denominator, null for a zero denominator."""
    return F.try_divide(numerator * F.lit(times), F.nullif(denominator, F.lit(0)))


def gated(value: Column, sample: Column, least: float) -> Column:
    """The value if the sample is large enough."""
    return F.when(sample >= least, value)


def best_share(a: Column, b: Column, digits: int = 1) -> Column:
    """Greater of two shares, of those known, in percent."""
    return F.bround(F.greatest(a, b) * 100, digits)


def tier(value: Column, thresholds: Sequence[tuple[float, str]], lowest: str) -> Column:
    """Label of the first threshold reached; thresholds in decreasing order."""
    found = None
    for least, label in thresholds:
        found = F.when(value >= least, F.lit(label)) if found is None else found.when(value >= least, F.lit(label))
    return found.otherwise(F.lit(lowest))


def win_share(wins: Column, losses: Column, ties: Column) -> Column:
    """Wins and half the ties over games, 0.5 without games."""
    games = wins + losses + ties
    return F.when(games > 0, (wins + ties * 0.5) / games).otherwise(0.5)


def two_way_share(a: Column, b: Column) -> Column:
    """Share of ``a`` in both, one half if both are 0."""
    return F.when(a + b == 0, 0.5).otherwise(a / (a + b))


def prorated(total: Column, years: Column, remaining: Column) -> Column:
    """Part of a total that falls to the remaining years."""
    return F.try_divide(total * F.least(remaining, years), F.nullif(years, F.lit(0)))


def zero_as_missing(value: Column) -> Column:
    """Null for 0."""
    return F.nullif(value, F.lit(0))


def clamped(value: Column, low: float, high: float) -> Column:
    """The value within its range."""
    return F.greatest(F.least(value, F.lit(high)), F.lit(low))


def modal_confidence(first: Column, second: Column, least: int = 4, lead: int = 3) -> Column:
    """Whether the most frequent value is frequent enough and far enough ahead of the next."""
    return (first >= least) & (first - F.coalesce(second, F.lit(0)) >= lead)
