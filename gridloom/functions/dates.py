"""Seasons and ages. Every function takes the day it is asked for, so results don't depend on the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def season_started(day: Column, first_month: int) -> Column:
    """Year in which the season of ``day`` started, for seasons that start in ``first_month``."""
    return F.when(F.month(day) >= first_month, F.year(day)).otherwise(F.year(day) - 1)


def season_ended(day: Column, first_month: int = 10) -> Column:
    """Year in which the season of ``day`` ends."""
    return F.when(F.month(day) >= first_month, F.year(day) + 1).otherwise(F.year(day))


def season_label(end_year: Column) -> Column:
    """2026-27 for 2027."""
    return F.concat((end_year - 1).cast("string"), F.lit("-"), F.substring(end_year.cast("string"), -2, 2))


def age_on(born: Column, day: Column) -> Column:
    """Full years between two dates."""
    before = (F.month(day) * 100 + F.dayofmonth(day)) < (F.month(born) * 100 + F.dayofmonth(born))
    return F.year(day) - F.year(born) - before.cast("int")


def years_in(season: Column, entry_year: Column) -> Column:
    """Seasons since entry, at least 0; null if either is null."""
    return F.when(season.isNotNull() & entry_year.isNotNull(), F.greatest(F.lit(0), season - entry_year))


def manifest_seasons(manifest: DataFrame, day: Column) -> DataFrame:
    """One row (roster_season, stats_season, previous_season) from seasons (id, starts, ends) whose ids step by 10001.

    Statistics stay with the last season that started; rosters move on once it
    has ended and its successor is listed.
    """
    ids = F.collect_set("id")
    current = F.max_by(F.struct("id", "ends"), F.when(F.col("starts") <= day, F.col("starts")))
    row = manifest.agg(ids.alias("ids"), current.alias("c"))
    following, before = F.col("c.id") + 10001, F.col("c.id") - 10001
    moved = (F.col("c.ends") <= day) & F.array_contains("ids", following)
    return row.select(
        F.when(moved, following).otherwise(F.col("c.id")).alias("roster_season"),
        F.col("c.id").alias("stats_season"),
        F.when(F.array_contains("ids", before), before).alias("previous_season"),
    )
