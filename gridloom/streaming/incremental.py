"""Refreshes that build on what is stored: refetch of the latest periods, merged items, rolling pools, last known good."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.relational import prefer_side


def periods_to_fetch(stored: Sequence[int], available: Sequence[int], complete: Sequence[int], again: int = 2) -> list[int]:
    """Periods to read: the latest ``again`` stored ones, then new ones up to the first incomplete period."""
    refetch = sorted(stored)[-again:] if again else []
    new = []
    for period in sorted(set(available) - set(stored)):
        if period not in set(complete):
            break
        new.append(period)
    return [*refetch, *new]


def replace_periods(stored: DataFrame, fetched: DataFrame, period: str) -> DataFrame:
    """Stored rows with the fetched periods in their place."""
    return prefer_side(fetched, stored, [period])


def keep_expiring(fresh: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fresh items and the stored ones that the source no longer lists."""
    return prefer_side(fresh, stored, keys)


def next_from_pool(pool: Sequence[str], everything: Sequence[str], take: int, seed: int) -> tuple[list[str], list[str]]:
    """(chosen, rest): ``take`` entries of a shuffled pool that is refilled when it runs out."""
    chance, left, chosen = random.Random(seed), list(pool), []
    while len(chosen) < min(take, len(set(everything))):
        if not left:
            left = [e for e in everything if e not in chosen]
            chance.shuffle(left)
        chosen.append(left.pop(0))
    return chosen, left


def last_known_good(fetched: DataFrame, cached: DataFrame, group: str) -> DataFrame:
    """Fetched rows, and for groups whose fetch failed the cached ones, marked."""
    return prefer_side(fetched.withColumn("is_cached", F.lit(False)), cached.withColumn("is_cached", F.lit(True)), [group])
