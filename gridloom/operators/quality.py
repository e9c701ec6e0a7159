"""Gates that decide whether a refresh replaces the stored snapshot. Each gate is one aggregated row of measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def measures(df: DataFrame, group: str, key: str, marker: Column, homogeneous: str, required: Sequence[str]) -> DataFrame:
    """One row: rows, groups, marker_share, distinct_values, missing_groups, duplicate_keys.

    ``marker`` must hold for most rows, ``homogeneous`` should have one value,
    every one of ``required`` should be a group. One pass with partial
    aggregation for all measures but the duplicates.
    """
    wanted = F.array(*[F.lit(r) for r in required]) if required else F.array().cast("array<string>")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(group).alias("groups"),
        F.coalesce(F.avg(marker.cast("double")), F.lit(0.0)).alias("marker_share"),
        F.count_distinct(homogeneous).alias("distinct_values"),
        F.size(F.array_except(wanted, F.collect_set(F.when(F.col(group).isin(*required), F.col(group)) if required else F.col(group)))).alias("missing_groups"),
        (F.count(key) - F.count_distinct(key)).alias("duplicate_keys"),
    )


def floor_rows(previous_rows: int | None, absolute: int, share: float = 0.9) -> float:
    """Rows that a refresh must have: an absolute floor and a share of what is stored."""
    return max(absolute, (previous_rows or 0) * share)


def verdicts(row: DataFrame, least_rows: float, least_groups: int, marker_least: float = 0.95) -> DataFrame:
    """Adds one boolean per gate and ``accept``."""
    gates = {
        "enough_rows": F.col("rows") >= least_rows,
        "enough_groups": F.col("groups") >= least_groups,
        "marked": F.col("marker_share") >= marker_least,
        "one_value": F.col("distinct_values") == 1,
        "all_groups": F.col("missing_groups") == 0,
        "unique_keys": F.col("duplicate_keys") == 0,
    }
    accept = F.lit(True)
    for name, gate in gates.items():
        row = row.withColumn(name, gate)
        accept = accept & F.col(name)
    return row.withColumn("accept", accept)


def contiguous(df: DataFrame, key: str) -> DataFrame:
    """One row: whether the keys are 1 to n without gap or repetition."""
    return df.agg(
        ((F.coalesce(F.min(key), F.lit(1)) == 1) & (F.coalesce(F.max(key), F.lit(0)) == F.count(key)) & (F.count_distinct(key) == F.count(F.lit(1)))).alias("contiguous")
    )


def never_rises(df: DataFrame, group: str, order: Sequence[str], value: str) -> DataFrame:
    """(group, never_rises): whether the series of each group only falls or stays."""
    step = F.col(value) - F.lag(value).over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_step", step).groupBy(group).agg(F.coalesce(F.max("_step") <= 0, F.lit(True)).alias("never_rises"))


def carry_over(fresh: DataFrame, previous: DataFrame, expected: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """Rows of each expected group from the fresh table, else from the previous one; and (group, state): fresh, stale or missing."""
    have = fresh.select(group).distinct().withColumn("_f", F.lit(True))
    had = previous.select(group).distinct().withColumn("_p", F.lit(True))
    states = expected.select(group).distinct().join(have, group, "left").join(had, group, "left")
    states = states.select(group, F.when(F.col("_f"), "fresh").when(F.col("_p"), "stale").otherwise("missing").alias("state"))
    kept = fresh.join(states.where("state = 'fresh'").select(group), group, "left_semi").unionByName(
        previous.join(states.where("state = 'stale'").select(group), group, "left_semi")
    )
    return kept, states


def match_share(df: DataFrame, matched: Column) -> DataFrame:
    """One row (rows, matched, share)."""
    hits = F.coalesce(F.sum(matched.cast("long")), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("rows"), hits.alias("matched"), F.coalesce(F.try_divide(hits, F.count(F.lit(1))), F.lit(0.0)).alias("share"))


def source_tally(df: DataFrame, source: str, unmatched: str = "unmatched") -> DataFrame:
    """(source, rows, share): histogram of provenance."""
    counted = df.groupBy(F.coalesce(F.col(source), F.lit(unmatched)).alias(source)).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(F.lit(0)))  # over the histogram: one row per source
    return counted.select(source, "rows", (F.col("rows") / total).alias("share"))


def carry_column(current: DataFrame, previous: DataFrame, key: str, column: str, source_present: bool) -> DataFrame:
    """``current`` with a whole column taken from the last output while the column's own source is missing."""
    if source_present:
        return current
    held = previous.select(key, F.col(column).alias("_held")).dropDuplicates([key])
    joined = current.drop(column).join(held, key, "left")
    return joined.withColumn(column, F.col("_held")).drop("_held")
