"""Attribute history (validity periods) from full snapshots.

Consecutive snapshots are compared by a null-safe full outer join of each
record's row with its row in the snapshot before; the join classifies keys as
inserted, changed or deleted, and the next event closes a version.

Defined results
---------------
* Rows without a snapshot date are left out; null feeds and keys are values.
* Of several rows of a key on one date the greatest ``latest`` counts.
* A version is a run of consecutive dates of the key's feed with equal values
  (null equals null); absence from one date of the feed ends it.
* ``valid_to`` is the first date on which the version no longer holds, null
  for versions that hold on the feed's last date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.snapshots import latest_in_snapshot, number_snapshots, with_numbers


def version_events(
    df: DataFrame, feed: str, date: str, key: str, values: Sequence[str], latest: str | None = None
) -> DataFrame:
    """(_feed, _key, _snap, _idx, _kind, _v0 ...): inserted, changed and deleted keys of each snapshot."""
    names = [f"_v{i}" for i in range(len(values))]
    rows = with_numbers(latest_in_snapshot(df, feed, date, key, values, latest), number_snapshots(df, feed, date))
    now = rows.withColumn("_here", F.lit(True))
    # the same rows, moved to the snapshot after; a feed's last snapshot has none after it
    before = rows.where(F.col("_next").isNotNull()).select(
        F.col("_feed").alias("b_feed"),
        F.col("_key").alias("b_key"),
        (F.col("_idx") + 1).alias("b_idx"),
        F.col("_next").alias("b_snap"),
        *[F.col(n).alias(f"b{n}") for n in names],
        F.lit(True).alias("b_here"),
    )
    joined = now.join(
        before,
        (F.col("_idx") == F.col("b_idx"))
        & F.col("_key").eqNullSafe(F.col("b_key"))
        & F.col("_feed").eqNullSafe(F.col("b_feed")),
        "full_outer",
    )
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"b{n}"))
    kind = (
        F.when(F.col("_here").isNull(), F.lit("deleted"))
        .when(F.col("b_here").isNull(), F.lit("inserted"))
        .when(~same, F.lit("changed"))
    )
    here = F.col("_here").isNotNull()
    return joined.withColumn("_kind", kind).where(F.col("_kind").isNotNull()).select(
        F.when(here, F.col("_feed")).otherwise(F.col("b_feed")).alias("_feed"),
        F.when(here, F.col("_key")).otherwise(F.col("b_key")).alias("_key"),
        F.when(here, F.col("_snap")).otherwise(F.col("b_snap")).alias("_snap"),
        F.when(here, F.col("_idx")).otherwise(F.col("b_idx")).alias("_idx"),
        "_kind",
        *names,
    )


def attribute_history(
    df: DataFrame, feed: str, date: str, key: str, values: Sequence[str], latest: str | None = None
) -> DataFrame:
    """(feed, record_key, values..., valid_from, valid_to, is_current): one row per version."""
    events = version_events(df, feed, date, key, values, latest)
    after = Window.partitionBy("_feed", "_key").orderBy("_idx")
    closed = events.withColumn("_to", F.lead("_snap").over(after)).where(F.col("_kind") != "deleted")
    return closed.select(
        F.col("_feed").alias("feed"),
        F.col("_key").alias("record_key"),
        *[F.col(f"_v{i}").alias(v) for i, v in enumerate(values)],
        F.col("_snap").alias("valid_from"),
        F.col("_to").alias("valid_to"),
        F.col("_to").isNull().alias("is_current"),
    )
