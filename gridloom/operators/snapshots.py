"""Differences between full snapshots of a table.

``snapshot_changes`` follows each record through the numbered snapshots of its
feed: a lagged hash shows a changed record, a gap in the numbers shows a
removal and, where the record comes back, a later addition. The table is
shuffled once, by feed and record; a feed of any size spreads over its records.

Defined results
---------------
* Rows without a snapshot are in no snapshot and are left out.
* A null feed is a feed of its own and a null record key a key of its own.
* Of several rows of one record in one snapshot the row with the greatest
  ``latest`` counts (null is oldest), then the greatest values.
* Values are compared as stored; null equals null only, NaN equals NaN.
* An empty table has no changes; a feed's first snapshot has none either.
* Columns that are not named take no part, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.session import bounded_broadcast


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of values with their null pattern, so that a null never hashes like its neighbour."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return F.xxhash64(nulls, *[F.col(c) for c in columns])


def number_snapshots(df: DataFrame, feed: str, snapshot: str) -> DataFrame:
    """(_feed, _snap, _idx, _next) per existing snapshot: its number within the feed and its successor.

    Partial aggregation leaves one row per snapshot before the shuffle.
    """
    order = Window.partitionBy("_feed").orderBy("_snap")
    return (
        df.select(F.col(feed).alias("_feed"), F.col(snapshot).alias("_snap"))
        .where(F.col("_snap").isNotNull())
        .distinct()
        .withColumn("_idx", F.row_number().over(order))
        .withColumn("_next", F.lead("_snap").over(order))
    )


def latest_in_snapshot(
    df: DataFrame, feed: str, snapshot: str, key: str, values: Sequence[str], latest: str | None
) -> DataFrame:
    """(_feed, _key, _snap, _v0 ...): one row per record and snapshot.

    Sorting each record's rows by snapshot and recency makes the row to keep
    the first of its snapshot; the same partitions and order then serve the
    caller's windows without another exchange.
    """
    names = [f"_v{i}" for i in range(len(values))]
    rows = df.select(
        F.col(feed).alias("_feed"),
        F.col(key).alias("_key"),
        F.col(snapshot).alias("_snap"),
        (F.col(latest) if latest else F.lit(0)).alias("_latest"),
        *[F.col(v).alias(n) for v, n in zip(values, names, strict=True)],
    ).where(F.col("_snap").isNotNull())
    recency = [F.col("_latest").desc_nulls_last(), *[F.col(n).desc_nulls_last() for n in names]]
    by_record = Window.partitionBy("_feed", "_key").orderBy(F.col("_snap").asc(), *recency)
    return (
        rows.withColumn("_before", F.lag("_snap").over(by_record))
        .where(F.col("_before").isNull() | (F.col("_before") != F.col("_snap")))
        .select("_feed", "_key", "_snap", *names)
    )


def with_numbers(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """Adds ``_idx`` and ``_next``; the numbers are broadcast only if they are few."""
    numbers = bounded_broadcast(numbers)
    on = rows["_feed"].eqNullSafe(numbers["_feed"]) & (rows["_snap"] == numbers["_snap"])
    return rows.join(numbers, on, "inner").select(*[rows[c] for c in rows.columns], "_idx", "_next")


def snapshot_changes(
    df: DataFrame, feed: str, snapshot: str, key: str, values: Sequence[str], latest: str | None = None
) -> DataFrame:
    """(feed, snapshot, record_key, change_kind): every record added, removed or changed.

    ``snapshot`` is the later of the two snapshots compared. ``change_kind`` is
    added, removed or changed.
    """
    names = [f"_v{i}" for i in range(len(values))]
    rows = latest_in_snapshot(df, feed, snapshot, key, values, latest).withColumn("_hash", row_hash(names))
    rows = with_numbers(rows.drop(*names), number_snapshots(df, feed, snapshot))
    by_record = Window.partitionBy("_feed", "_key").orderBy("_snap")
    rows = (
        rows.withColumn("_idx_before", F.lag("_idx").over(by_record))
        .withColumn("_hash_before", F.lag("_hash").over(by_record))
        .withColumn("_idx_after", F.lead("_idx").over(by_record))
    )
    contiguous = F.col("_idx_before") == F.col("_idx") - 1
    added = (F.col("_idx") > 1) & ~F.coalesce(contiguous, F.lit(False))
    changed = contiguous & (F.col("_hash") != F.col("_hash_before"))
    removed = F.col("_next").isNotNull() & ~F.coalesce(F.col("_idx_after") == F.col("_idx") + 1, F.lit(False))
    events = F.array_compact(
        F.array(
            F.when(added, F.struct(F.col("_snap").alias("s"), F.lit("added").alias("k"))),
            F.when(changed, F.struct(F.col("_snap").alias("s"), F.lit("changed").alias("k"))),
            F.when(removed, F.struct(F.col("_next").alias("s"), F.lit("removed").alias("k"))),
        )
    )
    return rows.select("_feed", "_key", F.explode(events).alias("e")).select(
        F.col("_feed").alias("feed"),
        F.col("e.s").alias("snapshot"),
        F.col("_key").alias("record_key"),
        F.col("e.k").alias("change_kind"),
    )


def change_totals(changes: DataFrame, numbers: DataFrame) -> DataFrame:
    """(feed, snapshot, added, removed, changed) for every snapshot, also those without any change."""
    counted = changes.groupBy("feed", "snapshot").agg(
        *[
            F.sum(F.when(F.col("change_kind") == k, 1).otherwise(0)).cast("long").alias(k)
            for k in ("added", "removed", "changed")
        ]
    )
    on = numbers["_feed"].eqNullSafe(counted["feed"]) & (numbers["_snap"] == counted["snapshot"])
    return numbers.join(counted, on, "left").select(
        F.col("_feed").alias("feed"),
        F.col("_snap").alias("snapshot"),
        F.col("_idx").alias("snapshot_index"),
        *[F.coalesce(F.col(k), F.lit(0)).alias(k) for k in ("added", "removed", "changed")],
    )
