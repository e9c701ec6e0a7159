"""Interval joins by buckets: no pair of rows meets unless its intervals share a bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _buckets(low: Column, high: Column, width: float) -> Column:
    return F.sequence(F.floor(low / width), F.floor(high / width))


def overlap_pairs(df: DataFrame, key: str, low: str, high: str, width: float) -> DataFrame:
    """(a, b): keys of rows with a smaller and a greater key whose closed intervals overlap.

    A pair that shares several buckets is reported in the first one only, so no
    distinct is needed. ``width`` should be about the usual length of an interval.
    """
    rows = df.where(F.col(low) <= F.col(high)).select(F.col(key).alias("k"), F.col(low).alias("lo"), F.col(high).alias("hi"))
    spread = rows.withColumn("bucket", F.explode(_buckets(F.col("lo"), F.col("hi"), width)))
    a, b = spread.alias("a"), spread.alias("b").hint("merge")
    overlap = (F.col("a.k") < F.col("b.k")) & (F.col("a.lo") <= F.col("b.hi")) & (F.col("b.lo") <= F.col("a.hi"))
    first = F.col("a.bucket") == F.greatest(F.floor(F.col("a.lo") / width), F.floor(F.col("b.lo") / width))
    return a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & overlap & first).select(F.col("a.k").alias("a"), F.col("b.k").alias("b"))


def range_lookup(points: DataFrame, value: str, ranges: DataFrame, start: str, end: str, width: float) -> DataFrame:
    """``points`` with the columns of the range that holds their value, null outside all ranges.

    Ranges must not overlap. A range is stored under every bucket it touches.
    """
    spread = ranges.withColumn("_bucket", F.explode(_buckets(F.col(start), F.col(end), width)))
    keyed = points.withColumn("_at", F.floor(F.col(value) / width))
    inside = (F.col("_at") == F.col("_bucket")) & F.col(value).between(F.col(start), F.col(end))
    return keyed.join(spread, inside, "left").drop("_at", "_bucket")
