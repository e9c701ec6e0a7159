"""Global order and numbers without a global task: ranges are sorted in parallel and only their sizes are summed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.session import cut_lineage


def _column(c: str | Column) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def ranked(df: DataFrame, *order: str | Column, without: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``rank``: the row's place in the global order, from 0; names sort ascending with nulls last.

    Columns ``without`` take part in the order only.

    The sorted rows are written to the checkpoint folder first, so a lost
    executor can't give a row another rank. An empty table stays empty.
    """
    keys = [_column(c) for c in order]
    placed = cut_lineage(df.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*without).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    sizes = sorted((row["p"], row["n"]) for row in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for p, n in sizes:  # one entry per partition
        starts.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts or [(0, 0)], "p long, start long")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), F.col("_part") == F.col("p"))
        .withColumn("rank", F.col("start") + F.col("_place").bitwiseAND((1 << 33) - 1))
        .drop("_place", "_part", "p", "start")
    )


def ranked_within(df: DataFrame, keys: list[str], order: list[str | Column], name: str, total: str | None = None) -> DataFrame:
    """Adds the row's number within its key, from 1, and the key's size; a key with most of the rows is no task of its own.

    Null keys are a key. The number is the global rank less the key's first.
    """
    placed = cut_lineage(ranked(df, *keys, *order))
    firsts = placed.groupBy(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)]).agg(F.min("rank").alias("_first"), F.count(F.lit(1)).alias("_size"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{i}"))
    numbered = placed.join(firsts, same).withColumn(name, (F.col("rank") - F.col("_first") + 1).cast("int"))
    if total:
        numbered = numbered.withColumn(total, F.col("_size"))
    return numbered.drop("rank", "_first", "_size", *[f"_k_{i}" for i in range(len(keys))])
