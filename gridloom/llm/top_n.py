"""Top N items within every group.

One SQL statement: a ``row_number`` window ordered by score and identifier with
a rank filter. Spark's group-limit operator keeps at most N rows per group and
map task before the exchange, so a group of millions of items sends N rows per
task; the same operator reduces redelivered items to their latest row first.

Defined results
---------------
* Rows with a null or NaN score, or a null in any group column, never count.
* Of several rows of one item the greatest ``latest`` counts (null is oldest),
  then the greatest of ``tie_latest``; only that row's score and group matter.
* Equal scores are ordered by the smaller identifier (null last).
* A group with fewer than N items gives all of them; an empty table gives none.
* Other columns take no part, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SQL = """
SELECT {groups}, item AS {item}, score AS {score}, CAST(rank AS INT) AS top_rank
FROM (
  SELECT *, row_number() OVER (PARTITION BY {groups} ORDER BY score DESC, item ASC NULLS LAST) AS rank
  FROM (
    SELECT * FROM (
      SELECT *, row_number() OVER (
        PARTITION BY {item_key} ORDER BY latest DESC NULLS LAST, tie DESC NULLS LAST, score DESC NULLS LAST) AS copy
      FROM {rows}
    ) WHERE copy = 1
  )
  WHERE score IS NOT NULL AND NOT isnan(CAST(score AS DOUBLE)) AND {known}
)
WHERE rank <= {n}
"""


def top_n(
    df: DataFrame,
    groups: Sequence[str],
    score: str,
    item: str,
    n: int,
    item_key: Sequence[str] | None = None,
    latest: str | None = None,
    tie_latest: str | None = None,
) -> DataFrame:
    """(groups..., item, score, top_rank): the ``n`` best items of every group.

    ``item_key`` names the columns that identify an item across deliveries
    (default: all group columns and ``item``).
    """
    key = list(item_key or [*groups, item])
    carried = {f"g{i}": g for i, g in enumerate(groups)} | {f"k{i}": k for i, k in enumerate(key)}
    rows = df.select(
        *[F.col(c).alias(a) for a, c in carried.items()],
        F.col(item).alias("item"),
        F.col(score).alias("score"),
        (F.col(latest) if latest else F.lit(0)).alias("latest"),
        (F.col(tie_latest) if tie_latest else F.lit(0)).alias("tie"),
    )
    group_aliases = [f"g{i}" for i in range(len(groups))]
    sql = (
        _SQL.replace("{groups}", ", ".join(group_aliases))
        .replace("{item_key}", ", ".join(f"k{i}" for i in range(len(key))))
        .replace("{known}", " AND ".join(f"{g} IS NOT NULL" for g in group_aliases))
        .replace("{n}", str(int(n)))
        .replace("{item}", "found_item")
        .replace("{score}", "found_score")
    )
    found = df.sparkSession.sql(sql, rows=rows)
    return found.select(
        *[F.col(a).alias(g) for a, g in zip(group_aliases, groups, strict=True)],
        F.col("found_item").alias(item),
        F.col("found_score").alias(score),
        "top_rank",
    )
