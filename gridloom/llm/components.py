"""Connected components of a link table, by label passing with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every linked node with the smallest node it can reach.

    Each round sends labels along links with a partially aggregated minimum and
    then follows the label's own label; a chain of n nodes takes about log n
    rounds. Every round is written to the checkpoint folder. No node set is
    gathered in one place.
    """
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    edges = cut_lineage(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).where("x <> y").distinct())
    labels = cut_lineage(edges.groupBy("x").agg(F.least("x", F.min("y")).alias("label")))
    while True:
        near = edges.join(labels.withColumnRenamed("x", "y").hint("merge"), "y").groupBy("x").agg(F.min("label").alias("seen"))
        passed = labels.join(near.hint("merge"), "x").select("x", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        jump = labels.select(F.col("x").alias("j"), F.col("label").alias("jumped"))
        moved = cut_lineage(
            passed.join(jump.hint("merge"), F.col("label") == F.col("j")).select("x", "old", F.least("label", "jumped").alias("label"))
        )
        done = moved.where("label <> old").limit(1).count() == 0
        labels = moved.drop("old")
        if done:
            return labels.select(F.col("x").alias("node"), F.col("label").alias("component"))
