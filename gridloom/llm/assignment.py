"""One-to-one assignment that maximises the total score, over a table of scored pairs.

Pairs without a rival are taken at once. The rest falls into connected
components. Components of up to ``TASK_EDGES`` pairs are solved exactly, each in
its own task, by the Hungarian method in its sparse form (shortest augmenting
paths over dual prices). Larger ones, which no task should hold, are settled
over the cluster by an auction with a bid step of ``STEP``: its total is within
``STEP`` per left member of the maximum, and it is the maximum wherever members
times ``STEP`` stay below the least difference between two totals.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.components import components
from gridloom.session import cut_lineage

#: Largest component, in pairs, that one task solves exactly (some 200 bytes a pair).
TASK_EDGES = 500_000
#: Least raise of a bid in the auction of larger components.
STEP = 0.1


def best_assignment(weights: dict[tuple[int, int], float]) -> list[tuple[int, int]]:
    """Pairs of maximum total weight, one-to-one; only listed pairs of positive weight may be chosen."""
    edges: dict[int, list[tuple[int, float]]] = {}
    for (a, b), w in sorted(weights.items()):
        if w > 0:
            edges.setdefault(a, []).append((b, w))
    profit: dict[int, float] = {}
    price: dict[int, float] = {}
    partner: dict[int, int] = {}  # of lefts
    owner: dict[int, int] = {}  # of rights
    for start, listed in edges.items():
        profit[start] = max([0.0, *(w - price.get(b, 0.0) for b, w in listed)])
        # a left may end without a partner, at the cost of its profit
        best, end_free, end_left = profit[start], None, start
        reached = {start: 0.0}
        settled: dict[int, float] = {}
        came: dict[int, int] = {}
        heap = [(profit[start] + price.get(b, 0.0) - w, b, start) for b, w in listed]
        heapq.heapify(heap)
        while heap:
            d, b, a = heapq.heappop(heap)
            if d >= best - 1e-12:
                break
            if b in settled:
                continue
            settled[b], came[b] = d, a
            if b not in owner:
                best, end_free, end_left = d, b, None
                break
            a = owner[b]
            reached[a] = d
            if d + profit[a] < best - 1e-12:
                best, end_free, end_left = d + profit[a], None, a
            for c, w in edges[a]:
                if c not in settled:
                    heapq.heappush(heap, (d + profit[a] + price.get(c, 0.0) - w, c, a))
        for a, d in reached.items():
            if d < best:
                profit[a] -= best - d
        for b, d in settled.items():
            if d < best:
                price[b] = price.get(b, 0.0) + best - d
        b = end_free if end_left is None else partner.pop(end_left, None)
        while b is not None:  # hand each right on the path to the left it was reached from
            a = came[b]
            owner[b], partner[a], b = a, b, partner.get(a)
    return sorted(partner.items())


def _solve(group: pd.DataFrame) -> pd.DataFrame:
    weights = {(int(a), int(b)): float(s) for a, b, s in zip(group["l"], group["r"], group["score"], strict=True)}
    return pd.DataFrame([(a, b, weights[a, b]) for a, b in best_assignment(weights)], columns=["l", "r", "score"])


def _auction(pairs: DataFrame) -> DataFrame:
    """Forward auction from zero prices: lefts without a partner bid for their best right, rights take the highest bid."""
    held = pairs.limit(0).select("l", "r", F.col("score").alias("price"))
    while True:
        priced = pairs.join(held.select("r", "price").hint("merge"), "r", "left").withColumn("price", F.coalesce("price", F.lit(0.0)))
        free = priced.join(held.select("l").hint("merge"), "l", "left_anti").withColumn("net", F.col("score") - F.col("price")).where("net > 0")
        best = free.groupBy("l").agg(F.max(F.struct("net", (-F.col("r")).alias("m"), "price")).alias("b"), F.sort_array(F.collect_list("net"), asc=False).alias("nets"))
        # the next best, at least to go without, limits the bid
        second = F.greatest(F.coalesce(F.get("nets", F.lit(1)), F.lit(0.0)), F.lit(0.0))
        bids = cut_lineage(best.select("l", (-F.col("b.m")).alias("r"), (F.col("b.price") + F.col("b.net") - second + STEP).alias("price")))
        if not bids.limit(1).count():
            break
        taken = bids.groupBy("r").agg(F.max(F.struct("price", (-F.col("l")).alias("m"))).alias("b")).select((-F.col("b.m")).alias("l"), "r", "b.price")
        kept = held.join(taken.select("r").hint("merge"), "r", "left_anti").select("l", "r", "price")
        held = cut_lineage(kept.unionByName(taken))
    return pairs.join(held.select("l", "r").hint("merge"), ["l", "r"]).select("l", "r", "score")


def assign(pairs: DataFrame) -> DataFrame:
    """(l, r, score): the chosen ones of distinct pairs with positive score; ``l`` and ``r`` are long."""
    rivals = pairs.withColumn("_l", F.count(F.lit(1)).over(Window.partitionBy("l"))).withColumn("_r", F.count(F.lit(1)).over(Window.partitionBy("r")))
    rivals = cut_lineage(rivals)
    alone = rivals.where("_l = 1 AND _r = 1").select("l", "r", "score")
    contested = rivals.where("_l > 1 OR _r > 1").select("l", "r", "score")
    if not contested.limit(1).count():
        return alone
    # left and right numbers become nodes of one graph: even and odd
    edges = contested.select(F.col("l"), F.col("r"), "score", F.shiftleft("l", 1).alias("a"), F.shiftleft("r", 1).bitwiseOR(1).alias("b"))
    parts = components(edges)
    placed = edges.join(parts.hint("merge"), edges["a"] == parts["node"]).select("l", "r", "score", "component")
    sizes = placed.groupBy("component").agg(F.count(F.lit(1)).alias("_n"))
    sized = cut_lineage(placed.join(sizes.hint("merge"), "component"))
    found = alone.unionByName(sized.where(F.col("_n") <= TASK_EDGES).groupBy("component").applyInPandas(_solve, "l long, r long, score double"))
    large = sized.where(F.col("_n") > TASK_EDGES).select("l", "r", "score")
    return found.unionByName(_auction(large)) if large.limit(1).count() else found
