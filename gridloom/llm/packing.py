"""Filling containers of fixed capacity with texts.

First-fit decreasing in independent groups: items go to groups at random, so
that every group has the same mix of sizes, and each group places its items,
largest first, into the first container with room. A tournament tree over the
containers' room finds it in logarithmic time. Groups have a bounded number of
items whatever the data; at most one container per group stays part empty for
want of items.

Defined results
---------------
* A null text is no item. An empty text has size 0 and fits anywhere.
* An item that exceeds the capacity is split into full pieces, each filling a
  container, and a rest that is placed like any item. No other item is split.
* Repeated rows are separate items. Ties are placed by identifier. The same
  items give the same containers in whatever order or files they come.
* A capacity that is null or below 1 is no container; an empty table fills none.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.ordering import ranked_within
from gridloom.session import cut_lineage

#: Items of one group: a group is packed in one task.
GROUP_ITEMS = 20_000


class Tournament:
    """Room of the containers in a complete binary tree; every inner node holds the greater room below it."""

    def __init__(self, most: int, capacity: int) -> None:
        self.leaves = 1 << max(most - 1, 0).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Takes ``size`` from the first container with room for it and gives its number."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        number, node = node - self.leaves, node // 2
        while node:
            room[node] = max(room[2 * node], room[2 * node + 1])
            node //= 2
        return number


def first_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[int]:
    """Container of each item; ``sizes`` are in decreasing order and none exceeds the capacity."""
    tree = Tournament(max(len(sizes), 1), capacity)
    return [tree.place(size) for size in sizes]


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    capacity = int(group["capacity"].iat[0])
    ordered = group.sort_values(["n_tokens", "item"], ascending=[False, True], kind="stable")
    pieces, full = [], 0
    whole = []
    for item, size in zip(ordered["item"], ordered["n_tokens"], strict=True):
        filled, rest = divmod(int(size), capacity) if size > capacity else (0, int(size))
        for piece in range(filled):
            whole.append((item, piece, capacity, full))
            full += 1
        if rest or not filled:
            pieces.append((item, filled, rest))
    pieces.sort(key=lambda p: -p[2])  # stable: ties stay in the order of the items
    bins = first_fit_decreasing([p[2] for p in pieces], capacity)
    rows = whole + [(item, piece, size, full + b) for (item, piece, size), b in zip(pieces, bins, strict=True)]
    out = pd.DataFrame(rows, columns=["item", "piece", "n_tokens", "bin"])
    out["pack_name"], out["capacity"], out["pack_group"] = group["pack_name"].iat[0], capacity, int(group["pack_group"].iat[0])
    return out


def pack_items(items: DataFrame, packs: Sequence[tuple[str, int]], item: str, size: str, seed: int = 7) -> DataFrame:
    """(pack_name, container, item, piece, n_tokens, capacity): where each item, or piece of one, goes.

    ``packs`` are the kinds of container with their capacities; every kind gets all items.
    """
    kept = [(n, int(c)) for n, c in packs if c is not None and c >= 1]
    # groups follow from the identifier and, for repeated ones, the copy: the layout of the files plays no part
    sized = cut_lineage(items.select(F.col(item).alias("item"), F.col(size).cast("long").alias("n_tokens")))  # ranking reads its rows twice
    numbered = cut_lineage(ranked_within(sized, ["item"], ["n_tokens"], "_copy"))
    groups = max(1, math.ceil(numbered.count() / GROUP_ITEMS))
    kinds = F.array(*[F.struct(F.lit(n).alias("pack_name"), F.lit(c).cast("long").alias("capacity")) for n, c in kept]) if kept else None
    grouped = numbered.withColumn("pack_group", F.pmod(F.xxhash64("item", "_copy", F.lit(seed)), F.lit(groups))).drop("_copy")
    if kinds is None:
        kinds = F.array().cast("array<struct<pack_name:string,capacity:bigint>>")
    spread = grouped.withColumn("_k", F.explode(kinds)).select("item", "n_tokens", "pack_group", "_k.pack_name", "_k.capacity")
    kind = dict(spread.dtypes)["item"]
    packed = spread.groupBy("pack_name", "pack_group").applyInPandas(
        _pack, f"item {kind}, piece long, n_tokens long, bin long, pack_name string, capacity long, pack_group long"
    )
    return packed.select(
        "pack_name", F.concat_ws("-", "pack_group", "bin").alias("container"), F.col("item").alias(item), F.col("piece").cast("int").alias("piece"), "n_tokens", "capacity"
    )


def fill_report(packed: DataFrame) -> DataFrame:
    """(pack_name, capacity, pieces, containers, least_containers, fill): how full the containers are."""
    return (
        packed.groupBy("pack_name", "capacity", "container")
        .agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("pieces"))
        .groupBy("pack_name", "capacity")
        .agg(
            F.sum("pieces").alias("pieces"),
            F.count(F.lit(1)).alias("containers"),
            F.ceil(F.sum("used") / F.col("capacity")).alias("least_containers"),
            F.round(F.avg(F.col("used") / F.col("capacity")), 6).alias("fill"),
        )
    )
