"""Sorted neighbourhood: records of two sources under several composite sort keys, compared in sliding windows.

All passes are one global sort. A record is compared with the ``window``
records after it and with all records that share the leading part of its sort
key, so what a pass finds doesn't depend on how densely the data fill the key's
range. Ranks fall into blocks of equal size; a task compares one block with
itself or with one other, so no task depends on how often a key occurs: a
leading part that many records share is spread over as many pairs of blocks as
it fills. Within a block runs of equal leading parts show by themselves; only
those that cross its border are looked up, one at most per border.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.ordering import ranked
from gridloom.session import bounded_broadcast

#: Rows of one block; a task holds two blocks at most.
BLOCK_ROWS = 10_000
#: Pairs that are handed to the comparison at once.
PAIRS_AT_ONCE = 500_000
#: Pairs that are screened at once.
CELLS = 250_000

#: Whether pairs of places may pass the comparison: two arrays of places, of one shape or a column and a row of a table.
Screen = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _table(xs: np.ndarray, ys: np.ndarray, wanted: Screen) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The wanted ones of all pairs of ``xs`` with ``ys``, in portions."""
    if not len(xs) or not len(ys):
        return
    step = max(1, CELLS // len(ys))
    for at in range(0, len(xs), step):
        part = xs[at : at + step]
        i, j = np.nonzero(wanted(part[:, None], ys[None, :]))
        yield part[i], ys[j]


def _sides(left: np.ndarray, right: np.ndarray, side: np.ndarray, wanted: Screen) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The wanted pairs of a place of ``left`` with one of ``right`` that is of the other side."""
    for one in (0, 1):
        yield from _table(left[side[left] == one], right[side[right] != one], wanted)


def _pairs(rank: np.ndarray, run: np.ndarray, number: np.ndarray, side: np.ndarray, window: int, split: int, screen: Screen) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    near = lambda x, y: (number[x] == number[y]) & (np.abs(rank[x] - rank[y]) <= window) & screen(x, y)
    far = lambda x, y: (np.abs(rank[x] - rank[y]) > window) & screen(x, y)
    places = np.arange(len(rank))
    if split:
        left, right = places[:split], places[split:]
        yield from _sides(left[rank[left] + window >= rank[split]], right[rank[right] - window <= rank[split - 1]], side, near)
        if run[split - 1] == run[split]:
            yield from _sides(left[run[left] == run[split]], right[run[right] == run[split]], side, far)
        return
    for d in range(1, min(window, len(rank) - 1) + 1):  # the ranks of a block have no gaps
        x, y = places[:-d], places[d:]
        ok = (side[x] != side[y]) & near(x, y)
        yield x[ok], y[ok]
    borders = np.concatenate([[0], np.flatnonzero(run[1:] != run[:-1]) + 1, [len(run)]])
    for k in np.flatnonzero(np.diff(borders) > window + 1):
        own = places[borders[k] : borders[k + 1]]
        yield from _table(own[side[own] == 0], own[side[own] != 0], far)


def neighbour_pairs(rank: np.ndarray, run: np.ndarray, number: np.ndarray, side: np.ndarray, window: int, split: int, screen: Screen) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (x, y), rank[x] < rank[y], of the pairs of different sides that ``screen`` lets pass, in portions; ranks ascend.

    They are of one pass (``number``) and at most ``window`` ranks apart, or of one run. With ``split`` > 0 the first
    ``split`` rows, of one block, are compared with the others, of a later block, only.
    """
    xs, ys, held = [], [], 0
    for x, y in _pairs(rank, run, number, side, window, split, screen):
        xs.append(np.minimum(x, y))
        ys.append(np.maximum(x, y))
        held += len(x)
        if held > PAIRS_AT_ONCE:
            yield np.concatenate(xs), np.concatenate(ys)
            xs, ys, held = [], [], 0
    if held:
        yield np.concatenate(xs), np.concatenate(ys)


def runs_over_borders(rows: DataFrame) -> DataFrame:
    """(_run, _from, _to): first and last rank of each run that goes on from one block to the next; there are fewer of them than blocks."""
    last = F.pmod("rank", F.lit(BLOCK_ROWS))
    edges = rows.where((last == 0) | (last == BLOCK_ROWS - 1)).groupBy("run", F.floor((F.col("rank") + 1) / F.lit(BLOCK_ROWS)).alias("_b")).count()
    over = bounded_broadcast(edges.where("count = 2").select(F.col("run").alias("_run")).distinct())
    return rows.select("run", "rank").join(over, F.col("run") == F.col("_run")).groupBy("_run").agg(F.min("rank").alias("_from"), F.max("rank").alias("_to"))


def sorted_neighbourhood(
    records: DataFrame, passes: str, compare: Callable[[pd.DataFrame, np.ndarray, np.ndarray], pd.DataFrame], schema: str, window: int, tie: str,
    screen: Callable[[pd.DataFrame], Screen] | None = None,
) -> DataFrame:
    """Result of ``compare`` over all pairs of neighbours that are of different sides.

    ``records`` has ``side``, 0 or 1; ``passes`` is an array column of (p int, lead
    string, k string) sort keys, null leads and keys taking no part in their
    pass. ``compare(rows, x, y)`` gets rows and the places of the pairs' members;
    ``screen(rows)`` may drop pairs before, of which ``compare`` would keep none.
    A pair may be compared in several passes.
    """
    keyed = records.withColumn("_e", F.explode(passes)).drop(passes)
    keyed = keyed.withColumns({"pass": F.col("_e.p"), "lead": F.col("_e.lead"), "sort_key": F.col("_e.k")}).drop("_e").where("lead IS NOT NULL AND sort_key IS NOT NULL")
    keyed = keyed.withColumn("run", F.xxhash64("pass", "lead"))  # two leads of one hash would only be compared as well
    rows = ranked(keyed, "pass", "lead", "sort_key", tie, without=("lead", "sort_key"))
    joined = rows.join(bounded_broadcast(runs_over_borders(rows)), F.col("run") == F.col("_run"), "left").drop("_run")
    size = F.lit(BLOCK_ROWS)
    reach = F.greatest(F.col("rank") + window, F.coalesce("_to", F.lit(-1)))
    since = F.greatest(F.least(F.col("rank") - window, F.coalesce("_from", F.col("rank"))), F.lit(0))
    block, first = F.floor(F.col("rank") / size), F.floor(since / size)
    as_left = F.transform(F.sequence(block, F.floor(reach / size)), lambda j: F.struct(block.alias("i"), j.alias("j")))
    as_right = F.when(first < block, F.transform(F.sequence(first, block - 1), lambda i: F.struct(i.alias("i"), block.alias("j"))))
    tasks = F.concat(as_left, F.coalesce(as_right, F.array().cast("array<struct<i:bigint,j:bigint>>")))
    spread = joined.withColumns({"block": block, "_t": F.explode(tasks)}).drop("_from", "_to")
    spread = spread.withColumns({"_i": F.col("_t.i"), "_j": F.col("_t.j")}).drop("_t")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("rank", kind="stable").reset_index(drop=True)
        own, other = int(ordered["_i"].iat[0]), int(ordered["_j"].iat[0])
        split = 0 if own == other else int((ordered["block"] == own).sum())
        found = []
        if not (own != other and split in (0, len(ordered))):
            hopeful = screen(ordered) if screen else lambda x, y: True
            rank, same_run, number, side = (ordered[c].to_numpy() for c in ("rank", "run", "pass", "side"))
            found = [compare(ordered, x, y) for x, y in neighbour_pairs(rank, same_run, number, side, window, split, hopeful)]
        return pd.concat(found) if found else compare(ordered, np.zeros(0, int), np.zeros(0, int))

    return spread.groupBy("_i", "_j").applyInPandas(run, schema)
