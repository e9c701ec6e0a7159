"""Row selection, ordering and set operators. Every order is total: a tie breaker is always part of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.ordering import ranked_within


def pick_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in an order.

    The rank filter lets the group-limit operator keep one row per key and map
    task before the exchange, so a hot key costs no more than another.
    """
    ranked = df.withColumn("_pick", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_pick") == 1).drop("_pick")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key."""
    return pick_row(df, keys, [F.col(c).asc_nulls_last() for c in order])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key."""
    return pick_row(df, keys, [F.col(c).desc_nulls_last() for c in order])


def first_and_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key with ``first_COLUMN`` and ``last_COLUMN``: one scan, one partially aggregated shuffle. Orders have no nulls."""
    at = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.min_by(c, at).alias(f"first_{c}") for c in columns], *[F.max_by(c, at).alias(f"last_{c}") for c in columns])


def prefer_row(df: DataFrame, keys: Sequence[str], preferred: Column, order: Sequence[Column]) -> DataFrame:
    """A preferred row per key if there is one, else the first in order."""
    return pick_row(df, keys, [F.coalesce(preferred, F.lit(False)).desc(), *order])


def latest_informative(df: DataFrame, keys: Sequence[str], informative: Column, order: Sequence[str]) -> DataFrame:
    """Last row per key among those that say something."""
    return keep_last(df.where(informative), keys, order)


def healthy_first(df: DataFrame, keys: Sequence[str], injured: Column, depth: Column, order: str) -> DataFrame:
    """Best row per key: healthy before injured, then by depth among the healthy, then the earliest."""
    hurt = F.coalesce(injured, F.lit(False))
    return pick_row(df, keys, [hurt.asc(), F.when(~hurt, depth).asc_nulls_last(), F.col(order).asc()])


def position_ranks(df: DataFrame, group: str, score: str, order: str) -> DataFrame:
    """Adds ``group_rank`` (by decreasing score, ties by order) and ``group_total``; a group may hold most of the rows."""
    return ranked_within(df, [group], [F.col(score).desc_nulls_last(), order], "group_rank", "group_total")


def running_record(df: DataFrame, keys: Sequence[str], order: Sequence[str], outcome: str, values: Sequence[str]) -> DataFrame:
    """Adds ``so_far_VALUE``: how often each outcome occurred up to and with the row."""
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for v in values:
        df = df.withColumn(f"so_far_{v}", F.sum(F.when(F.col(outcome) == v, 1).otherwise(0)).over(upto))
    return df


def cumulative_ends(df: DataFrame, size: str, order: str, within: Sequence[str] = ()) -> DataFrame:
    """Adds ``range_start`` and ``range_end``: consecutive ranges of the sizes in order, from 1."""
    upto = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("range_end", F.sum(size).over(upto)).withColumn("range_start", F.col("range_end") - F.col(size) + 1)


def rising_steps(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Rows whose value is greater than the one before: what a falling series must not have."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("value_before", before).where(F.col(value) > F.col("value_before"))


def fill_down(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, filled: str) -> DataFrame:
    """Adds ``filled``: the last value known up to the row."""
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(filled, F.last(value, ignorenulls=True).over(upto))


def running_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Adds the row's number within its key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def with_suffixes(df: DataFrame, key: str, order: Sequence[str], name: str) -> DataFrame:
    """Adds an id made unique: the key, then key-2, key-3 in order; a key may be that of most rows."""
    numbered = ranked_within(df, [key], list(order), "_nth")
    return numbered.withColumn(name, F.when(F.col("_nth") == 1, F.col(key)).otherwise(F.concat_ws("-", key, F.col("_nth").cast("string")))).drop("_nth")


def first_claims(claims: DataFrame, claimed: Sequence[str], claimant: str, order: Sequence[str]) -> DataFrame:
    """Each claimed thing goes to its first claimant; a claimant keeps its first thing only.

    A claim that loses does not fall through to another thing.
    """
    first = keep_first(claims, [claimant], order)
    return keep_first(first, claimed, order)


def diminishing(df: DataFrame, keys: Sequence[str], order: Sequence[str], factors: Sequence[float], name: str) -> DataFrame:
    """Adds the factor of the k-th row of a key; the last factor repeats."""
    table = F.array(*[F.lit(float(f)) for f in factors])
    numbered = ranked_within(df, list(keys), list(order), "_nth")
    return numbered.withColumn(name, F.element_at(table, F.least("_nth", F.lit(len(factors))))).drop("_nth")


def modes(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys..., modal, n1, n2): most frequent value, its count, and the runner-up's count (0 if none)."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_n").desc(), F.col(value).asc_nulls_last()))
    top = counted.withColumn("_r", rank).where(F.col("_r") <= 2)
    return top.groupBy(*keys).agg(
        F.max(F.when(F.col("_r") == 1, F.col(value))).alias("modal"),
        F.max(F.when(F.col("_r") == 1, F.col("_n"))).alias("n1"),
        F.coalesce(F.max(F.when(F.col("_r") == 2, F.col("_n"))), F.lit(0)).alias("n2"),
    )


def prefix_contains(df: DataFrame, others: DataFrame, name: str, other: str, letters: int = 6) -> DataFrame:
    """Pairs of distinct names (name, other) where ``other`` contains the first ``letters`` letters of ``name``; shorter names have none.

    Names are cut into all their runs of that many letters, so the pairs are an equi-join.
    """
    heads = df.where(F.length(name) >= letters).select(name, F.substring(name, 1, letters).alias("_run")).distinct()
    runs = F.transform(F.sequence(F.lit(1), F.length(other) - letters + 1), lambda i: F.substr(F.col(other), i, F.lit(letters)))
    held = others.where(F.length(other) >= letters).select(other).distinct().withColumn("_run", F.explode(F.array_distinct(runs)))
    return heads.join(held.hint("merge"), "_run").drop("_run")


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int = 10) -> DataFrame:
    """The first ``n`` rows in a total order: a preview or a report."""
    return df.orderBy(*[F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]).limit(n)


def prefer_side(fresh: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All fresh rows and the previous rows whose key no fresh row has."""
    kept = previous.join(fresh.select(*keys).distinct(), list(keys), "left_anti")
    return fresh.unionByName(kept)


def key_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side): every distinct key with both, left_only or right_only. One shuffle serves all set operations."""
    sides = a.select(F.col(key).alias(key), F.lit(1).alias("_s")).unionByName(b.select(F.col(key).alias(key), F.lit(2).alias("_s")))
    seen = sides.groupBy(key).agg(F.bit_or("_s").alias("_s"))
    return seen.select(key, F.when(F.col("_s") == 3, "both").when(F.col("_s") == 1, "left_only").otherwise("right_only").alias("side"))


def keyed_diff(old: DataFrame, new: DataFrame, key: str, main: str, others: Sequence[str]) -> DataFrame:
    """One row (main_changed, others_changed, added, removed): differences of two keyed tables; null equals null."""
    o = old.select(F.col(key).alias("_ok"), F.col(main).alias("_om"), F.struct(*others).alias("_oo"))
    n = new.select(F.col(key).alias("_nk"), F.col(main).alias("_nm"), F.struct(*others).alias("_no"))
    both = F.col("_ok").isNotNull() & F.col("_nk").isNotNull()
    count = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).alias
    joined = o.join(n, F.col("_ok") == F.col("_nk"), "full_outer")
    return joined.agg(
        count(both & ~F.col("_om").eqNullSafe(F.col("_nm")))("main_changed"),
        count(both & ~F.col("_oo").eqNullSafe(F.col("_no")))("others_changed"),
        count(F.col("_ok").isNull())("added"),
        count(F.col("_nk").isNull())("removed"),
    )


def table_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (rows, digest): equal for tables with the same rows in any order.

    Row hashes are summed as decimals, so nothing is sorted or gathered.
    """
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])
    part = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(part), F.lit(0).cast("decimal(38,0)")).cast("string").alias("digest"))


def unchanged_since(old_digest: str | None, new_digest: str, old_date: str | None, today: str) -> str:
    """Date of the last change: carried forward while the digest stays the same."""
    return old_date if old_date and old_digest == new_digest else today


def nulls_last_rank(df: DataFrame, columns: Sequence[str], name: str, within: Sequence[str]) -> DataFrame:
    """Adds the row's place in a composite order with nulls last, within a group."""
    order = [F.col(c).asc_nulls_last() for c in columns]
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*order)))


def season_pivot(df: DataFrame, keys: Sequence[str], index: str, values: Sequence[str]) -> DataFrame:
    """Values at index 0 as they are and at index 1 as ``prev_VALUE``, one row per key."""
    at = lambda i, v: F.max(F.when(F.col(index) == i, F.col(v)))
    return df.groupBy(*keys).agg(*[at(0, v).alias(v) for v in values], *[at(1, v).alias(f"prev_{v}") for v in values])


def season_totals(df: DataFrame, key: str, sums: Sequence[str], first: Sequence[str], last: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per known key: sums with null as 0, attributes of its first row and of its last row in order."""
    at = F.struct(*order)
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        *[F.min_by(c, at).alias(c) for c in first],
        *[F.max_by(c, at).alias(c) for c in last],
    )


def total_and_length(df: DataFrame, values: str, total: str, length: str) -> DataFrame:
    """Adds the sum and the number of an array's values."""
    summed = F.aggregate(F.transform(values, lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return df.withColumn(total, summed).withColumn(length, F.size(values))


def remap_keys(column: str, names: dict[str, str]) -> Column:
    """Map with its keys renamed (as they are, else in upper case, else kept); a later entry of the same name wins."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    renamed = lambda k: F.coalesce(F.try_element_at(table, k), F.try_element_at(table, F.upper(k)), k)
    entries = F.transform(F.map_entries(column), lambda e: F.struct(renamed(e["key"]).alias("key"), e["value"].alias("value")))
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]
    return F.map_from_arrays(keys, F.transform(keys, last))


def without_zeros(column: str) -> Column:
    """Map without entries that are null or zero."""
    return F.map_filter(column, lambda _, v: v.isNotNull() & (v != "0") & (v != "0.0"))
