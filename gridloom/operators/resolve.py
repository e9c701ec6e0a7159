"""Tiered resolution: a spine joined with candidates tier by tier, at most one match per row, with its source.

Each tier is an equi-join on its own key. Within a tier a match counts only if
it is unique (or is the first in order, where a tier says so); tiers are tried
in order. Candidates are reduced to one row per key and tier before the join,
so the spine never grows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import similarity as sim
from gridloom.session import bounded_broadcast, cut_lineage


@dataclass(frozen=True)
class Tier:
    """A way to match: keys on both sides, and whether one id must be the only one under a key.

    A null key takes no part. ``order`` picks among candidates of a tier that
    need not be unique (default: the smallest id).
    """

    name: str
    spine_key: Column
    candidate_key: Column
    unique: bool = True
    order: Column | None = None
    where: Column | None = None


def resolve_tiers(
    spine: DataFrame, candidates: DataFrame, candidate_id: str, tiers: Sequence[Tier], found: str = "matched_id", source: str = "match_source"
) -> DataFrame:
    """``spine`` with the id of its match and the tier that found it, both null for no match."""
    result = spine
    for i, tier in enumerate(tiers):
        kept = candidates if tier.where is None else candidates.where(tier.where)
        order = tier.order if tier.order is not None else F.col(candidate_id)
        per_key = (
            kept.select(tier.candidate_key.alias(f"_k{i}"), F.col(candidate_id).alias("_id"), order.alias("_o"))
            .where(F.col(f"_k{i}").isNotNull() & F.col("_id").isNotNull())
            .groupBy(f"_k{i}")
            .agg(F.min("_id").alias("_least"), F.max("_id").alias("_most"), F.min_by("_id", F.struct("_o", "_id")).alias("_first"))
        )
        hit = F.when(F.col("_least") == F.col("_most"), F.col("_least")) if tier.unique else F.col("_first")
        per_key = per_key.select(f"_k{i}", hit.alias(f"_m{i}")).where(F.col(f"_m{i}").isNotNull())
        result = result.withColumn(f"_s{i}", tier.spine_key).join(per_key, F.col(f"_s{i}") == F.col(f"_k{i}"), "left").drop(f"_s{i}", f"_k{i}")
    which = F.lit(None).cast("string")
    for i in reversed(range(len(tiers))):
        which = F.when(F.col(f"_m{i}").isNotNull(), F.lit(tiers[i].name)).otherwise(which)
    matched = F.coalesce(*[F.col(f"_m{i}") for i in range(len(tiers))])
    return result.withColumn(found, matched).withColumn(source, which).drop(*[f"_m{i}" for i in range(len(tiers))])


def token_candidates(spine: DataFrame, spine_id: str, spine_tokens: str, cards: DataFrame, card_id: str, card_tokens: str, within: Sequence[str], least: int = 4) -> DataFrame:
    """(spine id, card id, shared, equal): pairs that share a word of ``least`` letters within a group.

    An equi-join on exploded words replaces the scan of every card for every row.
    """
    words = lambda df, key, tokens, out: df.select(*within, F.col(key).alias(out), F.col(tokens).alias(f"{out}_tokens"), F.explode(F.filter(F.array_distinct(F.col(tokens)), lambda t: F.length(t) >= least)).alias("word"))
    left, right = words(spine, spine_id, spine_tokens, "s"), words(cards, card_id, card_tokens, "c")
    joined = left.join(right.hint("merge"), [*within, "word"])
    # a card may have several spellings: words are counted within one of them
    spelled = joined.groupBy("s", "c", "s_tokens", "c_tokens").agg(F.count(F.lit(1)).alias("n"))
    equal = F.array_sort("s_tokens") == F.array_sort("c_tokens")
    return spelled.groupBy("s", "c").agg(F.max("n").alias("shared"), F.max(equal).alias("equal"))


def unique_match(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs whose left side has exactly one right side."""
    agreed = pairs.groupBy(left).agg(F.min(right).alias("_a"), F.max(right).alias("_b"))
    return agreed.where(F.col("_a") == F.col("_b")).select(left, F.col("_a").alias(right))


#: Ratio from which on the rarest grams of a name find fewer candidates than its block.
INDEXED = 85.0
#: Tasks that share the names of a block where its pairs are joined.
SPREAD = 4


def similar_names(names: DataFrame, others: DataFrame, least: float) -> DataFrame:
    """(b, x, y, score): names (b, x) and others (b, y) of one block whose sorted words have a ratio of ``least`` or more.

    From ``INDEXED`` on an exact candidate index stands in for all pairs of a
    block: names that similar share so many grams (``grams_in_common``) that the
    rarest ones of both, all but that many less one, have one in common. Below,
    most grams would be looked up: pairs of a block are joined. Either join
    keeps only pairs whose signatures leave the ratio possible (``may_reach``).
    ``least`` is above 200/3.
    """
    tasks = 4 * int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes, many pairs: not to be coalesced by size

    def keyed(df: DataFrame, name: str) -> DataFrame:
        sorted_name = df.select("b", name, sim.sorted_words(F.col(name)).alias("k")).where("b IS NOT NULL AND k <> ''").distinct()
        signed = sorted_name.withColumn("s", sim.signed_text(F.col("k")))
        return cut_lineage(signed.select("b", name, F.col("k").alias(f"k_{name}"), F.length("k").alias(f"n_{name}"), *[F.col(f"s.{c}").alias(f"{c}_{name}") for c in ("l0", "l1", "g0", "g1")]))

    left, right = keyed(names, "x"), keyed(others, "y")
    if least < INDEXED:
        # the names of a block are spread over a few tasks, each with all others of the block
        spread = left.withColumn("part", F.pmod(F.hash("x"), F.lit(SPREAD))).repartition(tasks, "b", "part")
        copied = right.withColumn("part", F.explode(F.array(*[F.lit(i) for i in range(SPREAD)]))).repartition(tasks, "b", "part")
        joined = spread.join(copied.hint("merge"), ["b", "part"])
        pairs = joined.where(sim.may_reach("x", "y", least)).select("b", "x", "y", "k_x", "k_y")
    else:
        grams = lambda df, name: df.select("*", F.explode(sim.numbered_grams(F.col(f"k_{name}"))).alias("g"))
        left, right = cut_lineage(grams(left, "x")), cut_lineage(grams(right, "y"))
        frequent = left.select("g").unionByName(right.select("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n"))
        frequent = bounded_broadcast(frequent)

        def rarest(df: DataFrame, name: str) -> DataFrame:
            own = [c for c in df.columns if c != "g"]
            listed = df.join(frequent, "g").groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("n", "g"))).alias("gs"))
            length = F.col(f"n_{name}")
            # letters of short texts stand beside their pairs: they are all looked up
            kept = F.when(length <= 3, F.size("gs")).otherwise(F.size("gs") - sim.grams_in_common(length, least) + 1)
            return listed.select(*own, F.explode(F.slice("gs", F.lit(1), F.greatest(kept, F.lit(1)).cast("int"))).alias("e")).select(*own, F.col("e.g").alias("g")).repartition(tasks, "b", "g")

        joined = rarest(left, "x").join(rarest(right, "y").hint("merge"), ["b", "g"])
        pairs = joined.where(sim.may_reach("x", "y", least)).select("b", "x", "y", "k_x", "k_y").distinct()
    scored = pairs.withColumn("score", sim.sorted_ratio(F.col("k_x"), F.col("k_y")))
    return scored.where(F.col("score") >= least).select("b", "x", "y", "score")


def most_similar(rows: DataFrame, cards: DataFrame, least: float) -> DataFrame:
    """(s, c, score): for rows (s, b, x) the card (c, b, y) of the best ratio in the block, from ``least`` on, the smallest of several.

    Names of the same words need no comparison; only the others are looked up among similar ones.
    """
    rows = rows.where("b IS NOT NULL")
    cards = cards.where("b IS NOT NULL").groupBy("b", "y").agg(F.min("c").alias("c"))
    words = lambda df, name: df.withColumn("k", sim.sorted_words(F.col(name))).where("k <> ''")
    by_words = words(cards, "y").groupBy("b", "k").agg(F.min("c").alias("c"), F.lit(100.0).alias("score"))
    same = cut_lineage(words(rows, "x").join(by_words.hint("merge"), ["b", "k"], "left").select("s", "b", "x", "c", "score"))
    missed = same.where("score IS NULL").select("s", "b", "x")
    scored = similar_names(missed.select("b", "x").distinct(), cards.select("b", "y"), least)
    best = scored.join(cards.hint("merge"), ["b", "y"]).groupBy("b", "x").agg(F.max(F.struct("score", (-F.col("c")).alias("m"))).alias("v"))
    similar = missed.join(best.hint("merge"), ["b", "x"]).select("s", (-F.col("v.m")).alias("c"), F.col("v.score").alias("score"))
    return same.where("score IS NOT NULL").select("s", "c", "score").unionByName(similar)


def similar_any_or_own(rows: DataFrame, cards: DataFrame, strict: float, loose: float) -> DataFrame:
    """(s, c, score) for rows (s, b, x, t) and cards (c, b, y, t): the best card of the block from ``strict`` on, else the best of the own team from ``loose`` on.

    Only pairs that can count are looked for: whole blocks from ``strict`` on, and
    for rows without such a card those of a block and team.
    """
    found = cut_lineage(most_similar(rows.select("s", "b", "x"), cards.select("c", "b", "y"), strict))
    missed = rows.join(found.select("s").distinct(), "s", "left_anti")
    team = F.when(F.col("b").isNotNull() & F.col("t").isNotNull(), F.struct("b", "t"))
    own = most_similar(missed.select("s", team.alias("b"), "x"), cards.select("c", team.alias("b"), "y"), loose)
    return found.unionByName(own)


def fuzzy_in_block(
    spine: DataFrame, spine_id: str, spine_name: str, candidates: DataFrame, candidate_id: str, candidate_name: str,
    block: str, team: str, strict: float = 95.0, loose: float = 80.0,
) -> DataFrame:
    """(spine id, candidate id, score): best ratio within a block.

    From ``strict`` on the best name of the block counts whatever its team;
    from ``loose`` on the best name of the row's own team does. Distinct names
    are compared once per block.
    """
    rows = spine.select(F.col(spine_id).alias("s"), F.col(block).alias("b"), F.col(spine_name).alias("x"), F.col(team).alias("t"))
    cards = candidates.select(F.col(candidate_id).alias("c"), F.col(block).alias("b"), F.col(candidate_name).alias("y"), F.col(team).alias("t"))
    found = similar_any_or_own(rows, cards, strict, loose)
    return found.select(F.col("s").alias(spine_id), F.col("c").alias(candidate_id), "score")
