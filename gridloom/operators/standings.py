"""Who owned a slot first, inferred from an order of picks.

``modal_owners``: a slot whose most frequent owner over the rounds is clear is
that team's, if it is clear for one slot only. ``standing_owners``: teams with
equal records share as many consecutive slots of a round as there are of them,
worst record first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.metrics import modal_confidence
from gridloom.operators.relational import modes

#: Slots by which an order may differ from the standings.
WOBBLE = 4


def modal_owners(picks: DataFrame) -> DataFrame:
    """(slot, team) of picks (round, slot, owner): clear and unique modal owners."""
    clear = modes(picks, ["slot"], "owner").where(modal_confidence(F.col("n1"), F.col("n2")))
    claims = F.count(F.lit(1)).over(Window.partitionBy("modal"))
    return clear.withColumn("_c", claims).where("_c = 1").select("slot", F.col("modal").alias("team"))


def slot_ranges(standings: DataFrame) -> DataFrame:
    """(team, low, high): the slots that a team's group of equal records takes, from standings (team, share)."""
    share = F.round("share", 6)
    low = F.rank().over(Window.orderBy(share))  # one row per team of a league
    return standings.select("team", low.alias("low"), (low + F.count(F.lit(1)).over(Window.partitionBy(share)) - 1).alias("high"))


def standing_owners(picks: DataFrame, standings: DataFrame) -> DataFrame:
    """(round, slot, owner, original) of picks (round, slot, owner) by standings (team, share).

    In a round with a pick for every team's slot: a team keeps its first slot in
    its group's range; one without any there may hold the nearest slot outside,
    within ``WOBBLE``, as its own. A group with one other slot and one team
    without a slot has found them: the slot was that team's. Everything else stays with its owner.
    """
    ranges = slot_ranges(standings)
    groups = ranges.groupBy("low", "high").agg(F.collect_set("team").alias("members"))
    places = groups.select("members", F.col("low").alias("group"), F.explode(F.sequence("low", "high")).alias("slot"))
    # only slots of the base order are judged, and only in rounds that have all of them
    placed = picks.join(places, "slot", "left").withColumn("_in_base", F.count("group").over(Window.partitionBy("round")))
    all_slots = F.lit(standings.count())  # a league's teams
    judged = placed.where(F.col("group").isNotNull() & (F.col("_in_base") >= all_slots)).join(ranges, F.col("owner") == F.col("team"), "left")
    by_owner = Window.partitionBy("round", "owner")
    within = F.coalesce(F.col("slot").between(F.col("low"), F.col("high")), F.lit(False))
    away = F.greatest(F.col("low") - F.col("slot"), F.col("slot") - F.col("high"))
    judged = judged.withColumn("_first_own", F.min(F.when(within, F.col("slot"))).over(by_owner))
    judged = judged.withColumn("_moved", F.min(F.when(F.col("_first_own").isNull() & (away <= WOBBLE), F.col("slot"))).over(by_owner))
    holds = F.col("slot") == F.coalesce("_first_own", "_moved")
    judged = judged.withColumn("_holds", F.coalesce(holds, F.lit(False)))
    others = judged.groupBy("round", "group").agg(
        F.count(F.when(~F.col("_holds"), F.col("slot"))).alias("_others"), F.min(F.when(~F.col("_holds"), F.col("slot"))).alias("_other"), F.first("members").alias("members")
    )
    holders = judged.where("_holds").groupBy("round", F.col("low").alias("group")).agg(F.collect_set("owner").alias("holders"))
    one_left = others.where("_others = 1").join(holders, ["round", "group"], "left")
    left_over = F.array_except("members", F.coalesce("holders", F.array().cast("array<string>")))
    known = one_left.where(F.size(left_over) == 1).select("round", F.col("_other").alias("slot"), left_over[0].alias("_was"))
    found = picks.join(known, ["round", "slot"], "left")
    return found.select("round", "slot", "owner", F.coalesce("_was", "owner").alias("original"))


def order_problems(picks: DataFrame, teams: DataFrame, rounds: int, least: int, most: int) -> list[str]:
    """What keeps picks (pick, round, owner) from being a whole draft order; nothing if it is one.

    Picks count from 1 without gaps or repeats, rounds 1 to ``rounds`` follow
    each other, all owners are ``teams`` (team), and every team owns a pick.
    """
    before = F.lag("round").over(Window.orderBy("pick"))  # a few hundred picks
    seen = picks.withColumn("_before", before).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("pick").alias("distinct"), F.min("pick").alias("first"), F.max("pick").alias("last"), F.count_distinct("round").alias("rounds"),
        F.min("round").alias("low"), F.max("round").alias("high"), F.sum((F.col("round") < F.col("_before")).cast("int")).alias("back"),
    ).first()
    owners = picks.select(F.col("owner").alias("team")).distinct()
    problems = []
    if seen["distinct"] < seen["n"]:
        problems.append("a pick is listed twice")
    if not least <= seen["n"] <= most or seen["first"] != 1 or seen["last"] != seen["n"]:
        problems.append(f"{seen['n']} picks don't count from 1 to {most} at most")
    if (seen["rounds"], seen["low"], seen["high"]) != (rounds, 1, rounds) or seen["back"]:
        problems.append(f"rounds aren't 1 to {rounds} in order")
    strange = sorted(r["team"] for r in owners.join(teams, "team", "left_anti").collect())  # at most a pick's number
    if strange:
        problems.append(f"unknown owners {', '.join(strange)}")
    if teams.join(owners, "team", "left_anti").limit(1).count():
        problems.append("a team owns no pick")
    return problems


def override_latest(labelled: DataFrame, overrides: DataFrame) -> DataFrame:
    """Known owners (round, owner, original) replace the label of that owner's latest unlabelled pick of the round."""
    open_picks = labelled.where(F.col("owner") == F.col("original")).groupBy("round", "owner").agg(F.max("slot").alias("slot"))
    known = overrides.withColumnRenamed("original", "known").join(open_picks, ["round", "owner"]).select("round", "slot", "known")
    return labelled.join(known, ["round", "slot"], "left").withColumn("original", F.coalesce("known", "original")).drop("known")
