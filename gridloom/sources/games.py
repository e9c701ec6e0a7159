"""Game summaries and reference tables: nested answers as one document or row per thing, with built-in array functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A game summary as it is delivered.
GAME = (
    "id string, date string, status string, venue string, "
    "competitors array<struct<side:string,team:string,name:string,score:string,winner:boolean,linescores:array<double>>>, "
    "statistics array<struct<team:string,items:array<struct<name:string,value:string>>>>, "
    "leaders array<struct<team:string,groups:array<struct<name:string,leaders:array<struct<athlete_id:string,name:string,position:string,line:string>>>>>>, "
    "plays array<struct<quarter:int,clock:string,team:string,kind:string,text:string,away:int,home:int>>, "
    "videos array<struct<url:string,title:string,duration:int>>"
)


def first_by(items: Column, key: str) -> Column:
    """An array of structs without those whose key stood earlier, and without null keys."""
    known = F.filter(items, lambda x: x[key].isNotNull())
    keys = F.transform(known, lambda x: x[key])
    return F.filter(known, lambda x, i: F.array_position(keys, x[key]) == i + 1)


def game_documents(games: DataFrame, kept: Sequence[str], groups: Mapping[str, str]) -> DataFrame:
    """One row per game: home and away side, their kept statistics, leaders, plays and videos.

    Of a statistic or video listed twice the first counts; a leader group without
    leaders gives none. ``groups`` are the leader groups to keep with their short
    names, in order. A game without one of its sides is left out.
    """

    def side(which: str) -> Column:
        c = F.get(F.filter("competitors", lambda x: x["side"] == which), F.lit(0))
        line = F.transform(F.coalesce(c["linescores"], F.array().cast("array<double>")), lambda x: x.cast("int"))
        return F.struct(c["team"].alias("team"), c["name"].alias("name"), c["score"].try_cast("int").alias("score"), F.coalesce(c["winner"], F.lit(False)).alias("winner"), line.alias("linescore"))

    def statistics(which: str) -> Column:
        own = F.get(F.filter("statistics", lambda x: x["team"] == F.col(f"{which}.team")), F.lit(0))["items"]
        wanted = F.filter(F.coalesce(own, F.array().cast("array<struct<name:string,value:string>>")), lambda x: x["name"].isin(*kept))
        return F.map_from_entries(first_by(wanted, "name"))

    def leaders_of(team: Column) -> Column:
        found = []
        for name, short in groups.items():
            group = F.get(F.filter(team["groups"], lambda g: g["name"] == name), F.lit(0))  # noqa: B023
            one = F.get(group["leaders"], F.lit(0))
            entry = F.struct(F.lit(short).alias("category"), team["team"].alias("team"), one["name"].alias("name"), one["athlete_id"].alias("athlete_id"), one["position"].alias("position"), one["line"].alias("line"))
            found.append(F.when(one.isNotNull(), entry))
        return F.array_compact(F.array(*found))

    sided = games.withColumn("home", side("home")).withColumn("away", side("away")).where("home.team IS NOT NULL AND away.team IS NOT NULL")
    named = F.filter(F.coalesce("videos", F.array().cast("array<struct<url:string,title:string,duration:int>>")), lambda v: v["title"].isNotNull())
    return sided.select(
        "id", "date", "status", "venue", "home", "away", statistics("home").alias("home_stats"), statistics("away").alias("away_stats"),
        F.flatten(F.transform(F.coalesce("leaders", F.expr("cast(array() AS array<struct<team:string,groups:array<struct<name:string,leaders:array<struct<athlete_id:string,name:string,position:string,line:string>>>>>>)")), leaders_of)).alias("leaders"),
        "plays", first_by(named, "url").alias("highlights"),
    )


def leader_lines(documents: DataFrame, master: DataFrame, on: str, fields: Sequence[str]) -> DataFrame:
    """One row per leader of a game document with fields of the master, null for players it doesn't hold."""
    lines = documents.select(F.col("id").alias("game_id"), F.posexplode("leaders").alias("place", "l")).select("game_id", "place", "l.*")
    return lines.join(master.select(F.col(on).alias("athlete_id"), *fields), "athlete_id", "left")


def with_references(answer: DataFrame, items: str, references: Mapping[str, tuple[str, Mapping[str, str]]]) -> DataFrame:
    """One row per item of a single answer, with fields of the reference lists that the same answer holds.

    ``references`` maps an item's key column to (list, {field: name}); the list's
    elements have ``id``. An unknown key gives nulls; of equal ids the last one counts.
    """
    rows = answer.select(F.explode(items).alias("_i")).select("_i.*")
    for key, (listed, fields) in references.items():
        entries = answer.select(F.posexplode(listed).alias("_n", "_r"))
        last = entries.groupBy(F.col("_r.id").alias(key)).agg(*[F.max_by(F.col(f"_r.{f}"), "_n").alias(name) for f, name in fields.items()])
        rows = rows.join(last, key, "left")
    return rows
