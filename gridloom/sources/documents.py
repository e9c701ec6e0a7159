"""Nested JSON as typed rows. Schemas are given, never inferred: dynamic keys are maps, not structs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.ordering import ranked

#: One player of a team document.
CHART_PLAYER = "name string, depth int, injured boolean, attainment string, standard_slot string, standard_pos string, cap_number string, stats map<string,string>, stats_season int"


def team_document_schema() -> T.StructType:
    """Schema of a team document: a map of slots to arrays of players."""
    player = T._parse_datatype_string(CHART_PLAYER)
    head = T._parse_datatype_string("team string, abbr string, source string, base_defense string")
    return T.StructType([*head.fields, T.StructField("depth_chart", T.MapType(T.StringType(), T.ArrayType(player)))])


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """Whole-file JSON documents (an object or an array of objects) with the file they come from."""
    return spark.read.schema(schema).option("multiLine", True).json(paths).withColumn("_file", F.col("_metadata.file_path"))


def unnest_charts(documents: DataFrame, order: Sequence[str] = ("_file",)) -> DataFrame:
    """One row per player of team documents; ``row_id`` counts in the order of files, slots and places.

    Rows are ranked in parallel; no task holds all documents.
    """
    slots = documents.where(F.col("depth_chart").isNotNull()).select(*order, "team", "abbr", "source", "base_defense", F.posexplode(F.map_entries("depth_chart")).alias("_slot", "_entry"))
    players = slots.select(*order, "team", "abbr", "source", "base_defense", "_slot", F.col("_entry.key").alias("ourlads_pos"), F.posexplode("_entry.value").alias("_place", "_player"))
    rows = players.select("*", "_player.*").withColumn("stats_json", F.to_json("stats")).drop("_player", "stats")
    return ranked(rows, *order, "_slot", "_place").withColumnRenamed("rank", "row_id").drop("_slot", "_place")


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """CSV files with a header as typed rows; columns are found by name, and a file that lacks one is refused where ``strict``.

    Nothing is inferred. Columns of the file that the schema doesn't name are left out; cells that don't parse are null.
    """
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    held = spark.read.option("header", True).csv(path)
    missing = [f.name for f in wanted.fields if f.name not in held.columns]
    if missing and strict:
        raise ValueError(f"source lacks {', '.join(missing)}")
    typed = lambda f: F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})") if f.name in held.columns else F.lit(None).cast(f.dataType)
    return held.select(*[typed(f).alias(f.name) for f in wanted.fields])


def keyed_rows(df: DataFrame, column: str, key: str = "record_id") -> DataFrame:
    """One row per entry of a map column, with its place among the entries."""
    return df.select(F.posexplode(F.map_entries(column)).alias("row_id", "_e")).select("row_id", F.col("_e.key").alias(key), "_e.value.*")


def envelope_rows(df: DataFrame, items: str, scalars: Sequence[str] = ()) -> DataFrame:
    """One row per element of an envelope's list, with its place and the envelope's scalars."""
    return df.select(*scalars, F.posexplode(items).alias("row_id", "_i")).select(*scalars, "row_id", "_i.*")


def dictionary_index(values: Column, value: Column) -> Column:
    """Place of a value in the envelope's own list, null if it isn't listed."""
    return F.nullif(F.array_position(values, value), F.lit(0)) - 1


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs as columns named by their path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
        found = []
        for field in schema.fields:
            here = (*path, field.name)
            found += leaves(field.dataType, here) if isinstance(field.dataType, T.StructType) else [here]
        return found

    quoted = lambda path: ".".join(f"`{p}`" for p in path)
    return df.select(*[F.col(quoted(path)).alias(separator.join(path)) for path in leaves(df.schema, ())])


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error that names the columns it lacks."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"source lacks {', '.join(missing)}")
    return df


def struct_of_others(df: DataFrame, without: Sequence[str], name: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` and one struct of all columns but the administrative ones."""
    return df.select(*keep, F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in set(without) | set(keep)]).alias(name))


def season_or_before(read: Callable[[int], DataFrame], season: int) -> tuple[DataFrame, int]:
    """The season's rows, or the season before's if reading fails or gives none."""
    try:
        found = read(season)
        if found.limit(1).count():
            return found, season
    except Exception as problem:  # a missing file is what this is for
        print(f"season {season} can't be read ({type(problem).__name__}); {season - 1} instead")
    return read(season - 1), season - 1


def has_table(spark: SparkSession, name: str) -> bool:
    """Whether an optional table exists."""
    return spark.catalog.tableExists(name)


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN in number columns becomes null, the only missing value of this library."""
    number = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType | T.FloatType)}
    return df.select(*[F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in number else F.col(f"`{c}`") for c in df.columns])
