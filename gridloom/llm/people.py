"""The project's people: how depth charts and match rows describe one player, for linking and matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.variants import Attribute, Rule, variant_groups, variant_row_pairs, with_name_key
from gridloom.session import cut_lineage

#: Depth charts: what a chart repeats about a player in each of his slots.
CHART = (
    Attribute("attainment", same=3.0),
    Attribute("years_pro", same=2.0),
    Attribute("cap", same=1.5),
    Attribute("madden", same=3.0),
    Attribute("age", same=2.0, near=1.0, tolerance=1),
    Attribute("jersey", same=4.0, near=2.0, steps=(10, -10), modulus=100),
)
#: Match rows: measures that don't change between deliveries.
MATCH = (
    Attribute("jersey", same=4.0),
    Attribute("height", same=2.0),
    Attribute("weight", same=4.0),
    Attribute("position", same=2.0),
    Attribute("age", same=1.5, near=1.0, tolerance=1),
)
#: What a link on a chart has in common: a token that is the same, an edit off or sounds so, or two short forms; every weaker
#: agreement of names stays below the threshold of ``chart_pairs`` unless some attribute agrees.
CHART_RULES = (Rule("near"), Rule("", tuple((a.name,) for a in CHART)))
#: What a link of match rows has in common: the threshold of ``match_pairs`` asks for evidence of 3.5, which is the jersey, the weight,
#: or two of position, height and age. Without jersey and weight at most 2.0 may be lost on the name: a token is the same, or all are short forms.
MATCH_RULES = (
    Rule("ends", (("jersey", "position"), ("weight", "position"))),
    Rule("exact", (("height", "position"), ("position", "age"), ("height", "age")), one_lacks=("jersey", "weight")),
    Rule("ends", (("jersey",), ("weight",), ("height", "age")), one_lacks=("position",)),
)


def text_code(c: Column) -> Column:
    """A text as a number that is equal for equal texts only (up to a 31-bit hash); null stays null."""
    return F.when(c.isNotNull() & (F.trim(c) != ""), F.hash(F.trim(c)))


def inches(height: Column) -> Column:
    """Height in inches from 6-1 or 6'1"."""
    feet = F.regexp_extract(height, r"^\s*(\d)\s*['\-]\s*(\d{1,2})", 1)
    rest = F.regexp_extract(height, r"^\s*(\d)\s*['\-]\s*(\d{1,2})", 2)
    return F.when(feet != "", feet.cast("int") * 12 + rest.cast("int"))


def chart_attributes() -> list[tuple[Attribute, Column]]:
    columns = {
        "attainment": text_code(F.col("attainment")),
        "cap": text_code(F.when(F.col("cap_number").rlike(r"\d"), F.col("cap_number"))),
    }
    return [(a, columns.get(a.name, F.col(a.name))) for a in CHART]


def match_attributes() -> list[tuple[Attribute, Column]]:
    columns = {
        "jersey": F.coalesce("jersey", "madden_jersey"),
        "height": inches(F.col("height")),
        "position": text_code(F.col("standard_pos")),
    }
    return [(a, columns.get(a.name, F.col(a.name))) for a in MATCH]


def hashed(*columns: str) -> Column:
    """64-bit identity of a key; null is a value of its own."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])


def entity_of(key: str, row: str) -> Column:
    """Identity of a row's entity; a row without a key stands for itself."""
    return F.when(F.col(key).isNotNull(), hashed(key)).otherwise(F.xxhash64(F.lit("row"), F.col(row)))


def chart_pairs(charts: DataFrame) -> DataFrame:
    """(row_id_a, row_id_b): rows of one chart that mean the same player under different spellings.

    One name key on one chart is one player; other keys link to it.
    """
    keyed = with_name_key(
        charts.select("doc_no", F.col("row_id").alias("row"), F.col("name").alias("spelling"), *[v.cast("int").alias(a.name) for a, v in chart_attributes()]),
        "spelling",
    )
    rows = cut_lineage(keyed.where(F.col("name_key").isNotNull()).withColumns(
        {"entity": hashed("doc_no", "name_key"), "block": F.col("doc_no").cast("string"), "name_keys": F.array("name_key")}
    ))
    groups = variant_groups(rows, CHART, 3.0, 9.0, CHART_RULES)
    return variant_row_pairs(rows, groups, CHART, within_entity=True)


def match_rows(matches: DataFrame) -> DataFrame:
    """Match rows with entity (player key), the name keys of both name columns and attributes."""
    columns = ["player_key", "row", "spelling", *[a.name for a in MATCH]]
    plain = matches.select(
        "player_key", F.col("row_id").alias("row"), F.col("canonical_name").alias("spelling"), F.col("ourlads_name").alias("listed"),
        *[v.cast("int").alias(a.name) for a, v in match_attributes()],
    )
    keyed = with_name_key(with_name_key(plain, "listed").withColumnRenamed("name_key", "listed_key"), "spelling")
    keyed = keyed.withColumn("name_keys", F.array_distinct(F.array_compact(F.array("name_key", "listed_key"))))
    return cut_lineage(keyed.select(*columns, "name_key", "name_keys", F.lit(None).cast("string").alias("block"), entity_of("player_key", "row").alias("entity")))


def match_pairs(matches: DataFrame) -> DataFrame:
    """(row_id_a, row_id_b): match rows of one player under different keys and spellings."""
    rows = match_rows(matches)
    groups = variant_groups(rows, MATCH, 9.5, 11.0, MATCH_RULES)
    return variant_row_pairs(rows, groups, MATCH, within_entity=False)
