"""Queries of the training-data problems and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import people
from gridloom.llm import survivors as sv
from gridloom.llm.matching import match_rosters
from gridloom.llm.mixing import mix_documents, mix_plan, mix_shares, sized_documents
from gridloom.llm.packing import fill_report, pack_items
from gridloom.llm.text_forms import LOOK_ALIKES, canonical_sql, with_canonical
from gridloom.llm.tokens import token_sizes
from gridloom.llm.top_n import top_n
from gridloom.llm.truncation import judged_documents, truncation_rates
from gridloom.session import load


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rows that mean the same player under different spellings, on depth charts and among match rows."""
    charts = people.chart_pairs(load(spark, sf_dir, "ourlads_players")).withColumn("tbl", F.lit("ourlads_players"))
    matches = people.match_pairs(load(spark, sf_dir, "player_match")).withColumn("tbl", F.lit("player_match"))
    return charts.unionByName(matches).select("tbl", "row_id_a", "row_id_b")


def p2_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each match row without an id with the roster id of its player and the confidence of the match."""
    unresolved = load(spark, sf_dir, "player_match").where(F.col("gsis_id").isNull())
    return match_rosters(unresolved, load(spark, sf_dir, "nflreadpy_rosters"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each match row without an id with the roster id of its player."""
    return p2_matches(spark, sf_dir).select("row_id", "gsis_id")


def p4_top_five(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    """The five best cards of every position label in every rating iteration, with rank and score."""
    cards = load(spark, sf_dir, "madden_ratings")
    return top_n(
        cards, ["iteration_id", "madden_pos_label"], "madden", "card_id", n,
        item_key=["iteration_id", "card_id"], latest="delivered_at", tie_latest="row_id",
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best cards of every position label in every rating iteration."""
    return p4_top_five(spark, sf_dir).select("iteration_id", "madden_pos_label", "card_id")


def p5_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name of both tables with its canonical form."""
    matches = load(spark, sf_dir, "player_match").select(F.lit("player_match").alias("tbl"), "row_id", F.col("canonical_name").alias("stored"))
    ratings = load(spark, sf_dir, "qbr_ratings").select(F.lit("qbr_ratings").alias("tbl"), "row_id", F.col("name").alias("stored"))
    return with_canonical(matches.unionByName(ratings), "stored")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose name looks ordinary but is stored in other characters."""
    altered = ~F.col("stored").eqNullSafe(F.col("canonical")) | F.col("mixed_script")
    return p5_forms(spark, sf_dir).where(altered).select("tbl", "row_id").distinct()


MATCH_FIELDS = (
    sv.Field("cap_number", needs_digit=True),
    sv.Field("college"),
    sv.Field("depth", 1, 98),
    sv.Field("madden", 1, 99),
    sv.Field("team"),
)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per player key and field the row that the surviving value comes from."""
    rows = load(spark, sf_dir, "player_match")
    return sv.survivors(rows, "player_key", MATCH_FIELDS, "inj_section", "loaded_at", "row_id").drop("value")


def p6_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bayesian fusion with copy detection over kinds of delivery: list or chart, stamped or not, listed hurt or not."""
    rows = load(spark, sf_dir, "player_match")
    flag = lambda c, yes, no: F.when(c, F.lit(yes)).otherwise(F.lit(no))
    source = F.concat_ws(
        "-",
        flag(F.coalesce("inj_section", F.lit(False)), "list", "chart"),
        flag(F.col("loaded_at").isNull(), "undated", "dated"),
        flag(F.coalesce(F.trim("injury_status"), F.lit("")) == "", "fit", "hurt"),
    )
    return sv.fuse(rows, "player_key", MATCH_FIELDS, source, "inj_section", "loaded_at", "row_id")


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document, or piece of one, for each kind of container."""
    sizes = token_sizes(load(spark, sf_dir, "documents"), "text", ["doc_id"])
    # the kinds of container are a parameter: a fixed table of a few rows
    packs = [(row["pack_name"], row["capacity_tokens"]) for row in load(spark, sf_dir, "pack_sizes").collect()]
    return pack_items(sizes, packs, "doc_id", "n_tokens")


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are."""
    return fill_report(p8_containers(spark, sf_dir))


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sized = sized_documents(load(spark, sf_dir, "documents"), "doc_id", "text", "source")
    plan = mix_plan(sized, load(spark, sf_dir, "mix_targets"))
    return mix_documents(sized, plan), plan


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of every mix with their repeats."""
    return _mix(spark, sf_dir)[0].withColumnRenamed("doc", "doc_id")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of every source in every mix."""
    return mix_shares(*_mix(spark, sf_dir))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut off before the end of what the author wrote."""
    return judged_documents(load(spark, sf_dir, "documents"), "doc_id", "text", "source").where("cut").select(F.col("doc").alias("doc_id"))


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source cuts its texts off."""
    return truncation_rates(load(spark, sf_dir, "documents"), "doc_id", "text", "source")


QUERIES = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p2_matches": p2_matches,
    "p4_found": p4_found,
    "p4_top_five": p4_top_five,
    "p5_found": p5_found,
    "p5_forms": p5_forms,
    "p6_found": p6_found,
    "p6_fused": p6_fused,
    "p8_containers": p8_containers,
    "p8_fill": p8_fill,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_rates": p10_rates,
}

_TOP = """
WITH latest AS (
  SELECT iteration_id, card_id, madden, madden_pos_label FROM madden_ratings
  QUALIFY row_number() OVER (PARTITION BY iteration_id, card_id ORDER BY delivered_at DESC NULLS LAST, row_id DESC) = 1)
SELECT iteration_id, madden_pos_label, card_id, madden,
       CAST(row_number() OVER (PARTITION BY iteration_id, madden_pos_label ORDER BY madden DESC, card_id) AS INT) AS top_rank
FROM latest WHERE madden IS NOT NULL AND madden_pos_label IS NOT NULL AND iteration_id IS NOT NULL
QUALIFY top_rank <= 5
"""
_NAMES = """(SELECT 'player_match' AS tbl, row_id, canonical_name AS name FROM player_match
   UNION ALL SELECT 'qbr_ratings', row_id, name FROM qbr_ratings)"""
_UNKNOWN = ", ".join(f"'{x}'" for x in sv.UNKNOWN)
_CLAIMS = " UNION ALL ".join(
    f"SELECT player_key, '{field}' AS field_name, inj_section, loaded_at, row_id FROM player_match WHERE {real}"
    for field, real in (
        ("cap_number", f"regexp_matches(cap_number, '[0-9]') AND lower(trim(cap_number)) NOT IN ({_UNKNOWN})"),
        ("college", f"regexp_matches(college, '[\\p{{L}}\\p{{N}}]') AND lower(trim(college)) NOT IN ({_UNKNOWN})"),
        ("depth", "depth BETWEEN 1 AND 98"),
        ("madden", "madden BETWEEN 1 AND 99"),
        ("team", f"regexp_matches(team, '[\\p{{L}}\\p{{N}}]') AND lower(trim(team)) NOT IN ({_UNKNOWN})"),
    )
)

#: What names are ordinarily stored in: ASCII but the grave accent, and composed Latin letters that are no compatibility forms.
_ORDINARY = "[ -_a-~À-ÖØ-öø-ıĴ-ľŁ-ňŊ-žƀ-ǃǍ-ǰǴ-ɏḀ-ỿ]*"

ORACLE = {
    "p4_top_five": _TOP,
    "p4_found": f"SELECT iteration_id, madden_pos_label, card_id FROM ({_TOP})",
    "p5_forms": f"SELECT tbl, row_id, name AS stored, canonical, mixed AS mixed_script FROM ({canonical_sql(_NAMES, 'name')})",
    "p5_found": f"""
SELECT DISTINCT tbl, row_id FROM {_NAMES}
WHERE name IS NOT NULL AND (name <> nfc_normalize(name) OR NOT regexp_full_match(name, '{_ORDINARY}'))
  AND NOT (regexp_matches(name, '[^\\p{{Latin}}\\P{{L}}]') AND NOT regexp_matches(name, '\\p{{Latin}}')
           AND NOT regexp_full_match(regexp_replace(name, '\\P{{L}}', '', 'g'), '[{"".join(LOOK_ALIKES)}]*'))
""",
    "p6_found": f"""
SELECT player_key, field_name, row_id FROM ({_CLAIMS})
WHERE player_key IN (SELECT player_key FROM player_match GROUP BY 1 HAVING count(*) >= 2)
QUALIFY row_number() OVER (PARTITION BY player_key, field_name
  ORDER BY inj_section NULLS LAST, loaded_at DESC NULLS LAST, row_id) = 1
""",
}
