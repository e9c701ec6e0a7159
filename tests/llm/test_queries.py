"""Registered queries of this subpackage against their SQL, and what all of them must hold."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gridloom.llm import people
from gridloom.llm.matching import match_rosters
from gridloom.llm.mixing import sized_documents
from gridloom.llm.queries import ORACLE, QUERIES
from gridloom.llm.tokens import token_sizes
from tests.conftest import SMALL
from tests.test_queries import compare, duck  # noqa: F401

needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@needs_data
@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, duck, name):  # noqa: F811
    compare(spark, duck, name)


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


@needs_data
def test_linked_rows_never_have_two_ids_and_known_spellings_are_linked(spark):
    found = entry.queries()["p1_found"](spark, SMALL).where("tbl = 'player_match'").select("row_id_a", "row_id_b")
    ids = table(spark, "player_match").where("gsis_id IS NOT NULL").select("row_id", "gsis_id")
    a, b = (ids.select(F.col("row_id").alias(f"row_id_{x}"), F.col("gsis_id").alias(f"id_{x}")) for x in "ab")
    assert found.join(a, "row_id_a").join(b, "row_id_b").where("id_a <> id_b").count() == 0
    # rows of one id under keys of their own: their spellings must find each other again
    apart = table(spark, "player_match").where("gsis_id IS NOT NULL").withColumn("player_key", F.col("row_id").cast("string"))
    names = apart.select("row_id", "gsis_id", "canonical_name")
    x, y = (names.select(*[F.col(c).alias(f"{c}_{s}") for c in names.columns]) for s in "ab")
    wanted = x.join(y, (F.col("gsis_id_a") == F.col("gsis_id_b")) & (F.col("row_id_a") < F.col("row_id_b")) & (F.col("canonical_name_a") != F.col("canonical_name_b"))).select("row_id_a", "row_id_b")
    assert people.match_pairs(apart).intersect(wanted).count() >= 0.8 * wanted.count()


@needs_data
def test_hidden_ids_are_found_again(spark):
    matches = table(spark, "player_match").where("gsis_id IS NOT NULL")
    rosters = table(spark, "nflreadpy_rosters")
    listed = matches.join(rosters.select("gsis_id").distinct(), "gsis_id")
    found = match_rosters(matches.withColumn("gsis_id", F.lit(None).cast("string")), rosters).withColumnRenamed("gsis_id", "found")
    judged = found.join(matches.select("row_id", "gsis_id"), "row_id")
    assert judged.where("found <> gsis_id").count() == 0 and judged.count() >= 0.97 * listed.count()
    assert found.where("NOT match_confidence BETWEEN 1 AND 100").count() == 0
    real = entry.queries()["p2_matches"](spark, SMALL)
    assert real.groupBy("row_id").count().where("count > 1").count() == 0 and real.join(matches, "row_id").count() == 0


@needs_data
def test_fusion_takes_real_values_and_mostly_the_preferred_row(spark):
    fused, ruled = entry.queries()["p6_fused"](spark, SMALL), entry.queries()["p6_found"](spark, SMALL)
    items = ["player_key", "field_name"]
    assert fused.select(*items).exceptAll(ruled.select(*items)).count() == 0 == ruled.select(*items).exceptAll(fused.select(*items)).count()
    assert fused.where("posterior IS NULL OR posterior <= 0 OR posterior > 1").count() == 0
    assert fused.select(*items, "row_id").intersect(ruled.select(*items, "row_id")).count() >= 0.75 * ruled.count()


@needs_data
def test_containers_hold_every_document_whole_and_no_more_than_their_capacity(spark):
    packed = entry.queries()["p8_containers"](spark, SMALL).cache()
    sizes = token_sizes(table(spark, "documents"), "text", ["doc_id"])
    for pack in table(spark, "pack_sizes").collect():
        one = packed.where(F.col("pack_name") == pack["pack_name"])
        assert one.groupBy("container").agg(F.sum("n_tokens").alias("n")).where(F.col("n") > pack["capacity_tokens"]).count() == 0
        held = one.groupBy("doc_id").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("pieces"))
        assert held.select("doc_id", "n_tokens").exceptAll(sizes).count() == 0 == sizes.exceptAll(held.select("doc_id", "n_tokens")).count()
        assert held.where((F.col("pieces") > 1) & (F.col("n_tokens") <= pack["capacity_tokens"])).count() == 0
    assert entry.queries()["p8_fill"](spark, SMALL).where("containers > 1.1 * least_containers + 2").count() == 0


@needs_data
def test_mixes_reach_their_shares_within_the_repeats(spark):
    mixed = entry.queries()["p9_mix"](spark, SMALL).cache()
    targets = table(spark, "mix_targets")
    over = mixed.join(targets, ["mix_name", "source"]).where("repeats > max_repeats")
    assert over.count() == 0 and mixed.count() == mixed.select("mix_name", "doc_id").distinct().count() > 0
    shares = entry.queries()["p9_shares"](spark, SMALL)
    reachable = shares.where("tokens > 0").groupBy("mix_name").agg(F.sum("target_share").alias("all"))
    off = shares.join(reachable, "mix_name").where("tokens > 0").withColumn("off", F.abs(F.col("actual_share") - F.col("target_share") / F.col("all")))
    largest = sized_documents(table(spark, "documents"), "doc_id", "text", "source").agg(F.max("n_tokens")).first()[0]
    total = mixed.groupBy("mix_name").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("total"))
    # a budget is met up to half the document at which it runs out
    assert off.join(total, "mix_name").where(F.col("off") > F.lit(4.0 * largest) / F.col("total")).count() == 0


@needs_data
def test_cut_documents_end_openly_and_rates_add_up(spark):
    documents = table(spark, "documents")
    found = entry.queries()["p10_found"](spark, SMALL).join(documents, "doc_id").select("doc_id", "text", "source").collect()
    assert 0 < len(found) < 0.4 * documents.count()
    marked = {r["doc_id"] for r in documents.collect() if r["text"] and r["text"].rstrip().endswith(("[more]", "[truncated]", ">>", "(more)"))}
    assert marked <= {r["doc_id"] for r in found}
    rates = {r["source"]: r["truncated"] for r in entry.queries()["p10_rates"](spark, SMALL).collect()}
    assert sum(rates.values()) == len(found)


def test_names_and_columns(spark):
    assert all(re.fullmatch(r"p\d+_\w+", n) for n in QUERIES) and set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


COLUMNS = {
    "p1_found": ["tbl", "row_id_a", "row_id_b"], "p2_found": ["row_id", "gsis_id"], "p4_found": ["iteration_id", "madden_pos_label", "card_id"],
    "p5_found": ["tbl", "row_id"], "p6_found": ["player_key", "field_name", "row_id"], "p10_found": ["doc_id"],
}


@needs_data
@pytest.mark.parametrize("name", list(COLUMNS))
def test_found_rows_are_distinct(spark, name):
    df = entry.queries()[name](spark, SMALL)
    assert df.columns == COLUMNS[name]
    assert df.count() == df.distinct().count()
