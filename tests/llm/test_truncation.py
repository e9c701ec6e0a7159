"""Limits, endings and marks on texts whose cuts are known."""

import random

from pyspark.sql import functions as F

from gridloom.llm import truncation as tr
from tests.conftest import rows

PARTS = ["The coach praised the rookie after practice.", "A trade is expected before Friday.", "The defence held late in the game.", "Two players returned to the field.", "Nobody was surprised by the result.", "The team signed a kicker on Monday."]
DOCS = "doc_id long, source string, text string, cut string, kind string"


def corpus(n, limit, seed=1):
    r, found = random.Random(seed), []
    for i in range(n):
        text = " ".join(r.choice(PARTS) for _ in range(r.randrange(1, 12)))
        source = r.choice(["wire", "free"])
        cut = source == "wire" and len(text) > limit
        found.append((i, source, text[:limit] if cut else text, "cut" if cut and text[limit - 1] != "." else "", "x"))
    return found


def test_finds_the_limit_and_the_cuts(spark):
    data = corpus(800, 211)
    df = spark.createDataFrame(data, DOCS)
    judged = {r["doc"]: r for r in tr.judged_documents(df, "doc_id", "text", "source").collect()}
    truth = {d[0] for d in data if d[3] == "cut"}
    found = {i for i, r in judged.items() if r["cut"]}
    assert len(truth) > 50 and found == truth
    rates = {r["source"]: r["truncation_rate"] for r in tr.truncation_rates(df, "doc_id", "text", "source").collect()}
    assert rates["free"] == 0 and rates["wire"] > 0.1


def test_significant_lengths(spark):
    r = random.Random(5)
    lengths = [(("s", 0, r.randrange(50, 400), True)) for _ in range(3000)] + [("s", 0, 280, True)] * 90
    found = tr.significant_lengths(spark.createDataFrame(lengths, "source string, measure int, length int, open boolean"))
    assert [x[0] for x in rows(found, "length")] == [280]


def test_bodies():
    footers = {"rating:", "filed", "*"}
    assert tr.body_of("A text.\nRating: 5/99", footers) == ("A text.", "A text.", "")
    assert tr.body_of("A te [more]\nFiled 3/4", footers)[1:] == ("A te", "cut")
    assert tr.body_of("A text.\nFiled 3/4\n\nRating: 1/9\n🏈\n" + "Filed " + "x" * 2000, footers)[1] == "A text."
    assert tr.body_of("A te" + " " * 2000 + ">>>>" + "\n" * 900)[1:] == ("A te", "cut")
    assert tr.body_of("Rating: 5/99", footers)[1] == "Rating: 5/99"  # a text's only line is no footer
    assert tr.body_of("A te...[truncated]")[1:] == ("A te", "cut")
    assert tr.body_of("So it goes…")[1:] == ("So it goes", "trail")
    assert tr.body_of("  ")[1:] == ("", "")
    assert tr.body_of("Whole.\n🏈🏈", footers)[1] == "Whole."


def test_footers_are_learnt(spark):
    r = random.Random(6)
    data = [f"{r.choice(PARTS)}\nOverall, {r.choice(PARTS)}" + (f"\nDesk note {i}/9" if i % 3 else "\n#tag #other") for i in range(300)]
    df = spark.createDataFrame([(t,) for t in [*data, None, "", "\n\n"]], "text string")
    assert tr.learnt_footers(df) == {"desk", "#"}
    assert tr.learnt_footers(df.where("text = 'nothing'")) == frozenset()


def test_hazards_count_all_lengths_at_risk(spark):
    r = random.Random(8)
    lengths = [r.randrange(1, 90) ** 2 // 40 for _ in range(300)]
    found = spark.createDataFrame([("s", 0, x) for x in lengths], "source string, measure int, length int").groupBy("source", "measure", "length").agg(F.count(F.lit(1)).alias("ended"))
    by = tr.Window.partitionBy("source", "measure")
    table = found.withColumn("reached", F.sum("ended").over(by.orderBy(F.col("length").desc()).rowsBetween(tr.Window.unboundedPreceding, 0)))
    table = table.withColumn("gap", F.col("length") - F.coalesce(F.lag("length").over(by.orderBy("length")), F.lit(-1)))
    for reach in (1, 20):
        for row in table.withColumn("risk", tr._at_risk(by, reach)).collect():
            assert row["risk"] == sum(sum(x >= y for x in lengths) for y in range(max(row["length"] - reach, 0), row["length"] + reach + 1))


def test_endings_on_purpose_and_lacking_stops(spark):
    data = corpus(400, 10_000)
    whole = [(1000 + i, "free", d[2].rstrip("."), "", "x") for i, d in enumerate(data[:40])]
    trailing = [(2000 + i, "free", f"{d[2]} And that was that...", "", "x") for i, d in enumerate(data[:20])]
    cut = [(3000, "free", PARTS[0][:20], "", "x"), (3001, "free", f"{PARTS[1]} The coach praised the", "", "x"), (3002, "free", f"{PARTS[1]} The tea [more]", "", "x")]
    df = spark.createDataFrame([*data, *whole, *trailing, *cut], DOCS)
    found = {r[0] for r in tr.judged_documents(df, "doc_id", "text", "source").where("cut").select("doc").collect()}
    assert found == {3000, 3001, 3002}


def test_nulls_empty_long_repeated_and_clashing(spark):
    long = "word " * 40_000
    data = [(1, None, None, "c", "k"), (2, "s", "", "c", "k"), (3, "s", "   ", "c", "k"), (4, None, "Fine.", "c", "k"), (5, "s", long, "c", "k"), (5, "s", long, "c", "k"), (None, "s", "It ended", "c", "k"), (None, "s", "Fine.", "c", "k")]
    df = spark.createDataFrame(data, DOCS).withColumn("doc", F.lit(9))
    judged = tr.judged_documents(df, "doc_id", "text", "source")
    assert sorted(str(r["doc"]) for r in judged.collect()) == ["4", "5", "5", "None", "None"]
    assert tr.judged_documents(df.where("doc_id > 9"), "doc_id", "text", "source").count() == 0


def test_poisson_tail():
    import pandas as pd

    found = tr._poisson_tail(pd.Series([0, 1, 3, 50]), pd.Series([2.0, 2.0, 2.0, 2.0]))
    assert abs(found[0] - 1) < 1e-12 and abs(found[1] - 0.8646647) < 1e-6 and abs(found[2] - 0.3233236) < 1e-6 and found[3] < 1e-40


def test_a_fragment_that_closes_many_texts_is_no_word(spark):
    data = corpus(400, 10_000)
    cut = [(3000 + i, "free", f"{d[2]} Two players retu", "", "x") for i, d in enumerate(data[:8])]
    whole = [(4000 + i, "free", d[2].rstrip("."), "", "x") for i, d in enumerate(data[:8])]
    df = spark.createDataFrame([*data, *cut, *whole], DOCS)
    found = {r[0] for r in tr.judged_documents(df, "doc_id", "text", "source").where("cut").select("doc").collect()}
    assert found == {c[0] for c in cut}
