"""Top N against plain Python, with ties, nulls, copies, empty tables and clashing names."""

import random

from gridloom.llm.top_n import top_n
from tests.conftest import rows

SCHEMA = "g int, label string, card long, score double, seen int, rank int, copy int, item string"


def brute(data, n):
    latest = {}
    for g, label, card, score, seen, *_ in data:
        order = (seen is not None, seen or 0, score is not None, score or 0.0)
        if (g, card) not in latest or order > latest[g, card][0]:
            latest[g, card] = (order, label, score)
    groups = {}
    for (g, card), (_, label, score) in latest.items():
        if g is not None and label is not None and score is not None and score == score:
            groups.setdefault((g, label), []).append((-score, card is None, card or 0, card, score))
    return sorted(((g, label, card, score, i + 1) for (g, label), items in groups.items() for i, (*_, card, score) in enumerate(sorted(items)[:n])), key=str)


def test_equals_brute_force(spark):
    r = random.Random(2)
    data = list({(g, c, s): (g, r.choice([None, "a", "b"]), c, r.choice([None, 1.0, 2.0, 3.0]), s, 1, 2, "x") for g, c, s in ((r.choice([None, 1, 2]), r.randrange(12), r.choice([None, 1, 2])) for _ in range(150))}.values())
    found = top_n(spark.createDataFrame(data, SCHEMA), ["g", "label"], "score", "card", 3, item_key=["g", "card"], latest="seen")
    assert sorted(map(tuple, found.collect()), key=str) == brute(data, 3)


def test_repeated_rows_nan_and_empty(spark):
    data = [(1, "a", 5, 9.0, 1, 0, 0, "x")] * 4 + [(1, "a", 6, float("nan"), 1, 0, 0, "x"), (1, "a", 7, 9.0, None, 0, 0, "x")]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(top_n(df, ["g", "label"], "score", "card", 2), "card", "top_rank") == [(5, 1), (7, 2)]
    assert top_n(df.where("g = 9"), ["g", "label"], "score", "card", 2).count() == 0


def test_prunes_before_and_after_the_exchange(spark):
    df = spark.createDataFrame([(1, "a", 5, 9.0, 1, 0, 0, "x")], SCHEMA)
    plan = top_n(df, ["g", "label"], "score", "card", 2, item_key=["g", "card"], latest="seen")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4
