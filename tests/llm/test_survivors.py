"""Survivorship rules against plain Python; fusion on claims whose truth is known."""

import datetime as dt
import random

from pyspark.sql import functions as F

from gridloom.llm import survivors as sv
from tests.conftest import rows

SCHEMA = "row_id long, k string, listed boolean, seen timestamp, team string, depth int, cap string, _key string, p string"
FIELDS = [sv.Field("team"), sv.Field("depth", 1, 98), sv.Field("cap", needs_digit=True)]


def real(name, v):
    if v is None:
        return False
    if name == "depth":
        return 1 <= v <= 98
    text = v.strip().lower()
    return any(c.isalnum() for c in text) and text not in sv.UNKNOWN and (name != "cap" or any(c.isdigit() for c in text))


def random_rows(n):
    r = random.Random(7)
    time = lambda: r.choice([None, *[dt.datetime(2025, 1, d) for d in (1, 2, 3)]])
    return [
        (i, r.choice([None, "a", "b", "c"]), r.choice([None, True, False]), time(), r.choice([None, "", "SF", "N/A", " tbd ", "ZEN", "--"]), r.choice([None, -1, 0, 3, 98, 99]), r.choice([None, "$-", "$5", "TBD"]), "x", "y")
        for i in range(n)
    ]


def test_rule_equals_brute_force(spark):
    data = [*random_rows(80), (999, "alone", False, None, "SF", 1, "$1", "x", "y")]
    expected = []
    for k in {d[1] for d in data}:
        group = [d for d in data if d[1] == k]
        for at, name in ((4, "team"), (5, "depth"), (6, "cap")):
            known = [d for d in group if real(name, d[at])]
            if len(group) >= 2 and known:
                order = lambda d: (2 if d[2] is None else int(d[2]), d[3] is None, -(d[3] - dt.datetime(1970, 1, 1)).total_seconds() if d[3] else 0, d[0])
                expected.append((k, name, min(known, key=order)[0]))
    found = sv.survivors(spark.createDataFrame(data, SCHEMA), "k", FIELDS, "listed", "seen", "row_id").drop("value")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_repeated_rows_count_and_empty_is_empty(spark):
    df = spark.createDataFrame([(1, "a", False, None, "SF", None, None, "x", "y")] * 2, SCHEMA)
    assert rows(sv.survivors(df, "k", FIELDS, "listed", "seen", "row_id")) == [("a", "team", 1, "SF")]
    assert sv.survivors(df.where("k = 'z'"), "k", FIELDS, "listed", "seen", "row_id").count() == 0
    assert sv.fuse(df.where("k = 'z'"), "k", FIELDS, F.col("p"), "listed", "seen", "row_id").count() == 0


def test_estimate_finds_good_sources_and_copiers():
    r, patterns = random.Random(4), {}
    for _ in range(3000):
        draw = lambda accuracy: 1 if r.random() < accuracy else 2 + r.randrange(8)
        claims = {"good": draw(0.95), "fair": draw(0.8), "third": draw(0.75), "bad": draw(0.35)}
        claims["copy"] = claims["bad"] if r.random() < 0.9 else draw(0.35)
        key = tuple(sorted(claims.items()))
        patterns[key] = patterns.get(key, 0) + 1
    posterior, accuracy, depends = sv.estimate(patterns)
    assert accuracy["good"] > accuracy["fair"] > accuracy["bad"]
    assert depends["bad", "copy"] > 0.9 > 0.5 > depends["fair", "good"]
    right = sum(n for p, n in patterns.items() if max(posterior[p], key=posterior[p].get) == 1)
    votes = sum(n for p, n in patterns.items() if max({v for _, v in p}, key=[v for _, v in p].count) == 1)
    assert right > votes  # two copies that are wrong together no longer outvote one good source


def test_fusion_takes_values_from_rows(spark):
    data = [(i * 3 + j, f"k{i}", False, None, t, None, None, "x", s) for i in range(30) for j, (s, t) in enumerate((("a", "SF"), ("b", "SF"), ("c", "ZEN" if i % 2 else "SF")))]
    found = sv.fuse(spark.createDataFrame(data, SCHEMA), "k", FIELDS, F.col("p"), "listed", "seen", "row_id")
    assert found.count() == 30
    assert {r["value"] for r in found.collect()} == {"SF"}
    assert all(0 < r["posterior"] <= 1 for r in found.collect())


def test_fusion_of_many_sources_follows_the_same_rules(spark, monkeypatch):
    r = random.Random(2)
    teams = ["SF", "ZEN", "KES", None]
    data = [(i * 9 + j, f"k{i}", False, None, r.choice(teams), r.choice([None, 1, 2]), None, "x", f"s={j}") for i in range(40) for j in range(4)]
    df = spark.createDataFrame(data, SCHEMA)
    fuse = lambda t: rows(sv.fuse(t, "k", FIELDS, F.col("p"), "listed", "seen", "row_id"))
    here = fuse(df)
    monkeypatch.setattr(sv, "MAX_SOURCES", 2)
    there = fuse(df)
    assert [x[:4] for x in here] == [x[:4] for x in there] and all(abs(x[4] - y[4]) < 1e-5 for x, y in zip(here, there, strict=True))
    many = spark.createDataFrame([(i, "a", False, None, "SF" if i % 3 else "ZEN", None, None, "x", f"s{i}") for i in range(30)], SCHEMA)
    assert [x[3] for x in fuse(many)] == ["SF"]
