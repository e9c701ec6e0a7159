"""Operators on small tables: ties, nulls, empty inputs and the invariants of spine-preserving joins."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from gridloom.operators import intervals as iv
from gridloom.operators import quality as qg
from gridloom.operators import regression as rg
from gridloom.operators import relational as rel
from gridloom.operators import resolve as rs
from tests.conftest import rows


def test_interval_pairs_equal_brute_force(spark):
    r = random.Random(1)
    boxes = [(i, lo := r.uniform(-50, 50), lo + r.uniform(0, 30)) for i in range(60)] + [(99, 5.0, 1.0)]
    found = iv.overlap_pairs(spark.createDataFrame(boxes, "k int, lo double, hi double"), "k", "lo", "hi", 7.0)
    brute = [(a, b) for a, x, y in boxes for b, u, v in boxes if a < b and x <= y and u <= v and x <= v and u <= y]
    assert rows(found) == sorted(brute, key=str)


def test_range_lookup_keeps_points_outside(spark):
    ranges = spark.createDataFrame([("a", 1, 32), ("b", 33, 64)], "round string, s int, e int")
    points = spark.createDataFrame([(1,), (32,), (33,), (65,), (None,)], "pick int")
    assert rows(iv.range_lookup(points, "pick", ranges, "s", "e", 10.0), "pick", "round") == [(None, None), (1, "a"), (32, "a"), (33, "b"), (65, None)]


def test_selection_is_stable_under_ties(spark):
    df = spark.createDataFrame([("x", 1, 5), ("x", 2, 5), ("y", 3, None), (None, 4, 1)], "k string, i int, v int")
    assert rows(rel.keep_first(df, ["k"], ["v", "i"]), "k", "i") == [(None, 4), ("x", 1), ("y", 3)]
    assert rows(rel.keep_last(df, ["k"], ["v", "i"]), "k", "i") == [(None, 4), ("x", 2), ("y", 3)]


def test_healthy_before_injured(spark):
    df = spark.createDataFrame([("x", 0, True, 1), ("x", 1, False, 3), ("x", 2, None, 2)], "k string, i int, injured boolean, depth int")
    assert rows(rel.healthy_first(df, ["k"], F.col("injured"), F.col("depth"), "i"), "i") == [(2,)]


def test_claims_do_not_fall_through(spark):
    claims = spark.createDataFrame([("g1", "p1", 1), ("g2", "p1", 2), ("g2", "p2", 3)], "grade string, prospect string, i int")
    assert rows(rel.first_claims(claims, ["prospect"], "grade", ["i"]), "grade", "prospect") == [("g1", "p1")]


def test_digest_ignores_order_and_sees_changes(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    digest = lambda df: rel.table_digest(df, ["k", "v"]).first()["digest"]
    assert digest(a) == digest(a.orderBy(F.desc("k")))
    assert digest(a) != digest(a.fillna("x"))
    assert rel.unchanged_since("d", "d", "2026-01-01", "2026-02-02") == "2026-01-01"
    assert rel.unchanged_since("d", "e", "2026-01-01", "2026-02-02") == "2026-02-02"


def test_tiers_keep_the_spine(spark):
    spine = spark.createDataFrame([(1, "a", "T"), (2, "b", "T"), (3, "c", "T"), (4, None, "T")], "i int, k string, team string")
    cards = spark.createDataFrame([(10, "a", "T"), (11, "a", "U"), (12, "b", "U"), (12, "b", "V"), (13, "c", "X"), (14, "c", "Y")], "id int, k string, team string")
    both = F.struct("k", "team")
    tiers = [rs.Tier("name_team", both, both), rs.Tier("name_only", F.col("k"), F.col("k"))]
    found = rs.resolve_tiers(spine, cards, "id", tiers)
    # a row duplicated under two teams has one id and counts once; two ids are ambiguous
    assert rows(found, "i", "matched_id", "match_source") == [(1, 10, "name_team"), (2, 12, "name_only"), (3, None, None), (4, None, None)]


def test_gates(spark):
    df = spark.createDataFrame([(1, "A", "s"), (2, "B", "s"), (2, "B", "s")], "k int, g string, src string")
    row = qg.verdicts(qg.measures(df, "g", "k", F.col("src") == "s", "src", ["A", "B", "C"]), qg.floor_rows(3, 1, 0.9), 2).first()
    assert (row["rows"], row["groups"], row["missing_groups"], row["duplicate_keys"]) == (3, 2, 1, 1)
    assert row["enough_rows"] and not row["all_groups"] and not row["unique_keys"] and not row["accept"]
    assert qg.contiguous(df, "k").first()[0] is False
    assert qg.contiguous(df.where("g = 'A'"), "k").first()[0] is True
    empty = df.where("k > 9")
    assert qg.measures(empty, "g", "k", F.lit(True), "src", ["A"]).first()["missing_groups"] == 1


def test_carry_over(spark):
    table = lambda *g: spark.createDataFrame([(x, i) for i, x in enumerate(g)], "g string, i int")
    kept, states = qg.carry_over(table("a"), table("a", "b"), table("a", "b", "c"), "g")
    assert rows(states) == [("a", "fresh"), ("b", "stale"), ("c", "missing")]
    assert rows(kept) == [("a", 0), ("b", 1)]


def test_regression_equals_numpy(spark):
    r = random.Random(5)
    data = [(r.choice("ab"), r.random() < 0.5, r.randrange(1, 200), r.uniform(40, 90)) for _ in range(120)]
    df = spark.createDataFrame(data, "g string, f boolean, pick int, y double")
    x = np.array([[g == "a", g == "b", f, math.log(p)] for g, f, p, _ in data], dtype=float)
    y = np.array([d[3] for d in data])
    parts = rg.design(["a", "b"], F.col("g"), F.col("f"), F.col("pick"), "shared")
    model = rg.fit(df, parts, F.col("y"))
    b, *_ = np.linalg.lstsq(x, y, rcond=None)
    assert np.allclose(model.coefficients, b, atol=1e-6)
    hat = x @ np.linalg.pinv(x.T @ x) @ x.T
    loo = (y - hat @ y) / (1 - np.diag(hat))
    found = rg.residuals(df, parts, F.col("y"), model).agg(rg.rmse("loo_residual")).first()[0]
    assert abs(found - float(np.sqrt((loo**2).mean()))) < 1e-6
    own = rg.fit(df, rg.design(["a", "b"], F.col("g"), F.col("f"), F.col("pick"), "own"), F.col("y"))
    f, p = rg.nested_f(model, own)
    assert f >= 0 and 0 <= p <= 1
    assert abs(rg._f_tail(1.0, 10, 10) - 0.5) < 1e-9
    assert abs(rg._f_tail(4.9646, 1, 10) - 0.05) < 1e-4


def test_sets_and_diffs(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(rel.key_sets(a, b, "k")) == [(1, "left_only"), (2, "both"), (3, "right_only")]
    old = spark.createDataFrame([(1, 5, None), (2, 6, 1)], "k int, m int, o int")
    new = spark.createDataFrame([(1, 5, 2), (3, 6, 1)], "k int, m int, o int")
    assert rows(rel.keyed_diff(old, new, "k", "m", ["o"])) == [(0, 1, 1, 1)]


def test_modes_and_factors(spark):
    df = spark.createDataFrame([("x", v) for v in "aaaab"] + [("y", "c")], "k string, v string")
    assert rows(rel.modes(df, ["k"], "v")) == [("x", "a", 4, 1), ("y", "c", 1, 0)]
    ordered = spark.createDataFrame([("x", i) for i in range(6)], "k string, i int")
    assert [r[2] for r in rows(rel.diminishing(ordered, ["k"], ["i"], [1.0, 0.6, 0.35, 0.2], "f"))] == [1.0, 0.6, 0.35, 0.2, 0.2, 0.2]


def test_columns_carried_while_their_source_is_missing(spark):
    now = spark.createDataFrame([(1, None), (2, 5)], "k int, rating int")
    old = spark.createDataFrame([(1, 70), (1, 70), (3, 80)], "k int, rating int")
    assert rows(qg.carry_column(now, old, "k", "rating", False), "k", "rating") == [(1, 70), (2, None)]
    assert rows(qg.carry_column(now, old, "k", "rating", True), "k", "rating") == [(1, None), (2, 5)]
