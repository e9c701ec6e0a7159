"""Ranks, windows, assignment and roster matching, against exhaustive search on small inputs."""

import datetime as dt
import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.llm import assignment as asg
from gridloom.llm import matching as mt
from gridloom.llm import names as nm
from gridloom.llm import neighbourhood as nb
from gridloom.llm.variants import name_worth
from gridloom.operators.ordering import ranked
from tests.conftest import rows


def test_ranks_are_the_global_order(spark):
    r = random.Random(3)
    df = spark.createDataFrame([(r.choice([None, "a", "b", "c"]), i) for i in range(200)], "k string, i int")
    found = [x["i"] for x in ranked(df, "k", "i").orderBy("rank").collect()]
    assert found == [x["i"] for x in df.orderBy(F.col("k").asc_nulls_last(), "i").collect()]


@pytest.mark.parametrize("lead", ["one", "few"])
def test_windows_and_runs_cover_block_borders(spark, monkeypatch, lead):
    monkeypatch.setattr(nb, "BLOCK_ROWS", 10)
    run_of = (lambda i: 0) if lead == "one" else (lambda i: i // 23)
    df = spark.createDataFrame([(i, i % 2, f"{run_of(i):03}", f"{i:03}") for i in range(57)], "i int, side int, lead string, k string")
    df = df.withColumn("keys", F.expr("array(struct(1 AS p, lead AS lead, k AS k), struct(2 AS p, cast(null AS string) AS lead, k AS k), struct(3 AS p, lead AS lead, cast(null AS string) AS k))"))

    def compare(block, x, y):
        return pd.DataFrame({"a": block["i"].to_numpy()[x], "b": block["i"].to_numpy()[y]})

    found = rows(nb.sorted_neighbourhood(df.drop("lead", "k"), "keys", compare, "a int, b int", 4, "i"))
    assert sorted(found) == [(i, j) for i in range(57) for j in range(i + 1, 57) if i % 2 != j % 2 and (j - i <= 4 or run_of(i) == run_of(j))]
    assert nb.sorted_neighbourhood(df.drop("lead", "k").where("i > 99"), "keys", compare, "a int, b int", 4, "i").count() == 0


def exhaustive(weights):
    lefts, rights = sorted({a for a, _ in weights}), sorted({b for _, b in weights})
    best = 0.0
    for chosen in itertools.product([None, *rights], repeat=len(lefts)):
        used = [c for c in chosen if c is not None]
        if len(set(used)) == len(used) and all(c is None or (a, c) in weights for a, c in zip(lefts, chosen, strict=True)):
            best = max(best, sum(weights[a, c] for a, c in zip(lefts, chosen, strict=True) if c is not None))
    return best


@pytest.mark.parametrize("seed", range(12))
def test_assignment_is_optimal(seed):
    r = random.Random(seed)
    weights = {(a, b): r.randrange(1, 20) / 2 for a in range(4) for b in range(10, 14) if r.random() < 0.6}
    if weights:
        chosen = asg.best_assignment(weights)
        assert len({a for a, _ in chosen}) == len({b for _, b in chosen}) == len(chosen)
        assert sum(weights[p] for p in chosen) == exhaustive(weights)


@pytest.mark.parametrize("seed", range(3))
def test_assignment_of_larger_components_is_optimal(seed):
    r = random.Random(seed)
    weights = {(a, b): r.randrange(1, 40) / 2 for a in range(7) for b in range(10, 16) if r.random() < 0.5}
    chosen = asg.best_assignment(weights)
    assert len({a for a, _ in chosen}) == len({b for _, b in chosen}) == len(chosen)
    assert sum(weights[p] for p in chosen) == exhaustive(weights)


def test_assign_over_a_table(spark, monkeypatch):
    pairs = [(1, 1, 5.0), (1, 2, 4.0), (2, 1, 4.0), (7, 7, 3.0)]
    df = spark.createDataFrame(pairs, "l long, r long, score double")
    assert rows(asg.assign(df)) == [(1, 2, 4.0), (2, 1, 4.0), (7, 7, 3.0)]
    assert asg.assign(df.where("l > 99")).count() == 0
    monkeypatch.setattr(asg, "TASK_EDGES", 2)  # the way of components that no task should hold
    monkeypatch.setattr(asg, "STEP", 0.25)
    assert rows(asg.assign(df)) == [(1, 2, 4.0), (2, 1, 4.0), (7, 7, 3.0)]


MATCH = "row_id long, player_key string, canonical_name string, team string, standard_pos string, jersey int, madden_jersey int, college string, age int, height string, weight int, side string, name string"
ROSTER = "gsis_id string, full_name string, team string, position string, college string, birth_date date, height int, weight int, jersey_number int, season int, entity string"


@pytest.fixture
def tables(spark):
    matches = spark.createDataFrame(
        [
            (1, "a", "T. Rudessphy", "SF", "WR", 7, None, "Alder St", 25, "6-1", 200, "x", "y"),
            (2, "a", "Rudessphy, Thomas", None, "WR", None, 7, "n/a", None, None, None, "x", "y"),
            (3, "b", "Thomas Rudessfy", "SF", "WR", 7, None, None, None, "6'1\"", 200, "x", "y"),  # the same player under another key
            (4, "c", "Thomas Rudessphy", "SF", "QB", 11, None, "Orrin", 33, "5-9", 180, "x", "y"),  # a namesake
            (5, "d", None, None, None, None, None, None, None, None, None, "x", "y"),
            (6, "e", "Nobody Known", "SF", "WR", 7, None, "Alder St", 25, "6-1", 200, "x", "y"),
        ],
        MATCH,
    )
    rosters = spark.createDataFrame(
        [
            ("00-1", "Thomas Rudessphy", "STF", "WR", "Alder State", dt.date(2000, 5, 1), 73, 203, 7, 2024, "x"),
            ("00-1", "Tom Rudessphy", "KWT", "WR", None, None, 73, 199, 7, 2025, "x"),
            ("00-1", "Tom Rudessphy", "KWT", "WR", None, None, 73, 199, 7, 2025, "x"),
            ("00-2", None, None, None, None, None, None, None, None, 2025, "x"),
            (None, "Thomas Rudessphy", None, None, None, None, None, None, None, None, "x"),
        ],
        ROSTER,
    )
    return matches, rosters


def test_roster_matches(spark, tables):
    found = mt.match_rosters(*tables)
    assert rows(found, "row_id", "gsis_id") == [(1, "00-1"), (2, "00-1"), (3, "00-1")]
    assert all(0 < r["match_confidence"] <= 100 for r in found.collect())


def test_merged_keys_share_an_id_and_others_do_not(spark):
    records = spark.createDataFrame([(1, 7, 73, 200, "WR", 0), (2, None, 73, None, "WR", 0), (3, 8, 73, 200, "WR", 0)], "entity long, jersey int, height int, weight_low int, positions string, side int")
    pairs = spark.createDataFrame([(1, 50, 20.0), (2, 50, 15.0), (3, 50, 12.0), (3, 60, 10.0)], "l long, r long, score double")
    assert rows(mt.merged_players(pairs, records)) == [(1, 1), (2, 1), (3, 3)]


def test_empty_sides(spark, tables):
    matches, rosters = tables
    assert mt.match_rosters(matches.where("row_id > 99"), rosters).count() == 0
    assert mt.match_rosters(matches, rosters.where("season > 9999")).count() == 0


def test_college_keys(spark):
    df = spark.createDataFrame([(c,) for c in ("University of Alder College", "U. Zephyr Falls Tech", "Talmere St.", "Orrin A and M", "Orrin A&M", "n/a", None)], "c string")
    assert [r[0] for r in df.select(mt.college_key(mt.known_text(F.col("c")))).collect()] == ["alder college", "zephyr falls tech", "talmere state", "orrin am", "orrin am", None, None]


def slipped(r: random.Random, name: str) -> str:
    """The name with a slip, a token shortened, a token to spare, two written together or another token."""
    core = name.split()
    k = r.randrange(len(core))
    way = r.randrange(6)
    if way == 0 and len(core) > 1:
        core = ["".join(core[:2]), *core[2:]]
    elif way == 1:
        core.append(r.choice("abcdefgh"))
    elif way == 2:
        core[k] = core[k][: r.randrange(1, 4)]
    elif way == 3:
        core[k] = r.choice(sorted(nm.FULL_NAMES))
    for _ in range(r.randrange(3)):
        k = r.randrange(len(core))
        i = r.randrange(len(core[k]))
        core[k] = core[k][:i] + r.choice("aeinrst") + core[k][i + r.randrange(2) :]
    return nm.name_key(" ".join(core))


def made_names(r: random.Random, n: int) -> list[str]:
    parts = "ka lo mi ren tas vel dor qui sha phi zen bur".split()
    first = sorted(nm.NICKNAMES)
    return [nm.name_key(f"{r.choice(first)} {''.join(r.choices(parts, k=3))}{r.choice(['', '', ' ii', ' b.'])}") for _ in range(n)]


def test_the_look_at_the_letters_drops_no_names_that_are_accepted():
    r = random.Random(11)
    a = made_names(r, 6000)
    b = [slipped(r, x) for x in a]
    n = len(a)
    hopeful = mt._name_screen(np.array(a + b, dtype=object))
    i = np.arange(n)
    for strong, others in ((False, 0), (True, 1)):
        accepted = np.array([name_worth(nm.tokens(x), nm.tokens(y), others) is not None for x, y in zip(a, b, strict=True)])
        kept = hopeful(i, n + i, np.full(n, strong))
        assert accepted.sum() > 2000 and not (accepted & ~kept).any()
    assert hopeful(i, np.roll(n + i, 1), np.zeros(n, dtype=bool)).mean() < 0.2


def test_a_long_run_hands_on_only_the_pairs_whose_measures_leave_hope():
    r = random.Random(12)
    n = 1500
    names = made_names(r, n // 2)
    names += [slipped(r, x) for x in names]
    of = lambda values, none: [None if r.random() < none else r.choice(values) for _ in range(n)]
    rows = pd.DataFrame({
        "entity": range(n), "side": [i * 2 // n for i in range(n)], "name_key": names, "pass": 0, "run": 5, "jersey": of(range(100), 0.1), "height": of(range(68, 79), 0.1),
        "weight_low": of(range(180, 320), 0.1), "age_low": of(range(21, 37), 0.1), "positions": "QB", "colleges": of(["", "alder", "orrin state"], 0.0), "teams": "SF",
    })
    rows.loc[n // 2 :, ["jersey", "height", "age_low"]] = rows.loc[: n // 2 - 1, ["jersey", "height", "age_low"]].to_numpy()
    rows = rows.assign(weight_high=rows["weight_low"], age_high=rows["age_low"]).sample(frac=1, random_state=1).reset_index(drop=True)
    rank, run, number, side = np.arange(n), *(rows[c].to_numpy() for c in ("run", "pass", "side"))
    pairs = lambda screen, split: [np.concatenate(z) for z in zip(*nb.neighbour_pairs(rank, run, number, side, 20, split, screen), strict=True)]
    for split, cross in ((0, (n // 2) ** 2), (700, None)):
        every, few = pairs(lambda x, y: True, split), pairs(mt._screen(rows), split)
        assert len({*zip(*every, strict=True)}) == len(every[0]) and (cross is None or len(every[0]) == cross)
        assert len(few[0]) < 0.1 * len(every[0])
        found = mt._compare(rows, *every)
        assert len(found) > 50
        pd.testing.assert_frame_equal(found, mt._compare(rows, *few))
