"""Snapshot differences and attribute history against plain Python, and on the cases that the docstrings define."""

import datetime as dt
import random

import pytest

from gridloom.operators.history import attribute_history
from gridloom.operators.snapshots import change_totals, number_snapshots, snapshot_changes
from tests.conftest import rows

SCHEMA = "feed long, snap int, k string, a string, b double, seen timestamp, _key string, rank int"


def at(minute):
    return dt.datetime(2025, 1, 1, 0, minute)


def brute(data, numbered=False):
    """(latest row per feed, snapshot and key), and the snapshots of each feed."""
    best, snaps = {}, {}
    for feed, snap, k, a, b, seen, *_ in data:
        if snap is None:
            continue
        snaps.setdefault(feed, set()).add(snap)
        order = (seen is not None, seen, a is not None, a or "", b is not None, b or 0.0)
        if (feed, snap, k) not in best or order > best[feed, snap, k][0]:
            best[feed, snap, k] = (order, (a, b))
    return {key: v for key, (_, v) in best.items()}, {f: sorted(s) for f, s in snaps.items()}


def brute_changes(data):
    held, snaps = brute(data)
    found = set()
    for feed, order in snaps.items():
        for before, now in zip(order, order[1:], strict=False):
            keys = {k for f, s, k in held if f == feed and s in (before, now)}
            for k in keys:
                old, new = held.get((feed, before, k)), held.get((feed, now, k))
                if old is None:
                    found.add((feed, now, k, "added"))
                elif new is None:
                    found.add((feed, now, k, "removed"))
                elif old != new:
                    found.add((feed, now, k, "changed"))
    return found


def brute_versions(data):
    held, snaps = brute(data)
    found = set()
    for feed, order in snaps.items():
        for k in {k for f, _, k in held if f == feed}:
            before = None
            for i, s in enumerate(order):
                now = held.get((feed, s, k))
                if now is not None and (before is None or before != now):
                    end = next((order[j] for j in range(i + 1, len(order)) if held.get((feed, order[j], k)) != now), None)
                    found.add((feed, k, *now, s, end, end is None))
                before = now
    return found


def random_rows(n, seed):
    r = random.Random(seed)
    return [
        (
            r.choice([None, 1, 1, 1, 2]), r.choice([None, 1, 2, 3, 4, 6, 9]), r.choice([None, "p", "q", "r", "s"]),
            r.choice([None, "x", "y"]), r.choice([None, 1.0, 2.0]), r.choice([None, at(1), at(2), at(3)]), "noise", r.randrange(9),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_changes_equal_brute_force(spark, seed):
    data = random_rows(90, seed)
    df = spark.createDataFrame(data, SCHEMA)
    found = snapshot_changes(df, "feed", "snap", "k", ["a", "b"], "seen")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute_changes(data), key=str)


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_history_equals_brute_force(spark, seed):
    data = random_rows(90, seed)
    df = spark.createDataFrame(data, SCHEMA)
    found = attribute_history(df, "feed", "snap", "k", ["a", "b"], "seen")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute_versions(data), key=str)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert snapshot_changes(empty, "feed", "snap", "k", ["a"], "seen").count() == 0
    assert attribute_history(empty, "feed", "snap", "k", ["a"], "seen").count() == 0


def test_one_snapshot_has_no_changes_and_open_versions(spark):
    df = spark.createDataFrame([(1, 5, "p", "x", None, at(1), "n", 1)] * 3, SCHEMA)
    assert snapshot_changes(df, "feed", "snap", "k", ["a", "b"], "seen").count() == 0
    assert rows(attribute_history(df, "feed", "snap", "k", ["a"], "seen")) == [(1, "p", "x", 5, None, True)]


def test_null_never_hashes_like_its_neighbour(spark):
    df = spark.createDataFrame([(1, 1, "p", "x", None, None, "n", 1), (1, 2, "p", None, None, None, "n", 1)], SCHEMA)
    assert rows(snapshot_changes(df, "feed", "snap", "k", ["a", "b"])) == [(1, 2, "p", "changed")]
    swapped = spark.createDataFrame([(1, 1, "p", "x", None), (1, 2, "p", None, "x")], "feed long, snap int, k string, a string, b string")
    assert rows(snapshot_changes(swapped, "feed", "snap", "k", ["a", "b"])) == [(1, 2, "p", "changed")]


def test_totals_list_snapshots_without_changes(spark):
    df = spark.createDataFrame([(1, s, "p", "x", None, None, "n", 1) for s in (1, 2, 3)], SCHEMA)
    found = change_totals(snapshot_changes(df, "feed", "snap", "k", ["a"]), number_snapshots(df, "feed", "snap"))
    assert rows(found) == [(1, 1, 1, 0, 0, 0), (1, 2, 2, 0, 0, 0), (1, 3, 3, 0, 0, 0)]


def test_very_long_values(spark):
    long = "z" * 200_000
    df = spark.createDataFrame([(1, 1, "p", long, None, None, "n", 1), (1, 2, "p", long + "!", None, None, "n", 1)], SCHEMA)
    assert rows(snapshot_changes(df, "feed", "snap", "k", ["a"])) == [(1, 2, "p", "changed")]
