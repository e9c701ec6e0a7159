"""Token sizes, packing and mixing: exact capacities, bounds on waste, budgets and shares."""

import os
import random

import pytest
from pyspark.sql import functions as F

from gridloom.llm import mixing as mx
from gridloom.llm import packing as pk
from gridloom.llm import tokens as tk
from tests.conftest import rows

needs_vocabulary = pytest.mark.skipif(not os.path.exists(tk.DEFAULT_RANKS), reason="no vocabulary file")


@needs_vocabulary
def test_sizes_equal_the_library(spark):
    import base64

    import tiktoken

    with open(tk.DEFAULT_RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    encoding = tiktoken.Encoding("t", pat_str=tk.DEFAULT_PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["Hello world", "", "  ünï<|endoftext|>", "a" * 50_000, None, "x y\n\nz"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("n_tokens_old", F.lit(1))
    found = dict(rows(tk.token_sizes(df, "text", ["i"])))
    assert found == {i: len(encoding.encode_ordinary(t)) for i, t in enumerate(texts) if t is not None}


def first_fit(sizes, capacity):
    room, placed = [], []
    for s in sizes:
        at = next((i for i, r in enumerate(room) if r >= s), None)
        if at is None:
            at = len(room)
            room.append(capacity)
        room[at] -= s
        placed.append(at)
    return placed


@pytest.mark.parametrize("seed", range(5))
def test_tree_equals_the_plain_scan(seed):
    r = random.Random(seed)
    sizes = sorted((r.randrange(0, 101) for _ in range(300)), reverse=True)
    assert pk.first_fit_decreasing(sizes, 100) == first_fit(sizes, 100)


ITEMS = "doc long, n long, container string, capacity int"


def test_packing_is_whole_and_within_capacity(spark, monkeypatch):
    monkeypatch.setattr(pk, "GROUP_ITEMS", 60)
    r = random.Random(1)
    sizes = [0, 0, 100, 101, 250, 300] + [r.randrange(1, 100) for _ in range(200)]
    items = spark.createDataFrame([(i, s, "x", 1) for i, s in enumerate(sizes)] + [(0, 0, "x", 1)], ITEMS)
    packed = pk.pack_items(items, [("small", 100), ("bad", None), ("none", 0)], "doc", "n").cache()
    assert rows(packed.groupBy("doc").agg(F.sum("n_tokens")).where("doc > 1")) == sorted(((i, s) for i, s in enumerate(sizes) if i > 1), key=lambda t: str(t[0]))
    assert packed.groupBy("container").agg(F.sum("n_tokens").alias("u")).where("u > 100").count() == 0
    # only items beyond the capacity are split, into full pieces and a rest
    assert {d for d, n in rows(packed.groupBy("doc").count()) if n > 1} == {0, 3, 4, 5}
    assert rows(packed.where("doc = 4"), "piece", "n_tokens") == [(0, 100), (1, 100), (2, 50)]
    report = pk.fill_report(packed).first()
    assert report["containers"] <= 1.1 * report["least_containers"] + 4
    assert pk.pack_items(items.where("doc > 999"), [("small", 100)], "doc", "n").count() == 0
    assert pk.pack_items(items, [], "doc", "n").count() == 0


SIZED = "doc long, source string, weight double, n_tokens long, copy long, epochs string"


def sized_table(spark, counts, size=10):
    data, n = [], 0
    for source, count in counts.items():
        for _ in range(count):
            data.append((n, source, 0.5 + (n % 5) / 10, size, n, "x"))
            n += 1
    return spark.createDataFrame(data, SIZED)


TARGETS = "mix_name string, source string, target_share double, max_repeats int, note string"


def test_mix_meets_budgets(spark):
    sized = sized_table(spark, {"big": 300, "mid": 60, "tiny": 10})
    targets = spark.createDataFrame([("m", "big", 0.5, 2, "x"), ("m", "mid", 0.4, 3, "x"), ("m", "tiny", 0.1, 2, "x"), ("m", "gone", 0.0, None, "x"), ("m", None, 0.3, 1, "x")], TARGETS)
    plan = mx.mix_plan(sized, targets, size=3700)
    budgets = {r["source"]: (r["budget"], r["epochs"], r["rest"]) for r in plan.collect()}
    assert budgets == {"big": (1850, 0, 1850), "mid": (1480, 2, 280), "tiny": (200, 2, 0), "gone": (0, 0, 0)}
    mixed = mx.mix_documents(sized, plan).cache()
    assert mixed.count() == mixed.select("mix_name", "doc").distinct().count()
    held = {r["source"]: r for r in mx.mix_shares(mixed, plan).collect()}
    for source, (budget, _, _) in budgets.items():
        assert abs(held[source]["tokens"] - budget) <= 10
    assert {r["repeats"] for r in mixed.where("source = 'mid'").collect()} == {2, 3}
    assert {r["repeats"] for r in mixed.where("source = 'tiny'").collect()} == {2}
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, mx.mix_documents(sized, plan).collect()))


def test_without_a_size_every_source_that_can_reaches_its_share(spark):
    sized = sized_table(spark, {"big": 300, "mid": 60, "tiny": 10})
    targets = spark.createDataFrame([("m", "big", 0.5, 1, "x"), ("m", "mid", 0.4, 3, "x"), ("m", "tiny", 0.1, 2, "x"), ("m", "none", 0.0, 1, "x"), ("n", "gone", 1.0, 1, "x")], TARGETS)
    plan = mx.mix_plan(sized, targets)
    budgets = {(r["mix_name"], r["source"]): (r["budget"], r["epochs"]) for r in plan.collect()}
    assert budgets == {("m", "big"): (1000, 0), ("m", "mid"): (800, 1), ("m", "tiny"): (200, 2), ("m", "none"): (0, 0), ("n", "gone"): (0, 0)}
    shares = {r["source"]: r["actual_share"] for r in mx.mix_shares(mx.mix_documents(sized, plan), plan).collect()}
    assert abs(shares["big"] - 0.5) < 0.01 and abs(shares["mid"] - 0.4) < 0.01 and abs(shares["tiny"] - 0.1) < 0.01


@needs_vocabulary
def test_layout_of_the_input_changes_nothing(spark):
    r = random.Random(4)
    data = [(i, r.choice(["a", "b", None]), "word " * r.randrange(0, 60), 1) for i in range(150)] + [(3, "a", "again", 1), (3, "a", "again", 1), (None, "b", "no id", 1)]
    docs = spark.createDataFrame(data, "doc_id long, source string, text string, n_tokens int")
    other = docs.orderBy(F.desc("text")).repartition(3)
    targets = spark.createDataFrame([("m", "a", 0.7, 1, "x"), ("m", "b", 0.3, 2, "x")], TARGETS)

    def both(df):
        sized = mx.sized_documents(df, "doc_id", "text", "source")
        packed = pk.pack_items(tk.token_sizes(df.drop("n_tokens"), "text", ["doc_id"]), [("p", 40)], "doc_id", "n_tokens")
        return rows(mx.mix_documents(sized, mx.mix_plan(sized, targets))), rows(packed)

    assert both(docs) == both(other)


def test_weights_matter(spark):
    data = [(i, "s", 1.0 if i % 2 else 0.25, 10, i, "x") for i in range(4000)]
    sized = spark.createDataFrame(data, SIZED)
    plan = spark.createDataFrame([("m", "s", 1.0, 40_000, 8000, 0, 8000)], "mix_name string, source string, target_share double, available long, budget long, epochs int, rest long")
    chosen = mx.mix_documents(sized, plan)
    heavy = chosen.where("doc % 2 = 1").count()
    assert 0.7 < heavy / chosen.count() < 0.9  # four times the weight: about four fifths early on


def test_empty_mixes(spark):
    sized = sized_table(spark, {"big": 3})
    targets = spark.createDataFrame([("m", "big", 1.0, 1, "x")], TARGETS)
    nothing = sized.where("doc > 99")
    assert mx.mix_documents(nothing, mx.mix_plan(nothing, targets)).count() == 0
    none = mx.mix_plan(sized, targets.where("source = 'z'"))
    assert mx.mix_documents(sized, none).count() == 0


def test_quality_is_bounded(spark):
    df = spark.createDataFrame([("",), ("a" * 1000,), ("#1 2 3",), (None,)], "t string")
    found = [r[0] for r in df.select(mx.quality(F.col("t"))).collect()]
    assert all(f is None or mx.LEAST_WEIGHT <= f <= 1 for f in found) and found[1] > found[2]
