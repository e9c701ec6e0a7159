"""Mixing sources to target shares of the total size.

Each source's budget is its share of the mix's size, at most ``max_repeats``
times what the source holds. The size is a parameter; without one it is the
largest at which every source that can contribute reaches its share, so that no
source stands in for another. Whole passes over a source come first; the rest of
the budget is a weighted sample without replacement by Efraimidis-Spirakis
keys: exponential variates divided by the document's quality weight, in order,
until their prefix sum of sizes meets the budget.

Keys are binned by their distribution function and the bins' sizes are summed
first, so that only the bin in which the budget runs out is sorted: no source,
however large, is ordered in one task.

Defined results
---------------
* A null text or source is in no mix. Targets without documents get share 0.
* A null or negative target share counts as 0, a null ``max_repeats`` as 1.
* The document at which the budget runs out is taken if half of it fits.
* Repeated rows are separate documents. Empty tables give empty results.
* The same documents give the same mix in whatever order or files they come.
* Shares of a mix are taken relative to their sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.tokens import token_sizes
from gridloom.operators.ordering import ranked_within
from gridloom.session import bounded_broadcast, cut_lineage

#: Bins of the keys' distribution; grows with the data so that a bin holds about ``BIN_ROWS`` documents at most.
LEAST_BINS, BIN_ROWS = 1024, 200_000
#: Range of quality weights, and the rate with which keys are binned.
LEAST_WEIGHT, BIN_RATE = 0.25, 0.7


def quality(text: Column) -> Column:
    """Weight between ``LEAST_WEIGHT`` and 1: texts of letters and some length weigh more."""
    length = F.greatest(F.length(text), F.lit(1))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}\s]", "")) / length
    return F.lit(LEAST_WEIGHT) + (1 - LEAST_WEIGHT) * letters * (length / (length + 200))


def mix_plan(sized: DataFrame, targets: DataFrame, size: int | None = None) -> DataFrame:
    """(mix_name, source, target_share, available, budget, epochs, rest) per target.

    ``size`` is the size of every mix in tokens: sources whose repeats don't
    fill their share then stay below it. None is the largest size at which all
    sources that hold anything, may be used and have a share reach it.
    """
    held = sized.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    wanted = targets.where(F.col("source").isNotNull()).select(
        "mix_name", "source", F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)).alias("share"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("most")
    )
    plan = wanted.join(held, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    mix = Window.partitionBy("mix_name")
    shares = F.sum("share").over(mix)
    plan = plan.withColumn("target_share", F.when(shares > 0, F.col("share") / shares).otherwise(0.0))
    useful = (F.col("available") * F.col("most") > 0) & (F.col("target_share") > 0)
    reachable = F.min(F.when(useful, F.col("available") * F.col("most") / F.col("target_share"))).over(mix)
    plan = plan.withColumn("_size", F.lit(size).cast("double") if size is not None else F.coalesce(reachable, F.lit(0.0)))
    # a share of the size that comes out a hair below a whole number is that number
    plan = plan.withColumn("budget", F.least(F.floor(F.col("_size") * F.col("target_share") + 1e-6), F.col("available") * F.col("most")))
    epochs = F.when(F.col("available") > 0, F.floor(F.col("budget") / F.col("available"))).otherwise(0)
    plan = plan.withColumn("epochs", epochs.cast("int"))
    return plan.select("mix_name", "source", "target_share", "available", "budget", "epochs", (F.col("budget") - F.col("epochs") * F.col("available")).alias("rest"))


def sized_documents(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(doc, source, weight, n_tokens, copy), kept for the passes that follow; ``copy`` counts the rows of an identifier."""
    rows = docs.where(F.col(source).isNotNull()).select(
        F.col(doc_id).alias("doc"), F.col(source).alias("source"), quality(F.col(text)).alias("weight"), F.col(text).alias("text")
    )
    sizes = cut_lineage(token_sizes(rows, "text", ["doc", "source", "weight"]))  # ranking reads its rows twice
    return cut_lineage(ranked_within(sizes, ["doc"], ["source", "n_tokens", "weight"], "copy"))


def mix_documents(sized: DataFrame, plan: DataFrame, seed: int = 11) -> DataFrame:
    """(mix_name, source, doc, n_tokens, repeats): the documents of every mix and how often each is repeated."""
    bins = max(LEAST_BINS, sized.count() // BIN_ROWS + 1)
    kept = bounded_broadcast(plan.select("mix_name", "source", "epochs", "rest").where("epochs > 0 OR rest > 0"))
    rows = sized.select("doc", "source", "weight", "n_tokens", "copy").join(kept, "source")
    # uniform in (0, 1) from the document, the mix and the seed: the same in every attempt of a task
    uniform = (F.pmod(F.xxhash64("doc", "copy", "mix_name", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = rows.withColumn("key", -F.log(uniform) / F.col("weight"))
    rows = rows.withColumn("bin", F.floor((1 - F.exp(-F.col("key") * BIN_RATE)) * bins))
    sums = rows.where("rest > 0").groupBy("mix_name", "source", "rest", "bin").agg(F.sum("n_tokens").alias("held"))
    upto = Window.partitionBy("mix_name", "source").orderBy("bin")
    edges = sums.withColumn("base", F.coalesce(F.sum("held").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    edges = edges.where((F.col("base") < F.col("rest")) & (F.col("base") + F.col("held") >= F.col("rest")))
    edges = bounded_broadcast(edges.select("mix_name", "source", F.col("bin").alias("edge"), "base"))
    placed = rows.join(edges, ["mix_name", "source"], "left")
    # below the edge bin everything is taken; in it the prefix sum decides
    in_edge = placed.where(F.col("bin") == F.col("edge"))
    before = Window.partitionBy("mix_name", "source").orderBy("key", "doc", "copy").rowsBetween(Window.unboundedPreceding, -1)
    in_edge = in_edge.withColumn("_before", F.col("base") + F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    fits = (F.col("_before") + F.col("n_tokens") / 2 <= F.col("rest")).cast("int")
    others = placed.where(F.col("edge").isNull() | (F.col("bin") != F.col("edge")))
    taken = F.when(F.col("rest") <= 0, 0).when(F.col("edge").isNull() | (F.col("bin") < F.col("edge")), 1).otherwise(0)
    columns = ["mix_name", "source", "doc", "n_tokens"]
    chosen = in_edge.select(*columns, (F.col("epochs") + fits).alias("repeats")).unionByName(others.select(*columns, (F.col("epochs") + taken).alias("repeats")))
    return chosen.where("repeats > 0")


def mix_shares(mixed: DataFrame, plan: DataFrame) -> DataFrame:
    """(mix_name, source, target_share, actual_share, tokens, documents, epochs): the shares really reached."""
    reached = mixed.groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("documents"))
    joined = plan.join(reached, ["mix_name", "source"], "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    total = F.sum("tokens").over(Window.partitionBy("mix_name"))
    return joined.select(
        "mix_name", "source", F.round("target_share", 6).alias("target_share"),
        F.when(total > 0, F.round(F.col("tokens") / total, 6)).otherwise(0.0).alias("actual_share"),
        "tokens", F.coalesce("documents", F.lit(0)).alias("documents"), "epochs",
    )
