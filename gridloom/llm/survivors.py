"""Best representative of each duplicate group, field by field.

Two policies over the same claims (a claim is a real value of one field in one row):

``survivors``
    the stated order of preference: trusted rows first, then the most recent,
    then the smaller identifier. One partially aggregated ``min`` per field, so
    a group that holds a third of all rows costs no more than any other.

``fuse``
    Bayesian fusion with copy detection. Sources make claims about the fields
    of a key; their accuracies and the dependence between them are estimated
    from shared false values, copied votes are discounted, and the value of
    maximum posterior survives. What decides an item is only which sources
    agree, so items are first counted by agreement pattern; the iterations run
    on that histogram, whose size depends on the number of sources alone.

Defined results
---------------
* Nulls, texts that stand for "not known" and numbers outside the stated range
  are no claims; a field without a claim gives no row.
* A null key is a group of its own. Groups of fewer than ``min_rows`` rows are
  left out; repeated rows count as rows.
* A null trust flag comes after true, a null recency last.
* Equal posteriors go to the preferred row of ``survivors``.
* An empty table gives no rows. Other columns take no part.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.session import bounded_broadcast, cut_lineage

#: Spellings of "not known"; a text without any letter or digit is one as well.
UNKNOWN = (
    "n/a", "na", "none", "null", "nan", "nil", "unknown", "unk", "tbd", "tba", "undefined",
    "not known", "not available", "not applicable", "no data", "pending",
)
#: Sources whose agreement patterns are gathered on the driver: there are no more than the Bell number of this plus one.
MAX_SOURCES = 8


@dataclass(frozen=True)
class Field:
    """A field to settle: text (``low`` is None), money text, or a number with its possible range."""

    name: str
    low: float | None = None
    high: float | None = None
    needs_digit: bool = False


def is_real(field: Field) -> Column:
    """Whether the row's value of the field is a claim."""
    c = F.col(field.name)
    if field.low is not None:
        return F.coalesce(c.between(field.low, field.high) & ~F.isnan(c.cast("double")), F.lit(False))
    text = F.lower(F.trim(c))
    real = text.rlike(r"[\p{L}\p{N}]") & ~text.isin(*UNKNOWN)
    if field.needs_digit:
        real = real & text.rlike(r"\p{N}")
    return F.coalesce(real, F.lit(False))


def _preference(trust_last: str, recency: str, row_id: str) -> Column:
    """Smaller is better: untrusted flag, missing recency, age, identifier."""
    return F.struct(
        F.coalesce(F.col(trust_last).cast("int"), F.lit(2)).alias("t"),
        F.col(recency).isNull().cast("int").alias("m"),
        F.coalesce(-F.unix_micros(F.col(recency).cast("timestamp")), F.lit(0)).alias("r"),
        F.col(row_id).alias("row_id"),
    )


def survivors(
    df: DataFrame,
    key: str,
    fields: Sequence[Field],
    trust_last: str,
    recency: str,
    row_id: str,
    min_rows: int = 2,
) -> DataFrame:
    """(key, field_name, row_id, value): the row from which each field of the surviving record comes."""
    best = [
        F.min(F.when(is_real(f), F.struct(_preference(trust_last, recency, row_id).alias("p"), F.col(f.name).cast("string").alias("v")))).alias(f"b{i}")
        for i, f in enumerate(fields)
    ]
    grouped = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"), *best)
    each = F.explode(
        F.array(*[F.struct(F.lit(f.name).alias("field_name"), F.col(f"b{i}").alias("b")) for i, f in enumerate(fields)])
    )
    return (
        grouped.where(F.col("_rows") >= min_rows)
        .select("_key", each.alias("e"))
        .where(F.col("e.b").isNotNull())
        .select(
            F.col("_key").alias(key),
            F.col("e.field_name").alias("field_name"),
            F.col("e.b.p.row_id").alias("row_id"),
            F.col("e.b.v").alias("value"),
        )
    )


# --- Bayesian fusion -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Prior:
    """Constants of the model: false values per item, first accuracy, copying prior and rate, rounds."""

    false_values: int = 10
    accuracy: float = 0.8
    copying: float = 0.2
    copied_share: float = 0.8
    rounds: int = 8


def _posteriors(
    pattern: tuple[tuple[str, int], ...],
    accuracy: Mapping[str, float],
    depends: Mapping[tuple[str, str], float],
    prior: Prior,
) -> dict[int, float]:
    """Posterior of each value of an item, votes of likely copiers discounted."""
    confidence: dict[int, float] = defaultdict(float)
    for value in {v for _, v in pattern}:
        counted: list[str] = []
        for source in sorted((s for s, v in pattern if v == value), key=lambda s: (-accuracy[s], s)):
            independent = math.prod(1 - prior.copied_share * depends.get(tuple(sorted((source, other))), 0.0) for other in counted)
            a = min(max(accuracy[source], 0.01), 0.99)
            confidence[value] += independent * math.log(prior.false_values * a / (1 - a))
            counted.append(source)
    top = max(0.0, *confidence.values())
    unseen = max(prior.false_values + 1 - len(confidence), 0) * math.exp(-top)
    total = unseen + sum(math.exp(c - top) for c in confidence.values())
    return {v: math.exp(c - top) / total for v, c in confidence.items()}


Pattern = tuple[tuple[str, int], ...]


def _sums(pattern: Pattern, n: int, posterior: Mapping[int, float]) -> Iterator[tuple[str, str, str, float]]:
    """What a pattern that ``n`` items have adds to the sums that accuracies and dependence are taken from."""
    for source, value in pattern:
        yield "right", source, "", n * posterior[value]
        yield "made", source, "", float(n)
    for (s, v), (t, w) in itertools.combinations(sorted(pattern), 2):
        if v == w:
            yield "agree_true", s, t, n * posterior[v]
            yield "agree_false", s, t, n * (1 - posterior[v])
        else:
            yield "differ", s, t, float(n)


def _model(sums: Mapping[tuple[str, str, str], float], prior: Prior) -> tuple[dict[str, float], dict[tuple[str, str], float]]:
    """Accuracies, and dependence per pair of sources that ever met."""
    accuracy = {s: min(max(sums.get(("right", s, ""), 0.0) / made, 0.01), 0.99) for (kind, s, _), made in sums.items() if kind == "made"}
    depends = {}
    for s, t in sorted({(s, t) for _, s, t in sums if t}):
        a, b = accuracy[s], accuracy[t]
        both_true, both_false = a * b, (1 - a) * (1 - b) / prior.false_values
        c, mean = prior.copied_share, (a + b) / 2
        log_odds = math.log(prior.copying / (1 - prior.copying))
        log_odds += sums.get(("agree_true", s, t), 0.0) * math.log((c * mean + (1 - c) * both_true) / both_true)
        log_odds += sums.get(("agree_false", s, t), 0.0) * math.log((c * (1 - mean) + (1 - c) * both_false) / both_false)
        log_odds += sums.get(("differ", s, t), 0.0) * math.log(1 - c)
        depends[s, t] = 1 / (1 + math.exp(-max(min(log_odds, 50), -50)))
    return accuracy, depends


def estimate(patterns: Mapping[Pattern, int], prior: Prior = Prior()) -> tuple[dict[Pattern, dict[int, float]], dict[str, float], dict[tuple[str, str], float]]:
    """Posteriors per pattern, accuracies, and dependence per pair of sources, from counted agreement patterns."""
    accuracy = dict.fromkeys(sorted({s for pattern in patterns for s, _ in pattern}), prior.accuracy)
    depends: dict[tuple[str, str], float] = {}
    posterior: dict = {}
    for _ in range(prior.rounds):
        posterior = {p: _posteriors(p, accuracy, depends, prior) for p in patterns}
        sums: dict[tuple[str, str, str], float] = defaultdict(float)
        for pattern, n in patterns.items():
            for kind, s, t, x in _sums(pattern, n, posterior[pattern]):
                sums[kind, s, t] += x
        accuracy, depends = _model(sums, prior)
    return posterior, accuracy, depends


def _parsed(claims: Sequence[str]) -> Pattern:
    return tuple((s, int(v)) for s, v in (c.rsplit("=", 1) for c in claims))


def _settled_here(histogram: DataFrame, prior: Prior) -> DataFrame:
    """(f, pattern, _position, posterior) with the patterns of few sources gathered on the driver."""
    by_field: dict[str, dict] = defaultdict(dict)
    for row in histogram.collect():
        by_field[row["field_name"]][_parsed(row["_pattern"])] = row["count"]
    settled = []
    for name, patterns in by_field.items():
        posterior, _, _ = estimate(patterns, prior)
        settled += [(name, [f"{s}={v}" for s, v in p], v, float(round(q, 6))) for p, values in posterior.items() for v, q in values.items()]
    return histogram.sparkSession.createDataFrame(settled, "f string, pattern array<string>, _position long, posterior double")


def _settled_there(histogram: DataFrame, prior: Prior) -> DataFrame:
    """The same with the patterns left where they are: only sums per source and pair of sources reach the driver."""
    first = histogram.select("field_name", F.explode("_pattern").alias("c")).select("field_name", F.regexp_replace("c", "=[0-9]+$", "").alias("s")).distinct()
    accuracy: dict[str, dict[str, float]] = defaultdict(dict)
    for row in first.collect():
        accuracy[row["field_name"]][row["s"]] = prior.accuracy
    depends: dict[str, dict[tuple[str, str], float]] = defaultdict(dict)

    def judged(batch: pd.DataFrame, accuracy: Mapping, depends: Mapping) -> Iterator[tuple]:
        for f, claims, n in zip(batch["field_name"], batch["_pattern"], batch["count"], strict=True):
            pattern = _parsed(list(claims))
            yield f, list(claims), pattern, int(n), _posteriors(pattern, accuracy[f], depends[f], prior)

    for turn in range(prior.rounds):
        if turn == prior.rounds - 1:
            break
        accuracy, depends = _next_models(histogram, judged, accuracy, depends, prior)

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(f, claims, v, round(q, 6)) for f, claims, _, _, values in judged(batch, accuracy, depends) for v, q in values.items()]
            yield pd.DataFrame(rows, columns=["f", "pattern", "_position", "posterior"])

    return cut_lineage(histogram.mapInPandas(settle, "f string, pattern array<string>, _position long, posterior double"))


def _next_models(histogram: DataFrame, judged: Callable, accuracy: Mapping, depends: Mapping, prior: Prior) -> tuple[dict, dict]:
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: dict[tuple, float] = defaultdict(float)
            for f, _, pattern, n, posterior in judged(batch, accuracy, depends):
                for kind, s, t, x in _sums(pattern, n, posterior):
                    sums[f, kind, s, t] += x
            yield pd.DataFrame([(*k, x) for k, x in sums.items()], columns=["f", "kind", "s", "t", "x"])

    by_field: dict[str, dict] = defaultdict(dict)
    for row in histogram.mapInPandas(add, "f string, kind string, s string, t string, x double").groupBy("f", "kind", "s", "t").agg(F.sum("x").alias("x")).collect():
        by_field[row["f"]][row["kind"], row["s"], row["t"]] = row["x"]
    models = {f: _model(sums, prior) for f, sums in by_field.items()}
    return {f: m[0] for f, m in models.items()}, {f: m[1] for f, m in models.items()}


def fuse(
    df: DataFrame,
    key: str,
    fields: Sequence[Field],
    source: Column,
    trust_last: str,
    recency: str,
    row_id: str,
    min_rows: int = 2,
    prior: Prior = Prior(),
) -> DataFrame:
    """(key, field_name, row_id, value, posterior): the value of maximum posterior and the row it is taken from.

    A source's claim about an item is its preferred row's value. Patterns of up
    to ``MAX_SOURCES`` sources are settled on the driver, those of more over the
    cluster, by the same rules.
    """
    claim = [
        F.when(
            is_real(f),
            F.struct(_preference(trust_last, recency, row_id).alias("p"), F.lower(F.trim(F.col(f.name).cast("string"))).alias("n"), F.col(f.name).cast("string").alias("v")),
        )
        for f in fields
    ]
    per_source = df.groupBy(F.col(key).alias("_key"), F.coalesce(source, F.lit("?")).alias("_source")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.min(c).alias(f"c{i}") for i, c in enumerate(claim)]
    )
    collected = per_source.groupBy("_key").agg(
        F.sum("_rows").alias("_rows"),
        *[F.array_sort(F.collect_list(F.when(F.col(f"c{i}").isNotNull(), F.struct(F.col("_source").alias("s"), F.col(f"c{i}").alias("c"))))).alias(f"c{i}") for i in range(len(fields))],
    )
    each = F.explode(
        F.array(*[F.struct(F.lit(f.name).alias("field_name"), F.col(f"c{i}").alias("claims")) for i, f in enumerate(fields)])
    )
    items = (
        collected.where(F.col("_rows") >= min_rows)
        .select("_key", each.alias("e"))
        .select("_key", "e.field_name", "e.claims")
        .where(F.size("claims") > 0)
        # a pattern lists each source with the position of its value among the item's distinct values
        .withColumn("_values", F.array_distinct(F.transform("claims", lambda x: x["c"]["n"])))
        .withColumn("_pattern", F.transform("claims", lambda x: F.concat_ws("=", x["s"], F.array_position("_values", x["c"]["n"]).cast("string"))))
    )
    items = cut_lineage(items)
    histogram = cut_lineage(items.groupBy("field_name", "_pattern").count())
    sources = histogram.select(F.explode("_pattern").alias("c")).select(F.regexp_replace("c", "=[0-9]+$", "").alias("s")).distinct()
    few = sources.limit(MAX_SOURCES + 1).count() <= MAX_SOURCES
    table = (_settled_here if few else _settled_there)(histogram, prior)
    best = table.groupBy("f", "pattern").agg(F.max("posterior").alias("posterior"), F.collect_list(F.struct("posterior", "_position")).alias("ranked"))
    joined = items.join(bounded_broadcast(best), (F.col("field_name") == F.col("f")) & (F.col("_pattern") == F.col("pattern")))
    top_positions = F.transform(F.filter("ranked", lambda x: x["posterior"] == F.col("posterior")), lambda x: x["_position"])
    chosen = F.array_min(
        F.transform(F.filter("claims", lambda x: F.array_contains(top_positions, F.array_position("_values", x["c"]["n"]))), lambda x: x["c"])
    )
    return joined.withColumn("_c", chosen).select(
        F.col("_key").alias(key), "field_name", F.col("_c.p.row_id").alias("row_id"), F.col("_c.v").alias("value"), "posterior"
    )
