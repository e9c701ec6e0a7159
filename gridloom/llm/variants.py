"""Variant spellings of names typed by people.

1. Rows are reduced to forms: one per entity and name key (tokens without order,
   case and accents), with the values that the entity's rows give for each attribute.
2. A symmetric-delete neighbourhood index finds forms with tokens in common up to
   an edit. Rules say which entries of a name (``names.index_entries``) are
   looked up together with which agreeing attributes, so that every pair the
   scorer may accept has an entry of some rule in common and a common first name
   alone never forms a bucket. Only hashes are shuffled. Forms that contradict
   each other in an attribute are not paired.
3. The tokens of a pair are aligned by optimal assignment, permitting initials,
   abbreviations, nicknames and slips; agreeing and contradicting attributes
   weigh in, and pairs above the threshold are linked.
4. Links are closed over their connected components; members that contradict
   each other are not paired.

Defined results
---------------
* A null or empty name has no tokens and no links.
* Entities with the same tokens and attributes are one class and are paired as one, however many they are.
* Attributes that are null on one side weigh nothing.
* Repeated rows share a form and link like any other row of the form.
* A row without an entity key is an entity of its own.
* Empty tables give no pairs; columns that are not named take no part.
* Names of any number of tokens are aligned as a whole.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm import names as nm
from gridloom.llm.components import components
from gridloom.llm.text_forms import with_canonical
from gridloom.session import cut_lineage


@dataclass(frozen=True)
class Attribute:
    """A whole-number attribute of an entity: what agreement is worth and when two values contradict.

    ``tolerance`` is the greatest difference that doesn't contradict; ``steps``
    are further differences (modulo ``modulus``) that slips are known to make.
    ``near`` is the worth of agreement within tolerance or by a step, and
    ``contradiction`` the worth of anything else; None forbids the pair.
    """

    name: str
    same: float
    near: float = 0.0
    tolerance: int = 0
    steps: tuple[int, ...] = ()
    modulus: int = 0
    contradiction: float | None = None


def _compatible(attribute: Attribute, a: Column, b: Column) -> Column:
    """Whether two value lists of an attribute don't contradict each other (empty lists never do)."""
    spread = {0, *range(-attribute.tolerance, attribute.tolerance + 1), *attribute.steps}
    widened = a
    if spread != {0}:
        shift = lambda x: F.array(*[(F.pmod(x + d, F.lit(attribute.modulus)) if attribute.modulus else x + d) for d in sorted(spread)])
        widened = F.flatten(F.transform(a, shift))
    return (F.size(a) == 0) | (F.size(b) == 0) | F.arrays_overlap(widened, b)


def compatible(attributes: Sequence[Attribute], a: str, b: str) -> Column:
    """Whether the attributes of two forms, in arrays prefixed ``a`` and ``b``, allow a link."""
    allowed = F.lit(True)
    for t in attributes:
        if t.contradiction is None:
            allowed = allowed & _compatible(t, F.col(f"{a}{t.name}"), F.col(f"{b}{t.name}"))
    return allowed


def attribute_worth(attribute: Attribute, a: Sequence[int], b: Sequence[int]) -> float:
    """Worth of two value lists; the best pair of values counts."""
    if len(a) == 0 or len(b) == 0:
        return 0.0
    best = -99.0 if attribute.contradiction is None else attribute.contradiction
    for x in a:
        for y in b:
            difference = int(x) - int(y)
            if difference == 0:
                return attribute.same
            stepped = {difference, difference % attribute.modulus} if attribute.modulus else {difference}
            allowed = {s % attribute.modulus for s in attribute.steps} if attribute.modulus else set(attribute.steps)
            if abs(difference) <= attribute.tolerance or stepped & allowed:
                best = max(best, attribute.near)
    return best


#: Forms of a block up to which all its pairs are looked at: no form meets more than so many others.
WHOLE_BLOCK = 500
#: Worth of a name that agrees in every token; ``names.COST`` is what weaker agreement takes from it.
NAME_WORTH = 6.0


def name_worth(a: tuple[tuple[str, ...], str], b: tuple[tuple[str, ...], str], others: int = 1) -> float | None:
    """Worth of two tokenised names, or None if they can't name the same entity."""
    found = nm.align(a[0], b[0], others)
    if found is None:
        return None
    cost, kinds = found
    # something longer than an initial must carry the match
    if not any(kinds.get(k) for k in ("same", "typo", "typos", "short")):
        return None
    worth = NAME_WORTH - cost
    if a[1] != b[1]:
        worth -= 6.0 if a[1] and b[1] else 0.5
    return worth


def with_name_key(df: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name_key``: the tokens of the name's canonical form; null for a name without tokens."""

    def keys(names: pd.Series) -> pd.Series:
        return names.map(nm.name_key)

    canonical = with_canonical(df, name, "_plain", "_mixed")
    keyed = canonical.withColumn("name_key", F.pandas_udf(keys, "string")("_plain")).drop("_plain", "_mixed")
    return keyed.withColumn("name_key", F.when(F.col("name_key") != "", F.col("name_key")))


@dataclass(frozen=True)
class Rule:
    """Forms are candidates if they share a name entry of a kind and agree in some attributes.

    ``entries`` is near, ends, exact (``names.index_entries``) or '' for none;
    ``together`` are groups of attributes one of which must agree in all its
    members. With ``one_lacks``, at least one of the two has no value for one of
    these attributes: pairs for which the other rules have no key.
    """

    entries: str
    together: tuple[tuple[str, ...], ...] = ((),)
    one_lacks: tuple[str, ...] = ()


def spelling_forms(rows: DataFrame, attributes: Sequence[Attribute]) -> DataFrame:
    """(entity, block, plain, one array per attribute, form): one row per entity and name key.

    ``rows`` has entity, block, name_keys (an array) and the attributes as
    columns. Arrays hold the distinct values that all rows of the entity give.
    ``form`` is the class: equal for entities with equal tokens, block and attributes.
    """
    spelled = rows.select("entity", "block", F.explode("name_keys").alias("plain")).where(F.col("plain").isNotNull()).distinct()
    values = rows.groupBy("entity").agg(*[F.sort_array(F.collect_set(t.name)).alias(t.name) for t in attributes])
    identity = [F.coalesce("block", F.lit("\0")), F.col("plain"), *[F.concat_ws(",", F.transform(t.name, lambda x: x.cast("string"))) for t in attributes]]
    return spelled.join(values, "entity").withColumn("form", F.xxhash64(*identity))


def _agreement_keys(attributes: Sequence[Attribute], together: Sequence[tuple[str, ...]]) -> Column:
    """Hashes that two forms have in common if they agree in all attributes of a group of ``together``.

    Within a tolerance of one, values share one of {x, x + 1}; by a step, one of {x, x + step}. Empty lists give no key.
    """
    spread = {t.name: (t, sorted({*range(t.tolerance + 1), *(s for s in t.steps if s > 0)})) for t in attributes}
    keys = []
    for group in together:
        combined = F.array(F.lit("|".join(group)))
        for name in group:
            t, added = spread[name]
            near = lambda x: F.array(*[(F.pmod(x + d, F.lit(t.modulus)) if t.modulus else x + d).cast("string") for d in added])  # noqa: B023, E731
            values = F.flatten(F.transform(F.col(name), near))
            combined = F.flatten(F.transform(combined, lambda k: F.transform(values, lambda v: F.concat(k, F.lit("|"), v))))  # noqa: B023
        keys.append(combined)
    return F.transform(F.array_distinct(F.concat(*keys)), lambda k: F.xxhash64(k))


_NAME_ENTRIES = "struct<near:array<bigint>,ends:array<bigint>,exact:array<bigint>>"


def _name_entries(names: pd.Series) -> pd.DataFrame:
    found = {n: nm.index_entries(n) for n in set(names)}
    return pd.DataFrame([found[n] for n in names], columns=["near", "ends", "exact"])


def signature(attributes: Sequence[Attribute]) -> Column:
    """The single values of all forbidding attributes in one number, so that pairs are refused before they are written.

    Each attribute has the same number of bits: 0 for no or several values, else
    1 + the value modulo the rest of the range.
    """
    forbidding = [t for t in attributes if t.contradiction is None]
    width = 63 // max(len(forbidding), 1)
    packed = F.lit(0).cast("long")
    for i, t in enumerate(forbidding):
        code = F.when(F.size(t.name) == 1, 1 + F.pmod(F.get(F.col(t.name), F.lit(0)).cast("long"), F.lit((1 << width) - 1))).otherwise(F.lit(0).cast("long"))
        packed = packed.bitwiseOR(F.shiftleft(code, i * width))
    return packed


def signatures_allow(attributes: Sequence[Attribute], a: Column, b: Column) -> Column:
    """False only for pairs of signatures that contradict each other in an attribute."""
    forbidding = [t for t in attributes if t.contradiction is None]
    width = 63 // max(len(forbidding), 1)
    mask = (1 << width) - 1
    allowed = F.lit(True)
    for i, t in enumerate(forbidding):
        x, y = (F.shiftrightunsigned(s, i * width).bitwiseAND(mask) for s in (a, b))
        steps = {0, *range(-t.tolerance, t.tolerance + 1), *t.steps, *(s - t.modulus for s in t.steps if t.modulus and s > 0), *(s + t.modulus for s in t.steps if t.modulus and s < 0)}
        close = x == y if steps == {0} else F.pmod(x - y, F.lit(mask)).isin(sorted({s % mask for s in steps}))
        allowed = allowed & ((x == 0) | (y == 0) | close)
    return allowed


def _entries_of(forms: DataFrame, attributes: Sequence[Attribute], rules: Sequence[Rule]) -> DataFrame:
    """(entry, form, sig): the hashed keys of the rules."""
    hashes = []
    for i, rule in enumerate(rules):
        keys = _agreement_keys(attributes, rule.together)
        block = F.coalesce("block", F.lit("\0"))
        if rule.entries:
            combine = lambda k: F.transform(F.col(f"_names.{rule.entries}"), lambda e: F.xxhash64(F.lit(i), block, k, e))  # noqa: B023, E731
            hashes.append(F.flatten(F.transform(keys, combine)))
        else:
            hashes.append(F.transform(keys, lambda k: F.xxhash64(F.lit(i), block, k)))  # noqa: B023
    return forms.select(F.explode(F.concat(*hashes)).alias("entry"), "form", "sig")


def candidate_pairs(forms: DataFrame, attributes: Sequence[Attribute], rules: Sequence[Rule]) -> DataFrame:
    """(a, b): distinct forms that a rule makes candidates, the smaller first. ``forms`` has one row per form, with ``sig``."""
    used = sorted({r.entries for r in rules if r.entries})  # only these are written
    if used:
        forms = forms.withColumn("_names", F.pandas_udf(_name_entries, _NAME_ENTRIES)("plain"))
        forms = forms.withColumn("_names", F.struct(*[F.col(f"_names.{k}").alias(k) for k in used]))
    named = cut_lineage(forms)
    free = [r for r in rules if not r.one_lacks]
    found = []
    allowed = (F.col("l.entry") == F.col("r.entry")) & signatures_allow(attributes, F.col("l.sig"), F.col("r.sig"))
    if free:
        entries = _entries_of(named, attributes, free)
        # both sides are one exchange; exploded sides outgrow their estimate, so the planner may not broadcast one
        l, r = entries.alias("l"), entries.alias("r").hint("merge")
        found.append(l.join(r, allowed & (F.col("l.form") < F.col("r.form"))).select(F.col("l.form").alias("a"), F.col("r.form").alias("b")))
    for lacking in sorted({r.one_lacks for r in rules if r.one_lacks}):
        some = F.lit(False)
        for name in lacking:
            some = some | (F.size(name) == 0)
        few = named.where(some)
        if not few.limit(1).count():
            continue  # no pair can meet the condition
        bound = [r for r in rules if r.one_lacks == lacking]
        l, r = _entries_of(few, attributes, bound).alias("l"), _entries_of(named, attributes, bound).alias("r").hint("merge")
        pairs = l.join(r, allowed & (F.col("l.form") != F.col("r.form")))
        found.append(pairs.select(F.least("l.form", "r.form").alias("a"), F.greatest("l.form", "r.form").alias("b")))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def _scorer(attributes: Sequence[Attribute], threshold: float, other_evidence: float):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cached = functools.lru_cache(maxsize=1 << 15)  # what it forgets is computed again
        parsed = cached(nm.tokens)
        named = cached(lambda x, y, others: name_worth(parsed(x), parsed(y), others))
        for batch in batches:
            keep = []
            columns = [(t, batch[f"a_{t.name}"].to_numpy(), batch[f"b_{t.name}"].to_numpy()) for t in attributes]
            a, b = batch["a"].to_numpy(), batch["b"].to_numpy()
            for i, (x, y) in enumerate(zip(batch["a_plain"], batch["b_plain"], strict=True)):
                evidence = sum(attribute_worth(t, va[i], vb[i]) for t, va, vb in columns)
                if NAME_WORTH + evidence < threshold:
                    continue
                worth = named(x, y, 0)
                if worth is None and evidence >= other_evidence:
                    worth = named(x, y, 1)
                if worth is not None and worth + evidence >= threshold:
                    keep.append((a[i], b[i], worth + evidence))
            yield pd.DataFrame(keep, columns=["a", "b", "score"])

    return score


def link_forms(forms: DataFrame, attributes: Sequence[Attribute], threshold: float, other_evidence: float, rules: Sequence[Rule]) -> DataFrame:
    """(a, b, score): linked forms; a form that stands for several entities which are one is linked to itself.

    Blocks of up to ``WHOLE_BLOCK`` forms are compared as a whole, which shuffles
    their forms once and nothing else; larger ones, and forms without a block,
    meet through the index.
    """
    carried = ["plain", *[t.name for t in attributes]]
    distinct = forms.groupBy("form").agg(*[F.first(c).alias(c) for c in ("block", *carried)], F.count(F.lit(1)).alias("_n"))
    distinct = cut_lineage(distinct.withColumn("sig", signature(attributes)))
    blocked = distinct.where("block IS NOT NULL")
    small = blocked.groupBy("block").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") <= WHOLE_BLOCK).drop("_size")
    whole, large = blocked.join(small.hint("merge"), "block"), blocked.join(small, "block", "left_anti")
    others = distinct.where("block IS NULL").unionByName(large.select(distinct.columns))
    found = []
    if small.limit(1).count():
        side = lambda p: whole.select(F.col("block").alias(f"{p}_block"), F.col("form").alias(p), "sig", "_n", *[F.col(c).alias(f"{p}_{c}") for c in carried]).alias(p)
        ordered = (F.col("a") < F.col("b")) | ((F.col("a") == F.col("b")) & (F.col("a._n") > 1))
        met = side("a").join(side("b").hint("merge"), (F.col("a_block") == F.col("b_block")) & ordered & signatures_allow(attributes, F.col("a.sig"), F.col("b.sig")))
        found.append(met.select(*[x for p in "ab" for x in (p, *[f"{p}_{c}" for c in carried])]))
    if not found or others.limit(1).count():
        pairs = candidate_pairs(others.drop("_n"), attributes, rules)
        pairs = pairs.unionByName(others.where("_n > 1").select(F.col("form").alias("a"), F.col("form").alias("b")))
        side = lambda p: others.select(F.col("form").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in carried])
        found.append(pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").select(*[x for p in "ab" for x in (p, *[f"{p}_{c}" for c in carried])]))
    joined = functools.reduce(DataFrame.unionByName, found).where(compatible(attributes, "a_", "b_"))
    return joined.mapInPandas(_scorer(attributes, threshold, other_evidence), "a long, b long, score double")


def variant_groups(rows: DataFrame, attributes: Sequence[Attribute], threshold: float, other_evidence: float, rules: Sequence[Rule]) -> DataFrame:
    """(entity, group, one array per attribute) of linked entities; ``rows`` as for ``spelling_forms``."""
    forms = cut_lineage(spelling_forms(rows, attributes))
    links = cut_lineage(link_forms(forms, attributes, threshold, other_evidence, rules).select("a", "b"))
    linked = links.select(F.col("a").alias("form")).unionByName(links.select(F.col("b").alias("form"))).distinct()
    # entities hang on their forms: many entities of one form are as many links, not as many squared
    owned = forms.join(linked.hint("merge"), "form", "left_semi").select(F.col("entity").alias("a"), F.xxhash64(F.lit("form"), "form").alias("b"))
    between = links.where("a <> b").select(F.xxhash64(F.lit("form"), "a").alias("a"), F.xxhash64(F.lit("form"), "b").alias("b"))
    grouped = components(owned.unionByName(between), "a", "b")
    values = forms.select("entity", *[t.name for t in attributes]).dropDuplicates(["entity"])
    return grouped.join(values.hint("merge"), grouped["node"] == values["entity"]).select(
        "entity", F.col("component").alias("group"), *[t.name for t in attributes]
    )


def variant_row_pairs(rows: DataFrame, groups: DataFrame, attributes: Sequence[Attribute], within_entity: bool) -> DataFrame:
    """(row_id_a, row_id_b): rows of one group whose spellings differ and whose entities don't contradict each other.

    ``rows`` has row, spelling and entity. ``within_entity`` pairs the rows of
    one entity as well; else only rows of different entities are paired.
    Spellings are paired before rows are: rows that repeat a spelling, however
    many, meet nothing but rows of another spelling, which is the result.
    """
    grouped = groups.select(F.col("entity").alias("g_entity"), "group", *[t.name for t in attributes])
    typed = rows.where(F.col("spelling").isNotNull()).select("entity", "spelling").distinct()
    members = typed.join(grouped.hint("merge"), F.col("entity") == F.col("g_entity"), "left" if within_entity else "inner")
    members = members.withColumn("group", F.coalesce("group", "entity"))
    for t in attributes:
        members = members.withColumn(t.name, F.coalesce(t.name, F.array().cast("array<int>")))
    l, r = members.alias("l"), members.alias("r").hint("merge")
    same_entity = F.col("l.entity") == F.col("r.entity")
    differ = (F.col("l.group") == F.col("r.group")) & (F.col("l.spelling") < F.col("r.spelling"))
    allowed = compatible(attributes, "l.", "r.")
    allowed = (same_entity | allowed) if within_entity else (~same_entity & allowed)
    pairs = l.join(r, differ & allowed).select(
        F.col("l.entity").alias("le"), F.col("l.spelling").alias("ls"), F.col("r.entity").alias("re"), F.col("r.spelling").alias("rs")
    )
    left = rows.select(F.col("entity").alias("le"), F.col("spelling").alias("ls"), F.col("row").alias("x"))
    right = rows.select(F.col("entity").alias("re"), F.col("spelling").alias("rs"), F.col("row").alias("y"))
    found = pairs.join(left.hint("merge"), ["le", "ls"]).join(right.hint("merge"), ["re", "rs"]).where("x <> y")
    return found.select(F.least("x", "y").alias("row_id_a"), F.greatest("x", "y").alias("row_id_b")).distinct()
