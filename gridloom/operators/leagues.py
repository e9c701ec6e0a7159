"""Named resolvers, each a tiered left join that gives a spine row at most one card and says how it was found.

A spine has (sid, name, team, grp), cards have (card, name, team, position, ord).
``card`` may repeat under several names; uniqueness counts distinct cards.
Every tier is an equi-join on a key or on exploded words.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import text as tx
from gridloom.operators.relational import first_claims
from gridloom.operators.resolve import Tier, fuzzy_in_block, resolve_tiers, similar_any_or_own
from gridloom.session import cut_lineage


def _coalesced(spine: DataFrame, tiers: Sequence[tuple[str, DataFrame]], found: str = "card", source: str = "match_source") -> DataFrame:
    """Spine rows with the first tier's card; a tier is a table (sid, card) with at most one row per sid."""
    result, matched, which = spine, [], F.lit(None).cast("string")
    for i, (_, table) in enumerate(tiers):
        one = table.select(F.col("sid").alias(f"_s{i}"), F.col("card").alias(f"_c{i}"))
        result = result.join(one, F.col("sid") == F.col(f"_s{i}"), "left").drop(f"_s{i}")
        matched.append(F.col(f"_c{i}"))
    for i in reversed(range(len(tiers))):
        which = F.when(matched[i].isNotNull(), F.lit(tiers[i][0])).otherwise(which)
    return result.withColumn(found, F.coalesce(*matched)).withColumn(source, which).drop(*[f"_c{i}" for i in range(len(tiers))])


def _first(pairs: DataFrame) -> DataFrame:
    """First card per spine row in the cards' order."""
    return pairs.groupBy("sid").agg(F.min_by("card", F.struct("ord", "card")).alias("card"))


def _only(pairs: DataFrame) -> DataFrame:
    """The card of spine rows that have exactly one."""
    judged = pairs.groupBy("sid").agg(F.min("card").alias("card"), F.max("card").alias("_most"))
    return judged.where(F.col("card") == F.col("_most")).drop("_most")


def word_subset_pairs(spine: DataFrame, cards: DataFrame) -> DataFrame:
    """Columns of the spine (sid, team, try, key) and (card, ord, c_team): cards whose words include all words of the spine's key.

    The longest word of the spine's name is looked up among the cards' words.
    """
    words = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    rare = F.get(F.array_sort(F.transform(words(F.col("key")), lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), F.lit(0))["w"]
    s = spine.where("key <> ''").withColumn("word", rare)
    c = cards.select("card", "ord", F.col("key").alias("c_key"), F.col("team").alias("c_team"), F.explode(F.array_distinct(words(F.col("key")))).alias("word"))
    joined = s.join(c.hint("merge"), "word")
    return joined.where(tx.is_token_subset(words(F.col("key")), words(F.col("c_key")))).drop("word", "c_key")


def find_cards(spine: DataFrame, cards: DataFrame, aliases: Mapping[str, str] | None = None, cross_team: bool = True) -> DataFrame:
    """Own team by name, own team by words, then (if ``cross_team``) the league by name and by words.

    Each way tries the aliased name first, then the name as typed. A name that
    cards of several teams carry is never looked up in the league. The first
    card in order counts; several are no contradiction.
    """
    aliased = tx.spaced_key(tx.mapped(F.col("name"), aliases or {}))
    tried = F.array_distinct(F.array_compact(F.array(F.when(aliased != "", aliased), tx.spaced_key(F.col("name")))))
    s = spine.select("sid", "team", F.posexplode(tried).alias("try", "key")).where("key <> ''")
    c = cards.withColumn("key", tx.spaced_key(F.col("name")))
    shared = c.groupBy("key").agg(F.count_distinct("team").alias("teams")).where("teams > 1").select("key")
    by_try = lambda pairs: pairs.groupBy("sid").agg(F.min_by("card", F.struct("try", "ord", "card")).alias("card"))
    named = s.join(c.select("key", F.col("team").alias("c_team"), "card", "ord"), "key")
    worded = word_subset_pairs(s, c)
    own = F.col("team") == F.col("c_team")
    tiers = [("team_name", by_try(named.where(own))), ("team_words", by_try(worded.where(own)))]
    if cross_team:
        tiers.append(("league_name", by_try(named.join(shared, "key", "left_anti"))))
        tiers.append(("league_words", by_try(worded.join(shared, "key", "left_anti"))))
    return _coalesced(spine, tiers)


def five_tiers(spine: DataFrame, cards: DataFrame, compatible: Mapping[str, str], aliases: Mapping[str, str | None] | None = None, league: bool = True) -> DataFrame:
    """Name and team, name alone, shared words within the team, the same words within the team, then the league's words.

    A null alias forces no match. The league tier needs a compatible position:
    ``compatible`` maps a position to the groups it may stand for, space-separated.
    Without ``league`` there are four tiers; a row without a team has the name tier only.
    """
    lookup = tx.mapped(F.col("name"), aliases or {}, default=F.col("name"))
    s = spine.withColumn("_name", lookup).where(F.col("_name").isNotNull()).select(
        "sid", "team", "grp", tx.match_key(F.col("_name"), True).alias("key"), tx.match_key(F.split(F.trim("_name"), r"\s+")[0], True).alias("first"), tx.token_set(F.col("_name")).alias("words")
    )
    c = cards.select(
        "card", "ord", F.col("team").alias("c_team"), "position", tx.match_key(F.col("name"), True).alias("c_key"), tx.match_key(F.split(F.trim("name"), r"\s+")[0], True).alias("c_first"), tx.token_set(F.col("name")).alias("c_words")
    )
    s = s.where("key <> ''")
    groups = sorted({g for v in compatible.values() for g in v.split(" ")})
    if len(groups) > 63:
        raise ValueError("positions stand for more than 63 groups")
    bit = {g: 1 << i for i, g in enumerate(groups)}
    stands = {p: str(sum(bit[g] for g in set(v.split(" ")))) for p, v in compatible.items()}
    kinds = ("team", "name", "first", "same", *(("strong", "weak") if league else ()))

    def entries(name: str, first: str, words: str, team: str, least: int) -> Column:
        """The keys under which a name is found; words are letters only, so a key means one thing.

        Whole names take part with ``least`` words besides the first name. Only
        the kind and 96 bits of hashes of a key are shuffled.
        """
        further = F.array_except(F.col(words), F.array(first))
        long = F.filter(F.col(words), lambda w: F.length(w) >= 4)
        no = F.array().cast("array<string>")
        own = lambda keys: F.when(F.col(team).isNotNull(), F.transform(keys, lambda k: F.concat_ws("|", k, F.col(team)))).otherwise(no)
        glued = F.when(F.col(name) != "", F.array(name)).otherwise(no)
        whole = F.when((F.size(words) > 0) & (F.size(further) >= least), F.array(F.array_join(words, " "))).otherwise(no)
        beside = lambda some: F.transform(some, lambda w: F.concat_ws("|", F.col(first), w))
        lists = {"team": own(glued), "name": glued, "first": own(beside(further)), "same": own(whole)}
        if league:
            lists["strong"] = F.concat(beside(F.filter(further, lambda w: F.length(w) >= 4)), whole)
            lists["weak"] = F.flatten(F.transform(long, lambda w: F.transform(F.filter(long, lambda v: v > w), lambda v: F.concat_ws("|", w, v))))
        hashed = lambda n, k: F.struct(F.lit(n).alias("kind"), F.xxhash64(F.lit(n), k).alias("h"), F.hash(F.lit(n), k).alias("g"))
        return F.explode(F.concat(*[F.transform(lists[k], lambda x: hashed(n, x)) for n, k in enumerate(kinds)]))  # noqa: B023

    # cards are reduced to a row per entry before the one join, so that a common name or word multiplies no rows
    mask = [F.when(F.col("card").isNotNull(), tx.mapped(F.col("position"), stands).cast("long")).alias("_mask")] if league else []
    listed = c.select("card", "ord", *mask, entries("c_key", "c_first", "c_words", "c_team", 0).alias("e")).select("card", "ord", *["_mask"] * league, "e.*")
    of_team, other = F.col("kind") == 0, F.when(F.col("kind") != 0, F.col("card"))
    last = F.min(F.when(of_team, F.struct(-F.col("ord"), "card")))  # the last card of a name and team
    listed = listed.groupBy("h", "g").agg(last["card"].alias("_last"), F.min(other).alias("_lo"), F.max(other).alias("_hi"), *[F.bit_or("_mask").alias("_mask")] * league)
    grp = [tx.mapped(F.col("grp"), {g: str(n) for g, n in bit.items()}).cast("long").alias("_bit")] if league else []
    looked = s.select("sid", *grp, entries("key", "first", "words", "team", 1).alias("e")).select("sid", *["_bit"] * league, "e.*")
    fits = F.coalesce(F.col("_mask").bitwiseAND(F.col("_bit")) != 0, F.lit(False)) if league else F.lit(False)
    hits = looked.join(listed.hint("merge"), ["h", "g"]).select("sid", "kind", F.coalesce("_last", "_lo").alias("_lo"), F.coalesce("_last", "_hi").alias("_hi"), fits.alias("_fits"))
    aggregates = ((F.min, "_lo"), (F.max, "_hi"), (F.max, "_fits"))
    of = lambda n, x: F.when(F.col("kind") == n, F.col(x))
    judged = hits.groupBy("sid").agg(*[f(of(n, x)).alias(f"{k}{x}") for n, k in enumerate(kinds) for f, x in aggregates[: 3 if k in ("strong", "weak") else 2]])
    one = lambda k: F.when(F.col(f"{k}_lo") == F.col(f"{k}_hi"), F.col(f"{k}_lo"))
    fit = lambda k: F.when(F.col(f"{k}_fits"), one(k))
    tiers = [("name_team", one("team")), ("name_only", one("name")), ("token_overlap", one("first")), ("token_set_swap", one("same"))]
    if league:
        tiers.append(("league_token", F.when(F.col("strong_fits").isNotNull(), fit("strong")).otherwise(fit("weak"))))
    found = judged.select(F.col("sid").alias("_sid"), F.coalesce(*[card for _, card in tiers]).alias("card"), F.coalesce(*[F.when(card.isNotNull(), n) for n, card in tiers]).alias("match_source"))
    return spine.join(found.where("card IS NOT NULL"), F.col("sid") == F.col("_sid"), "left").drop("_sid")


def labelled_match(spine: DataFrame, cards: DataFrame, aliases: Mapping[str, str], free_agents: str, agrees: Column) -> DataFrame:
    """Exact, alias and hyphen tiers within the team, then a free agent of that name alone if ``agrees``; every miss says why.

    ``agrees`` is a condition on columns of both sides (cards prefixed ``c_``).
    """
    s = spine.select("*", tx.roster_key(F.col("name")).alias("key"), tx.roster_key(tx.hyphen_head(F.col("name"))).alias("head"))
    s = s.withColumn("alias", tx.mapped(F.col("key"), aliases)).withColumn("head", F.nullif("head", F.lit("")))
    c = cards.select(*[F.col(x).alias(f"c_{x}") for x in cards.columns], tx.roster_key(F.col("name")).alias("c_key"), F.nullif(tx.roster_key(tx.hyphen_head(F.col("name"))), F.lit("")).alias("c_head"))
    reach = c.select("*", F.explode(F.array_compact(F.array("c_key", "c_head"))).alias("reach"))
    tries = s.select("*", F.explode(F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.struct(F.lit(i).alias("i"), F.lit(n).alias("n"), F.col(k).alias("k"))) for i, (n, k) in enumerate((("exact", "key"), ("alias", "alias"), ("hyphen", "head")))]))).alias("t"))
    hits = tries.join(reach.hint("merge"), F.col("t.k") == F.col("reach"))
    own = hits.where(F.col("team") == F.col("c_team")).groupBy("sid", "t.i", "t.n").agg(F.min("c_card").alias("card"), F.max("c_card").alias("most"))
    best = own.groupBy("sid").agg(F.min(F.when(F.col("card") == F.col("most"), F.struct("i", "n", "card"))).alias("best"), F.max((F.col("card") != F.col("most")).cast("int")).alias("ambiguous"))
    named = hits.where(F.col("t.n") != "hyphen").groupBy("sid").agg(
        F.min("c_card").alias("n_card"), F.max("c_card").alias("n_most"), F.min(F.when((F.col("c_team") == free_agents) & agrees, F.col("c_card"))).alias("fa")
    )
    joined = spine.join(best, "sid", "left").join(named, "sid", "left")
    free = (F.col("n_card") == F.col("n_most")) & F.col("fa").isNotNull()
    card = F.when(F.col("best").isNotNull(), F.col("best.card")).when(F.coalesce("ambiguous", F.lit(0)) == 1, F.lit(None)).when(free, F.col("fa"))
    source = (
        F.when(F.col("best").isNotNull(), F.col("best.n"))
        .when(F.coalesce("ambiguous", F.lit(0)) == 1, "unmatched_ambiguous")
        .when(free, "fa_name_only")
        .when(F.col("n_card").isNotNull(), "unmatched_other_team")
        .otherwise("unmatched_no_name")
    )
    return joined.select(*[spine[x] for x in spine.columns], card.alias("card"), source.alias("match_source"))


def any_key_match(spine: DataFrame, cards: DataFrame, aliases: Mapping[str, str], carried: DataFrame | None = None) -> DataFrame:
    """Own name, alias and inverse alias looked up together: one id within the team, else one id by name.

    ``carried`` (sid, card) is an earlier crosswalk that goes first.
    """
    inverse = {v: k for k, v in aliases.items()}
    names = F.array_compact(F.array(F.col("name"), tx.mapped(F.col("name"), aliases), tx.mapped(F.col("name"), inverse)))
    s = spine.select("sid", "team", F.explode(F.array_distinct(F.transform(names, lambda n: tx.match_key(n, True)))).alias("key")).where("key <> ''")
    c = cards.select("card", F.col("team").alias("c_team"), tx.match_key(F.col("name"), True).alias("key"))
    hits = s.join(c, "key")
    tiers = [("name_team", _only(hits.where(F.col("team") == F.col("c_team")))), ("name_only", _only(hits))]
    return _coalesced(spine, [*([("carried", carried)] if carried is not None else []), *tiers])


def initial_tier(spine: DataFrame, cards: DataFrame, within: Sequence[str]) -> DataFrame:
    """Exact key, then first initial and last name, unique within the given columns.

    A card whose source has a short name beside the display name is listed under both.
    """
    s = spine.select("sid", *within, tx.match_key(tx.display_name(F.col("name"))).alias("key"), tx.initial_last(F.col("name")).alias("ini"))
    c = cards.select("card", *within, tx.match_key(tx.display_name(F.col("name"))).alias("key"), tx.initial_last(F.col("name")).alias("ini"))
    exact = _only(s.where("key <> ''").join(c.drop("ini"), [*within, "key"]).select("sid", "card"))
    near = _only(s.where("ini IS NOT NULL").drop("key").join(c.drop("key"), [*within, "ini"]).select("sid", "card"))
    return _coalesced(spine, [("name", exact), ("initial", near)])


def school_cards(spine: DataFrame, cards: DataFrame, compatible: Column) -> DataFrame:
    """Name and school (position decides among several), the same words at the school, initial and last name at the school.

    ``team`` holds the school's key on both sides; ``compatible`` is a condition on grp and c_position.
    """
    s = spine.select("sid", "team", "grp", tx.spaced_key(F.col("name")).alias("key"))
    s = s.withColumn("words", F.array_sort(F.array_distinct(F.split("key", " ")))).withColumn("last", F.element_at(F.split("key", " "), -1))
    c = cards.select("card", F.col("team").alias("team"), F.col("position").alias("c_position"), tx.spaced_key(F.col("name")).alias("c_key"))
    c = c.withColumn("c_words", F.array_sort(F.array_distinct(F.split("c_key", " ")))).withColumn("c_last", F.element_at(F.split("c_key", " "), -1))
    # all three tiers agree in the school and in a word of the name: that word is the join key, not the school alone
    worded = s.withColumn("word", F.explode("words")).join(c.withColumn("word", F.explode("c_words")).hint("merge"), ["team", "word"])
    pairs = worded.drop("word").dropDuplicates(["sid", "card", "c_key", "c_position"])
    exact = pairs.where(F.col("key") == F.col("c_key")).withColumn("_fits", compatible)
    some_fit = exact.groupBy("sid").agg(F.max(F.col("_fits").cast("int")).alias("_any"), F.count_distinct("card").alias("_n"))
    exact = _only(exact.join(some_fit, "sid").where((F.col("_n") == 1) | (F.col("_any") == 0) | F.col("_fits")).select("sid", "card"))
    same = _only(pairs.where(F.col("words") == F.col("c_words")).select("sid", "card"))
    initial = (F.col("last") == F.col("c_last")) & (F.substring("key", 1, 1) == F.substring("c_key", 1, 1)) & F.col("key").contains(" ") & F.col("c_key").contains(" ")
    near = _only(pairs.where(initial & compatible).select("sid", "card"))
    return _coalesced(spine, [("exact", exact), ("token_set", same), ("initial_lastname", near)])


def claim_by_name(listed: DataFrame, prospects: DataFrame) -> DataFrame:
    """(place, card): entries of a ranked list that claim a prospect whose name only they can mean; the first claim wins."""
    e = listed.select("place", tx.spaced_key(F.col("name")).alias("key"), "grp")
    p = prospects.select("card", tx.spaced_key(F.col("name")).alias("key"), F.col("grp").alias("p_grp"))
    hits = e.join(p, "key").withColumn("_fits", F.coalesce(F.col("grp") == F.col("p_grp"), F.lit(False)))
    fits = hits.groupBy("place").agg(F.max(F.col("_fits").cast("int")).alias("_any"), F.count_distinct("card").alias("_n"))
    kept = hits.join(fits, "place").where((F.col("_n") == 1) | (F.col("_any") == 0) | F.col("_fits"))
    single = kept.groupBy("place").agg(F.min("card").alias("card"), F.max("card").alias("_m")).where(F.col("card") == F.col("_m")).drop("_m")
    return first_claims(single, ["card"], "place", ["place"])


def crosswalk_then_name(spine: DataFrame, ids: DataFrame, cards: DataFrame) -> DataFrame:
    """An id crosswalk (sid, card) first, whether or not a card has the id, then name and team if unique.

    Of several ids of a spine row the last one listed counts, where ``ids`` has ``ord``, else the smallest.
    """
    both = F.when(F.col("team").isNotNull(), F.struct(tx.review_key(F.col("name")).alias("k"), "team"))
    named = resolve_tiers(spine, cards, "card", [Tier("name_team", both, both)], "card", "_source").where("card IS NOT NULL").select("sid", "card")
    chosen = F.max_by("card", F.struct("ord", "card")) if "ord" in ids.columns else F.min("card")
    known = ids.where("card IS NOT NULL").groupBy("sid").agg(chosen.alias("card"))
    return _coalesced(spine, [("crosswalk", known), ("name_team", named)])


def find_ids(
    spine: DataFrame, sources: Sequence[tuple[str, DataFrame]], aliases: Mapping[str, str | None] | None = None,
    without: Sequence[str] = (), retry: Mapping[str, str] | None = None, strict: float = 95.0, loose: float = 80.0,
) -> DataFrame:
    """The most similar card of the row's position, source after source.

    Sources (label, cards) have (card, name, team, position), a position being
    the spine's; from ``strict`` on any team counts, from ``loose`` on the own
    one. Rows of a position in ``without`` and names with a null alias are never
    looked up. A row that no source has under its position is looked up once
    more under the position that ``retry`` gives it.
    """
    lookup = tx.mapped(F.col("name"), aliases or {}, default=F.col("name"))
    s = spine.withColumn("key", tx.spaced_key(lookup)).where(lookup.isNotNull() & ~F.coalesce(F.col("grp").isin(*without), F.lit(False)))
    s = s.select("sid", "team", "grp", "key").where("key <> ''")
    tried = [("", s)]
    if retry:
        tried.append(("_retry", s.withColumn("grp", tx.mapped(F.col("grp"), retry)).where("grp IS NOT NULL")))
    listed = [(label, cut_lineage(cards.select("card", "team", F.col("position").alias("grp"), tx.spaced_key(F.col("name")).alias("key")).where("key <> ''").distinct())) for label, cards in sources]
    tiers: list[tuple[str, DataFrame]] = []
    for suffix, rows in tried:
        for label, c in listed:
            for _, earlier in tiers:  # a row that has a card is looked up no more
                rows = rows.join(earlier.select("sid"), "sid", "left_anti")
            found = fuzzy_in_block(rows, "sid", "key", c, "card", "key", "grp", "team", strict, loose)
            tiers.append((label + suffix, cut_lineage(found.where("card IS NOT NULL").select("sid", "card"))))
    return _coalesced(spine, tiers)


def legacy_match(spine: DataFrame, cards: DataFrame, low: float = 95.0) -> DataFrame:
    """(sid, card, score, low_confidence): a name that one card has (100), else the best ratio from 90 on, else the best of the team from 80 on.

    Of cards of one name the last one in order counts; names are compared in one block.
    """
    whole = F.lit("all")
    s = spine.select("sid", "team", whole.alias("b"), tx.spaced_key(F.col("name")).alias("key")).where("key <> ''")
    named = cards.select("card", "team", "ord", tx.spaced_key(F.col("name")).alias("key")).where("key <> ''")
    last = named.groupBy("key", "team").agg(F.max_by("card", F.struct("ord", "card")).alias("card"))
    single = named.groupBy("key").agg(F.min("card").alias("card"), F.max("card").alias("_most")).where(F.col("card") == F.col("_most"))
    exact = s.join(single, "key").select("sid", "card", F.lit(100.0).alias("score"))
    missed = s.join(single.select("key"), "key", "left_anti")
    fuzzy = similar_any_or_own(missed.select(F.col("sid").alias("s"), "b", F.col("key").alias("x"), F.col("team").alias("t")), last.select(F.col("card").alias("c"), whole.alias("b"), F.col("key").alias("y"), F.col("team").alias("t")), 90.0, 80.0)
    first = exact.unionByName(fuzzy.select(F.col("s").alias("sid"), F.col("c").alias("card"), "score")).groupBy("sid").agg(F.first(F.struct("card", "score")).alias("f"))
    joined = spine.select("sid").join(first, "sid", "left")
    return joined.select("sid", F.col("f.card").alias("card"), F.col("f.score").alias("score"), F.coalesce(F.col("f.score") < low, F.lit(False)).alias("low_confidence"))


def draft_picks(entries: DataFrame, picks: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Entries (sid, name, year, round) with the pick of their name in that year and round.

    Alias, own name, then first initial and last name; a way counts only if it leads to one distinct pick.
    ``picks`` has (pick, name, year, round).
    """
    on = ["year", "round"]
    s = entries.where("year IS NOT NULL AND round IS NOT NULL").select("sid", *on, tx.match_key(tx.mapped(F.col("name"), aliases or {})).alias("alias"), tx.match_key(F.col("name")).alias("key"), tx.initial_last(F.col("name")).alias("ini"))
    p = picks.select(F.col("pick").alias("card"), *on, tx.match_key(F.col("name")).alias("key"), tx.initial_last(F.col("name")).alias("ini"))
    by_alias = _only(s.where("alias <> ''").select("sid", *on, F.col("alias").alias("key")).join(p, [*on, "key"]).select("sid", "card"))
    by_name = _only(s.where("key <> ''").select("sid", *on, "key").join(p, [*on, "key"]).select("sid", "card"))
    by_initial = _only(s.where("ini IS NOT NULL").select("sid", *on, "ini").join(p, [*on, "ini"]).select("sid", "card"))
    return _coalesced(entries, [("alias", by_alias), ("name", by_name), ("initial", by_initial)], "pick")


def id_then_similar(spine: DataFrame, cards: DataFrame, strict: float = 95.0, loose: float = 80.0) -> DataFrame:
    """The card with the row's ``id``, else the one of the most similar name of the row's position.

    The spine has ``id`` beside (sid, name, team, grp), cards have ``id`` beside
    (card, name, team, position); null ids match nothing. Of cards of one id the last in order counts.
    """
    last = cards.where("id IS NOT NULL").groupBy("id").agg(F.max_by("card", F.struct("ord", "card")).alias("card"))
    known = spine.where("id IS NOT NULL").select("sid", "id").join(last, "id").select("sid", "card")
    missed = spine.join(known.select("sid"), "sid", "left_anti")
    similar = find_ids(missed.select("sid", "name", "team", "grp"), [("similar", cards)], strict=strict, loose=loose).where("card IS NOT NULL").select("sid", "card")
    return _coalesced(spine, [("id", known), ("similar", similar)])
