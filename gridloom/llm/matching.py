"""Matching the match rows without an id to the roster source, which shares no key with them.

1. Both sides become records: one per entity (player key, roster id) and name key.
2. Sorted neighbourhood over composite sort keys of measures and of names;
   records of different sides within a window, or with an equal leading part of
   the key, are compared with weighted field similarities. A contradiction in a
   measure costs more than any agreement of names can win, so namesakes and
   relatives fall below the threshold.
3. Keys of the match rows that share their best id and contradict each other in
   no measure are one player under several keys: they are merged.
4. One-to-one assignment between players and ids, maximising the total score.
   All rows of a merged player get its id.

Defined results
---------------
* Fields that are null, or stand for "not known", on one side weigh nothing.
* Rows without a name have no records and no match; a row without a key is an entity of its own.
* Of equal assignments the one with the smaller entity hashes is kept.
* ``match_confidence`` is between 0 and 100.
* Empty tables on either side give no matches; other columns take no part.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm import names as nm
from gridloom.llm.assignment import assign
from gridloom.llm.neighbourhood import Screen, sorted_neighbourhood
from gridloom.llm.people import entity_of, hashed, inches
from gridloom.llm.survivors import UNKNOWN
from gridloom.llm.variants import NAME_WORTH, name_worth, with_name_key
from gridloom.session import cut_lineage

#: Roster positions that each position of the match rows may appear as.
POSITIONS = {
    "QB": "QB", "RB": "RB HB FB", "WR": "WR", "TE": "TE", "OL": "OL OT T G C", "DI": "DT NT DL", "EDGE": "DE EDGE OLB",
    "LB": "LB ILB MLB OLB", "CB": "CB DB", "S": "S SS FS DB", "DEF": "DL DT NT DE EDGE OLB LB ILB MLB CB DB S SS FS",
}
#: Worth of agreement and cost of contradiction, by field.
WORTH = {"jersey": (4.0, -8.0), "height": (2.0, -6.0), "weight": (3.0, -6.0), "age": (1.0, -5.0), "position": (1.5, -3.0), "college": (2.5, -1.5), "team": (1.0, 0.0)}
#: Pounds within which weights agree, years within which ages do.
WEIGHT_NEAR, AGE_NEAR = 6, 1
THRESHOLD = 9.0
#: Worth of all other fields from which one token of the names may differ altogether.
OTHER_EVIDENCE = 11.0
#: Score at which ``match_confidence`` is 100.
FULL_SCORE = 21.0
#: Records after each that are compared with it besides those of an equal leading part.
WINDOW = 20


def known_text(c: Column) -> Column:
    """The text, or null where it stands for "not known"."""
    text = F.lower(F.trim(c))
    return F.when(text.rlike(r"[\p{L}\p{N}]") & ~text.isin(*UNKNOWN), c)


def college_key(college: Column) -> Column:
    """College without case, accents' marks, and the words that sources add or shorten."""
    text = F.lower(F.trim(college))
    text = F.regexp_replace(text, r"\ba\s*(&|and)\s*m\b", "am")
    text = F.regexp_replace(text, r"\b(university|univ|u|of|the)\b\.?", " ")
    text = F.regexp_replace(text, r"\bst\b\.?\s*$", "state")
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))


def match_records(matches: DataFrame) -> DataFrame:
    """Records of match rows: side 0, entity from the player key."""
    rows = with_name_key(
        matches.select(
            entity_of("player_key", "row_id").alias("entity"), F.col("canonical_name").alias("name"),
            F.coalesce("jersey", "madden_jersey").alias("jersey"), inches(F.col("height")).alias("height"), "weight", "age",
            F.col("standard_pos").alias("position"), college_key(known_text(F.col("college"))).alias("college"), known_text(F.col("team")).alias("team"),
        ),
        "name",
    )
    return _records(rows.withColumn("age_low", F.col("age")).withColumn("age_high", F.col("age")), 0)


def roster_records(rosters: DataFrame, year: int) -> DataFrame:
    """Records of roster rows: side 1, entity from the id; ages as of ``year``."""
    rows = with_name_key(
        rosters.where(F.col("gsis_id").isNotNull()).select(
            hashed("gsis_id").alias("entity"), F.col("full_name").alias("name"), F.col("jersey_number").alias("jersey"), "height", "weight",
            (F.lit(year) - F.year("birth_date")).alias("age"), "position",
            college_key(known_text(F.col("college"))).alias("college"), known_text(F.col("team")).alias("team"),
        ),
        "name",
    )
    return _records(rows.withColumn("age_low", F.col("age")).withColumn("age_high", F.col("age")), 1)


def _records(rows: DataFrame, side: int) -> DataFrame:
    """One record per entity and name key with what all rows of the entity say."""
    said = rows.groupBy("entity").agg(
        F.max("jersey").cast("int").alias("jersey"),
        F.max("height").cast("int").alias("height"),
        F.min("weight").cast("int").alias("weight_low"),
        F.max("weight").cast("int").alias("weight_high"),
        F.min("age_low").cast("int").alias("age_low"),
        F.max("age_high").cast("int").alias("age_high"),
        F.concat_ws("|", F.sort_array(F.collect_set("position"))).alias("positions"),
        F.concat_ws("|", F.sort_array(F.collect_set(F.when(F.col("college") != "", F.col("college"))))).alias("colleges"),
        F.concat_ws("|", F.sort_array(F.collect_set("team"))).alias("teams"),
    )
    named = rows.where(F.col("name_key").isNotNull()).select("entity", "name_key").distinct()
    return named.join(said.hint("merge"), "entity").withColumn("side", F.lit(side))


def with_key_token(records: DataFrame) -> DataFrame:
    """``records`` with ``token``, the rarest token of the name over all records (usually the family name), and ``rest``, the others."""
    tokens = records.select("entity", "name_key", F.explode(F.split("name_key", " ")).alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.max_by("token", F.struct(-F.col("n"), F.length("token"), "token"))
    chosen = tokens.join(counts.hint("merge"), "token").groupBy("entity", "name_key").agg(rarest.alias("token"))
    rest = F.array_join(F.array_sort(F.array_except(F.split("name_key", " "), F.array("token"))), " ")
    return records.join(chosen.hint("merge"), ["entity", "name_key"]).withColumn("rest", rest)


def sort_keys() -> Column:
    """The composite sort keys, one per pass, with their leading parts; a pass whose parts are unknown is skipped."""
    number = lambda c: F.lpad(c.cast("string"), 3, "0")
    jersey, height = number(F.col("jersey")), number(F.col("height"))
    weight, age = number(((F.col("weight_low") + F.col("weight_high")) / 2).cast("int")), number(F.col("age_low"))
    known = lambda c: F.coalesce(c, F.lit(""))
    token, rest, letter = F.col("token"), F.col("rest"), F.substring("token", 1, 1)
    keys = [
        (F.concat(jersey, height, letter), F.concat(known(weight), token)),
        (F.concat(jersey, weight), F.concat(known(age), token)),
        (F.concat(jersey, age, letter), token),
        (F.concat(jersey, F.substring(token, -4, 4)), token),
        (F.concat(height, weight, letter), F.concat(known(age), token)),
        (F.concat(height, age, letter), F.concat(known(weight), token)),
        (token, F.concat(rest, known(height), known(weight))),
        (F.concat(F.reverse(token), F.lit(" "), F.substring(rest, 1, 1)), F.concat(rest, known(height))),
    ]
    passes = F.array(*[F.struct(F.lit(i).alias("p"), lead.alias("lead"), k.alias("k")) for i, (lead, k) in enumerate(keys)])
    # every token of some length beside a measure: a slip in one token leaves the others
    words = F.filter(F.split("name_key", " "), lambda w: F.length(w) > 2)
    beside = lambda p, measure: F.transform(words, lambda w: F.struct(F.lit(p).alias("p"), F.concat(w, F.lit(" "), measure).alias("lead"), known(weight).alias("k")))
    # and beside the initial of each other token, where no measure is known on both sides
    initial = lambda w: F.transform(F.filter(F.split("name_key", " "), lambda o: o != w), lambda o: F.struct(F.lit(len(keys) + 2).alias("p"), F.concat(w, F.lit(" "), F.substring(o, 1, 1)).alias("lead"), known(weight).alias("k")))
    return F.concat(passes, beside(len(keys), height), beside(len(keys) + 1, age), F.flatten(F.transform(words, initial)))


def _college_worth(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    for x, y in itertools.product(a.split("|"), b.split("|")):
        if x == y or min(len(x), len(y)) >= 5 and nm.edit_distance(x, y) <= 2:
            return WORTH["college"][0]
    return WORTH["college"][1]


def _position_worth(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    wanted = {p for x in a.split("|") for p in POSITIONS.get(x, x).split()}
    return WORTH["position"][0 if wanted & set(b.split("|")) else 1]


def _codes(values: np.ndarray) -> tuple[np.ndarray, list]:
    """Small numbers for values, and the values by number."""
    codes, distinct = pd.factorize(pd.Series(values, dtype="object"), use_na_sentinel=False)
    return codes, list(distinct)


def _looked_up(a: np.ndarray, b: np.ndarray, judge) -> np.ndarray:
    """``judge`` of two codes, once per distinct pair."""
    joint = a.astype("int64") << 32 | b
    distinct, place = np.unique(joint, return_inverse=True)
    return np.array([judge(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in distinct], dtype="float64")[place]


def _screen(rows: pd.DataFrame) -> Screen:
    """Lets all pairs pass whose measures leave the threshold within reach of the other fields.

    It sees every pair, so it counts in halves in the smallest integers, rounded in favour of the pair.
    """

    def measure(*columns: str) -> tuple[np.ndarray, ...]:
        values = [rows[c].to_numpy(dtype="float64", na_value=np.nan) for c in columns]
        known = ~np.isnan(values).any(axis=0)
        return known.astype("int8"), *(np.clip(np.where(known, v, 0), -9999, 9999).astype("int16") for v in values)

    jersey, height = measure("jersey"), measure("height")
    weight, age = measure("weight_low", "weight_high"), measure("age_low", "age_high")
    least = math.floor(2 * (THRESHOLD - sum(most for _, most, _ in _FURTHER)))
    counted = {f: (np.int8(math.ceil(2 * won) - math.ceil(2 * lost)), np.int8(math.ceil(2 * lost))) for f, (won, lost) in WORTH.items()}

    def worth(field: str, same: np.ndarray, known: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        step, lost = counted[field]
        total = same.view("int8") * step
        total += lost
        total *= known[x]
        total *= known[y]
        return total

    def hopeful(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        total = worth("jersey", jersey[1][x] == jersey[1][y], jersey[0], x, y)
        total += worth("height", height[1][x] == height[1][y], height[0], x, y)
        for field, (known, low, high), near in (("weight", weight, WEIGHT_NEAR), ("age", age, AGE_NEAR)):
            close = low[x] <= high[y] + np.int16(near)
            close &= low[y] <= high[x] + np.int16(near)
            total += worth(field, close, known, x, y)
        return total >= least

    return hopeful


def _compare(rows: pd.DataFrame, x: np.ndarray, y: np.ndarray) -> pd.DataFrame:
    """Scores of the pairs of rows that reach the threshold; of two rows one is of side 0 and one of side 1."""
    empty = pd.DataFrame({"l": np.zeros(0, "int64"), "r": np.zeros(0, "int64"), "score": np.zeros(0)})
    if not len(x):
        return empty
    number = lambda c: rows[c].to_numpy(dtype="float64", na_value=np.nan)
    left = rows["side"].to_numpy()[x] == 0
    i, j = np.where(left, x, y), np.where(left, y, x)

    def worth(field: str, same: np.ndarray, missing: np.ndarray) -> np.ndarray:
        return np.where(missing, 0.0, np.where(same, *WORTH[field]))

    jersey, height = number("jersey"), number("height")
    light, heavy, young, old = number("weight_low"), number("weight_high"), number("age_low"), number("age_high")
    total = worth("jersey", jersey[i] == jersey[j], np.isnan(jersey[i]) | np.isnan(jersey[j]))
    total += worth("height", height[i] == height[j], np.isnan(height[i]) | np.isnan(height[j]))
    apart = np.maximum(light[i] - heavy[j], light[j] - heavy[i])
    total += worth("weight", apart <= WEIGHT_NEAR, np.isnan(apart))
    years = np.maximum(young[i] - old[j], young[j] - old[i])
    total += worth("age", years <= AGE_NEAR, np.isnan(years))
    # each further field is judged once per distinct pair of values, and only where the rest can still reach the threshold
    left_to_win = sum(most for _, most, _ in _FURTHER)
    for field, most, judge in _FURTHER:
        hopeful = total + left_to_win >= THRESHOLD
        left_to_win -= most
        i, j, total = i[hopeful], j[hopeful], total[hopeful]
        if field == "colleges" and len(i):  # takes longer than a look at the names
            used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
            hopeful = _name_screen(rows["name_key"].to_numpy()[used])(place[: len(i)], place[len(i) :], total + most >= OTHER_EVIDENCE)
            i, j, total = i[hopeful], j[hopeful], total[hopeful]
        if not len(i):
            return empty
        codes, values = _codes(rows[field].to_numpy())
        added = _looked_up(codes[i], codes[j], lambda a, b: judge(values[a], values[b]))  # noqa: B023
        if field == "name_key":
            again = np.isinf(added) & (total >= OTHER_EVIDENCE)
            if again.any():
                added[again] = _looked_up(codes[i[again]], codes[j[again]], lambda a, b: _name_worth(1)(values[a], values[b]))  # noqa: B023
        total = total + added
    good = total >= THRESHOLD
    entity = rows["entity"].to_numpy()
    return pd.DataFrame({"l": entity[i[good]], "r": entity[j[good]], "score": total[good]}).groupby(["l", "r"], as_index=False)["score"].max()


#: Caches of a process; what they forget is computed again.
_TOKENS: dict[str, tuple[tuple[str, ...], str]] = {}
_LETTERS: dict[str, tuple[int, ...]] = {}
_TOLD: dict[str, tuple[tuple[int, ...], ...]] = {}
_MOST_CACHED = 100_000
#: Tokens of a name that ``_name_screen`` takes in, and pairs that it takes at once.
_SCREENED_TOKENS, _SCREENED_PAIRS = 3, 20_000


def _tokens(name: str) -> tuple[tuple[str, ...], str]:
    if name not in _TOKENS:
        if len(_TOKENS) > _MOST_CACHED:
            _TOKENS.clear()
        words = name.split()
        plain = name.isascii() and name.islower() and all(map(str.isalpha, words)) and nm.PARTICLES.isdisjoint(words) and nm.SUFFIXES.keys().isdisjoint(words)
        _TOKENS[name] = (tuple(words), "") if plain else nm.tokens(name)
    return _TOKENS[name]


def _bits(text: str | list[str], size: int = 63) -> int:
    found = 0
    for c in text:
        found |= 1 << (ord(c) & size)
    return found


def _letters(token: str) -> tuple[int, ...]:
    """Length of a token and, as bits: its letters, those of its sound, those of the names that it is short for, its first and last letter, its initials."""
    if token not in _LETTERS:
        if len(_LETTERS) > _MOST_CACHED:
            _LETTERS.clear()
        full, short = nm.FULL_NAMES.get(token, ()), nm.NICKNAMES.get(token, "").split()
        ends = _bits(token[:1], 31) | _bits(token[-1:], 31) << 32
        initials = _bits([t[0] for t in (token, *full, *short) if t])
        _LETTERS[token] = (min(len(token), 99), _bits(token), _bits(nm.sound(token)), _bits("".join(full)), ends, initials)
    return _LETTERS[token]


def _told(name: str) -> tuple[tuple[int, ...], ...]:
    """``_letters`` of the tokens of a name, at fixed places; of none for a name of more tokens."""
    if name not in _TOLD:
        if len(_TOLD) > _MOST_CACHED:
            _TOLD.clear()
        core, most = _tokens(name)[0], _SCREENED_TOKENS
        _TOLD[name] = tuple(map(_letters, [*core, *[""] * (most - len(core))] if len(core) <= most else [""] * most))
    return _TOLD[name]


def _may_agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """False only for tokens that ``names.token_kind`` calls nothing; the last axis is that of ``_letters``.

    An edit takes one letter out of a token at most, and puts one into it; a short form has no letter, or after a slip one, that the
    token or the token's full names lack.
    """
    (length, plain, heard, full, ends, initials), (length_, plain_, heard_, full_, ends_, initials_) = np.moveaxis(a, -1, 0), np.moveaxis(b, -1, 0)
    more, more_ = np.bitwise_count(plain & ~plain_), np.bitwise_count(plain_ & ~plain)
    least, most = np.minimum(length, length_), np.maximum(length, length_)
    edited = (most - least <= 2) & (np.maximum(more, more_) <= np.where(least >= 6, 2, 1))
    sounds = (least >= 5) & (np.bitwise_count(heard & ~heard_) <= 1) & (np.bitwise_count(heard_ & ~heard) <= 1)
    lacks = np.where(length < length_, more, more_)
    short = (least < most) & ((lacks == 0) & (ends & ends_ != 0) | (lacks <= 1) & (least <= 4) & (most > 4))
    named = (full != 0) & (np.bitwise_count(plain_ & ~full) <= 1) | (full_ != 0) & (np.bitwise_count(plain & ~full_) <= 1)
    initial = (most <= 3) | (initials & initials_ != 0)
    return (least > 0) & np.where(least <= 2, initial, edited | sounds | short | named)


def _name_screen(names: np.ndarray):
    """Drops pairs of places of names that ``name_worth`` refuses, as far as the letters of their tokens tell.

    Every token of weight needs a partner, where ``strong`` is set one of all does. Of two names of two tokens of weight both are paired;
    else neighbouring tokens may be written together as well.
    """
    codes, distinct = _codes(names)
    told = np.array([_told(n) for n in distinct], dtype="uint64")
    written = np.zeros((len(told), _SCREENED_TOKENS - 1, 6), dtype="uint64")  # of neighbouring tokens as one
    tokens, sizes = slice(0, _SCREENED_TOKENS), told[:, :, 0]
    two, screened = (sizes[:, 1] > 0) & (sizes[:, 2] == 0) & (sizes[:, :2] > 1).all(axis=1), sizes[:, 0] > 0

    def covered(may: np.ndarray, size: np.ndarray) -> np.ndarray:
        own = may[:, tokens].any(axis=2)
        joined = may[:, _SCREENED_TOKENS :, tokens].any(axis=2)
        own[:, :-1] |= joined
        own[:, 1:] |= joined
        return (own | (size <= 1)).all(axis=1)

    def some(i: np.ndarray, j: np.ndarray, strong: np.ndarray) -> np.ndarray:
        ok = np.ones(len(i), dtype=bool)
        both = two[i] & two[j]
        may = _may_agree(told[i[both], :2][:, :, None], told[j[both], :2][:, None])
        ok[both] = may[:, 0, 0] & may[:, 1, 1] | may[:, 0, 1] & may[:, 1, 0] | strong[both] & may.any(axis=(1, 2))
        rest = ~both & screened[i] & screened[j]
        a, b = (np.concatenate([told[k[rest]], written[k[rest]]], axis=1) for k in (i, j))
        may = _may_agree(a[:, :, None], b[:, None])
        ok[rest] = covered(may, sizes[i[rest]]) & covered(may.swapaxes(1, 2), sizes[j[rest]]) | strong[rest] & may.any(axis=(1, 2))
        return ok

    def hopeful(i: np.ndarray, j: np.ndarray, strong: np.ndarray) -> np.ndarray:
        i, j = codes[i], codes[j]
        rest = ~(two[i] & two[j])
        for k in np.unique(np.concatenate([i[rest], j[rest]])):
            core = _tokens(distinct[k])[0] if screened[k] else ()
            for t, pair in enumerate(itertools.pairwise(core)):
                written[k, t] = _letters("".join(pair))
        parts = [slice(at, at + _SCREENED_PAIRS) for at in range(0, len(i), _SCREENED_PAIRS)]
        return np.concatenate([some(i[p], j[p], strong[p]) for p in parts]) if parts else np.zeros(0, dtype=bool)

    return hopeful


def _name_worth(others: int):
    def judge(a: str, b: str) -> float:
        found = name_worth(_tokens(a), _tokens(b), others)
        return -np.inf if found is None else found

    return judge


def _team_worth(a: str, b: str) -> float:
    return WORTH["team"][0 if set(a.split("|")) & set(b.split("|")) - {""} else 1]


#: Fields judged by distinct values, with the most that each can add.
_FURTHER = (
    ("positions", WORTH["position"][0], _position_worth), ("teams", WORTH["team"][0], _team_worth),
    ("colleges", WORTH["college"][0], _college_worth), ("name_key", NAME_WORTH, _name_worth(0)),
)


def scored_pairs(records: DataFrame, window: int = WINDOW) -> DataFrame:
    """(l, r, score): entity of the match rows, entity of the roster, best total weight of their records."""
    keyed = cut_lineage(with_key_token(records)).withColumn("passes", sort_keys()).drop("token", "rest")
    scored = sorted_neighbourhood(keyed, "passes", _compare, "l long, r long, score double", window, "entity", _screen)
    return scored.groupBy("l", "r").agg(F.max("score").alias("score"))


def merged_players(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """(l, unit): match entities, and the player each belongs to (the entity itself unless it is merged).

    An entity joins the one that scores highest with the same best id, unless a measure contradicts.
    """
    measures = ["jersey", "height", "weight_low", "positions"]
    said = records.where("side = 0").select("entity", *measures).dropDuplicates(["entity"])
    best = pairs.groupBy("l").agg(F.max_by(F.struct("r", "score"), F.struct("score", (-F.col("r")).alias("m"))).alias("b")).select("l", "b.r", "b.score")
    best = cut_lineage(best.join(said.hint("merge"), F.col("l") == F.col("entity")).drop("entity"))
    head = best.groupBy("r").agg(F.max_by(F.struct("l", *measures), F.struct("score", (-F.col("l")).alias("m"))).alias("h"))
    joined = best.join(head.hint("merge"), "r")
    same = F.lit(True)
    for m in measures:
        same = same & F.coalesce(F.col(m) == F.col(f"h.{m}"), F.lit(True))
    return joined.select("l", F.when(same, F.col("h.l")).otherwise(F.col("l")).alias("unit"))


def matched_entities(records: DataFrame, window: int = WINDOW) -> DataFrame:
    """(l, r, score): entity of the match rows, its roster entity, and the score of its player with it."""
    pairs = cut_lineage(scored_pairs(records, window))
    units = cut_lineage(merged_players(pairs, records))
    of_units = pairs.join(units.hint("merge"), "l").groupBy("unit", "r").agg(F.max("score").alias("score"))
    chosen = assign(of_units.select(F.col("unit").alias("l"), "r", "score"))
    return units.join(chosen.withColumnRenamed("l", "unit").hint("merge"), "unit").select("l", "r", "score")


def roster_year(rosters: DataFrame) -> int:
    """The latest season of the roster source: ages are taken in it."""
    return int(rosters.agg(F.max("season")).first()[0] or 0)


def match_rosters(matches: DataFrame, rosters: DataFrame) -> DataFrame:
    """(row_id, gsis_id, match_confidence): the rows of ``matches`` whose player the rosters hold."""
    records = cut_lineage(match_records(matches).unionByName(roster_records(rosters, roster_year(rosters))))
    found = matched_entities(records)
    confidence = F.round(F.least(F.lit(100.0), F.col("score") / FULL_SCORE * 100), 1)
    rows = matches.select("row_id", entity_of("player_key", "row_id").alias("entity"))
    ids = rosters.where(F.col("gsis_id").isNotNull()).select("gsis_id", hashed("gsis_id").alias("id_entity")).distinct()
    return (
        rows.join(found.hint("merge"), F.col("entity") == F.col("l"))
        .join(ids.hint("merge"), F.col("r") == F.col("id_entity"))
        .select("row_id", "gsis_id", confidence.alias("match_confidence"))
        .distinct()
    )
