"""Queries of the named resolvers, slot owners, nested statistics and the league master."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions import dates as dt
from gridloom.functions import metrics as mx
from gridloom.functions import parse as ps
from gridloom.functions import text as tx
from gridloom.operators import leagues as lg
from gridloom.operators import relational as rel
from gridloom.operators import standings as st
from gridloom.operators.resolve import Tier, resolve_tiers
from gridloom.plans.column_queries import _SET, _SP, _STANDARD_SQL, STANDARD, similar_sql
from gridloom.session import load
from gridloom.sources import sinks

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query with the SQL it is compared with."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


def _spine(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "player_match").select(F.col("row_id").alias("sid"), F.col("canonical_name").alias("name"), "team", F.col("standard_pos").alias("grp"))


def _cards(spark: SparkSession, d: str) -> DataFrame:
    number = F.substring("gsis_id", 4, 8).cast("long")
    return load(spark, d, "nflreadpy_rosters").select(number.alias("card"), F.col("full_name").alias("name"), "team", "position", F.col("season").alias("ord")).distinct()


def _rating_cards(spark: SparkSession, d: str) -> DataFrame:
    latest = rel.keep_last(load(spark, d, "madden_ratings").where("first_name IS NOT NULL"), ["first_name", "last_name", "team_label"], ["delivered_at", "row_id"])
    return latest.select(F.col("row_id").alias("card"), F.concat_ws(" ", "first_name", "last_name").alias("name"), F.col("team_label").alias("team"), F.col("madden_pos_label").alias("position"), F.col("row_id").alias("ord"))


#: Spellings that the resolvers are told about; a null forces a row to stay without a match.
ALIASES: dict[str, str | None] = {
    "William Lamowpick": "William Lamopwick", "Xaiier Chaluvtti": "Xavier Chaluvtti", "Bian Galaymore": "Brian Galaymore",
    "Anthony Vadinlan": "Tony Vadinlan", "Brendan Rinintrix": "Breendan Rinintrix",
}
NO_MATCH: dict[str, str | None] = {"Kamren Lamarwick": None, "Ale. Brixergard": None}


def _alias_sql(column: str, table: dict[str, str | None], default: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{k}' THEN {'NULL' if v is None else repr(v)}" for k, v in table.items())
    return f"(CASE {column} {whens} ELSE {default} END)"


_CARDS_SQL = "SELECT DISTINCT CAST(substr(gsis_id, 4, 8) AS BIGINT) AS card, full_name AS name, team, position, season AS ord FROM nflreadpy_rosters"


def _charts_sql(where: str = "true") -> str:
    return f"""WITH charts AS (SELECT row_id AS sid, team, list_distinct(list_filter([{_SP(_alias_sql('name', ALIASES))}, {_SP('name')}], lambda k: k <> '')) AS ks FROM ourlads_players WHERE {where}),
s AS (SELECT sid, team, unnest(range(len(ks))) AS try, unnest(ks) AS key FROM charts),
l AS (SELECT * FROM madden_ratings WHERE first_name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY first_name, last_name, team_label ORDER BY delivered_at DESC NULLS LAST, row_id DESC) = 1),
c AS (SELECT row_id AS card, row_id AS ord, team_label AS team, {_SP("concat_ws(' ', first_name, last_name)")} AS key FROM l),
shared AS (SELECT key FROM c GROUP BY 1 HAVING count(DISTINCT team) > 1), safe AS (SELECT * FROM s WHERE key NOT IN (SELECT key FROM shared)),
sw AS (SELECT *, string_split(key, ' ') AS words, list_sort(list_transform(string_split(key, ' '), lambda w: {{'n': -length(w), 'w': w}}))[1].w AS word FROM s),
cw AS (SELECT *, string_split(key, ' ') AS words, unnest(list_distinct(string_split(key, ' '))) AS word FROM c),
w AS (SELECT sid, try, sw.key, card, ord, sw.team = cw.team AS own FROM sw JOIN cw USING (word) WHERE list_has_all(cw.words, sw.words)),
t1 AS (SELECT sid, min_by(card, (try, ord, card)) AS card FROM s JOIN c USING (key, team) GROUP BY 1), t2 AS (SELECT sid, min_by(card, (try, ord, card)) AS card FROM w WHERE own GROUP BY 1),
t3 AS (SELECT sid, min_by(card, (try, ord, card)) AS card FROM safe JOIN c USING (key) GROUP BY 1), t4 AS (SELECT sid, min_by(card, (try, ord, card)) AS card FROM w WHERE key NOT IN (SELECT key FROM shared) GROUP BY 1)
SELECT charts.sid, coalesce(t1.card, t2.card, t3.card, t4.card) AS card, CASE WHEN t1.card IS NOT NULL THEN 'team_name' WHEN t2.card IS NOT NULL THEN 'team_words' WHEN t3.card IS NOT NULL THEN 'league_name' WHEN t4.card IS NOT NULL THEN 'league_words' END AS match_source
FROM charts LEFT JOIN t1 USING (sid) LEFT JOIN t2 USING (sid) LEFT JOIN t3 USING (sid) LEFT JOIN t4 USING (sid)"""


@query(_charts_sql())
def resolve_chart_ratings(spark: SparkSession, d: str) -> DataFrame:
    """Depth-chart rows to rating cards: the team's names and words first, then the league's where no two teams share the name."""
    charts = load(spark, d, "ourlads_players").select(F.col("row_id").alias("sid"), "name", "team", F.col("standard_pos").alias("grp"))
    return lg.find_cards(charts, _rating_cards(spark, d), ALIASES).select("sid", "card", "match_source")


_RATINGS_SQL = """SELECT row_id AS card, concat_ws(' ', first_name, last_name) AS name, team_label AS team, madden_pos_label AS position, row_id AS ord FROM madden_ratings WHERE first_name IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY first_name, last_name, team_label ORDER BY delivered_at DESC NULLS LAST, row_id DESC) = 1"""


@query(_charts_sql("years_pro = 0"))
def resolve_rookies(spark: SparkSession, d: str) -> DataFrame:
    """First-year players of the charts to rating cards, by the same ways."""
    charts = load(spark, d, "ourlads_players").where("years_pro = 0").select(F.col("row_id").alias("sid"), "name", "team", F.col("standard_pos").alias("grp"))
    return lg.find_cards(charts, _rating_cards(spark, d), ALIASES).select("sid", "card", "match_source")


_KEY = "regexp_replace(array_to_string(list_filter(string_split(trim(regexp_replace(replace(lower(strip_accents(coalesce({x}, ''))), '.', ''), '\\s+', ' ', 'g')), ' '), lambda t: t NOT IN ('jr', 'sr', 'ii', 'iii', 'iv', 'vi', 'v')), ' '), '[^a-z]', '', 'g')"
_MK = lambda x: _KEY.replace("{x}", x)
_FIRST = "split_part(trim(regexp_replace({x}, '\\s+', ' ', 'g')), ' ', 1)"
_ONE = "SELECT sid, min(card) AS card FROM {t} GROUP BY 1 HAVING count(DISTINCT card) = 1"
_FITS = f"list_contains(string_split({_STANDARD_SQL}, ' '), grp)"
_TIER_SQL = "CASE " + " ".join(f"WHEN t{i}.card IS NOT NULL THEN '{n}'" for i, n in enumerate(("name_team", "name_only", "token_overlap", "token_set_swap", "league_token"), 1)) + " END"


def _five_sql(table: str, name: str, cards: str, league: str) -> str:
    return f"""WITH named AS (SELECT row_id AS sid, team, standard_pos AS grp, {_alias_sql(name, ALIASES | NO_MATCH, name)} AS name FROM {table}),
s AS (SELECT sid, team, grp, {_MK('name')} AS key, {_MK(_FIRST.format(x='name'))} AS f, {_SET.replace('{x}', 'name')} AS w FROM named WHERE name IS NOT NULL AND {_MK('name')} <> ''),
c AS (SELECT card, team AS c_team, position, ord, {_MK('name')} AS c_key, {_MK(_FIRST.format(x='name'))} AS c_f, {_SET.replace('{x}', 'name')} AS c_w FROM ({cards})),
n AS (SELECT sid, s.team, c.c_team, card, ord FROM s JOIN c ON key = c_key),
su AS (SELECT *, unnest(list_filter(w, lambda x: x <> f)) AS word FROM s), cu AS (SELECT *, unnest(c_w) AS word FROM c),
p AS (SELECT *, list_intersect(w, c_w) AS common FROM (SELECT DISTINCT sid, team, grp, f, w, card, c_team, position, c_f, c_w FROM su JOIN cu USING (word))),
q AS (SELECT *, f = c_f AS same_first, w = c_w AS same_words, len(list_filter(common, lambda x: x <> f AND x <> c_f)) AS further, len(list_filter(common, lambda x: x <> f AND x <> c_f AND length(x) >= 4)) AS far, len(list_filter(common, lambda x: length(x) >= 4)) AS long FROM p),
strong AS (SELECT * FROM q WHERE (same_first AND far > 0) OR same_words), weak AS (SELECT * FROM q WHERE long >= 2 AND sid NOT IN (SELECT sid FROM strong)), both_ AS (SELECT * FROM strong UNION ALL SELECT * FROM weak),
t1 AS (SELECT sid, min_by(card, (-ord, card)) AS card FROM n WHERE team = c_team GROUP BY 1), t2 AS ({_ONE.format(t='n')}),
t3 AS ({_ONE.format(t='q WHERE team = c_team AND same_first AND further > 0')}), t4 AS ({_ONE.format(t='q WHERE team = c_team AND same_words')}), one AS ({_ONE.format(t='both_')}),
t5 AS (SELECT DISTINCT sid, card FROM one JOIN both_ USING (sid, card) WHERE {_FITS} AND {league})
SELECT row_id AS sid, coalesce(t1.card, t2.card, t3.card, t4.card, t5.card) AS card, {_TIER_SQL} AS match_source
FROM {table} m LEFT JOIN t1 ON m.row_id = t1.sid LEFT JOIN t2 ON m.row_id = t2.sid LEFT JOIN t3 ON m.row_id = t3.sid LEFT JOIN t4 ON m.row_id = t4.sid LEFT JOIN t5 ON m.row_id = t5.sid"""


@query(_five_sql("player_match", "canonical_name", _CARDS_SQL, "true"))
def resolve_five_tiers(spark: SparkSession, d: str) -> DataFrame:
    """Match rows to rosters through five tiers."""
    return lg.five_tiers(_spine(spark, d), _cards(spark, d), STANDARD, ALIASES | NO_MATCH).select("sid", "card", "match_source")


@query(_five_sql("ourlads_players", "name", _RATINGS_SQL, "false"))
def resolve_four_tiers(spark: SparkSession, d: str) -> DataFrame:
    """The same without the league for another target: chart rows to rating cards."""
    charts = load(spark, d, "ourlads_players").select(F.col("row_id").alias("sid"), "name", "team", F.col("standard_pos").alias("grp"))
    return lg.five_tiers(charts, _rating_cards(spark, d), STANDARD, ALIASES | NO_MATCH, league=False).select("sid", "card", "match_source")


@query(f"""WITH s AS (SELECT row_id AS sid, team, {_MK(_alias_sql('canonical_name', ALIASES | NO_MATCH, 'canonical_name'))} AS k FROM player_match), c AS (SELECT *, {_MK('name')} AS k FROM ({_CARDS_SQL})),
t1 AS (SELECT k, team, min_by(card, (-ord, card)) AS card FROM c WHERE k <> '' AND team IS NOT NULL GROUP BY 1, 2), t2 AS (SELECT k, min(card) AS card FROM c WHERE k <> '' GROUP BY 1 HAVING count(DISTINCT card) = 1)
SELECT sid, coalesce(t1.card, t2.card) AS card, CASE WHEN t1.card IS NOT NULL THEN 'name_team' WHEN t2.card IS NOT NULL THEN 'name_only' END AS match_source FROM s LEFT JOIN t1 USING (k, team) LEFT JOIN t2 USING (k)""")
def resolve_last_of_team(spark: SparkSession, d: str) -> DataFrame:
    """Match rows by alias (a null forces none), the last card of the name and team, then a name that one card has."""
    key = F.nullif(tx.match_key(F.col("name"), True), F.lit(""))
    spine = _spine(spark, d).withColumn("name", tx.mapped(F.col("name"), ALIASES | NO_MATCH, default=F.col("name")))
    both = F.when(key.isNotNull() & F.col("team").isNotNull(), F.struct(key.alias("k"), "team"))
    tiers = [Tier("name_team", both, both, unique=False, order=-F.col("ord")), Tier("name_only", key, key)]
    return resolve_tiers(spine, _cards(spark, d), "card", tiers, "card").select("sid", "card", "match_source")


_ROSTER = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(coalesce({x}, ''))), '[.''’]', '', 'g'), '[-–]', ' ', 'g'), '\\b(jr|sr|ii|iii|iv)\\b', '', 'g'), '\\s+', ' ', 'g'))"
#: The aliases in the form of the keys.
_LOWER: dict[str, str | None] = {k.lower(): (v or "").lower() for k, v in ALIASES.items()}
_W = "string_split(trim(regexp_replace({x}, '\\s+', ' ', 'g')), ' ')"
_HEAD = f"CASE WHEN len({_W}) >= 2 AND contains({_W}[-1], '-') THEN array_to_string(list_append({_W}[1:-2], split_part({_W}[-1], '-', 1)), ' ') END"


@query(f"""WITH s AS (SELECT row_id AS sid, team, {_ROSTER.format(x='canonical_name')} AS k, {_ROSTER.replace('{x}', _HEAD.replace('{x}', 'canonical_name'))} AS h, {_alias_sql(_ROSTER.format(x='canonical_name'), _LOWER)} AS a FROM player_match),
c AS (SELECT DISTINCT CAST(substr(gsis_id, 4, 8) AS BIGINT) AS card, team, {_ROSTER.format(x='full_name')} AS k, {_ROSTER.replace('{x}', _HEAD.replace('{x}', 'full_name'))} AS h FROM nflreadpy_rosters),
reach AS (SELECT card, team, k AS r FROM c UNION SELECT card, team, h FROM c WHERE h <> ''),
e AS (SELECT sid, min(card) AS card, count(DISTINCT card) AS n FROM s JOIN reach ON s.k = r AND s.team = reach.team GROUP BY 1), i AS (SELECT sid, min(card) AS card, count(DISTINCT card) AS n FROM s JOIN reach ON s.a = r AND s.team = reach.team GROUP BY 1), y AS (SELECT sid, min(card) AS card, count(DISTINCT card) AS n FROM s JOIN reach ON s.h = r AND s.team = reach.team WHERE h <> '' GROUP BY 1),
n AS (SELECT DISTINCT sid FROM s JOIN reach ON s.k = r OR s.a = r)
SELECT s.sid, CASE WHEN e.n = 1 THEN e.card WHEN i.n = 1 THEN i.card WHEN y.n = 1 THEN y.card END AS card, CASE WHEN e.n = 1 THEN 'exact' WHEN i.n = 1 THEN 'alias' WHEN y.n = 1 THEN 'hyphen' WHEN e.n > 1 OR i.n > 1 OR y.n > 1 THEN 'unmatched_ambiguous' WHEN n.sid IS NOT NULL THEN 'unmatched_other_team' ELSE 'unmatched_no_name' END AS match_source
FROM s LEFT JOIN e USING (sid) LEFT JOIN i USING (sid) LEFT JOIN y USING (sid) LEFT JOIN n USING (sid)""")
def resolve_labelled(spark: SparkSession, d: str) -> DataFrame:
    """Match rows to rosters, every miss with its reason."""
    return lg.labelled_match(_spine(spark, d), _cards(spark, d), _LOWER, "FA", F.lit(True)).select("sid", "card", "match_source")


_INVERSE = {v: k for k, v in ALIASES.items() if v}


@query(f"""WITH s AS (SELECT DISTINCT row_id AS sid, team, {_MK('name')} AS k FROM (SELECT row_id, team, unnest([canonical_name, {_alias_sql('canonical_name', ALIASES)}, {_alias_sql('canonical_name', _INVERSE)}]) AS name FROM player_match) WHERE name IS NOT NULL), c AS (SELECT CAST(substr(gsis_id, 4, 8) AS BIGINT) AS card, team, {_MK('full_name')} AS k FROM nflreadpy_rosters),
t AS (SELECT sid, min(card) AS a, max(card) AS b FROM s JOIN c USING (k, team) WHERE k <> '' GROUP BY 1), n AS (SELECT sid, min(card) AS a, max(card) AS b FROM s JOIN c USING (k) WHERE k <> '' GROUP BY 1)
SELECT row_id AS sid, CASE WHEN t.a = t.b THEN t.a WHEN n.a = n.b THEN n.a END AS card, CASE WHEN t.a = t.b THEN 'name_team' WHEN n.a = n.b THEN 'name_only' END AS match_source FROM player_match m LEFT JOIN t ON m.row_id = t.sid LEFT JOIN n ON m.row_id = n.sid""")
def resolve_any_key(spark: SparkSession, d: str) -> DataFrame:
    """Own name, alias and inverse alias together: one id within the team, else one id by name."""
    return lg.any_key_match(_spine(spark, d), _cards(spark, d), ALIASES).select("sid", "card", "match_source")


_PLAIN = _KEY.replace("strip_accents(coalesce({x}, ''))", "coalesce({x}, '')")
_PARTS = "list_filter(string_split(trim(regexp_replace({x}, '\\s+', ' ', 'g')), ' '), lambda t: replace(lower(t), '.', '') NOT IN ('jr', 'sr', 'ii', 'iii', 'iv', 'v'))"


@query(f"""WITH s AS (SELECT row_id AS sid, team, {_PLAIN.format(x='canonical_name')} AS k, {_PARTS.format(x='canonical_name')} AS p FROM player_match),
c AS (SELECT CAST(substr(gsis_id, 4, 8) AS BIGINT) AS card, team, {_PLAIN.format(x='full_name')} AS k, {_PARTS.format(x='full_name')} AS p FROM nflreadpy_rosters),
si AS (SELECT sid, team, lower(p[1][1]) AS i, {_PLAIN.format(x='p[-1]')} AS l FROM s WHERE len(p) >= 2), ci AS (SELECT card, team, lower(p[1][1]) AS i, {_PLAIN.format(x='p[-1]')} AS l FROM c WHERE len(p) >= 2),
t AS (SELECT sid, min(card) AS card FROM s JOIN c USING (team, k) WHERE k <> '' GROUP BY 1 HAVING count(DISTINCT card) = 1), n AS (SELECT sid, min(card) AS card FROM si JOIN ci USING (team, i, l) GROUP BY 1 HAVING count(DISTINCT card) = 1)
SELECT s.sid, coalesce(t.card, n.card) AS card, CASE WHEN t.card IS NOT NULL THEN 'name' WHEN n.card IS NOT NULL THEN 'initial' END AS match_source FROM s LEFT JOIN t USING (sid) LEFT JOIN n USING (sid)""")
def resolve_initials(spark: SparkSession, d: str) -> DataFrame:
    """Match rows to rosters by name, then by first initial and last name, within the team."""
    return lg.initial_tier(_spine(spark, d), _cards(spark, d), ["team"]).select("sid", "card", "match_source")


_SCHOOL = "regexp_replace(lower(trim(coalesce({x}, ''))), '[^a-z0-9]', '', 'g')"
_GROUP_SQL = "CASE grp " + " ".join(f"WHEN '{k}' THEN '{v.split()[0]}'" for k, v in STANDARD.items()) + " END"


@query(f"""WITH s0 AS (SELECT DISTINCT concat_ws('|', board_no, prospect_id, name, school, position) AS sid, name, {_SCHOOL.format(x='school')} AS team, position AS grp FROM draft_prospects WHERE {_SCHOOL.format(x='school')} <> ''),
s AS (SELECT *, {_SP('name')} AS key FROM s0), c AS (SELECT DISTINCT CAST(substr(gsis_id, 4, 8) AS BIGINT) AS card, {_SCHOOL.format(x='college')} AS team, position, {_SP('full_name')} AS c_key FROM nflreadpy_rosters WHERE {_SCHOOL.format(x='college')} <> ''),
sw AS (SELECT *, list_sort(list_distinct(string_split(key, ' '))) AS w FROM s), cw AS (SELECT *, list_sort(list_distinct(string_split(c_key, ' '))) AS c_w FROM c),
p AS (SELECT *, coalesce(list_contains(string_split({_STANDARD_SQL}, ' '), {_GROUP_SQL}), false) AS fits FROM (SELECT DISTINCT sid, grp, key, w, card, position, c_key, c_w FROM (SELECT *, unnest(w) AS word FROM sw) JOIN (SELECT *, unnest(c_w) AS word FROM cw) USING (team, word))),
x AS (SELECT *, max(fits) OVER (PARTITION BY sid) AS any_fit FROM p WHERE key = c_key), xn AS (SELECT sid, count(DISTINCT card) AS n FROM x GROUP BY 1), xk AS (SELECT x.* FROM x JOIN xn USING (sid) WHERE n = 1 OR NOT any_fit OR fits),
t1 AS ({_ONE.format(t='xk')}), t2 AS ({_ONE.format(t='p WHERE w = c_w')}),
t3 AS ({_ONE.format(t="p WHERE string_split(key, ' ')[-1] = string_split(c_key, ' ')[-1] AND key[1] = c_key[1] AND contains(key, ' ') AND contains(c_key, ' ') AND fits")})
SELECT s0.sid, coalesce(t1.card, t2.card, t3.card) AS card, CASE WHEN t1.card IS NOT NULL THEN 'exact' WHEN t2.card IS NOT NULL THEN 'token_set' WHEN t3.card IS NOT NULL THEN 'initial_lastname' END AS match_source
FROM s0 LEFT JOIN t1 USING (sid) LEFT JOIN t2 USING (sid) LEFT JOIN t3 USING (sid)""")
def resolve_school_cards(spark: SparkSession, d: str) -> DataFrame:
    """Draft prospects to rosters of the same school."""
    prospects = load(spark, d, "draft_prospects").select(F.concat_ws("|", "board_no", "prospect_id", "name", "school", "position").alias("sid"), "name", tx.school_key(F.col("school"), {}).alias("team"), F.col("position").alias("grp")).distinct()
    cards = load(spark, d, "nflreadpy_rosters").select(F.substring("gsis_id", 4, 8).cast("long").alias("card"), F.col("full_name").alias("name"), tx.school_key(F.col("college"), {}).alias("team"), "position").distinct()
    compatible = F.array_contains(F.split(tx.mapped(F.col("c_position"), STANDARD), " "), tx.mapped(F.col("grp"), {k: v.split()[0] for k, v in STANDARD.items()}))
    return lg.school_cards(prospects.where("team <> ''"), cards.where("team <> ''"), F.coalesce(compatible, F.lit(False))).select("sid", "card", "match_source")


@query(f"""WITH last AS (SELECT board_no, max(snapshot_no) AS snapshot_no FROM draft_prospects GROUP BY 1), r AS (SELECT d.* FROM draft_prospects d JOIN last USING (board_no, snapshot_no) WHERE consensus_rank IS NOT NULL AND name IS NOT NULL),
e AS (SELECT DISTINCT consensus_rank, board_no, prospect_id, {_SP('name')} AS key, position AS grp FROM r), p AS (SELECT DISTINCT prospect_id AS card, {_SP('name')} AS key, position AS p_grp FROM r),
h AS (SELECT consensus_rank, board_no, prospect_id, card, coalesce(grp = p_grp, false) AS fits FROM e JOIN p USING (key)),
f AS (SELECT consensus_rank, board_no, prospect_id, max(fits) AS any_fit, count(DISTINCT card) AS n FROM h GROUP BY 1, 2, 3),
o AS (SELECT consensus_rank, board_no, prospect_id, min(card) AS card FROM h JOIN f USING (consensus_rank, board_no, prospect_id) WHERE n = 1 OR NOT any_fit OR fits GROUP BY 1, 2, 3 HAVING count(DISTINCT card) = 1)
SELECT consensus_rank, board_no, prospect_id, card FROM (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY card ORDER BY consensus_rank, board_no, prospect_id) = 1)""")
def claim_consensus(spark: SparkSession, d: str) -> DataFrame:
    """Entries of each board's latest list claim a prospect by name; the first claim wins."""
    boards = load(spark, d, "draft_prospects")
    last = boards.groupBy("board_no").agg(F.max("snapshot_no").alias("snapshot_no"))
    rows = boards.join(last, ["board_no", "snapshot_no"]).where("consensus_rank IS NOT NULL AND name IS NOT NULL")
    entry = F.struct("consensus_rank", "board_no", "prospect_id")
    listed = rows.select(entry.alias("place"), "name", F.col("position").alias("grp")).distinct()
    cards = rows.select(F.col("prospect_id").alias("card"), "name", F.col("position").alias("grp")).distinct()
    return lg.claim_by_name(listed, cards).select("place.*", "card")


_REVIEW = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(coalesce({x}, ''))), '[.''`\\-]', '', 'g'), '\\b(jr|sr|ii|iii|iv|v)\\b', '', 'g'), '[^a-z ]', '', 'g'), '\\s+', ' ', 'g'))"


@query(f"""WITH s AS (SELECT row_id AS sid, team, CAST(substr(gsis_id, 4, 8) AS BIGINT) AS own, {_REVIEW.format(x='canonical_name')} AS k FROM player_match), c AS (SELECT CAST(substr(gsis_id, 4, 8) AS BIGINT) AS card, team, {_REVIEW.format(x='full_name')} AS k FROM nflreadpy_rosters),
n AS (SELECT sid, min(card) AS card FROM s JOIN c USING (team, k) GROUP BY 1 HAVING count(DISTINCT card) = 1)
SELECT s.sid, coalesce(own, n.card) AS card, CASE WHEN own IS NOT NULL THEN 'crosswalk' WHEN n.card IS NOT NULL THEN 'name_team' END AS match_source FROM s LEFT JOIN n USING (sid)""")
def match_by_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    """Match rows by their id where they have one, else by name and team."""
    ids = load(spark, d, "player_match").where("gsis_id IS NOT NULL").select(F.col("row_id").alias("sid"), F.substring("gsis_id", 4, 8).cast("long").alias("card"))
    return lg.crosswalk_then_name(_spine(spark, d), ids, _cards(spark, d)).select("sid", "card", "match_source")


@query("""SELECT user_id, CAST(round(sum(coalesce(value, 0)), 4) AS DOUBLE) AS value, min_by(event_type, (ts, event_id)) AS first_type, max_by(event_type, (ts, event_id)) AS last_type FROM events WHERE user_id IS NOT NULL GROUP BY 1""")
def season_totals(spark: SparkSession, d: str) -> DataFrame:
    events = load(spark, d, "events").withColumn("first_type", F.col("event_type")).withColumn("last_type", F.col("event_type"))
    totals = rel.season_totals(events, "user_id", ["value"], ["first_type"], ["last_type"], ["ts", "event_id"])
    return totals.withColumn("value", F.round("value", 4))


@query("""SELECT o_custkey, round(sum(o_totalprice), 2) AS total, CAST(count(*) AS INT) AS n FROM orders GROUP BY 1""")
def array_totals(spark: SparkSession, d: str) -> DataFrame:
    nested = load(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list("o_totalprice").alias("prices"))
    return rel.total_and_length(nested, "prices", "total", "n").select("o_custkey", F.round("total", 2).alias("total"), "n")


@query("""SELECT row_id, coalesce(json_extract_string(stats_json, '$.TCK'), '0') AS tackles, len(list_filter(json_keys(stats_json), lambda k: json_extract_string(stats_json, '$."' || k || '"') NOT IN ('0', '0.0'))) AS kept FROM ourlads_players WHERE stats_json IS NOT NULL""")
def stats_remap(spark: SparkSession, d: str) -> DataFrame:
    """Statistic labels renamed through a table, zero entries dropped."""
    rows = load(spark, d, "ourlads_players").where("stats_json IS NOT NULL").withColumn("stats", F.from_json("stats_json", "map<string,string>"))
    renamed = rows.withColumn("named", rel.remap_keys("stats", {"TCK": "TACKLES", "REC": "RECEPTIONS"}))
    return renamed.select("row_id", F.coalesce(F.try_element_at("named", F.lit("TACKLES")), F.lit("0")).alias("tackles"), F.size(rel.without_zeros("named")).cast("long").alias("kept"))


@query("""WITH sizes AS (SELECT team, count(*) AS n FROM nflreadpy_rosters WHERE team IS NOT NULL GROUP BY 1), o AS (SELECT team, n, row_number() OVER (ORDER BY n, team) AS slot FROM sizes),
r AS (SELECT unnest(range(1, 8)) AS round), p0 AS (SELECT round, slot, team, lag(team) OVER (PARTITION BY round ORDER BY slot) AS before FROM r, o),
p AS (SELECT round, slot, CASE WHEN (round * 7 + slot * 5) % 11 = 0 THEN coalesce(before, team) ELSE team END AS owner FROM p0),
g AS (SELECT team, rank() OVER (ORDER BY n) AS low, rank() OVER (ORDER BY n) + count(*) OVER (PARTITION BY n) - 1 AS high FROM o),
m AS (SELECT low, list(team) AS members, unnest(range(low, high + 1)) AS slot FROM g GROUP BY low, high),
j AS (SELECT p.*, m.low AS grp, m.members, g.low, g.high, slot BETWEEN g.low AND g.high AS inside, greatest(g.low - slot, slot - g.high) AS away FROM p JOIN m USING (slot) JOIN g ON owner = g.team),
k AS (SELECT *, min(slot) FILTER (inside) OVER w AS own FROM j WINDOW w AS (PARTITION BY round, owner)), k2 AS (SELECT *, min(slot) FILTER (own IS NULL AND away <= 4) OVER (PARTITION BY round, owner) AS moved FROM k),
h AS (SELECT *, coalesce(slot = coalesce(own, moved), false) AS holds FROM k2),
rest AS (SELECT round, grp, count(*) FILTER (NOT holds) AS n, min(slot) FILTER (NOT holds) AS slot, any_value(members) AS members FROM h GROUP BY 1, 2), held AS (SELECT round, low AS grp, list(DISTINCT owner) AS names FROM h WHERE holds GROUP BY 1, 2),
known AS (SELECT round, slot, list_filter(members, lambda t: NOT list_contains(coalesce(names, []), t)) AS missing FROM rest LEFT JOIN held USING (round, grp) WHERE n = 1)
SELECT CAST(p.round AS INT) AS round, CAST(p.slot AS INT) AS slot, owner, CASE WHEN len(missing) = 1 THEN missing[1] ELSE owner END AS original FROM p LEFT JOIN known USING (round, slot)""")
def infer_slot_owners(spark: SparkSession, d: str) -> DataFrame:
    """First owners of the slots of seven rounds, with teams in the order of how often their rosters list a player."""
    sizes = load(spark, d, "nflreadpy_rosters").where("team IS NOT NULL").groupBy("team").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.orderBy("n", "team"))  # one row per team of a league
    order = sizes.withColumn("slot", place).withColumn("share", F.col("n").cast("double"))
    rounds = order.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(7))))
    # some slots change hands: their owner is the team of the slot before
    before = F.lag("team").over(Window.partitionBy("round").orderBy("slot"))
    traded = (F.col("round") * 7 + F.col("slot") * 5) % 11 == 0
    picks = rounds.select("round", F.col("slot").cast("int").alias("slot"), F.when(traded, F.coalesce(before, F.col("team"))).otherwise(F.col("team")).alias("owner"))
    return st.standing_owners(picks, order.select("team", "share"))


_RETRY = {"CB": "S", "S": "CB"}
_LATEST = "(SELECT * FROM nflreadpy_rosters WHERE season = (SELECT max(season) FROM nflreadpy_rosters))"


def _id_tier(n: int, rows: str, source: str) -> str:
    cards = f"(SELECT DISTINCT CAST(substr(gsis_id, 4, 8) AS BIGINT) AS card, unnest(string_split({_STANDARD_SQL}, ' ')) AS b, team, {_SP('full_name')} AS name FROM {source})"
    return f"""c{n} AS {cards}, p{n} AS (SELECT s.sid, c.card, z.score, s.team = c.team AS own FROM {rows} s JOIN {similar_sql(rows, f'c{n}', 80)} z ON s.b = z.b AND s.name = z.x JOIN c{n} c ON c.b = z.b AND c.name = z.y),
a{n} AS (SELECT sid, max((score, -card)) AS t, max((score, -card)) FILTER (own) AS o FROM p{n} GROUP BY 1), t{n} AS (SELECT sid, -(CASE WHEN t[1] >= 95 THEN t ELSE o END)[2] AS card FROM a{n} WHERE t[1] >= 95 OR o IS NOT NULL)"""


@query(f"""WITH s AS (SELECT row_id AS sid, standard_pos AS b, team, {_SP(_alias_sql('canonical_name', ALIASES | NO_MATCH, 'canonical_name'))} AS name FROM player_match WHERE coalesce(standard_pos <> 'OL', true) AND canonical_name NOT IN ({', '.join(f"'{k}'" for k in NO_MATCH)})),
r AS (SELECT sid, CASE b WHEN 'CB' THEN 'S' WHEN 'S' THEN 'CB' END AS b, team, name FROM s WHERE b IN ('CB', 'S')),
{_id_tier(1, 's', _LATEST)}, {_id_tier(2, 's', 'nflreadpy_rosters')}, {_id_tier(3, 'r', _LATEST)}, {_id_tier(4, 'r', 'nflreadpy_rosters')}
SELECT row_id AS sid, coalesce(t1.card, t2.card, t3.card, t4.card) AS card, CASE WHEN t1.card IS NOT NULL THEN 'crosswalk' WHEN t2.card IS NOT NULL THEN 'rosters' WHEN t3.card IS NOT NULL THEN 'crosswalk_retry' WHEN t4.card IS NOT NULL THEN 'rosters_retry' END AS match_source
FROM player_match m LEFT JOIN t1 ON m.row_id = t1.sid LEFT JOIN t2 ON m.row_id = t2.sid LEFT JOIN t3 ON m.row_id = t3.sid LEFT JOIN t4 ON m.row_id = t4.sid""")
def resolve_ids(spark: SparkSession, d: str) -> DataFrame:
    """Match rows to ids by similar names of the position: the latest season's list, then all rosters, then the other of two positions; linemen stay out."""
    rosters = load(spark, d, "nflreadpy_rosters")
    latest = rosters.where(F.col("season") == rosters.agg(F.max("season")).first()[0])
    cards = lambda df: df.select(F.substring("gsis_id", 4, 8).cast("long").alias("card"), F.col("full_name").alias("name"), "team", F.explode(F.split(tx.mapped(F.col("position"), STANDARD), " ")).alias("position"))
    found = lg.find_ids(_spine(spark, d), [("crosswalk", cards(latest)), ("rosters", cards(rosters))], ALIASES | NO_MATCH, ["OL"], _RETRY)
    return found.select("sid", "card", "match_source")


@query(f"""WITH s AS (SELECT row_id AS sid, 'all' AS b, team, {_SP('canonical_name')} AS name FROM player_match WHERE {_SP('canonical_name')} <> ''), c AS (SELECT card, team, ord, 'all' AS b, {_SP('name')} AS name FROM ({_CARDS_SQL}) WHERE {_SP('name')} <> ''),
l AS (SELECT b, name, team, max_by(card, (ord, card)) AS card FROM c GROUP BY 1, 2, 3), u AS (SELECT name, min(card) AS card FROM c GROUP BY 1 HAVING count(DISTINCT card) = 1), x AS (SELECT sid, u.card FROM s JOIN u USING (name)),
p AS (SELECT s.sid, l.card, z.score, coalesce(s.team = l.team AND z.score >= 80, false) AS own FROM s JOIN {similar_sql('s', 'l', 75)} z ON s.name = z.x JOIN l ON l.name = z.y),
a AS (SELECT sid, max((score, -card)) AS t, max((score, -card)) FILTER (own) AS o FROM p GROUP BY 1), f AS (SELECT sid, CASE WHEN t[1] >= 90 THEN t ELSE o END AS v FROM a WHERE t[1] >= 90 OR o IS NOT NULL)
SELECT row_id AS sid, coalesce(x.card, CAST(-f.v[2] AS BIGINT)) AS card, round(CASE WHEN x.card IS NOT NULL THEN 100.0 ELSE f.v[1] END, 4) AS score, coalesce(x.card IS NULL AND f.v[1] < 95, false) AS low_confidence
FROM player_match m LEFT JOIN x ON m.row_id = x.sid LEFT JOIN f ON m.row_id = f.sid""")
def resolve_legacy_names(spark: SparkSession, d: str) -> DataFrame:
    """Match rows to rosters by one name, or similar names of the league and the team, with a list of doubtful ones."""
    found = lg.legacy_match(_spine(spark, d), _cards(spark, d))
    return found.withColumn("score", F.round("score", 4))


_PICKS = "SELECT DISTINCT CAST(draft_number AS BIGINT) AS card, entry_year AS year, CAST(ceil(draft_number / 32) AS INT) AS round, full_name AS name FROM nflreadpy_rosters WHERE draft_number IS NOT NULL"
_INI = "CASE WHEN len({p}) >= 2 THEN lower({p}[1][1]) || '|' || {l} END"


@query(f"""WITH e AS (SELECT row_id AS sid, 2000 + CAST(substr(attainment, 1, 2) AS INT) AS year, CAST(substr(attainment, 4, 1) AS INT) AS round, {_PLAIN.replace('{x}', _alias_sql('name', ALIASES))} AS a, {_PLAIN.replace('{x}', 'name')} AS k, {_INI.format(p=_PARTS.replace('{x}', 'name'), l=_PLAIN.replace('{x}', _PARTS.replace('{x}', 'name') + '[-1]'))} AS i FROM ourlads_players WHERE regexp_full_match(attainment, '\\d\\d/[1-7]\\*?')),
c AS (SELECT card, year, round, {_PLAIN.replace('{x}', 'name')} AS k, {_INI.format(p=_PARTS.replace('{x}', 'name'), l=_PLAIN.replace('{x}', _PARTS.replace('{x}', 'name') + '[-1]'))} AS i FROM ({_PICKS})),
t1 AS (SELECT sid, min(card) AS card FROM e JOIN c ON e.year = c.year AND e.round = c.round AND e.a = c.k WHERE e.a <> '' GROUP BY 1 HAVING count(DISTINCT card) = 1), t2 AS (SELECT sid, min(card) AS card FROM e JOIN c USING (year, round, k) WHERE k <> '' GROUP BY 1 HAVING count(DISTINCT card) = 1),
t3 AS (SELECT sid, min(card) AS card FROM e JOIN c USING (year, round, i) GROUP BY 1 HAVING count(DISTINCT card) = 1)
SELECT row_id AS sid, coalesce(t1.card, t2.card, t3.card) AS pick, CASE WHEN t1.card IS NOT NULL THEN 'alias' WHEN t2.card IS NOT NULL THEN 'name' WHEN t3.card IS NOT NULL THEN 'initial' END AS match_source
FROM ourlads_players o LEFT JOIN t1 ON o.row_id = t1.sid LEFT JOIN t2 ON o.row_id = t2.sid LEFT JOIN t3 ON o.row_id = t3.sid""")
def resolve_draft_picks(spark: SparkSession, d: str) -> DataFrame:
    """Chart rows to the pick of their name in the year and round that the chart gives."""
    entries = load(spark, d, "ourlads_players").select(F.col("row_id").alias("sid"), "name", ps.attainment(F.col("attainment")).alias("a")).select("sid", "name", "a.year", "a.round")
    picks = load(spark, d, "nflreadpy_rosters").where("draft_number IS NOT NULL").select(
        F.col("draft_number").cast("long").alias("pick"), F.col("full_name").alias("name"), F.col("entry_year").alias("year"), F.ceil(F.col("draft_number") / 32).cast("int").alias("round")
    )
    return lg.draft_picks(entries, picks.distinct(), ALIASES).select("sid", "pick", "match_source")


@query("""SELECT DISTINCT a.school AS school, b.college AS college FROM draft_prospects a JOIN nflreadpy_rosters b ON contains(b.college, substr(a.school, 1, 6)) WHERE length(a.school) >= 6""")
def prefix_contains_join(spark: SparkSession, d: str) -> DataFrame:
    """Colleges of the rosters that contain the first six letters of a prospect's school."""
    return rel.prefix_contains(load(spark, d, "draft_prospects"), load(spark, d, "nflreadpy_rosters"), "school", "college")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def first_rows_report(spark: SparkSession, d: str) -> DataFrame:
    """The dearest orders: a report of a few rows."""
    return rel.first_rows(load(spark, d, "orders"), [F.col("o_totalprice").desc_nulls_last(), "o_orderkey"], 20).select("o_orderkey", "o_totalprice")


_SLUG = "regexp_replace(regexp_replace(lower(replace(coalesce({x}, ''), '''', '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
_MASTER = f"""WITH s AS (SELECT DISTINCT row_id AS sid, abbr AS team, {_MK('name')} AS k FROM ourlads_players WHERE {_MK('name')} <> ''), c AS (SELECT CAST(substr(gsis_id, 4, 8) AS BIGINT) AS card, team, {_MK('full_name')} AS k FROM nflreadpy_rosters),
t AS (SELECT sid, min(card) AS a, max(card) AS b FROM s JOIN c USING (k, team) GROUP BY 1), n AS (SELECT sid, min(card) AS a, max(card) AS b FROM s JOIN c USING (k) GROUP BY 1),
r AS (SELECT s.sid, CASE WHEN t.a = t.b THEN t.a WHEN n.a = n.b THEN n.a END AS card, CASE WHEN t.a = t.b THEN 'name_team' WHEN n.a = n.b THEN 'name_only' END AS match_source FROM s LEFT JOIN t USING (sid) LEFT JOIN n USING (sid)),
b AS (SELECT *, CAST(substr(gsis_id, 4, 8) AS BIGINT) AS card FROM nflreadpy_rosters QUALIFY row_number() OVER (PARTITION BY CAST(substr(gsis_id, 4, 8) AS BIGINT) ORDER BY season DESC NULLS LAST, team DESC NULLS LAST, position DESC NULLS LAST, full_name DESC NULLS LAST, weight DESC NULLS LAST, height DESC NULLS LAST, birth_date DESC NULLS LAST, entry_year DESC NULLS LAST, college DESC NULLS LAST) = 1),
j AS (SELECT o.*, r.match_source, b.gsis_id, b.entry_year, b.college, b.height, b.weight, coalesce(b.gsis_id, concat_ws('-', {_SLUG.format(x='o.name')}, lower(standard_pos), lower(abbr))) AS player_key FROM ourlads_players o JOIN r ON o.row_id = r.sid LEFT JOIN b USING (card)),
k AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY player_key ORDER BY coalesce(injured, false), CASE WHEN NOT coalesce(injured, false) THEN depth END NULLS LAST, row_id) = 1)"""


@query(_MASTER + """ SELECT player_key, row_id, name, abbr, standard_pos, coalesce(depth, 99) AS depth, coalesce(injured, false) AS injured, gsis_id, match_source,
CASE WHEN regexp_full_match(attainment, '\\d\\d/[1-7]\\*?') THEN 2000 + CAST(substr(attainment, 1, 2) AS INT) END AS draft_year, TRY_CAST(nullif(regexp_replace(cap_number, '[^0-9]', '', 'g'), '') AS BIGINT) AS cap,
season - entry_year AS years_pro, CAST(height // 12 AS VARCHAR) || '-' || CAST(height % 12 AS VARCHAR) AS height, weight, college, CASE WHEN coalesce(madden, 0) >= 80 THEN 'star' WHEN coalesce(madden, 0) >= 65 THEN 'starter' ELSE 'depth' END AS tier FROM k""")
def master_players(spark: SparkSession, d: str) -> DataFrame:
    """One row per player: charts as the spine, resolved against the rosters, the best chart row kept, enriched and typed."""
    charts = load(spark, d, "ourlads_players").where(tx.match_key(F.col("name"), True) != "")
    spine = charts.select(F.col("row_id").alias("sid"), "name", F.col("abbr").alias("team"), F.col("standard_pos").alias("grp"))
    resolved = lg.any_key_match(spine, _cards(spark, d), {})
    cards = resolved.select(F.col("sid").alias("row_id"), "card", "match_source")
    rosters = load(spark, d, "nflreadpy_rosters").withColumn("card", F.substring("gsis_id", 4, 8).cast("long"))
    total = ["season", "team", "position", "full_name", "weight", "height", "birth_date", "entry_year", "college"]
    bio = rel.keep_last(rosters, ["card"], total).select("card", "gsis_id", "entry_year", "college", F.col("height").alias("inches"), "weight")
    joined = charts.join(cards, "row_id").join(bio, "card", "left")
    slug = F.concat_ws("-", tx.slug(F.col("name")), F.lower("standard_pos"), F.lower("abbr"))
    keyed = joined.withColumn("player_key", F.coalesce("gsis_id", slug))
    best = rel.healthy_first(keyed, ["player_key"], F.col("injured"), F.col("depth"), "row_id")
    return best.select(
        "player_key", "row_id", "name", "abbr", "standard_pos", F.coalesce("depth", F.lit(99)).alias("depth"),
        F.coalesce("injured", F.lit(False)).alias("injured"), "gsis_id", "match_source", ps.attainment(F.col("attainment"))["year"].alias("draft_year"),
        ps.money(F.col("cap_number")).alias("cap"), dt.years_in(F.col("season"), F.col("entry_year")).alias("years_pro"), ps.height_text(F.col("inches")).alias("height"),
        "weight", "college", mx.tier(F.coalesce("madden", F.lit(0)), [(80, "star"), (65, "starter")], "depth").alias("tier"),
    )


@query(_MASTER + """ SELECT '{' || to_json(player_key) || ':' || to_json(struct_pack(player_key := player_key, name := name, abbr := abbr, depth := coalesce(depth, 99), gsis_id := gsis_id)) || '}' AS value FROM k""")
def master_export(spark: SparkSession, d: str) -> DataFrame:
    """The master as keyed JSON, one line per player in the order of the charts."""
    return sinks.keyed_json_lines(master_players(spark, d).select("player_key", "row_id", "name", "abbr", "depth", "gsis_id"), "player_key", "row_id")
