"""Queries for names, parsers, dates, metrics, conflicts, nested data and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import dates as dt
from gridloom.functions import metrics as mx
from gridloom.functions import parse as ps
from gridloom.functions import text as tx
from gridloom.operators import conflict as cf
from gridloom.operators import regression as rg
from gridloom.operators import resolve as rs
from gridloom.session import cut_lineage, load
from gridloom.sources import documents as docs
from gridloom.sources.html import table_rows
from gridloom.streaming.windows import run_available, windowed_counts

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


_WORDS = "string_split(trim(regexp_replace({x}, '\\s+', ' ', 'g')), ' ')"


def _sql_match_key(x: str, accents: bool = False) -> str:
    lowered = f"replace(lower({f'strip_accents({x})' if accents else x}), '.', '')"
    words = _WORDS.format(x=lowered)
    return f"regexp_replace(array_to_string(list_filter({words}, lambda t: t NOT IN ('jr', 'sr', 'ii', 'iii', 'iv', 'vi', 'v')), ' '), '[^a-z]', '', 'g')"


def _sql_squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


_N = "coalesce(name, '')"


@query(f"SELECT row_id, {_sql_match_key(_N)} AS plain_key, {_sql_match_key(_N, True)} AS folded_key FROM ourlads_players")
def normalize_match_key(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("name")
    return load(spark, d, "ourlads_players").select("row_id", tx.match_key(name).alias("plain_key"), tx.match_key(name, accents=True).alias("folded_key"))


_SPACED = _sql_squeeze(f"regexp_replace(regexp_replace(replace(lower(strip_accents({_N})), '-', ' '), '\\b(jr|sr|ii|iii|iv)\\b\\.?', '', 'g'), '[^a-z ]', '', 'g')")
_LOOSE = _sql_squeeze(f"regexp_replace(regexp_replace(lower({_N}), '\\b(jr|sr|ii|iii|iv)\\b\\.?', '', 'g'), '[^a-z ]', '', 'g')")
_GLUED = f"regexp_replace(regexp_replace(lower(strip_accents({_N})), '\\b(jr|sr|ii|iii|iv|v)\\b\\.?', '', 'g'), '[^a-z0-9]', '', 'g')"
_REVIEW = _sql_squeeze(f"regexp_replace(regexp_replace(regexp_replace(lower(strip_accents({_N})), '[.''`\\-]', '', 'g'), '\\b(jr|sr|ii|iii|iv|v)\\b', '', 'g'), '[^a-z ]', '', 'g')")
_ROSTER = _sql_squeeze(f"regexp_replace(regexp_replace(regexp_replace(lower(strip_accents({_N})), '[.''’]', '', 'g'), '[-–]', ' ', 'g'), '\\b(jr|sr|ii|iii|iv)\\b', '', 'g')")


@query(f"SELECT row_id, {_SPACED} AS spaced, {_LOOSE} AS loose, {_GLUED} AS glued, {_REVIEW} AS review, {_ROSTER} AS roster FROM ourlads_players")
def normalize_key_variants(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("name")
    return load(spark, d, "ourlads_players").select(
        "row_id", tx.spaced_key(name).alias("spaced"), tx.loose_key(name).alias("loose"), tx.glued_key(name).alias("glued"),
        tx.review_key(name).alias("review"), tx.roster_key(name).alias("roster"),
    )


@query("SELECT row_id, trim(regexp_replace(regexp_replace(lower(replace(school_text, '''', '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS slug FROM (SELECT row_id, coalesce(college, '') AS school_text FROM player_match)")
def normalize_url_slug(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "player_match").select("row_id", tx.slug(F.col("college")).alias("slug"))


@query("SELECT row_id, strip_accents(name) AS folded FROM ourlads_players")
def fold_accents(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "ourlads_players").select("row_id", tx.fold_accents(F.col("name")).alias("folded"))


@query()
def display_names(spark: SparkSession, d: str) -> DataFrame:
    """Display forms of typed names; compared with plain Python in the tests."""
    name = F.col("name")
    return load(spark, d, "ourlads_players").select("row_id", tx.display_name(name).alias("display"), tx.listed_name(name).alias("listed"), tx.hyphen_head(name).alias("head"))


@query(f"""SELECT a.row_id, list_sort(list_distinct(list_filter(list_transform(string_split(trim(regexp_replace(name, '\\s+', ' ', 'g')), ' '), lambda w: {_sql_match_key('w', True)}), lambda w: w <> ''))) AS words FROM ourlads_players a""")
def token_sets(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "ourlads_players").select("row_id", tx.token_set(F.col("name")).alias("words"))


@query("""SELECT DISTINCT a.p_name AS a, b.p_name AS b FROM part a JOIN part b ON split_part(a.p_name, ' ', 1) = split_part(b.p_name, ' ', 2) AND split_part(a.p_name, ' ', 2) = split_part(b.p_name, ' ', 1) WHERE a.p_name < b.p_name""")
def token_set_equal(spark: SparkSession, d: str) -> DataFrame:
    """Names with the same words in another order: distinct names meet on their sorted words."""
    names = load(spark, d, "part").select("p_name").distinct().withColumn("w", F.array_join(tx.token_set(F.col("p_name")), " "))
    a, b = names.alias("a"), names.alias("b")
    return a.join(b, (F.col("a.w") == F.col("b.w")) & (F.col("a.p_name") < F.col("b.p_name"))).select(F.col("a.p_name").alias("a"), F.col("b.p_name").alias("b"))


@query("""SELECT row_id, CASE WHEN regexp_full_match(t, '-?\\d+') THEN CAST(t AS BIGINT) END AS dollars, CAST(CAST(floor(madden / 2) AS BIGINT) AS VARCHAR) || '%' AS shown, CAST(floor(madden / 2) AS DOUBLE) AS pct,
depth * 1.0 / nullif(jersey, 0) AS fraction FROM (SELECT *, regexp_replace(trim(cap_number), '[$,]', '', 'g') AS t FROM player_match)""")
def parse_money_pct_frac(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "player_match")
    shown = F.concat(F.floor(F.col("madden") / 2).cast("string"), F.lit("%"))
    fraction = F.concat_ws("/", F.when(F.col("jersey").isNotNull(), F.col("depth")).cast("string"), F.when(F.col("depth").isNotNull(), F.col("jersey")).cast("string"))
    return rows.select("row_id", ps.money(F.col("cap_number")).alias("dollars"), shown.alias("shown"), ps.percent(shown).alias("pct"), F.when(F.col("depth").isNotNull() & F.col("jersey").isNotNull(), ps.fraction_value(fraction)).alias("fraction"))


@query("""SELECT row_id, CASE WHEN regexp_full_match(attainment, '\\d\\d/[1-7]\\*?') THEN 2000 + CAST(substr(attainment, 1, 2) AS INT) END AS draft_year,
CASE WHEN regexp_full_match(attainment, '\\d\\d/[1-7]\\*?') THEN CAST(substr(attainment, 4, 1) AS INT) END AS draft_round, CASE WHEN attainment LIKE '%/%' THEN split_part(attainment, '/', 2) END AS last_part FROM ourlads_players""")
def parse_attainment(spark: SparkSession, d: str) -> DataFrame:
    parsed = ps.attainment(F.col("attainment"))
    return load(spark, d, "ourlads_players").select("row_id", parsed["year"].alias("draft_year"), parsed["round"].alias("draft_round"), ps.after_mark(F.col("attainment"), "/").alias("last_part"))


@query("""SELECT board_no, snapshot_no, prospect_id, CASE WHEN regexp_full_match(height, '\\d{4}') THEN round(CAST(height[1] AS INT) * 12 + CAST(height[2:3] AS INT) + CAST(height[4] AS INT) / 10, 1) END AS inches FROM (SELECT DISTINCT board_no, snapshot_no, prospect_id, height FROM draft_prospects)""")
def parse_height_code(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "draft_prospects").select("board_no", "snapshot_no", "prospect_id", "height").distinct()
    return rows.select("board_no", "snapshot_no", "prospect_id", ps.height_code(F.col("height")).alias("inches"))


@query("""SELECT gsis_id, season, team, height // 12 || '''' || height % 12 || '"' AS feet, height // 12 || '-' || height % 12 AS dashed FROM (SELECT DISTINCT gsis_id, season, team, height FROM nflreadpy_rosters)""")
def format_height(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "nflreadpy_rosters").select("gsis_id", "season", "team", "height").distinct()
    return rows.select("gsis_id", "season", "team", ps.height_text(F.col("height")).alias("feet"), ps.height_text(F.col("height"), "-", "").alias("dashed"))


@query("SELECT c_custkey, CAST(regexp_extract(c_name, '#(\\d+)', 1) AS BIGINT) AS number FROM customer")
def regex_extract_id(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "customer").select("c_custkey", ps.digits_in(F.col("c_name"), r"#(\d+)").alias("number"))


@query("""SELECT o_orderkey, CAST(CASE WHEN month(o_orderdate) >= 9 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INT) AS autumn_season, CAST(CASE WHEN month(o_orderdate) >= 3 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS INT) AS spring_season,
CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate) || '-' || right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2) ELSE (year(o_orderdate) - 1) || '-' || right(CAST(year(o_orderdate) AS VARCHAR), 2) END AS label FROM orders""")
def season_and_label(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return load(spark, d, "orders").select(
        "o_orderkey", dt.season_started(day, 9).alias("autumn_season"), dt.season_started(day, 3).alias("spring_season"), dt.season_label(dt.season_ended(day)).alias("label")
    )


@query("""SELECT gsis_id, season, team, CAST(date_sub('year', birth_date, DATE '2025-09-01') AS INT) AS age, CAST(CASE WHEN season IS NOT NULL AND entry_year IS NOT NULL THEN greatest(0, season - entry_year) END AS INT) AS years_pro
FROM (SELECT DISTINCT gsis_id, season, team, birth_date, entry_year FROM nflreadpy_rosters)""")
def age_and_years_pro(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "nflreadpy_rosters").select("gsis_id", "season", "team", "birth_date", "entry_year").distinct()
    return rows.select("gsis_id", "season", "team", dt.age_on(F.col("birth_date"), F.lit("2025-09-01").cast("date")).alias("age"), dt.years_in(F.col("season"), F.col("entry_year")).cast("int").alias("years_pro"))


@query("""SELECT l_suppkey, l_returnflag, CASE WHEN count(*) >= 20 THEN round(100 * sum(l_tax) / nullif(sum(l_quantity), 0), 6) END AS per_hundred, CASE WHEN count(*) >= 10 THEN round(100 * sum(l_discount) / nullif(sum(l_tax), 0), 6) END AS ratio FROM lineitem GROUP BY 1, 2""")
def gated_rates(spark: SparkSession, d: str) -> DataFrame:
    sums = load(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_tax").alias("t"), F.sum("l_quantity").alias("q"), F.sum("l_discount").alias("c"), F.count(F.lit(1)).alias("n"))
    return sums.select("l_suppkey", "l_returnflag", mx.gated(F.round(mx.rate(F.col("t"), F.col("q")), 6), F.col("n"), 20).alias("per_hundred"), mx.gated(F.round(mx.rate(F.col("c"), F.col("t")), 6), F.col("n"), 10).alias("ratio"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal >= 7000 THEN 'starter' WHEN c_acctbal >= 2000 THEN 'rotation' ELSE 'bench' END AS tier, greatest(least(c_acctbal, 5000), 0) AS clamped, CASE WHEN c_acctbal = 0 THEN NULL ELSE c_acctbal END AS known FROM customer""")
def tier_thresholds(spark: SparkSession, d: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return load(spark, d, "customer").select("c_custkey", mx.tier(balance, [(7000, "starter"), (2000, "rotation")], "bench").alias("tier"), mx.clamped(balance, 0.0, 5000.0).alias("clamped"), mx.zero_as_missing(balance).alias("known"))


@query("""WITH s AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'A' THEN l_discount END) AS a, max(CASE WHEN l_returnflag = 'R' THEN l_discount END) AS r, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS f, sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS o FROM lineitem GROUP BY 1)
SELECT l_orderkey, round_even(greatest(a, r) * 100, 1) AS best, CASE WHEN f + o = 0 THEN 0.5 ELSE round(f / (f + o), 6) END AS share FROM s""")
def shares_and_maxima(spark: SparkSession, d: str) -> DataFrame:
    best = lambda flag: F.max(F.when(F.col("l_returnflag") == flag, F.col("l_discount")))
    held = lambda status: F.sum(F.when(F.col("l_linestatus") == status, F.col("l_quantity")).otherwise(0))
    s = load(spark, d, "lineitem").groupBy("l_orderkey").agg(best("A").alias("a"), best("R").alias("r"), held("F").alias("f"), held("O").alias("o"))
    return s.select("l_orderkey", mx.best_share(F.col("a"), F.col("r")).alias("best"), F.round(mx.two_way_share(F.col("f"), F.col("o")), 6).alias("share"))


@query("""SELECT p_brand, CAST(pick AS INT) AS pick, round(greatest(least(88 - 6 * ln(pick) + avg_size / 10, 88), 40), 4) AS value FROM (SELECT p_brand, avg(p_size) AS avg_size FROM part GROUP BY 1), (SELECT unnest(range(1, 258)) AS pick)""")
def generated_grid_clamped(spark: SparkSession, d: str) -> DataFrame:
    groups = load(spark, d, "part").groupBy("p_brand").agg(F.avg("p_size").alias("avg_size"))
    grid = groups.withColumn("pick", F.explode(F.sequence(F.lit(1), F.lit(257))))
    return grid.select("p_brand", "pick", F.round(mx.clamped(88 - 6 * F.log("pick") + F.col("avg_size") / 10, 40.0, 88.0), 4).alias("value"))


@query("""SELECT o_custkey, CAST(list_sum(list_transform(past, lambda x: x.v)) AS DOUBLE) AS later_total, len(past) AS later, len(list_filter(past, lambda x: x.y = 1998)) AS this_season FROM (
SELECT o_custkey, list_filter(seasons, lambda x: x.y >= 1998) AS past FROM (SELECT o_custkey, list({'y': y, 'v': v} ORDER BY y) AS seasons FROM (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS v FROM orders GROUP BY 1, 2) GROUP BY 1))""")
def season_history_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Roll-up over a nested season history: filter, count and sum of the seasons from 1998 on."""
    seasons = load(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("v"))
    nested = seasons.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("y", "v"))).alias("seasons"))
    past = F.filter("seasons", lambda s: s["y"] >= 1998)
    total = F.aggregate(past, F.lit(0).cast("double"), lambda a, s: a + s["v"])
    return nested.select("o_custkey", F.when(F.size(past) > 0, total).alias("later_total"), F.size(past).cast("long").alias("later"), F.size(F.filter(past, lambda s: s["y"] == 1998)).cast("long").alias("this_season"))


@query("""SELECT row_id, CASE WHEN madden_pos_label IN ('LT', 'LG', 'RG', 'RT', 'C') THEN madden_pos_label WHEN standard_pos IN ('OL', 'DI', 'EDGE') THEN 'line' WHEN standard_pos IN ('QB', 'RB') THEN 'backfield' END AS position,
CASE WHEN depth BETWEEN 1 AND 98 AND depth IN (1, 2, 3) THEN ['starter', 'rotation', 'bench'][depth] WHEN madden IS NOT NULL THEN CASE WHEN madden >= 75 THEN 'starter' ELSE 'bench' END END AS role,
CASE WHEN depth IN (1, 2, 3) THEN 'depth_chart' WHEN madden IS NOT NULL THEN 'minutes' END AS role_source, coalesce(depth, 99) AS depth_filled FROM player_match""")
def source_precedence(spark: SparkSession, d: str) -> DataFrame:
    groups = {"OL": "line", "DI": "line", "EDGE": "line", "QB": "backfield", "RB": "backfield"}
    rows = load(spark, d, "player_match")
    by_rating = F.when(F.col("madden").isNotNull(), mx.tier(F.col("madden"), [(75, "starter")], "bench"))
    role = cf.rotation(F.col("depth"), by_rating, {1: "starter", 2: "rotation", 3: "bench"})
    position = cf.granular_position(F.col("madden_pos_label"), F.col("standard_pos"), groups, ["LT", "LG", "RG", "RT", "C"])
    return rows.select("row_id", position.alias("position"), role["value"].alias("role"), role["source"].alias("role_source"), F.coalesce("depth", F.lit(99)).alias("depth_filled"))


@query("""SELECT row_id, coalesce(CASE base_defense WHEN '4-3' THEN CASE ourlads_pos WHEN 'LDE' THEN 'EDGE' WHEN 'RDE' THEN 'EDGE' WHEN 'WLB' THEN 'LB' END WHEN '3-4' THEN CASE ourlads_pos WHEN 'LDE' THEN 'DI' WHEN 'NT' THEN 'DI' WHEN 'WLB' THEN 'EDGE' END END,
CASE ourlads_pos WHEN 'LDE' THEN 'EDGE' WHEN 'RDE' THEN 'EDGE' WHEN 'WLB' THEN 'LB' END, CASE ourlads_pos WHEN 'LDE' THEN 'DI' WHEN 'NT' THEN 'DI' WHEN 'WLB' THEN 'EDGE' END) AS scheme_pos FROM ourlads_players""")
def scheme_slots(spark: SparkSession, d: str) -> DataFrame:
    tables = {"4-3": {"LDE": "EDGE", "RDE": "EDGE", "WLB": "LB"}, "3-4": {"LDE": "DI", "NT": "DI", "WLB": "EDGE"}}
    return load(spark, d, "ourlads_players").select("row_id", cf.scheme_slot(F.col("ourlads_pos"), F.col("base_defense"), tables).alias("scheme_pos"))


_PLAIN = _sql_match_key("full_name", True)
_OWN = _sql_match_key("canonical_name", True)


@query(f"""WITH c AS (SELECT gsis_id AS id, {_PLAIN} AS k, team FROM nflreadpy_rosters), s AS (SELECT row_id, {_OWN} AS k, team FROM player_match),
t1 AS (SELECT k, team, min(id) AS id FROM c WHERE k <> '' GROUP BY 1, 2 HAVING count(DISTINCT id) = 1), t2 AS (SELECT k, min(id) AS id FROM c WHERE k <> '' GROUP BY 1 HAVING count(DISTINCT id) = 1)
SELECT row_id, coalesce(t1.id, t2.id) AS matched_id, CASE WHEN t1.id IS NOT NULL THEN 'name_team' WHEN t2.id IS NOT NULL THEN 'name_only' END AS match_source
FROM s LEFT JOIN t1 ON s.k = t1.k AND s.team = t1.team LEFT JOIN t2 ON s.k = t2.k""")
def resolve_waterfall(spark: SparkSession, d: str) -> DataFrame:
    """Match rows resolved against the rosters by name and team, then by a name that only one id has."""
    spine = load(spark, d, "player_match").select("row_id", "team", tx.match_key(F.col("canonical_name"), accents=True).alias("k"))
    cards = load(spark, d, "nflreadpy_rosters").select("gsis_id", "team", tx.match_key(F.col("full_name"), accents=True).alias("k"))
    both = F.when(F.col("k") != "", F.struct("k", "team"))
    both = F.when(F.col("team").isNotNull(), both)
    name = F.nullif(F.col("k"), F.lit(""))
    tiers = [rs.Tier("name_team", both, both), rs.Tier("name_only", name, name)]
    return rs.resolve_tiers(spine, cards, "gsis_id", tiers).select("row_id", "matched_id", "match_source")


_SET = "list_sort(list_distinct(list_filter(list_transform(" + _WORDS.format(x="coalesce({x}, '')") + ", lambda w: " + _sql_match_key("w", True) + "), lambda w: w <> '')))"


@query(f"""WITH s AS (SELECT row_id, team, {_SET.replace('{x}', 'canonical_name')} AS w FROM player_match WHERE team IS NOT NULL), c AS (SELECT DISTINCT gsis_id, team, {_SET.replace('{x}', 'full_name')} AS w FROM nflreadpy_rosters),
p AS (SELECT row_id, gsis_id FROM s JOIN c ON s.team = c.team AND len(list_filter(list_intersect(s.w, c.w), lambda x: length(x) >= 4)) >= 1 AND (len(list_filter(list_intersect(s.w, c.w), lambda x: length(x) >= 4)) >= 2 OR s.w = c.w))
SELECT row_id, min(gsis_id) AS gsis_id FROM p GROUP BY 1 HAVING count(DISTINCT gsis_id) = 1""")
def resolve_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Match rows and rosters of one team that share two words, or all, and whose partner is unique."""
    spine = load(spark, d, "player_match").select("row_id", "team", tx.token_set(F.col("canonical_name")).alias("words")).where(F.col("team").isNotNull())
    cards = load(spark, d, "nflreadpy_rosters").select(F.xxhash64("gsis_id").alias("card"), "gsis_id", "team", tx.token_set(F.col("full_name")).alias("words"))
    people = cards.select("card", "team", "words").distinct()
    pairs = rs.token_candidates(spine, "row_id", "words", people, "card", "words", ["team"])
    unique = rs.unique_match(pairs.where("shared >= 2 OR equal"), "s", "c")
    ids = cards.select("card", "gsis_id").distinct()
    return unique.join(ids.hint("merge"), F.col("c") == F.col("card")).select(F.col("s").alias("row_id"), "gsis_id")


#: Standard positions that each roster position may stand for.
STANDARD = {
    "QB": "QB", "RB": "RB", "HB": "RB", "FB": "RB", "WR": "WR", "TE": "TE", "OL": "OL", "OT": "OL", "T": "OL", "G": "OL", "C": "OL",
    "DT": "DI DEF", "NT": "DI DEF", "DL": "DI DEF", "DE": "EDGE DEF", "EDGE": "EDGE DEF", "OLB": "EDGE LB DEF", "LB": "LB DEF",
    "ILB": "LB DEF", "MLB": "LB DEF", "CB": "CB DEF", "DB": "CB S DEF", "S": "S DEF", "SS": "S DEF", "FS": "S DEF",
}


_STANDARD_SQL = "CASE position " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STANDARD.items()) + " END"
_SP = lambda x: _SPACED.replace("coalesce(name, '')", f"coalesce({x}, '')")


def similar_sql(names: str, others: str, least: float) -> str:
    """SQL of (b, x, y, score) for two tables (b, name): all pairs of a block within the bound by length, subsequence bit by bit."""
    side = lambda t: f"(SELECT DISTINCT b, name, array_to_string(list_sort(string_split(name, ' ')), ' ') AS k FROM {t} WHERE name <> '')"
    masks = "map_from_entries(list_transform(list_distinct(string_split(k, '')), lambda c: struct_pack(key := c, value := CAST(list_sum(list_transform(range(length(k)), lambda i: CASE WHEN k[i + 1] = c THEN CAST(1 AS BIGINT) << i ELSE 0 END)) AS BIGINT))))"
    state = "list_reduce(list_prepend(f, list_transform(string_split(l, ''), lambda c: coalesce(m[c], 0))), lambda s, h: ((s + (s & h)) | (s - (s & h))) & f)"
    return f"""(SELECT b, x, y, score FROM (SELECT b, x, y, 200.0 * (length(k) - bit_count({state})) / (length(k) + length(l)) AS score FROM (
  SELECT p.b, p.name AS x, q.name AS y, p.k, q.k AS l, p.m, (CAST(1 AS BIGINT) << length(p.k)) - 1 AS f
  FROM (SELECT *, {masks} AS m FROM {side(names)}) p JOIN {side(others)} q USING (b)
  WHERE 200.0 * least(length(p.k), length(q.k)) / (length(p.k) + length(q.k)) >= {least})) WHERE score >= {least})"""


_FUZZY = f"""WITH s AS (SELECT row_id, standard_pos AS b, team, {_SP('canonical_name')} AS name FROM player_match),
c AS (SELECT DISTINCT CAST(substr(gsis_id, 4, 8) AS BIGINT) AS card, unnest(string_split({_STANDARD_SQL}, ' ')) AS b, team, {_SP('full_name')} AS name FROM nflreadpy_rosters),
p AS (SELECT s.row_id, c.card, z.score, s.team = c.team AS own FROM s JOIN {similar_sql('s', 'c', 80)} z ON s.b = z.b AND s.name = z.x JOIN c ON c.b = z.b AND c.name = z.y),
a AS (SELECT row_id, max((score, -card)) AS t, max((score, -card)) FILTER (own) AS o FROM p GROUP BY 1)"""


@query(_FUZZY + " SELECT row_id, -(CASE WHEN t[1] >= 95 THEN t ELSE o END)[2] AS card, round((CASE WHEN t[1] >= 95 THEN t ELSE o END)[1], 4) AS score FROM a WHERE t[1] >= 95 OR o IS NOT NULL")
def lcs_ratio_block(spark: SparkSession, d: str) -> DataFrame:
    """Best roster name for every match row by the ratio of sorted words, within the position."""
    spine = load(spark, d, "player_match").select("row_id", F.col("standard_pos").alias("pos"), "team", tx.spaced_key(F.col("canonical_name")).alias("name"))
    cards = load(spark, d, "nflreadpy_rosters").select(
        F.substring("gsis_id", 4, 8).cast("long").alias("card"), F.explode(F.split(tx.mapped(F.col("position"), STANDARD), " ")).alias("pos"), "team", tx.spaced_key(F.col("full_name")).alias("name")
    )
    found = rs.fuzzy_in_block(spine.where("name <> ''"), "row_id", "name", cards.where("name <> ''").distinct(), "card", "name", "pos", "team")
    return found.withColumn("score", F.round("score", 4))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS "props.k", value AS "payload.value", event_type AS "payload.type" FROM events""")
def json_props_flatten(spark: SparkSession, d: str) -> DataFrame:
    nested = load(spark, d, "events").select("event_id", F.from_json("props", "k long").alias("props"), F.struct(F.col("value"), F.col("event_type").alias("type")).alias("payload"))
    return docs.flatten(nested)


@query("""SELECT row_id, CAST(json_extract_string(stats_json, '$.TCK') AS INT) AS tackles, len(json_keys(stats_json)) AS keys FROM ourlads_players""")
def json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    stats = F.from_json("stats_json", "map<string,string>")
    again = F.from_json(F.to_json(stats), "map<string,string>")
    return load(spark, d, "ourlads_players").select("row_id", F.try_element_at(again, F.lit("TCK")).try_cast("int").alias("tackles"), F.when(again.isNotNull(), F.size(again)).cast("long").alias("keys"))


@query("""SELECT CAST(row_number() OVER (ORDER BY doc_no, ourlads_pos, row_id) - 1 AS BIGINT) AS row_id, team, abbr, ourlads_pos, name, depth FROM ourlads_players""")
def team_documents_unnest(spark: SparkSession, d: str) -> DataFrame:
    """Team documents as they are delivered (a map of slots to arrays of players), unnested again with row numbers."""
    rows = load(spark, d, "ourlads_players")
    carried = ["name", "depth", "injured", "attainment", "standard_slot", "standard_pos", "cap_number", "stats_json", "stats_season"]
    player = F.struct(*carried)
    slots = rows.groupBy("doc_no", "team", "abbr", "source", "base_defense", "ourlads_pos").agg(F.sort_array(F.collect_list(F.struct("row_id", player.alias("p")))).alias("players"))
    opened = lambda x: F.struct(*[x["p"][c].alias(c) for c in carried if c != "stats_json"], F.from_json(x["p"]["stats_json"], "map<string,string>").alias("stats"))
    slots = slots.withColumn("players", F.transform("players", opened))
    charts = slots.groupBy("doc_no", "team", "abbr", "source").agg(
        F.max("base_defense").alias("base_defense"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("ourlads_pos", "players")), lambda a, b: F.when(a["ourlads_pos"] < b["ourlads_pos"], -1).otherwise(1))).alias("depth_chart")
    )
    return docs.unnest_charts(charts, ["doc_no"]).select("row_id", "team", "abbr", "ourlads_pos", "name", "depth")


@query("SELECT l_orderkey, CAST(l_linenumber AS INT) AS l_linenumber, l_quantity FROM lineitem")
def map_array_unnest(spark: SparkSession, d: str) -> DataFrame:
    """Lines nested as an array per order and unnested again."""
    nested = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("lines"))
    return nested.select("l_orderkey", F.explode("lines").alias("l")).select("l_orderkey", F.col("l.l_linenumber").cast("int").alias("l_linenumber"), "l.l_quantity")


@query("""SELECT l_orderkey, min_by(l_partkey, (l_linenumber, l_partkey)) AS first_part, len(list_distinct(list(l_returnflag))) AS flags, count(*) AS lines FROM lineitem GROUP BY 1""")
def array_zip_first_wins(spark: SparkSession, d: str) -> DataFrame:
    """Parallel arrays zipped; the first occurrence of a label wins."""
    both = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))).alias("a"))
    parts, flags = F.transform("a", lambda x: x["l_partkey"]), F.transform("a", lambda x: x["l_returnflag"])
    zipped = F.arrays_zip(parts.alias("part"), flags.alias("flag"))
    return both.select("l_orderkey", F.get(zipped, F.lit(0))["part"].alias("first_part"), F.size(F.array_distinct(flags)).cast("long").alias("flags"), F.size(zipped).cast("long").alias("lines"))


@query("""SELECT p_brand, round(regr_slope(p_retailprice, ln(p_size)), 6) AS slope, round(regr_intercept(p_retailprice, ln(p_size)), 4) AS intercept, round(regr_r2(p_retailprice, ln(p_size)), 6) AS r2, count(*) AS n FROM part WHERE p_size > 0 GROUP BY 1""")
def simple_regression(spark: SparkSession, d: str) -> DataFrame:
    y, x = F.col("p_retailprice"), F.log("p_size")
    return load(spark, d, "part").where("p_size > 0").groupBy("p_brand").agg(
        F.round(F.regr_slope(y, x), 6).alias("slope"), F.round(F.regr_intercept(y, x), 4).alias("intercept"), F.round(F.regr_r2(y, x), 6).alias("r2"), F.count(F.lit(1)).alias("n")
    )


@query("""SELECT round(sum(l_quantity * l_quantity), 2) AS qq, round(sum(l_quantity * l_discount), 2) AS qd, round(sum(l_discount * l_discount), 4) AS dd, round(sum(l_quantity * l_extendedprice), 0) AS qy, round(sum(l_discount * l_extendedprice), 0) AS dy, count(*) AS n FROM lineitem""")
def gram_matrix(spark: SparkSession, d: str) -> DataFrame:
    matrix, by, _, _, n = rg.gram(load(spark, d, "lineitem"), [F.col("l_quantity"), F.col("l_discount")], F.col("l_extendedprice"))
    row = [(round(float(matrix[0, 0]), 2), round(float(matrix[0, 1]), 2), round(float(matrix[1, 1]), 4), round(float(by[0]), 0), round(float(by[1]), 0), int(n))]
    return spark.createDataFrame(row, "qq double, qd double, dd double, qy double, dy double, n long")


@query()
def curve_models(spark: SparkSession, d: str) -> DataFrame:
    """Rating on draft position: shared, own and ridge slopes per position, their errors and leave-one-out errors."""
    rows = load(spark, d, "nflreadpy_rosters").where("draft_number > 0").join(
        load(spark, d, "player_match").where("madden BETWEEN 1 AND 99 AND gsis_id IS NOT NULL").groupBy("gsis_id").agg(F.max("madden").alias("madden"), F.max("standard_pos").alias("pos")), "gsis_id"
    )
    rows = cut_lineage(rows.select("gsis_id", "season", "team", F.col("draft_number").alias("pick"), "madden", "pos").distinct())
    groups = [r["pos"] for r in rows.select("pos").distinct().orderBy("pos").collect()]
    parts = lambda slopes: rg.design(groups, F.col("pos"), F.col("season") == 2024, F.col("pick"), slopes)
    target = F.col("madden").cast("double")
    shared, own = rg.fit(rows, parts("shared"), target), rg.fit(rows, parts("own"), target)
    ridge = rg.fit(rows, parts("both"), target, [0.0] * (len(groups) + 2) + [20.0] * len(groups))
    f, p = rg.nested_f(shared, own)
    out = None
    for name, model, slopes in (("shared", shared, "shared"), ("own", own, "own"), ("ridge", ridge, "both")):
        scored = rg.residuals(rows, parts(slopes), target, model)
        one = scored.agg(rg.rmse("residual").alias("rmse"), rg.rmse("loo_residual").alias("loo_rmse"), rg.rmse("loo_residual", F.col("pick") <= 32).alias("loo_rmse_top"))
        one = one.select(F.lit(name).alias("model"), F.lit(int(model.n)).cast("long").alias("n"), F.lit(float(model.r2)).alias("r2"), F.lit(float(f)).alias("f"), F.lit(float(p)).alias("p"), "rmse", "loo_rmse", "loo_rmse_top")
        out = one if out is None else out.unionByName(one)
    return out


@query("""SELECT team AS key, 0 AS table_no, CAST(r AS INT) AS row_no, cells FROM (SELECT team, row_number() OVER (PARTITION BY team ORDER BY gsis_id) - 1 AS r, [gsis_id, CAST(n AS VARCHAR)] AS cells FROM (SELECT team, gsis_id, count(*) AS n FROM nflreadpy_rosters GROUP BY 1, 2))""")
def html_table_rows(spark: SparkSession, d: str) -> DataFrame:
    """Pages with one table per team, read back as rows of cells."""
    counted = load(spark, d, "nflreadpy_rosters").groupBy("team", "gsis_id").agg(F.count(F.lit(1)).alias("n"))
    line = F.concat(F.lit("<tr><td><a href='/id/"), "gsis_id", F.lit("'>"), "gsis_id", F.lit("</a></td><td> "), F.col("n").cast("string"), F.lit("</td></tr>"))
    pages = counted.groupBy(F.col("team").alias("key")).agg(F.concat(F.lit("<html><!-- <table>"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("gsis_id", line.alias("t")))), lambda x: x["t"]), "\n"), F.lit("</table> --></html>")).alias("page"))
    return table_rows(pages, "key", "page").drop("links")


@query("""SELECT date_trunc('hour', ts) AS window_start, event_type AS kind, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def stream_hourly_events(spark: SparkSession, d: str) -> DataFrame:
    """Extension: the events as a stream of files, counted by hour and kind."""
    schema = load(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{d}/events.parquet*")
    counted = run_available(spark, windowed_counts(stream, "ts", "event_type", "value"))
    return counted.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "kind", "events", F.round("total", 4).alias("total"))
