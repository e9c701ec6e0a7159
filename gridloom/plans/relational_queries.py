"""Queries for scans, joins, aggregations, windows, orders and set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions import metrics as mx
from gridloom.functions import text as tx
from gridloom.operators import intervals as iv
from gridloom.operators import quality as qg
from gridloom.operators import relational as rel
from gridloom.session import load

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


@query("""SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_quantity IS NOT NULL AND NOT (l_discount = 0)""")
def scan_filter_project(spark: SparkSession, d: str) -> DataFrame:
    kept = (F.col("l_returnflag").isin("A", "R")) & (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return load(spark, d, "lineitem").where(kept & F.col("l_quantity").isNotNull() & ~(F.col("l_discount") == 0)).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("""SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' END AS label,
CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE l_returnflag END AS label_or_self FROM lineitem""")
def map_lookup_default_self(spark: SparkSession, d: str) -> DataFrame:
    labels = {"A": "accepted", "R": "returned"}
    flag = F.col("l_returnflag")
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", tx.mapped(flag, labels).alias("label"), tx.mapped(flag, labels, default=flag).alias("label_or_self"))


@query("""WITH aliased AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END AS lookup FROM customer)
SELECT c_custkey, lookup, lookup IS NOT NULL AS may_match FROM aliased""")
def alias_null_forces_nomatch(spark: SparkSession, d: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    lookup = tx.mapped(segment, {"BUILDING": "construction", "MACHINERY": None}, default=segment)
    return load(spark, d, "customer").select("c_custkey", lookup.alias("lookup"), lookup.isNotNull().alias("may_match"))


@query("""WITH o AS (SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS f, max(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS o FROM orders GROUP BY 1)
SELECT c_custkey, n_name, r_name, CASE WHEN f = 1 AND o = 1 THEN 'both' WHEN f = 1 THEN 'finished' WHEN o = 1 THEN 'open' ELSE 'none' END AS provenance
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN o ON c_custkey = o_custkey""")
def spine_left_joins(spark: SparkSession, d: str) -> DataFrame:
    by_status = load(spark, d, "orders").groupBy("o_custkey").agg(
        F.max(F.col("o_orderstatus") == "F").alias("f"), F.max(F.col("o_orderstatus") == "O").alias("o")
    )
    spine = load(spark, d, "customer").join(load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    spine = spine.join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    spine = spine.join(by_status, F.col("c_custkey") == F.col("o_custkey"), "left")
    provenance = F.when(F.col("f") & F.col("o"), "both").when(F.col("f"), "finished").when(F.col("o"), "open").otherwise("none")
    return spine.select("c_custkey", "n_name", "r_name", provenance.alias("provenance"))


@query("""SELECT c_mktsegment AS segment, CAST(sum(CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') THEN 1 ELSE 0 END) AS BIGINT) AS active, count(*) AS customers
FROM customer GROUP BY 1 ORDER BY 2 DESC""")
def exists_or_exists(spark: SparkSession, d: str) -> DataFrame:
    # both EXISTS read one table: one semi-join key set serves them
    seen = load(spark, d, "orders").where(F.col("o_orderstatus").isin("F", "P")).select("o_custkey").distinct().withColumn("hit", F.lit(1))
    joined = load(spark, d, "customer").join(seen, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.sum(F.coalesce("hit", F.lit(0))).alias("active"), F.count(F.lit(1)).alias("customers")).orderBy(F.desc("active"))


@query("""SELECT c_custkey, event_id, event_type, value FROM customer LEFT JOIN (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) ON user_id = c_custkey""")
def last_row_wins_join(spark: SparkSession, d: str) -> DataFrame:
    last = rel.keep_last(load(spark, d, "events"), ["user_id"], ["ts", "event_id"])
    return load(spark, d, "customer").join(last, F.col("c_custkey") == F.col("user_id"), "left").select("c_custkey", "event_id", "event_type", "value")


@query("""SELECT o_custkey, CAST(max(CASE WHEN i = 0 THEN n END) AS BIGINT) AS orders, max(CASE WHEN i = 0 THEN total END) AS total,
CAST(max(CASE WHEN i = 1 THEN n END) AS BIGINT) AS prev_orders, max(CASE WHEN i = 1 THEN total END) AS prev_total
FROM (SELECT o_custkey, 1998 - year(o_orderdate) AS i, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE year(o_orderdate) IN (1997, 1998) GROUP BY 1, 2) GROUP BY 1""")
def two_season_pivot(spark: SparkSession, d: str) -> DataFrame:
    orders = load(spark, d, "orders").withColumn("i", 1998 - F.year("o_orderdate")).where(F.col("i").isin(0, 1))
    seasons = orders.groupBy("o_custkey", "i").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return rel.season_pivot(seasons, ["o_custkey"], "i", ["orders", "total"])


@query("""WITH a AS (SELECT l_suppkey, sum(l_quantity) AS qa FROM lineitem WHERE l_returnflag = 'A' AND l_discount > 0.05 GROUP BY 1),
r AS (SELECT l_suppkey, sum(l_quantity) AS qr FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.05 GROUP BY 1)
SELECT coalesce(a.l_suppkey, r.l_suppkey) AS suppkey, coalesce(qa, 0) + coalesce(qr, 0) AS total, round(qr / nullif(qa, 0) * 100, 4) AS returned_rate
FROM a FULL JOIN r ON a.l_suppkey = r.l_suppkey""")
def full_outer_rates(spark: SparkSession, d: str) -> DataFrame:
    lines = load(spark, d, "lineitem").where(F.col("l_discount") > 0.05)
    one = lambda flag, name: lines.where(F.col("l_returnflag") == flag).groupBy(F.col("l_suppkey").alias(f"k{name}")).agg(F.sum("l_quantity").alias(name))
    joined = one("A", "qa").join(one("R", "qr"), F.col("kqa") == F.col("kqr"), "full_outer")
    return joined.select(F.coalesce("kqa", "kqr").alias("suppkey"), mx.plus(F.col("qa"), F.col("qr")).alias("total"), F.round(mx.rate(F.col("qr"), F.col("qa")), 4).alias("returned_rate"))


@query("""WITH c AS (SELECT nullif(c_nationkey, 0) AS k, count(*) AS customers FROM customer GROUP BY 1), s AS (SELECT nullif(s_nationkey, 0) AS k, count(*) AS suppliers FROM supplier GROUP BY 1)
SELECT coalesce(c.k, s.k) AS nationkey, customers, suppliers FROM c FULL JOIN s ON c.k IS NOT DISTINCT FROM s.k""")
def full_outer_nullsafe(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "customer").groupBy(F.nullif("c_nationkey", F.lit(0)).alias("ck")).agg(F.count(F.lit(1)).alias("customers"))
    s = load(spark, d, "supplier").groupBy(F.nullif("s_nationkey", F.lit(0)).alias("sk")).agg(F.count(F.lit(1)).alias("suppliers"))
    return c.join(s, F.col("ck").eqNullSafe(F.col("sk")), "full_outer").select(F.coalesce("ck", "sk").alias("nationkey"), "customers", "suppliers")


@query("""WITH ends AS (SELECT p_brand, sum(n) OVER (ORDER BY p_brand) AS range_end, n FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1))
SELECT p_partkey, e.p_brand AS range_brand, CAST(range_end AS BIGINT) AS range_end FROM part LEFT JOIN ends e ON p_partkey BETWEEN range_end - n + 1 AND range_end""")
def range_lookup_round(spark: SparkSession, d: str) -> DataFrame:
    parts = load(spark, d, "part")
    ranges = rel.cumulative_ends(parts.groupBy(F.col("p_brand").alias("range_brand")).agg(F.count(F.lit(1)).alias("n")), "n", "range_brand")
    return iv.range_lookup(parts.select("p_partkey"), "p_partkey", ranges, "range_start", "range_end", 1000.0).select("p_partkey", "range_brand", "range_end")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_unmatched(spark: SparkSession, d: str) -> DataFrame:
    customers = load(spark, d, "customer")
    return customers.join(load(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("""WITH b AS (SELECT s_suppkey AS k, s_acctbal AS lo, s_acctbal + 10 AS hi FROM supplier) SELECT a.k AS a, b.k AS b FROM b a JOIN b ON a.k < b.k AND a.lo <= b.hi AND b.lo <= a.hi""")
def theta_overlap_pairs(spark: SparkSession, d: str) -> DataFrame:
    boxes = load(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("lo"), (F.col("s_acctbal") + 10).alias("hi"))
    return iv.overlap_pairs(boxes, "k", "lo", "hi", 10.0)


@query("""SELECT l_suppkey, round(avg(l_quantity), 6) AS avg_quantity, round(avg(l_extendedprice), 4) AS avg_price FROM lineitem WHERE coalesce(l_quantity, 0) + coalesce(l_discount, 0) > 2 GROUP BY 1""")
def played_week_avg(spark: SparkSession, d: str) -> DataFrame:
    played = load(spark, d, "lineitem").where(mx.plus(F.col("l_quantity"), F.col("l_discount")) > 2)
    return played.groupBy("l_suppkey").agg(F.round(F.avg("l_quantity"), 6).alias("avg_quantity"), F.round(F.avg("l_extendedprice"), 4).alias("avg_price"))


@query("""SELECT user_id, round(avg(value), 6) AS avg_value, round(avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END), 6) AS success_rate
FROM events WHERE (event_type = 'purchase' OR event_type = 'click') AND user_id IS NOT NULL GROUP BY 1""")
def rate_and_success(spark: SparkSession, d: str) -> DataFrame:
    tried = load(spark, d, "events").where(((F.col("event_type") == "purchase") | (F.col("event_type") == "click")) & F.col("user_id").isNotNull())
    return tried.groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("avg_value"), F.round(F.avg((F.col("event_type") == "purchase").cast("double")), 6).alias("success_rate"))


@query("SELECT user_id, event_type, count(*) AS n FROM events WHERE event_type IN ('error', 'click') GROUP BY 1, 2")
def group_count_typed(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "events").where(F.col("event_type").isin("error", "click")).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT max(n) AS most, count(*) AS distinct_keys FROM (SELECT k, count(*) AS n FROM (SELECT user_id AS k FROM events UNION ALL SELECT o_custkey FROM orders) WHERE k IS NOT NULL GROUP BY 1)")
def union_value_counts_max(spark: SparkSession, d: str) -> DataFrame:
    both = load(spark, d, "events").select(F.col("user_id").alias("k")).unionByName(load(spark, d, "orders").select(F.col("o_custkey").alias("k")))
    return both.where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("distinct_keys"))


@query("""SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'P') DESC, o_orderdate, o_orderkey) = 1""")
def prefer_aggregate_row(spark: SparkSession, d: str) -> DataFrame:
    picked = rel.prefer_row(load(spark, d, "orders"), ["o_custkey"], F.col("o_orderstatus").rlike("^P$"), [F.col("o_orderdate"), F.col("o_orderkey")])
    return picked.select("o_custkey", "o_orderkey", "o_orderstatus")


@query("""SELECT l_partkey, min_by(l_orderkey, (l_orderkey, l_linenumber)) AS first_order, max_by(l_orderkey, (l_orderkey, l_linenumber)) AS last_order FROM lineitem GROUP BY 1""")
def keep_first_keep_last(spark: SparkSession, d: str) -> DataFrame:
    ends = rel.first_and_last(load(spark, d, "lineitem"), ["l_partkey"], ["l_orderkey", "l_linenumber"], ["l_orderkey"])
    return ends.withColumnsRenamed({"first_l_orderkey": "first_order", "last_l_orderkey": "last_order"})


@query("SELECT user_id, event_id, event_type, value FROM events WHERE value > 50 AND event_type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_informative(spark: SparkSession, d: str) -> DataFrame:
    said = (F.col("value") > 50) & F.col("event_type").isNotNull()
    return rel.latest_informative(load(spark, d, "events"), ["user_id"], said, ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1")
def latest_strict_first_tie(spark: SparkSession, d: str) -> DataFrame:
    picked = rel.pick_row(load(spark, d, "orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()])
    return picked.select("o_custkey", "o_orderkey", "o_orderdate")


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY 1, 2)
SELECT user_id, max(CASE WHEN r = 1 THEN event_type END) AS modal, max(CASE WHEN r = 1 THEN n END) AS n1, coalesce(max(CASE WHEN r = 2 THEN n END), 0) AS n2,
max(CASE WHEN r = 1 THEN n END) >= 4 AND max(CASE WHEN r = 1 THEN n END) - coalesce(max(CASE WHEN r = 2 THEN n END), 0) >= 3 AS confident FROM c WHERE r <= 2 GROUP BY 1""")
def mode_runner_up(spark: SparkSession, d: str) -> DataFrame:
    return rel.modes(load(spark, d, "events"), ["user_id"], "event_type").withColumn("confident", mx.modal_confidence(F.col("n1"), F.col("n2")))


@query("""WITH r AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS w, count(*) FILTER (o_orderstatus = 'O') AS l, count(*) FILTER (o_orderstatus = 'P') AS t FROM orders GROUP BY 1)
SELECT round(CASE WHEN w + l + t > 0 THEN (w + t * 0.5) / (w + l + t) ELSE 0.5 END, 6) AS win_share, count(*) AS customers FROM r GROUP BY 1""")
def group_by_rounded_ratio(spark: SparkSession, d: str) -> DataFrame:
    n = lambda s, a: F.sum((F.col("o_orderstatus") == s).cast("long")).alias(a)
    records = load(spark, d, "orders").groupBy("o_custkey").agg(n("F", "w"), n("O", "l"), n("P", "t"))
    return records.groupBy(F.round(mx.win_share(F.col("w"), F.col("l"), F.col("t")), 6).alias("win_share")).agg(F.count(F.lit(1)).alias("customers"))


@query("""SELECT coalesce(match_source, 'unmatched') AS match_source, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM player_match GROUP BY 1""")
def source_tally_rate(spark: SparkSession, d: str) -> DataFrame:
    return qg.source_tally(load(spark, d, "player_match"), "match_source").withColumn("share", F.round("share", 6))


@query("SELECT o_orderpriority AS label, year(o_orderdate) AS season, count(*) AS n FROM orders GROUP BY 1, 2")
def label_by_year_pivot(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("label"), F.year("o_orderdate").cast("long").alias("season")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p_partkey, p_brand, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS INT) AS group_rank, count(*) OVER (PARTITION BY p_brand) AS group_total FROM part""")
def position_rank_total(spark: SparkSession, d: str) -> DataFrame:
    return rel.position_ranks(load(spark, d, "part"), "p_brand", "p_retailprice", "p_partkey").select("p_partkey", "p_brand", "group_rank", "group_total")


@query("""SELECT doc_no, name, row_id, ourlads_pos, depth FROM ourlads_players QUALIFY row_number() OVER (PARTITION BY doc_no, name
ORDER BY coalesce(injured, false), CASE WHEN NOT coalesce(injured, false) THEN depth END NULLS LAST, row_id) = 1""")
def starter_dedupe(spark: SparkSession, d: str) -> DataFrame:
    best = rel.healthy_first(load(spark, d, "ourlads_players"), ["doc_no", "name"], F.col("injured"), F.col("depth"), "row_id")
    return best.select("doc_no", "name", "row_id", "ourlads_pos", "depth")


@query("""SELECT o_orderkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS so_far_F, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS so_far_O,
CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS so_far_P FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)""")
def running_record(spark: SparkSession, d: str) -> DataFrame:
    run = rel.running_record(load(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus", ["F", "O", "P"])
    return run.select("o_orderkey", "so_far_F", "so_far_O", "so_far_P")


@query("""SELECT p_brand, p_partkey, p_retailprice, before AS value_before FROM (SELECT *, lag(p_retailprice) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS before FROM part) WHERE p_retailprice > before""")
def monotone_check(spark: SparkSession, d: str) -> DataFrame:
    return rel.rising_steps(load(spark, d, "part"), ["p_brand"], ["p_partkey"], "p_retailprice").select("p_brand", "p_partkey", "p_retailprice", "value_before")


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase,
CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS place FROM events""")
def fill_down_sections(spark: SparkSession, d: str) -> DataFrame:
    events = load(spark, d, "events").withColumn("purchase", F.when(F.col("event_type") == "purchase", F.col("value")))
    filled = rel.fill_down(events, ["user_id"], ["ts", "event_id"], "purchase", "last_purchase")
    return rel.running_index(filled, ["user_id"], ["ts", "event_id"], "place").select("event_id", "last_purchase", "place")


@query("""WITH s AS (SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g') AS slug FROM part)
SELECT p_partkey, CASE WHEN row_number() OVER w = 1 THEN slug ELSE slug || '-' || row_number() OVER w END AS unique_slug FROM s WINDOW w AS (PARTITION BY slug ORDER BY p_partkey)""")
def suffix_dedupe(spark: SparkSession, d: str) -> DataFrame:
    slugs = load(spark, d, "part").select("p_partkey", tx.slug(F.col("p_name")).alias("slug"))
    return rel.with_suffixes(slugs, "slug", ["p_partkey"], "unique_slug").select("p_partkey", "unique_slug")


@query("""WITH claims AS (SELECT event_id, user_id, CAST(floor(value) AS BIGINT) AS prize FROM events),
own AS (SELECT * FROM claims QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)
SELECT user_id, prize, event_id FROM own QUALIFY row_number() OVER (PARTITION BY prize ORDER BY event_id) = 1""")
def first_claim_wins(spark: SparkSession, d: str) -> DataFrame:
    claims = load(spark, d, "events").select("event_id", "user_id", F.floor("value").alias("prize"))
    return rel.first_claims(claims, ["prize"], "user_id", ["event_id"]).select("user_id", "prize", "event_id")


@query("""SELECT p_partkey, [1.0, 0.6, 0.35, 0.2][least(row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey), 4)]::DOUBLE AS factor FROM part""")
def repeat_factor(spark: SparkSession, d: str) -> DataFrame:
    return rel.diminishing(load(spark, d, "part"), ["p_brand", "p_type"], ["p_partkey"], [1.0, 0.6, 0.35, 0.2], "factor").select("p_partkey", "factor")


@query("""SELECT board_no, snapshot_no, prospect_id, CAST(row_number() OVER (PARTITION BY board_no, snapshot_no ORDER BY consensus_rank NULLS LAST, ras_score NULLS LAST, name NULLS LAST, prospect_id) AS INT) AS place
FROM (SELECT DISTINCT board_no, snapshot_no, prospect_id, name, consensus_rank, ras_score FROM draft_prospects)""")
def nulls_last_order(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "draft_prospects").select("board_no", "snapshot_no", "prospect_id", "name", "consensus_rank", "ras_score").distinct()
    return rel.nulls_last_rank(rows, ["consensus_rank", "ras_score", "name", "prospect_id"], "place", ["board_no", "snapshot_no"]).select("board_no", "snapshot_no", "prospect_id", "place")


@query("SELECT p_brand, p_partkey, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) <= 2")
def topk_per_group(spark: SparkSession, d: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey"))
    return load(spark, d, "part").withColumn("r", rank).where("r <= 2").select("p_brand", "p_partkey", "p_retailprice")


@query("""WITH o AS (SELECT DISTINCT o_custkey AS k FROM orders), c AS (SELECT DISTINCT c_custkey AS k FROM customer)
SELECT coalesce(o.k, c.k) AS k, CASE WHEN o.k IS NULL THEN 'right_only' WHEN c.k IS NULL THEN 'left_only' ELSE 'both' END AS side FROM o FULL JOIN c ON o.k = c.k""")
def set_ops_keys(spark: SparkSession, d: str) -> DataFrame:
    return rel.key_sets(load(spark, d, "orders").select(F.col("o_custkey").alias("k")), load(spark, d, "customer").select(F.col("c_custkey").alias("k")), "k")


@query("""SELECT c_custkey, c_name, c_nationkey, 'fresh' AS origin FROM customer WHERE c_nationkey IN (3, 7) UNION ALL
SELECT c_custkey, c_name, c_nationkey, 'previous' FROM customer WHERE c_nationkey NOT IN (3, 7)""")
def union_with_priority(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    fresh = rows.where(F.col("c_nationkey").isin(3, 7)).withColumn("origin", F.lit("fresh"))
    return rel.prefer_side(fresh, rows.withColumn("origin", F.lit("previous")), ["c_nationkey"])


@query("""WITH o AS (SELECT p_partkey AS k, p_retailprice AS m, p_size AS a FROM part WHERE p_size > 2), n AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 7 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS m, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size END AS a FROM part WHERE p_size < 49)
SELECT count(*) FILTER (o.k IS NOT NULL AND n.k IS NOT NULL AND o.m IS DISTINCT FROM n.m) AS main_changed, count(*) FILTER (o.k IS NOT NULL AND n.k IS NOT NULL AND o.a IS DISTINCT FROM n.a) AS others_changed,
count(*) FILTER (o.k IS NULL) AS added, count(*) FILTER (n.k IS NULL) AS removed FROM o FULL JOIN n ON o.k = n.k""")
def keyed_snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    parts, key = load(spark, d, "part"), F.col("p_partkey")
    old = parts.where("p_size > 2").select("p_partkey", "p_retailprice", "p_size")
    new = parts.where("p_size < 49").select(
        "p_partkey", F.when(key % 7 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("p_retailprice"), F.when(key % 11 != 0, F.col("p_size")).alias("p_size")
    )
    return rel.keyed_diff(old, new, "p_partkey", "p_retailprice", ["p_size"])


@query("""SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(sha256(concat_ws(chr(31), coalesce(CAST(n_nationkey AS VARCHAR), chr(0)), coalesce(n_name, chr(0)))), 1, 15) AS HUGEINT)) AS VARCHAR) AS digest FROM nation""")
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    return rel.table_digest(load(spark, d, "nation"), ["n_nationkey", "n_name"])


@query("""SELECT count(*) AS rows, count(DISTINCT abbr) AS groups, round(avg(CASE WHEN source LIKE '%Our%' THEN 1.0 ELSE 0.0 END), 6) AS marker_share, count(DISTINCT source) AS distinct_values,
CAST(2 - count(DISTINCT CASE WHEN abbr IN ('SF', 'ZEN') THEN abbr END) AS INT) AS missing_groups, count(row_id) - count(DISTINCT row_id) AS duplicate_keys,
count(*) >= 10 AS enough_rows, count(DISTINCT abbr) >= 2 AS enough_groups, avg(CASE WHEN source LIKE '%Our%' THEN 1.0 ELSE 0.0 END) >= 0.95 AS marked, count(DISTINCT source) = 1 AS one_value,
count(DISTINCT CASE WHEN abbr IN ('SF', 'ZEN') THEN abbr END) = 2 AS all_groups, count(row_id) = count(DISTINCT row_id) AS unique_keys,
count(*) >= 10 AND count(DISTINCT abbr) >= 2 AND avg(CASE WHEN source LIKE '%Our%' THEN 1.0 ELSE 0.0 END) >= 0.95 AND count(DISTINCT source) = 1
AND count(DISTINCT CASE WHEN abbr IN ('SF', 'ZEN') THEN abbr END) = 2 AND count(row_id) = count(DISTINCT row_id) AS accept FROM ourlads_players""")
def quality_gate_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "ourlads_players")
    row = qg.measures(rows, "abbr", "row_id", F.col("source").contains("Our"), "source", ["SF", "ZEN"])
    return qg.verdicts(row.withColumn("marker_share", F.round("marker_share", 6)), qg.floor_rows(None, 10), 2)


@query("""SELECT abbr, CASE WHEN f THEN 'fresh' WHEN p THEN 'stale' ELSE 'missing' END AS state, CASE WHEN f THEN nf WHEN p THEN np ELSE 0 END AS rows FROM (
SELECT abbr, count(*) FILTER (season >= 2020) > 0 AS f, count(*) FILTER (season < 2020 AND season >= 2010) > 0 AS p, count(*) FILTER (season >= 2020) AS nf, count(*) FILTER (season < 2020 AND season >= 2010) AS np FROM ourlads_players GROUP BY 1)""")
def stale_carry_over(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "ourlads_players").select("abbr", "season", "row_id")
    kept, states = qg.carry_over(rows.where("season >= 2020"), rows.where("season < 2020 AND season >= 2010"), rows, "abbr")
    counted = kept.groupBy("abbr").agg(F.count(F.lit(1)).alias("rows"))
    return states.join(counted, "abbr", "left").select("abbr", "state", F.coalesce("rows", F.lit(0)).alias("rows"))


@query("""SELECT o_custkey, bool_and(o_orderstatus <> 'P') AS all_settled, bool_or(o_totalprice > 200000) AS any_large,
CASE WHEN max(o_orderdate) FILTER (o_orderstatus = 'F') IS NOT NULL AND max(o_orderdate) FILTER (o_orderstatus = 'O') IS NOT NULL
THEN least(max(o_orderdate) FILTER (o_orderstatus = 'F'), max(o_orderdate) FILTER (o_orderstatus = 'O')) END AS both_until FROM orders GROUP BY 1""")
def quantifiers_and_conservative_max(spark: SparkSession, d: str) -> DataFrame:
    last = lambda s: F.max(F.when(F.col("o_orderstatus") == s, F.col("o_orderdate")))
    grouped = load(spark, d, "orders").groupBy("o_custkey").agg(
        F.every(F.col("o_orderstatus") != "P").alias("all_settled"), F.some(F.col("o_totalprice") > 200000).alias("any_large"), last("F").alias("f"), last("O").alias("o")
    )
    both = F.when(F.col("f").isNotNull() & F.col("o").isNotNull(), F.least("f", "o"))
    return grouped.select("o_custkey", "all_settled", "any_large", both.alias("both_until"))


@query("SELECT count(DISTINCT team) AS teams, c.name FROM (SELECT DISTINCT abbr AS team, name FROM ourlads_players) c GROUP BY c.name HAVING count(DISTINCT team) > 1")
def duplicate_names(spark: SparkSession, d: str) -> DataFrame:
    """Names on more than one team: those for which a league-wide match is not safe."""
    return load(spark, d, "ourlads_players").groupBy("name").agg(F.count_distinct("abbr").alias("teams")).where("teams > 1")


@query("""SELECT row_id, row_number() OVER (PARTITION BY madden_pos_label ORDER BY madden DESC, row_id) IS NOT NULL AS ranked, loaded_at FROM player_match WHERE madden_pos_label IS NOT NULL AND madden IS NOT NULL
AND loaded_at > (SELECT max(loaded_at) - INTERVAL 60 DAY FROM player_match)""")
def refetch_latest(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the latest 60 days: the part that an incremental refresh reads again."""
    rows = load(spark, d, "player_match").where("madden_pos_label IS NOT NULL AND madden IS NOT NULL")
    latest = load(spark, d, "player_match").agg(F.max("loaded_at").alias("latest")).first()["latest"]
    recent = F.col("loaded_at") > F.lit(latest).cast("timestamp_ntz") - F.expr("INTERVAL 60 DAYS")
    return rows.where(recent).select("row_id", F.lit(True).alias("ranked"), "loaded_at")
