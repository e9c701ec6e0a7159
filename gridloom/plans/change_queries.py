"""Queries on full snapshots: what changed (problem 3) and attribute history (problem 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.history import attribute_history
from gridloom.operators.snapshots import change_totals, number_snapshots, snapshot_changes
from gridloom.session import load

BOARD_VALUES = [
    "name", "position", "school", "height", "weight", "forty_yard_dash", "ras_score", "consensus_rank",
]
RATING_VALUES = ["team", "madden", "depth"]


def _board_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    boards = load(spark, sf_dir, "draft_prospects")
    return snapshot_changes(boards, "board_no", "snapshot_no", "prospect_id", BOARD_VALUES, "loaded_at")


def _rating_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = load(spark, sf_dir, "player_snapshots")
    return snapshot_changes(feeds, "feed_no", "snapshot_date", "player_key", RATING_VALUES, "delivered_at")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record added, removed or changed on draft boards and rating feeds."""

    def named(changes: DataFrame, table: str, snapshot) -> DataFrame:
        return changes.select(
            F.lit(table).alias("tbl"), F.col("feed").alias("feed_no"), snapshot.alias("snapshot"),
            "record_key", "change_kind",
        )

    boards = named(_board_changes(spark, sf_dir), "draft_prospects", F.col("snapshot").cast("string"))
    day = F.date_format("snapshot", "yyyy-MM-dd")
    return boards.unionByName(named(_rating_changes(spark, sf_dir), "player_snapshots", day))


def p3_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per snapshot the changes found, and whether the sidecar's claimed date and hash agree with them."""
    boards = load(spark, sf_dir, "draft_prospects")
    totals = change_totals(_board_changes(spark, sf_dir), number_snapshots(boards, "board_no", "snapshot_no"))
    meta = load(spark, sf_dir, "draft_meta").select(
        F.col("board_no").alias("m_feed"), F.col("snapshot_no").alias("m_snap"),
        (F.substring("fetched_at", 1, 10) == F.col("board_last_changed")).alias("claims_change"),
    )
    board = totals.join(meta, (F.col("feed") == F.col("m_feed")) & (F.col("snapshot") == F.col("m_snap")), "left")
    board = board.select(F.lit("draft_prospects").alias("tbl"), "feed", F.col("snapshot").cast("string").alias("snapshot"), "snapshot_index", "added", "removed", "changed", "claims_change")

    feeds = load(spark, sf_dir, "player_snapshots")
    totals = change_totals(_rating_changes(spark, sf_dir), number_snapshots(feeds, "feed_no", "snapshot_date"))
    meta = load(spark, sf_dir, "ratings_meta").select(
        F.col("feed_no").alias("m_feed"), F.col("snapshot_date").alias("m_snap"),
        (F.date_format("snapshot_date", "yyyy-MM-dd") == F.col("ratings_last_changed")).alias("claims_change"),
    )
    feed = totals.join(meta, (F.col("feed") == F.col("m_feed")) & (F.col("snapshot") == F.col("m_snap")), "left")
    feed = feed.select(F.lit("player_snapshots").alias("tbl"), "feed", F.date_format("snapshot", "yyyy-MM-dd").alias("snapshot"), "snapshot_index", "added", "removed", "changed", "claims_change")
    found = (F.col("added") + F.col("removed") + F.col("changed")) > 0
    # a first snapshot has nothing before it, so its claim can't be judged
    agrees = F.when(F.col("snapshot_index") > 1, F.col("claims_change") == found)
    return board.unionByName(feed).select(
        "tbl", F.col("feed").alias("feed_no"), "snapshot", "added", "removed", "changed", "claims_change",
        agrees.alias("claim_agrees"),
    )


def p7_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of team, madden and depth of a player with the dates between which it held."""
    feeds = load(spark, sf_dir, "player_snapshots")
    versions = attribute_history(feeds, "feed_no", "snapshot_date", "player_key", RATING_VALUES, "delivered_at")
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return versions.select(
        F.col("feed").alias("feed_no"), F.col("record_key").alias("player_key"), *RATING_VALUES,
        day("valid_from"), day("valid_to"), "is_current",
    )


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First date of each version."""
    return p7_history(spark, sf_dir).select("player_key", "valid_from")


QUERIES = {"p3_found": p3_found, "p3_claims": p3_claims, "p7_found": p7_found, "p7_history": p7_history}

_CHANGES = """
WITH latest AS (
  SELECT * FROM (
    SELECT {feed} AS feed, {snap} AS snap, {key} AS k, [{values}] AS v,
           row_number() OVER (PARTITION BY {feed}, {snap}, {key} ORDER BY {latest} DESC NULLS LAST) AS rn
    FROM {table} WHERE {snap} IS NOT NULL) WHERE rn = 1),
steps AS (
  SELECT feed, snap, lag(snap) OVER (PARTITION BY feed ORDER BY snap) AS before
  FROM (SELECT DISTINCT feed, snap FROM latest)),
now_rows AS (SELECT s.feed, s.snap, l.k, l.v FROM steps s JOIN latest l USING (feed, snap) WHERE s.before IS NOT NULL),
old_rows AS (SELECT s.feed, s.snap, l.k, l.v FROM steps s JOIN latest l ON l.feed = s.feed AND l.snap = s.before)
SELECT '{table}' AS tbl, coalesce(n.feed, o.feed) AS feed_no, {text} AS snapshot,
       coalesce(n.k, o.k) AS record_key,
       CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM now_rows n FULL JOIN old_rows o ON n.feed = o.feed AND n.snap = o.snap AND n.k = o.k
WHERE n.v IS DISTINCT FROM o.v
"""
_BOARDS = _CHANGES.format(
    feed="board_no", snap="snapshot_no", key="prospect_id", latest="loaded_at", table="draft_prospects",
    values=", ".join(f"CAST({c} AS VARCHAR)" for c in BOARD_VALUES),
    text="CAST(coalesce(n.snap, o.snap) AS VARCHAR)",
)
_RATINGS = _CHANGES.format(
    feed="feed_no", snap="snapshot_date", key="player_key", latest="delivered_at", table="player_snapshots",
    values="team, CAST(madden AS VARCHAR), CAST(depth AS VARCHAR)",
    text="strftime(coalesce(n.snap, o.snap), '%Y-%m-%d')",
)
_FOUND = f"SELECT * FROM ({_BOARDS}) UNION ALL SELECT * FROM ({_RATINGS})"

_CLAIMS = f"""
WITH found AS ({_FOUND}),
steps AS (
  SELECT 'draft_prospects' AS tbl, board_no AS feed_no, CAST(snapshot_no AS VARCHAR) AS snapshot,
         row_number() OVER (PARTITION BY board_no ORDER BY snapshot_no) AS i
  FROM (SELECT DISTINCT board_no, snapshot_no FROM draft_prospects)
  UNION ALL
  SELECT 'player_snapshots', feed_no, strftime(snapshot_date, '%Y-%m-%d'),
         row_number() OVER (PARTITION BY feed_no ORDER BY snapshot_date)
  FROM (SELECT DISTINCT feed_no, snapshot_date FROM player_snapshots)),
claims AS (
  SELECT 'draft_prospects' AS tbl, board_no AS feed_no, CAST(snapshot_no AS VARCHAR) AS snapshot,
         substr(fetched_at, 1, 10) = board_last_changed AS claims_change FROM draft_meta
  UNION ALL
  SELECT 'player_snapshots', feed_no, strftime(snapshot_date, '%Y-%m-%d'),
         strftime(snapshot_date, '%Y-%m-%d') = ratings_last_changed FROM ratings_meta),
counted AS (
  SELECT tbl, feed_no, snapshot, count(*) FILTER (change_kind = 'added') AS added,
         count(*) FILTER (change_kind = 'removed') AS removed,
         count(*) FILTER (change_kind = 'changed') AS changed
  FROM found GROUP BY 1, 2, 3)
SELECT s.tbl, s.feed_no, s.snapshot, coalesce(added, 0) AS added, coalesce(removed, 0) AS removed,
       coalesce(changed, 0) AS changed, claims_change,
       CASE WHEN i > 1 THEN claims_change = (added IS NOT NULL) END AS claim_agrees
FROM steps s LEFT JOIN counted USING (tbl, feed_no, snapshot) LEFT JOIN claims USING (tbl, feed_no, snapshot)
"""

_HISTORY = """
WITH latest AS (
  SELECT * FROM (
    SELECT feed_no, snapshot_date, player_key, team, madden, depth,
           row_number() OVER (PARTITION BY feed_no, snapshot_date, player_key ORDER BY delivered_at DESC) AS rn
    FROM player_snapshots) WHERE rn = 1),
steps AS (
  SELECT feed_no, snapshot_date, row_number() OVER (PARTITION BY feed_no ORDER BY snapshot_date) AS i,
         lead(snapshot_date) OVER (PARTITION BY feed_no ORDER BY snapshot_date) AS following
  FROM (SELECT DISTINCT feed_no, snapshot_date FROM player_snapshots)),
rows AS (SELECT l.*, s.i, s.following FROM latest l JOIN steps s USING (feed_no, snapshot_date)),
marked AS (
  SELECT *, CASE WHEN lag(i) OVER w = i - 1 AND lag(team) OVER w IS NOT DISTINCT FROM team
                  AND lag(madden) OVER w IS NOT DISTINCT FROM madden
                  AND lag(depth) OVER w IS NOT DISTINCT FROM depth THEN 0 ELSE 1 END AS starts
  FROM rows WINDOW w AS (PARTITION BY feed_no, player_key ORDER BY i)),
runs AS (SELECT *, sum(starts) OVER (PARTITION BY feed_no, player_key ORDER BY i) AS run FROM marked)
SELECT feed_no, player_key, any_value(team) AS team, any_value(madden) AS madden, any_value(depth) AS depth,
       strftime(min(snapshot_date), '%Y-%m-%d') AS valid_from,
       strftime(arg_max_null(following, i), '%Y-%m-%d') AS valid_to, arg_max_null(following, i) IS NULL AS is_current
FROM runs GROUP BY feed_no, player_key, run
"""

ORACLE = {
    "p3_found": _FOUND,
    "p3_claims": _CLAIMS,
    "p7_history": _HISTORY,
    "p7_found": f"SELECT player_key, valid_from FROM ({_HISTORY})",
}
