"""Named resolvers and slot owners on the cases that their rules are about."""

from pyspark.sql import functions as F

from gridloom.operators import leagues as lg
from gridloom.operators import relational as rel
from gridloom.operators import resolve as rs
from gridloom.operators import standings as st
from tests.conftest import rows

SPINE = "sid int, name string, team string, grp string"
CARDS = "card int, name string, team string, position string, ord int"


def tables(spark, spine, cards):
    return spark.createDataFrame(spine, SPINE), spark.createDataFrame(cards, CARDS)


def found(df):
    return {r["sid"]: (r["card"], r["match_source"]) for r in df.collect()}


def test_find_cards(spark):
    spine, cards = tables(
        spark,
        [(1, "Justin Jefferson", "MIN", "WR"), (2, "Josh Hines-Allen", "JAX", "EDGE"), (3, "Justin Jefferson", "NYG", "WR"), (4, "Will Moved", "DAL", "QB"), (5, None, "DAL", "QB"), (6, "Pat Stone", "SF", "CB")],
        [(10, "Justin Jefferson", "MIN", "WR", 1), (11, "Justin Jefferson", "CLE", "LB", 2), (12, "Josh Hines Allen Jr.", "JAX", "LE", 3), (13, "Will Moved", "LV", "QB", 4), (14, "Patrick Stone", "SF", "CB", 5)],
    )
    got = found(lg.find_cards(spine, cards, {"Pat Stone": "Patrick Stone"}))
    assert got == {1: (10, "team_name"), 2: (12, "team_name"), 3: (None, None), 4: (13, "league_name"), 5: (None, None), 6: (14, "team_name")}


def test_five_tiers(spark):
    spine, cards = tables(
        spark,
        [(1, "Erling Haaland", "MCI", "FWD"), (2, "Gabriel dos Santos Magalhães", "ARS", "DEF"), (3, "Mitoma Kaoru", "BHA", "MID"), (4, "Emiliano Martinez Romero", "CHE", "GKP"), (5, "Forced Out", "X", "MID"), (6, "Twin Name", "A", "MID")],
        [
            (10, "Erling Haaland", "MCI", "ST", 1), (11, "Gabriel dos S. Magalhães", "ARS", "CB", 2), (12, "Kaoru Mitoma", "BHA", "LM", 3), (13, "Emiliano Martinez", "AVL", "GK", 4),
            (14, "Forced Out", "X", "CM", 5), (15, "Twin Name", "B", "CM", 6), (16, "Twin Name", "C", "CM", 7), (13, "E. Martinez", "AVL", "GK", 8),
        ],
    )
    got = found(lg.five_tiers(spine, cards, {"GK": "GKP", "ST": "FWD", "CB": "DEF", "LM": "MID FWD", "CM": "MID"}, {"Forced Out": None}))
    assert got == {1: (10, "name_team"), 2: (11, "token_overlap"), 3: (12, "token_set_swap"), 4: (13, "league_token"), 5: (None, None), 6: (None, None)}


def test_ids_look_up_only_rows_without_a_card(spark, monkeypatch):
    spine, cards = tables(spark, [(1, "Ana Vandermeer", "A", "WR"), (2, "Bo Stonebridge", "A", "WR"), (3, "Cy Nobody", "A", "WR")], [(10, "Ana Vandermeer", "A", "WR", 1), (11, "Bo Stonebridge", "A", "WR", 2)])
    asked = []
    search = lg.fuzzy_in_block
    monkeypatch.setattr(lg, "fuzzy_in_block", lambda rows, *rest: asked.append(sorted(r["sid"] for r in rows.collect())) or search(rows, *rest))
    got = found(lg.find_ids(spine, [("one", cards.where("card = 10")), ("all", cards)], retry={"WR": "TE"}))
    assert got == {1: (10, "one"), 2: (11, "all"), 3: (None, None)}
    assert asked == [[1, 2, 3], [2, 3], [3], [3]]


def test_legacy_names_compare_the_league_only_from_ninety_on(spark, monkeypatch):
    spine, cards = tables(spark, [(1, "Ana Vandermeer", "A", "WR"), (2, "Bo Stonebridge", "A", "WR"), (3, "Cy Longworth", "A", "WR")], [(10, "Ana Vandermeer", "B", "WR", 1), (11, "Bo Stonebridg", "B", "WR", 2), (12, "Cyd Longwerta", "A", "WR", 3), (13, "Cyd Longwerta", "B", "WR", 4)])
    asked = []
    search = rs.similar_names
    for module in (rs, lg):
        monkeypatch.setattr(module, "similar_names", lambda n, o, least: asked.append((least, sorted(r["x"] for r in n.collect()))) or search(n, o, least), raising=False)
    got = {r["sid"]: (r["card"], r["low_confidence"]) for r in lg.legacy_match(spine, cards).collect()}
    assert got == {1: (10, False), 2: (11, False), 3: (12, True)}
    assert asked == [(90.0, ["bo stonebridge", "cy longworth"]), (80.0, ["cy longworth"])]


def shuffled_rows(spark, df):
    """Rows that a query writes to shuffles."""
    jvm, store = spark.sparkContext._jvm, spark.sparkContext._jsc.sc().statusStore()

    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        none = spark.sparkContext._gateway.new_array(jvm.double, 0)
        stages = store.stageList(jvm.java.util.ArrayList(), False, False, none, jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = written()
    df.collect()
    return written() - before


def common_word(spark):
    """Different first names and one last name: as many pairs share a word as there are rows times cards."""
    letters = [f"{a}{b}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"]
    return tables(spark, [(i, f"x{n} Stonebridge", "A", "WR") for i, n in enumerate(letters)], [(i, f"y{n} Stonebridge", "A", "WR", i) for i, n in enumerate(letters)])


def test_five_tiers_multiply_no_common_word(spark):
    df = lg.five_tiers(*common_word(spark), {"WR": "WR"})
    assert shuffled_rows(spark, df) < 20_000
    assert df.where("card IS NOT NULL").count() == 0


def test_four_tiers_multiply_no_common_word(spark):
    df = lg.five_tiers(*common_word(spark), {"WR": "WR"}, league=False)
    assert shuffled_rows(spark, df) < 20_000
    assert df.where("card IS NOT NULL").count() == 0


def test_four_tiers_shuffle_cards_and_names_once(spark, tmp_path):
    """Cards that are made by an exchange are made once, and names are shuffled as hashes; every tenth row has a card."""
    n, letters = 20_000, lambda x: F.translate(F.abs(F.xxhash64(x)).cast("string"), "0123456789", "abcdefghij")
    name = lambda x: F.concat(letters(x), F.lit(" "), letters(-x - 1))
    numbered = spark.range(n).select("id", name(F.col("id")).alias("name"), name(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.col("id") + n)).alias("other"))
    numbered.write.parquet(f"{tmp_path}/names")
    numbered = spark.read.parquet(f"{tmp_path}/names")
    spine = numbered.select(F.col("id").alias("sid"), "name", F.lit("Stonefall Miners").alias("team"), F.lit("WR").alias("grp"))
    cards = numbered.select(F.col("id").alias("card"), F.col("other").alias("name"), F.lit("Stonefall Miners").alias("team"), F.lit("WR").alias("position"), F.col("id").alias("ord"))
    before = shuffle_bytes(spark)
    assert lg.five_tiers(spine, rel.keep_last(cards, ["name"], ["ord"]), {"WR": "WR"}, league=False).where("card = sid AND match_source = 'name_team'").count() == n / 10
    assert shuffle_bytes(spark) - before < 300 * n


def shuffle_bytes(spark):
    """Bytes that the session has written to shuffles."""
    jvm, store = spark.sparkContext._jvm, spark.sparkContext._jsc.sc().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    stages = store.stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_labels_of_misses(spark):
    spine, cards = tables(
        spark,
        [(1, "Christian Encarnacion-Strand", "CIN", "b"), (2, "Al Two", "SD", "b"), (3, "Bo Free", "NYY", "b"), (4, "Cy Else", "NYY", "b"), (5, "Di None", "NYY", "b"), (6, "Nick Alias", "TB", "b")],
        [(10, "Christian Encarnacion", "CIN", "b", 1), (11, "Al Two", "SD", "b", 2), (12, "Al Two", "SD", "b", 3), (13, "Bo Free", "FA", "b", 4), (14, "Cy Else", "BOS", "b", 5), (15, "Nicholas Alias", "TB", "b", 6)],
    )
    got = found(lg.labelled_match(spine, cards, {"nick alias": "nicholas alias"}, "FA", F.col("grp") == F.col("c_position")))
    assert got == {1: (10, "hyphen"), 2: (None, "unmatched_ambiguous"), 3: (13, "fa_name_only"), 4: (None, "unmatched_other_team"), 5: (None, "unmatched_no_name"), 6: (15, "alias")}


def test_keys_initials_and_crosswalks(spark):
    spine, cards = tables(
        spark,
        [(1, "Bub Carr", "A", "g"), (2, "Que Robin", "B", "g"), (3, "Sam Same", "C", "g"), (4, "Zed Zed", None, "g")],
        [(10, "Carl Carr", "A", "g", 1), (11, "Quan Robin", "B", "g", 2), (12, "Sam Same", "D", "g", 3), (13, "Sam Same", "E", "g", 4), (14, "Zed Zed", "Q", "g", 5)],
    )
    assert found(lg.any_key_match(spine, cards, {"Carl Carr": "Bub Carr"})) == {1: (10, "name_team"), 2: (None, None), 3: (None, None), 4: (14, "name_only")}
    carried = spark.createDataFrame([(3, 13)], "sid int, card int")
    assert found(lg.any_key_match(spine, cards, {}, carried))[3] == (13, "carried")
    assert found(lg.initial_tier(spine, cards, ["team"]))[2] == (11, "initial")
    assert found(lg.crosswalk_then_name(spine, carried, cards))[3] == (13, "crosswalk")


def test_school_cards_and_claims(spark):
    spine, cards = tables(
        spark,
        [(1, "Dan Day", "ohio", "CB"), (2, "Lee Ann", "ohio", "QB"), (3, "D. Night", "ohio", "QB")],
        [(10, "Dan Day", "ohio", "CB", 1), (11, "Dan Day", "ohio", "QB", 2), (12, "Ann Lee", "ohio", "QB", 3), (13, "Dirk Night", "ohio", "QB", 4)],
    )
    assert found(lg.school_cards(spine, cards, F.col("grp") == F.col("c_position"))) == {1: (10, "exact"), 2: (12, "token_set"), 3: (13, "initial_lastname")}
    listed = spark.createDataFrame([(1, "Dan Day", "CB"), (2, "Dan Day", "CB"), (3, "Lee Ann", None)], "place int, name string, grp string")
    prospects = spark.createDataFrame([(10, "Dan Day", "CB"), (11, "Dan Day", "QB"), (12, "Lee Ann", "QB")], "card int, name string, grp string")
    assert rows(lg.claim_by_name(listed, prospects), "place", "card") == [(1, 10), (3, 12)]


def test_slot_owners(spark):
    standings = spark.createDataFrame([("a", 0.1), ("b", 0.1), ("c", 0.5), ("d", 0.9)], "team string, share double")
    picks = spark.createDataFrame([(1, 1, "b"), (1, 2, "d"), (1, 3, "c"), (1, 4, "d"), (2, 1, "a")], "round int, slot int, owner string")
    owners = st.standing_owners(picks, standings)
    # slot 2 belongs to the group of a and b, b holds its own: the rest is a's; a short round has no labels
    assert rows(owners, "round", "slot", "original") == [(1, 1, "b"), (1, 2, "a"), (1, 3, "c"), (1, 4, "d"), (2, 1, "a")]
    known = spark.createDataFrame([(1, "d", "c")], "round int, owner string, original string")
    assert rows(st.override_latest(owners, known), "slot", "original")[-1] == (4, "c")
    many = spark.createDataFrame([(r, 1, "a" if r < 6 else "b") for r in range(1, 8)] + [(r, 2, "a") for r in range(1, 4)], "round int, slot int, owner string")
    assert rows(st.modal_owners(many)) == [(1, "a")]


def test_order_problems(spark):
    teams = spark.createDataFrame([("a",), ("b",)], "team string")
    of = lambda *picks: spark.createDataFrame(picks, "pick int, round int, owner string")
    assert st.order_problems(of((1, 1, "a"), (2, 1, "b"), (3, 2, "b")), teams, 2, 2, 4) == []
    assert len(st.order_problems(of((1, 2, "a"), (1, 1, "z"), (9, 1, "a")), teams, 3, 2, 4)) == 5


def test_ids_aliases_and_doubt(spark):
    spine, cards = tables(
        spark,
        [(1, "Pat Stone", "SF", "CB"), (2, "Al Forced", "SF", "CB"), (3, "Guard Man", "SF", "OL"), (4, "Joe Moore", "NYG", "CB"), (5, "Nichol Name", "SF", "CB"), (6, None, "SF", "CB")],
        [(10, "Pat Stone", "SF", "CB", 1), (11, "Al Forced", "SF", "CB", 2), (12, "Guard Man", "SF", "OL", 3), (13, "Joe Moore", "NYG", "S", 4), (14, "Nicholas Name", "SF", "CB", 5)],
    )
    got = found(lg.find_ids(spine, [("rosters", cards)], {"Al Forced": None}, ["OL"], {"CB": "S", "S": "CB"}))
    assert got == {1: (10, "rosters"), 2: (None, None), 3: (None, None), 4: (13, "rosters_retry"), 5: (14, "rosters"), 6: (None, None)}
    with_id = spine.withColumn("id", F.when(F.col("sid") == 2, F.lit("x")))
    contracts = cards.withColumn("id", F.when(F.col("card") == 13, F.lit("x")))
    got = found(lg.id_then_similar(with_id, contracts))
    assert got[2] == (13, "id") and got[5] == (14, "similar") and got[6] == (None, None)
    doubtful = {r["sid"]: (r["card"], r["low_confidence"]) for r in lg.legacy_match(spine, cards).collect()}
    assert doubtful[1] == (10, False) and doubtful[5] == (14, True) and doubtful[6] == (None, False)


def test_alias_then_name_and_ids_without_cards(spark):
    spine, cards = tables(spark, [(1, "Pat Stone", "SF", "CB"), (2, "No Card", "SF", "CB")], [(10, "Pat Stone", "SF", "CB", 1)])
    assert found(lg.find_cards(spine, cards, {"Pat Stone": "Patrick Stone"}))[1] == (10, "team_name")
    ids = spark.createDataFrame([(2, 99)], "sid int, card int")
    assert found(lg.crosswalk_then_name(spine, ids, cards)) == {1: (10, "name_team"), 2: (99, "crosswalk")}


def test_draft_picks_need_one_pick(spark):
    entries = spark.createDataFrame([(1, "Al Two", 2023, 1), (2, "B. One", 2023, 2), (3, "Al Two", None, 1), (4, "Cy Nick", 2023, 3)], "sid int, name string, year int, round int")
    picks = spark.createDataFrame([(1, "Al Two", 2023, 1), (2, "Al Two", 2023, 1), (40, "Bob One", 2023, 2), (70, "Cyrus Nickel", 2023, 3)], "pick int, name string, year int, round int")
    got = {r["sid"]: (r["pick"], r["match_source"]) for r in lg.draft_picks(entries, picks, {"Cy Nick": "Cyrus Nickel"}).collect()}
    assert got == {1: (None, None), 2: (40, "initial"), 3: (None, None), 4: (70, "alias")}


def test_maps_and_totals(spark):
    df = spark.sql("SELECT map('tck', '3', 'TCK', '4', 'X', '0', 'N', null) AS m, array(1.5, null, 2.0) AS a")
    named = df.select(rel.remap_keys("m", {"TCK": "TACKLES"}).alias("m"))
    assert named.first()["m"] == {"TACKLES": "4", "X": "0", "N": None}
    assert named.select(rel.without_zeros("m").alias("m")).first()["m"] == {"TACKLES": "4"}
    assert tuple(rel.total_and_length(df, "a", "t", "n").select("t", "n").first()) == (3.5, 3)
