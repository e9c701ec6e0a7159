"""Column functions against plain Python, with the documented cases."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gridloom.functions import dates as dt
from gridloom.functions import metrics as mx
from gridloom.functions import parse as ps
from gridloom.functions import similarity as sim
from gridloom.functions import text as tx
from gridloom.operators import conflict as cf
from gridloom.operators import resolve as rs
from tests.conftest import rows


def values(spark, inputs, column, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column.alias("v")).collect()]


X = None  # the column "x": columns need a session


@pytest.fixture(autouse=True)
def _column(spark):
    global X
    X = F.col("x")


def test_match_keys(spark):
    names = ["V.J. Edgar", "Will Mcdonald IV", "Luka Dončić", "O'Neal Jr.", None, "", "Ii"]
    assert values(spark, names, tx.match_key(X)) == ["vjedgar", "willmcdonald", "lukadoni", "oneal", "", "", ""]
    assert values(spark, names, tx.match_key(X, accents=True))[2] == "lukadoncic"


def test_spaced_keys_keep_words(spark):
    names = ["Josh Hines-Allen", "Estimé Jr.", "D'Andre  Swift II", None]
    assert values(spark, names, tx.spaced_key(X)) == ["josh hines allen", "estime", "dandre swift", ""]
    assert values(spark, ["Estimé"], tx.loose_key(X)) == ["estim"]
    assert values(spark, ["Kenneth Walker III"], tx.glued_key(X)) == ["kennethwalker"]
    assert values(spark, ["J.J. O'Neil-Smith V"], tx.review_key(X)) == ["jj oneilsmith"]
    assert values(spark, ["Luis García Jr. – X"], tx.roster_key(X)) == ["luis garcia x"]


def plain_display(name):
    name = re.sub(r"\b([A-Z])([A-Z])\b", lambda m: m[0] if m[1] == m[2] or m[0] in ("IV", "VI") else f"{m[1]}.{m[2]}.", name.strip()).title()
    name = re.sub(r"\b(Jr|Sr)\b", r"\1.", re.sub(r"\b(Jr|Sr)\.", r"\1", name))
    return re.sub(r"\b(Ii|Iii|Iv|Vi)\b", lambda m: m[0].upper(), name)


def test_display_names_equal_python(spark):
    names = ["AJ brown", "will mcdonald IV", "TRE' o'neal-smith jr", "KENNETH WALKER III", "d.j. moore sr.", "LL cool", " jean-luc  o'x "]
    assert values(spark, names, tx.display_name(X)) == [plain_display(n) for n in names]


def test_listed_and_split_names(spark):
    assert values(spark, ["SMITH, JOHN 23/1", "Brown, AJ CC/NYG", "doe, jane jr."], tx.listed_name(X)) == ["John Smith", "AJ Brown", "Jane Jr. Doe"]
    assert values(spark, ["Christian Encarnacion-Strand", "No Hyphen", "Solo-Name"], tx.hyphen_head(X)) == ["Christian Encarnacion", None, None]
    assert [tuple(v) if v else None for v in values(spark, ["Quandarrius Robinson Jr.", "Solo"], tx.initial_last(X))] == [("q", "robinson"), None]
    assert [tuple(v) for v in values(spark, ["a b c", "solo"], tx.split_first_space(X))] == [("a", "b c"), ("solo", "")]


def test_codes_slugs_and_formats(spark):
    fixes = {"ARZ": "ARI"}
    assert values(spark, ["ARI/BAL", "ARZ", "Team Long", None], tx.last_segment(X, fixes)) == ["BAL", "ARI", None, ""]
    assert values(spark, ["Ja'Marr Chase--LSU ", None], tx.slug(X)) == ["jamarr-chase-lsu", ""]
    assert values(spark, ["App State", "Ohio St."], tx.school_key(X, {"app state": "appalachian state"})) == ["appalachianstate", "ohiost"]
    assert values(spark, [1262500, None], tx.dollars(X), "long") == ["$1,262,500", None]
    assert values(spark, ["<a href='x'>&"], tx.html_escaped(X)) == ["&lt;a href=&#39;x&#39;&gt;&amp;"]
    assert values(spark, ["https://x", "javascript:1"], tx.https_only(X)) == ["https://x", None]


def test_alias_null_forces_no_match(spark):
    table = {"a": "b", "c": None}
    assert values(spark, ["a", "c", "d", None], tx.mapped(X, table, default=X)) == ["b", None, "d", None]


def test_parsers(spark):
    assert values(spark, ["$1,262,500", "", None, "abc", "-5"], ps.money(X)) == [1262500, None, None, None, -5]
    assert values(spark, ["75%", "x"], ps.percent(X)) == [75.0, None]
    assert values(spark, ["12", "1.2", " 7 "], ps.whole(X)) == [12, None, 7]
    assert [tuple(v) if v else None for v in values(spark, ["23/1", "23/1*", "CC/NYG", None], ps.attainment(X))] == [(2023, 1), (2023, 1), None, None]
    assert values(spark, ["13/15", "31:30", "75%", "4", "1/0"], ps.fraction_value(X)) == [13 / 15, 31.5, 75.0, 4.0, None]
    assert values(spark, ["6040", "604", None], ps.height_code(X)) == [76.0, None, None]
    assert values(spark, [74, 0, None], ps.height_text(X), "int") == ["6'2\"", None, None]
    assert values(spark, ["6-2", "6'2\"", "x"], ps.height_inches(X)) == [74, 74, None]
    assert str(values(spark, ["October 2, 2026", "nonsense"], ps.long_date(X))) == "[datetime.date(2026, 10, 2), None]"
    assert [tuple(v) if v else None for v in values(spark, ["Joe Doe (14)", "OPEN slot", "Ann", "--", None], ps.roster_cell(X))] == [("Joe Doe", 14), None, ("Ann", None), None, None]


def test_season_line(spark):
    text = "2024: Old U | 10 GP | 5 Rec; 2025: Ohio State | 13 GP | 87 Rec | 9 Rec TD; Career: 38 GP"
    found = values(spark, [text, "Career: 3 GP", "", None], ps.season_line(X))
    assert (found[0]["season"], found[0]["school"], found[0]["gp"]) == ("2025", "Ohio State", "13")
    assert [tuple(s) for s in found[0]["stats"]] == [("Rec", "87"), ("Rec TD", "9")]
    assert [tuple(s) for s in found[0]["career"]] == [("GP", "38")] and values(spark, ["2025: Ohio State"], ps.season_line(X))[0]["career"] is None
    assert found[1:] == [None, None, None]


def test_joined_items(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "x array<string>")
    assert [v[0] for v in df.select(tx.join_or_null(X, "/")).collect()] == ["a/b", None, None]


def test_seasons_and_ages(spark):
    day = F.to_date(X)
    assert values(spark, ["2026-08-31", "2026-09-01"], dt.season_started(day, 9)) == [2025, 2026]
    assert values(spark, ["2026-10-01"], dt.season_label(dt.season_ended(day))) == ["2026-27"]
    assert values(spark, ["2000-09-02", "2000-09-01", "2000-02-29"], dt.age_on(day, F.lit("2025-09-01").cast("date"))) == [24, 25, 25]
    assert values(spark, [2026, None, 2020], dt.years_in(X, F.lit(2023)), "int") == [3, None, 0]


def test_manifest_seasons(spark):
    seasons = [(20242025, "2024-10-01", "2025-04-20"), (20252026, "2025-10-01", "2026-04-20"), (20262027, "2026-09-29", "2027-04-20")]
    manifest = spark.createDataFrame(seasons, "id long, starts string, ends string")
    ask = lambda day: tuple(dt.manifest_seasons(manifest, F.lit(day)).first())
    assert ask("2026-01-01") == (20252026, 20252026, 20242025)
    assert ask("2026-07-01") == (20262027, 20252026, 20242025)
    assert ask("2027-07-01") == (20262027, 20262027, 20252026)


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 4.0, 10), (1.0, 0.0, 10), (None, 4.0, 3)], "a double, b double, n int")
    a, b = F.col("a"), F.col("b")
    found = df.select(mx.rate(a, b), mx.gated(b, F.col("n"), 5), mx.plus(a, b), mx.win_share(F.lit(0), F.lit(0), F.lit(0)), mx.two_way_share(b, b)).collect()
    assert [tuple(r) for r in found] == [(25.0, 4.0, 5.0, 0.5, 0.5), (None, 0.0, 1.0, 0.5, 0.5), (None, None, 4.0, 0.5, 0.5)]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def test_subsequence_equals_dynamic_programming():
    r = random.Random(3)
    pairs = [tuple("".join(r.choice("abcd ") for _ in range(r.randrange(12))) for _ in range(2)) for _ in range(200)]
    pairs += [tuple("".join(r.choice("abcdefgh") for _ in range(n)) for n in sizes) for sizes in ((62, 62), (62, 90), (63, 64), (120, 70))]
    expected = [plain_lcs(a, b) for a, b in pairs]
    assert sim.common_subsequences(pairs).tolist() == expected
    assert [sim.common_subsequence(a, b) for a, b in pairs] == expected


def test_similar_names_equal_all_pairs_of_a_block(spark):
    r = random.Random(7)
    words = ["al", "ali", "bo", "x", "stone", "stoneham", "marco", "polo", "li", "lee", "vandermeer", "ab", "abc", "acb"]
    name = lambda: " ".join(r.choice(words)[: r.randrange(1, 11)] for _ in range(r.randrange(1, 3)))
    left, right = ({(r.choice("pq"), name()) for _ in range(120)} for _ in range(2))
    whole = lambda t: " ".join(sorted(t.split()))
    ratio = lambda x, y: 200.0 * plain_lcs(whole(x), whole(y)) / (len(whole(x)) + len(whole(y)))
    for least in (80.0, 95.0):
        wanted = {(b, x, y) for b, x in left for c, y in right if b == c and ratio(x, y) >= least}
        found = rs.similar_names(spark.createDataFrame(sorted(left), "b string, x string"), spark.createDataFrame(sorted(right), "b string, y string"), least)
        assert {tuple(z)[:3] for z in found.select("b", "x", "y").collect()} == wanted and wanted


def test_best_of_block_or_team_compares_only_pairs_that_count(spark, monkeypatch):
    r = random.Random(11)
    words = ["marco", "marko", "polo", "pollo", "stone", "stoneham", "stonehan", "vandermeer", "vandermere", "lee", "li"]
    name = lambda: " ".join(r.choice(words) for _ in range(2))
    spine = [(i, r.choice("pq"), name(), r.choice(["a", "b", None])) for i in range(80)]
    cards = [(i, r.choice("pq"), name(), r.choice(["a", "b", None])) for i in range(60)]
    whole = lambda t: " ".join(sorted(t.split()))
    ratio = lambda x, y: 200.0 * plain_lcs(whole(x), whole(y)) / (len(whole(x)) + len(whole(y)))
    wanted = {}
    for s, b, x, t in spine:
        every = [(ratio(x, y), -c, u == t and t is not None) for c, d, y, u in cards if d == b]
        best = max([e for e in every if e[0] >= 95] or [e for e in every if e[0] >= 80 and e[2]], default=None)
        if best:
            wanted[s] = (-best[1], round(best[0], 6))
    asked = []
    search = rs.similar_names
    monkeypatch.setattr(rs, "similar_names", lambda n, o, least: asked.append((least, n.distinct().collect())) or search(n, o, least))
    found = rs.fuzzy_in_block(spark.createDataFrame(spine, "s int, b string, x string, t string"), "s", "x", spark.createDataFrame(cards, "c int, b string, y string, t string"), "c", "y", "b", "t")
    assert {z[0]: (z[1], round(z[2], 6)) for z in found.collect()} == wanted
    # names of the same words aren't compared, and from the lower ratio on only within a team
    in_block = {(d, whole(y)) for _, d, y, _ in cards}
    (strict, whole_block), (loose, in_team) = asked
    assert (strict, loose) == (95.0, 80.0)
    assert whole_block and not [z for z in whole_block if (z["b"], whole(z["x"])) in in_block]
    assert in_team and {len(z["b"]) for z in in_team} == {2}


@pytest.mark.parametrize("letters", ["ab ", "abcdefghijklmnopqrstuvwxyz", "aßĀπ語 "])
def test_signatures_never_drop_a_pair(spark, letters):
    r = random.Random(5)
    text = lambda: "".join(r.choice(letters) for _ in range(r.randrange(1, 40)))
    slip = lambda t: "".join(c for c in t if r.random() > 0.1) + r.choice(["", r.choice(letters)])
    pairs = [(t, u) for t in (text() for _ in range(300)) for u in (slip(t), text()) if u]
    df = spark.createDataFrame([(a, b, 200.0 * plain_lcs(a, b) / (len(a) + len(b))) for a, b in pairs], "k_x string, k_y string, ratio double")
    for n in "xy":
        df = df.withColumn("s", sim.signed_text(F.col(f"k_{n}"))).select("*", F.length(f"k_{n}").alias(f"n_{n}"), *[F.col(f"s.{c}").alias(f"{c}_{n}") for c in ("l0", "l1", "g0", "g1")]).drop("s")
    for least in (70.0, 80.0, 95.0):
        judged = df.select((F.col("ratio") >= least).alias("similar"), sim.may_reach("x", "y", least).alias("kept")).collect()
        assert any(z["similar"] for z in judged) and not [z for z in judged if z["similar"] and not z["kept"]]


def test_ratio_ignores_word_order(spark):
    df = spark.createDataFrame([("kaoru mitoma", "mitoma kaoru"), ("a", None), ("", "x"), ("abcd", "abxd")], "a string, b string")
    assert [r[0] for r in df.select(sim.token_sort_ratio(F.col("a"), F.col("b"))).collect()] == [100.0, None, 0.0, 75.0]


def test_precedence_names_its_source(spark):
    df = spark.createDataFrame([(None, "b"), ("a", "b"), (None, None)], "x string, y string")
    found = df.select(cf.precedence([("one", F.col("x")), ("two", F.col("y"))]).alias("p")).select("p.*")
    assert rows(found) == [(None, None), ("a", "one"), ("b", "two")]


@pytest.mark.parametrize("text", ["Łukasz Ødegård", "Zoë", "Noël", ""])
def test_accents(spark, text):
    assert values(spark, [text], tx.fold_accents(X))[0] == {"Łukasz Ødegård": "Łukasz Ødegard", "Zoë": "Zoe", "Noël": "Noel", "": ""}[text]


def test_zero_is_missing_in_salary_texts(spark):
    df = spark.createDataFrame([(12_450_000, 3), (0, 3), (None, 3), (5_000_000, 0)], "t long, y int")
    assert [r[0] for r in df.select(tx.salary_text(F.col("t"), F.col("y"))).collect()] == ["$12.4M / 3yr", None, None, None]


def test_prorating_and_groups(spark):
    assert values(spark, [4, 1, 9], mx.prorated(F.lit(100.0), F.lit(4), X), "int") == [100.0, 25.0, 100.0]
    groups = values(spark, ["OF", "SS", "??", None], cf.position_group(X, {"SS": "IF"}, ["OF"]))
    assert [tuple(g) if g else None for g in groups] == [("OF", "defaulted"), ("IF", "mapped"), None, None]
    assert values(spark, ["B", "D"], cf.scheme_slot(X, F.lit("one"), {"one": {"A": "a"}, "two": {"B": "b"}})) == ["b", None]
