"""Tokens, edit neighbourhoods and alignment, with exhaustive and random checks; linking on small tables."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from gridloom.llm import names as nm
from gridloom.llm import people, variants
from gridloom.llm.components import components
from gridloom.llm.variants import attribute_worth, name_worth
from gridloom.session import cut_lineage
from tests.conftest import rows
from tests.test_leagues import shuffle_bytes


def full_distance(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_distance_equals_the_full_table():
    r = random.Random(1)
    for _ in range(500):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(9))) for _ in range(2))
        assert nm.edit_distance(a, b) == min(full_distance(a, b), 3)


def test_tokens_within_an_edit_share_an_index_entry():
    r = random.Random(2)
    for _ in range(400):
        a = "".join(r.choice("abcde") for _ in range(r.randrange(3, 9)))
        i = r.randrange(len(a))
        b = r.choice([a[:i] + a[i + 1 :], a[:i] + "z" + a[i:], a[:i] + "z" + a[i + 1 :], a[: max(i - 1, 0)] + a[max(i - 1, 0) : i + 1][::-1] + a[i + 1 :]])
        if len(b) > 2:
            assert nm.deletes(a) & nm.deletes(b), (a, b)


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("DUNURBERG, FREDERICK", "Fred Dunurberg"), ("A.J. Norelford", "AJ Norelford"), ("T. Calerkey", "Tyler Calerkey"), ("Topher Belingford", "Christopher Belingford"),
        ("Daniel de la Cruz Jr.", "Daniel De La Cruz"), ("Sol. Calibdal-Lornell", "Solomon Calibdal Lornell"), ("Mike Stone", "Michael D. Stone"), ("Pe1alton, Seun", "Oluwaseun Pelalton"),
        ("René Ruiz", "Rene Ruiz"), ("Xavier Zúiram 3rd", "Xavier Zúñiram III"), ("Moxelby Shaun", "Shaun Mokselby"),
    ],
)
def test_variants_align(a, b):
    assert name_worth(nm.tokens(a), nm.tokens(b), others=0) is not None
    assert name_worth(nm.tokens(b), nm.tokens(a), others=0) == name_worth(nm.tokens(a), nm.tokens(b), others=0)


@pytest.mark.parametrize(("a", "b"), [("Rashad Pelidmore", "Travis Xanundsen"), ("J. Smith", "Bob Smith"), ("", "Ann Lee"), ("A. B.", "Ann Bee")])
def test_others_do_not(a, b):
    assert name_worth(nm.tokens(a), nm.tokens(b), others=0) is None


def test_contradictions_cost():
    assert name_worth(nm.tokens("Al Stone Jr."), nm.tokens("Al Stone Sr.")) <= 0
    jersey = people.CHART[-1]
    assert attribute_worth(jersey, [7], [97]) == jersey.near and attribute_worth(jersey, [7], [8]) < -50 and attribute_worth(jersey, [], [8]) == 0


def test_names_of_many_tokens_are_aligned_as_a_whole():
    long = " ".join(f"{c}part{c}" for c in "abcdefgh")
    other = " ".join(reversed(long.split())).replace("cpartc", "cpartce")
    assert nm.align(nm.tokens(long)[0], nm.tokens(other)[0]) == (nm.COST["short"], {"same": 7, "short": 1, "over": 0, "crossed": 0})
    assert nm.align(nm.tokens(long)[0], nm.tokens(long + " zorro quentin")[0]) is None
    assert nm.tokens("x" * 100_000)[0] == ("x" * 100_000,)


def test_least_cost_equals_all_permutations():
    r = random.Random(5)
    for _ in range(200):
        n = r.randrange(1, 6)
        cost = [[r.choice([0.0, 1.0, 1.5, 2.5, 3.0, nm.FORBIDDEN]) for _ in range(n)] for _ in range(n)]
        total, columns = nm.least_cost(nm.np.array(cost))
        assert sorted(columns) == list(range(n))
        assert abs(total - min(sum(cost[i][j] for i, j in enumerate(p)) for p in itertools.permutations(range(n)))) < 1e-6


def test_both_ways_of_assigning_agree():
    r = random.Random(11)
    words = ["al", "ali", "b", "c", "smith", "smyth", "jo", "joe", "j", "stone"]
    for _ in range(300):
        a, b = sorted((tuple(r.choice(words) for _ in range(r.randrange(1, 4))), tuple(r.choice(words) for _ in range(r.randrange(1, 5)))), key=len)
        pairs = [[(nm.COST[k], k) if (k := nm.token_kind(x, y)) else (nm.FORBIDDEN, "other") for y in b] for x in a]
        spare_a, spare_b = ([c if len(x) == 1 else nm.FORBIDDEN for x in side] for side, c in ((a, 4.5), (b, 0.5)))
        n, m = len(a), len(b)
        cost = nm.np.zeros((n + m, n + m))
        cost[:n, :m] = [[c for c, _ in row] for row in pairs]
        cost[:n, m:], cost[n:, :m] = nm.np.array(spare_a)[:, None], nm.np.array(spare_b)[None, :]
        one, other = nm._all_ways(pairs, spare_a, spare_b)[0], nm.least_cost(cost)[0]
        assert abs(one - other) < 1e-6 or min(one, other) >= nm.FORBIDDEN / 2


FIRST = ["william", "bill", "robert", "bob", "christopher", "chris", "topher", "anthony", "tony", "jo", "joe", "mark", "marcus", "ezekiel", "zeke", "anna", "joanna", "phil"]
LAST = ["stonewell", "dunurberg", "drayelley", "okaforsen", "li", "lee", "quentin", "xanundsen", "macalister", "sotomeyer", "vanderkolk", "ruiz"]


def slip(r, word):
    i = r.randrange(len(word))
    return r.choice([word[:i] + word[i + 1 :], word[:i] + r.choice("aeklt") + word[i:], word[:i] + r.choice("aeklt") + word[i + 1 :], word[: max(i - 1, 0)] + word[max(i - 1, 0) : i + 1][::-1] + word[i + 1 :]]) or word


def test_every_pair_the_scorer_accepts_has_the_entries_that_the_rules_rely_on():
    r = random.Random(9)
    linked = 0
    for _ in range(6000):
        a = [r.choice(FIRST), r.choice(LAST)][r.randrange(2) :] if r.random() < 0.1 else [r.choice(FIRST), r.choice(LAST)]
        b = [w if r.random() < 0.8 else r.choice(FIRST + LAST) for w in a]
        for _ in range(r.randrange(4)):
            i = r.randrange(len(b))
            b[i] = r.choice([slip(r, b[i]), b[i][: max(3, len(b[i]) // 2)], b[i][-max(3, len(b[i]) - 2) :], b[i]])
        x, y = nm.name_key(" ".join(a)), nm.name_key(" ".join(b))
        s, t = nm.tokens(x), nm.tokens(y)
        worth = name_worth(s, t, 0)
        weak = name_worth(s, t, 1)
        (near, ends, exact), (near_, ends_, exact_) = nm.index_entries(x), nm.index_entries(y)
        if weak is not None:
            linked += 1
            assert set(ends) & set(ends_), (x, y)  # whatever the worth
        if worth is not None and worth >= 3.0:
            assert set(near) & set(near_), (x, y)  # chart links without evidence
        if worth is not None and worth >= 4.0:
            assert set(exact) & set(exact_), (x, y)  # match links without jersey and weight
    assert linked > 1000


def test_components_of_chains_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    found = dict(rows(components(spark.createDataFrame(links, "a long, b long"))))
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in (100, 101, 102)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


CHART = "row_id long, doc_no long, name string, attainment string, years_pro int, cap_number string, madden int, age int, jersey int, entity string, block string, spelling string"


def chart(spark, *people_rows):
    return spark.createDataFrame([(i, *p, "e", "b", "s") for i, p in enumerate(people_rows)], CHART)


def test_chart_pairs(spark):
    data = chart(
        spark,
        (1, "Frederick Stonewell", "08/2", 10, None, 75, 31, 2),
        (1, "F. Stonewell", "08/2", 10, None, 75, None, None),
        (1, "STONEWELL, FREDERICK", None, None, None, None, 31, 2),
        (1, "Felix Stonewell", "19/1", 3, None, 60, 24, 44),  # a relative
        (1, "Frederick Stonewell", None, None, None, None, None, None),  # the same spelling is no pair
        (2, "Fred Stonewell", "08/2", 10, None, 75, 31, 2),  # another chart
        (1, None, None, None, None, None, None, None),
        (1, "", None, None, None, None, None, None),
        (None, "Nobody Inparticular", None, None, None, None, None, None),
    )
    assert rows(people.chart_pairs(data)) == [(0, 1), (0, 2), (1, 2), (1, 4), (2, 4)]
    assert people.chart_pairs(data.where("row_id > 99")).count() == 0


MATCH = "row_id long, player_key string, canonical_name string, ourlads_name string, standard_pos string, jersey int, madden_jersey int, height string, weight int, age int, entity string"


def test_match_pairs(spark):
    data = spark.createDataFrame(
        [
            (0, "a", "Leonard Shanopdez", None, "QB", 7, None, "6-1", 200, 25, "x"),
            (1, "b", "Leo Shanopdez", None, "QB", None, 7, "6'1\"", 200, 26, "x"),
            (2, "a", "Leo Shanopdez", None, "QB", 7, None, None, None, None, "x"),  # the same key is no pair
            (3, "c", "Leonard Shanopdez", None, "QB", 8, None, "6-1", 200, 25, "x"),  # a namesake
            (4, None, None, None, None, None, None, None, None, None, "x"),
            (6, None, "L Shanopdez", None, "QB", 7, None, "6-1", 200, None, "x"),  # without a key: an entity of its own
            (5, "d", "Le​onard Shanopdez", None, "QB", 7, None, "6-1", 200, None, "x"),
        ],
        MATCH,
    )
    assert rows(people.match_pairs(data)) == [(0, 1), (0, 5), (0, 6), (1, 5), (1, 6), (2, 5), (2, 6), (5, 6)]
    assert people.match_pairs(data.where("row_id > 99")).count() == 0


def test_strong_evidence_links_names_without_a_common_index_entry(spark):
    data = chart(
        spark,
        (1, "Coyb Drayelley", "08/2", 10, None, 59, 31, 9),
        (1, "Decoby Drayelley", "08/2", 10, None, 59, None, 9),
        (1, "Alexander Tarurpjy", "03/4", 2, None, 81, 24, 44),
        (1, "Aleander Tarurphy", "03/4", 2, None, 81, 24, 44),
        (1, "Hollis Nobbervane", "01/1", 3, None, 60, 22, 12),
    )
    assert rows(people.chart_pairs(data)) == [(0, 1), (2, 3)]


def test_agreeing_match_rows_link_without_a_common_index_entry(spark):
    data = [
        (0, "a", "David Stavelmaer", None, "WR", 7, None, "6-1", 200, 25, "x"),
        (1, "b", "Dave Stavelmore", None, "WR", 7, None, "6'1", 200, 26, "x"),
        (2, "c", "David Stavelmaer", None, "WR", 8, None, "6-1", 200, 25, "x"),  # contradicts in jersey
        (3, "d", "Coyb Drayelley", None, "WR", 9, None, "5-9", 180, None, "x"),
        (4, "e", "Decoby Drayelley", None, "WR", 9, None, "5-9", 180, None, "x"),
    ]
    assert rows(people.match_pairs(spark.createDataFrame(data, MATCH))) == [(0, 1), (3, 4)]


def some_charts(spark):
    """Twenty charts of sixty different names; every tenth name is typed with a slip as well."""
    letters = lambda x: "".join("abcdefghij"[int(d)] for d in str(x))
    named = [(d, f"{letters(7919 * (d * 60 + i) ** 2 + 10**8)} {letters(104729 * (d * 60 + i + 1) ** 2 + 10**8)}", i) for d in range(20) for i in range(60)]
    slips = [(d, name[:-1], i) for d, name, i in named if i % 10 == 0]
    return chart(spark, *[(d, name, f"{i:02}/1", i, None, 60 + i % 30, 20 + i % 15, i) for d, name, i in named + slips])


def test_charts_meet_as_a_whole_as_they_do_in_the_index(spark, monkeypatch):
    data = some_charts(spark)
    expected = [(d * 60 + i, 1200 + d * 6 + i // 10) for d in range(20) for i in range(0, 60, 10)]
    before = shuffle_bytes(spark)
    assert rows(people.chart_pairs(data)) == sorted(expected, key=lambda r: [(True, str(v)) for v in r])
    whole = shuffle_bytes(spark) - before
    assert whole < 900 * data.count()
    monkeypatch.setattr(variants, "WHOLE_BLOCK", 0, raising=False)
    assert rows(people.chart_pairs(data)) == sorted(expected, key=lambda r: [(True, str(v)) for v in r])


def test_shuffle_files_are_gone_after_a_checkpoint(spark):
    files = lambda: sum(1 for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if f.endswith(".data"))
    before = files()
    kept = cut_lineage(spark.range(10_000).repartition(4, "id").withColumn("x", F.col("id") * 2).repartition(4, "x"))
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before
    assert kept.agg(F.sum("x")).first()[0] == 9_999 * 10_000
