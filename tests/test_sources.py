"""Readers, sinks and incremental refreshes on small files."""

import json

import pytest
from pyspark.sql import functions as F

from gridloom.sources import documents as docs
from gridloom.sources import games, html, layout, paging, sinks
from gridloom.streaming import incremental as inc
from tests.conftest import rows

TEAM = {"team": "Zenith", "abbr": "ZEN", "source": "s", "base_defense": "4-3", "depth_chart": {"LWR": [{"name": "A", "depth": 1, "stats": {"REC": 5}}, {"name": "B", "depth": 2}], "QB": [{"name": "C", "depth": 1}]}}


def test_team_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(TEAM))
    (tmp_path / "b.json").write_text(json.dumps([TEAM | {"abbr": "SF"}]))
    (tmp_path / "meta.json").write_text(json.dumps({"fetched": "x"}))  # no chart: no rows
    read = docs.read_json(spark, str(tmp_path / "*.json"), docs.team_document_schema())
    found = docs.unnest_charts(read)
    assert rows(found, "row_id", "abbr", "ourlads_pos", "name") == [(0, "ZEN", "LWR", "A"), (1, "ZEN", "LWR", "B"), (2, "ZEN", "QB", "C"), (3, "SF", "LWR", "A"), (4, "SF", "LWR", "B"), (5, "SF", "QB", "C")]
    assert rows(found.where("name = 'A' AND abbr = 'SF'"), "stats_json") == [('{"REC":"5"}',)]


def test_envelopes_and_keyed_objects(spark):
    df = spark.sql("SELECT map('7', named_struct('n', 'x'), '3', named_struct('n', 'y')) AS m, array(named_struct('s', '2025', 'v', 1)) AS items, array('2026', '2025') AS seasons, 'd' AS day")
    assert rows(docs.keyed_rows(df, "m")) == [(0, "7", "x"), (1, "3", "y")]
    found = docs.envelope_rows(df, "items", ["day", "seasons"]).withColumn("i", docs.dictionary_index(F.col("seasons"), F.col("s")))
    assert rows(found, "day", "row_id", "v", "i") == [("d", 0, 1, 1)]


def test_flatten_requires_and_gathers(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('label', 'x', 'deep', named_struct('n', 2)) AS team, 'adm' AS loaded_at")
    assert docs.flatten(df).columns == ["id", "team.label", "team.deep.n", "loaded_at"]
    assert docs.struct_of_others(df, ["loaded_at"], "stats", ["id"]).first()["stats"]["team"]["label"] == "x"
    with pytest.raises(ValueError, match="lacks y"):
        docs.require_columns(df, ["id", "y"])


def test_nan_and_season_fallback(spark):
    df = spark.sql("SELECT double('NaN') AS x, 1 AS i UNION ALL SELECT 2.0, 2")
    assert rows(docs.nan_as_null(df)) == [(None, 1), (2.0, 2)]

    def read(season):
        if season == 2027:
            raise FileNotFoundError
        return df.where("i > 5") if season == 2026 else df

    assert docs.season_or_before(read, 2027)[1] == 2026
    assert docs.season_or_before(read, 2026)[1] == 2025


def test_report_layout(spark, tmp_path):
    lines = ["﻿HAWKS,,,", "Starter,Pos,Bench,Pos", "Joe Doe,PG,Ann (12),C", "OPEN,,Max,", "REMAINING FA x,,Lee,SG", "OWLS,,,", "s,p,b,p", "Kim,PF,,"]
    (tmp_path / "g.csv").write_text("\n".join(lines), encoding="utf-8")
    found = layout.depth_tiers(layout.read_grid(spark, str(tmp_path / "g.csv")), {"HAWKS": "ATL", "OWLS": "OWL"}, [(0, 1), (2, 2)])
    assert rows(found, "team", "name", "position", "depth_rank", "draft_pick") == [("ATL", "Ann", "C", 2, 12), ("ATL", "Joe Doe", "PG", 1, None), ("ATL", "Lee", "SG", 2, None), ("ATL", "Max", None, 2, None), ("OWL", "Kim", "PF", 1, None)]


def test_html_tables_and_objects(spark):
    page = "<p>x<!-- <table><tr><th>N</th><td><a href='/id/5/'>Joe &amp; Co</a> x</td></tr></table> --><table><tr><td>2</table>"
    script = 'var pageState = {"a": "}{", "b": {"c": 1}}; more'
    pages = spark.createDataFrame([("p", page), ("e", ""), ("n", None), ("s", script)], "k string, h string")
    assert rows(html.table_rows(pages, "k", "h"), "k", "table_no", "cells", "links") == [("p", 0, ["N", "Joe & Co x"], ["", "/id/5/"])]
    assert dict(rows(html.embedded_objects(pages, "k", "h", "pageState")))["s"] == '{"a": "}{", "b": {"c": 1}}'


def test_paging_and_retries():
    data = [{"id": i} for i in range(7)]
    assert paging.counted_pages(lambda at, n: {"items": data[at : at + n], "total": 7}, 3) == data
    with pytest.raises(paging.Refused):
        paging.counted_pages(lambda at, n: {"items": data[at : at + n][:1] if at < 2 else [], "total": 7}, 3)
    assert paging.numbered_pages(lambda p: {"items": [p], "total_pages": 3}) == [1, 2, 3]
    assert paging.cursor_pages(lambda c: {None: {"items": [1], "next": "x"}, "x": {"items": [2]}}[c]) == [1, 2]
    waits, tries = [], iter([ValueError(), ValueError(), "ok"])

    def call():
        r = next(tries)
        if isinstance(r, Exception):
            raise r
        return r

    assert paging.with_retries(call, 3, 1.0, waits.append) == "ok" and len(waits) == 2
    assert 1.0 <= waits[0] <= 1.25 and 2.0 <= waits[1] <= 2.5


def test_counted_pages_refuse_what_is_not_whole():
    twice = [{"id": 1, "v": 1}, {"id": 2}, {"id": 1, "v": 2}]
    pages = lambda data, total: lambda at, n: {"items": data[at : at + n], "total": total}
    with pytest.raises(paging.Refused):
        paging.counted_pages(pages(twice, 3), 2)
    assert paging.counted_pages(pages(twice, 3), 2, dedupe_by="id") == twice[:2]
    with pytest.raises(paging.Refused):
        paging.counted_pages(pages(twice[:2], 2), 2, min_total=3)
    with pytest.raises(paging.Refused):
        paging.counted_pages(pages(twice[:2], 2), 2, validate=lambda item: "v" in item)


def test_statuses_backoff_bulk_and_references():
    assert paging.status_hint(200, {}, 0, 2) is None
    for status, attempt in ((404, 0), (403, 2)):
        with pytest.raises(paging.Refused):
            paging.status_hint(status, {}, attempt, 2)
    with pytest.raises(RuntimeError) as held:
        paging.status_hint(429, {"Retry-After": "7"}, 0, 2)
    assert held.value.wait == 7.0
    with pytest.raises(RuntimeError):
        paging.status_hint(403, {}, 0, 2)  # may be a guard against haste
    assert paging.backoff(3, 1.0, chance=lambda: 0.0) == 8.0 and paging.backoff(20, 1.0, most=60.0, chance=lambda: 1.0) == 75.0

    def broken():
        raise OSError

    each = lambda part: [{"id": part}, {"id": "x"}]
    assert paging.bulk_or_each(lambda: [{"id": 1}], each, ["a"]) == ([{"id": 1}], True)
    assert paging.bulk_or_each(broken, each, ["a", "b"]) == ([{"id": "a"}, {"id": "x"}, {"id": "b"}], False)
    tree = {"root": {"items": [{"$ref": "a"}, {"$ref": "b"}]}, "a": {"items": [{"$ref": "c"}, {"$ref": "b"}, {"$ref": "root"}]}, "b": {"n": 1}, "c": {"n": 2}}
    assert paging.followed_refs("root", tree.__getitem__) == [{"address": "b", "n": 1}, {"address": "c", "n": 2}]


def test_paged_source(spark):
    source = paging.paged_source("numbers", lambda: ["0", "3"], lambda page: [{"n": int(page) + i} for i in range(2)])
    spark.dataSource.register(source)
    found = rows(spark.read.format("numbers").load())
    assert found == [("0", 0, '{"n": 0}'), ("0", 1, '{"n": 1}'), ("3", 0, '{"n": 3}'), ("3", 1, '{"n": 4}')]


def test_chunks_never_exceed_their_size(spark):
    chunks = [r["keys"].split(",") for r in paging.in_chunks(spark.range(1000), "id", 100).collect()]
    assert sorted(map(len, chunks)) == [100] * 10 and sorted(int(k) for c in chunks for k in c) == list(range(1000))


def test_wide_and_broken_lines_of_a_grid(spark, tmp_path):
    (tmp_path / "g.csv").write_text("\ufeffa," + ",".join(str(i) for i in range(99)) + '\r\n"x\ny",2\n\n', encoding="utf-8")
    found = [r["cells"] for r in layout.read_grid(spark, str(tmp_path / "g.csv")).orderBy("line").collect()]
    assert found[0] == ["a", *map(str, range(99))] and found[1] == ["x\ny", "2"]


def test_typed_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,name,w\n1,A,2.5\nx,B,\n", encoding="utf-8")
    found = docs.read_csv(spark, str(tmp_path / "c.csv"), "w double, id int")
    assert found.dtypes == [("w", "double"), ("id", "int")] and rows(found) == [(None, None), (2.5, 1)]
    with pytest.raises(ValueError, match="lacks z"):
        docs.read_csv(spark, str(tmp_path / "c.csv"), "z int")
    assert rows(docs.read_csv(spark, str(tmp_path / "c.csv"), "z int, name string", strict=False)) == [(None, "A"), (None, "B")]


def test_one_object_is_refused_when_large(spark):
    df = spark.createDataFrame([("b", 1), ("a", None)], "id string, v int")
    assert sinks.keyed_object(df, "id").first()[0] == '{"a":{},"b":{"v":1}}'
    with pytest.raises(ValueError, match="too many"):
        sinks.keyed_object(df, "id", most_rows=1)


def test_log_enriched_maps_and_optional_tables(spark, tmp_path):
    sinks.append_log(str(tmp_path / "logs" / "l.txt"), "one\n")
    sinks.append_log(str(tmp_path / "logs" / "l.txt"), "two")
    assert (tmp_path / "logs" / "l.txt").read_text() == "one\ntwo\n"
    assert docs.has_table(spark, "no_such_table") is False


def test_fetch_each_allows_few_failures(spark):
    ids = spark.createDataFrame([(i,) for i in range(20)], "id int")

    def fetch(k):
        if k == "3":
            raise OSError
        return f"b{k}"

    assert paging.fetch_each(ids, "id", fetch, first_wait=0.0).where("problem IS NULL").count() == 19
    with pytest.raises(paging.Refused):
        paging.fetch_each(ids, "id", fetch, failures_allowed=0.01, first_wait=0.0)
    assert sum(len(r["keys"].split(",")) for r in paging.in_chunks(ids, "id", 6).collect()) == 20


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 1, None), ("a", 0, 2.0)], "id string, o int, v double")
    assert [r[0] for r in sinks.keyed_json_lines(df, "id", "o").collect()] == ['{"a":{"id":"a","v":2.0}}', '{"b":{"id":"b","v":null}}']
    assert [r[0] for r in sinks.unmatched_report(df, "id", {"team": "v"}).collect()] == ["a (team=2.0)", "b (team=None)"]
    sinks.replace_table(df, str(tmp_path / "t"), partition_by=["id"])
    sinks.replace_partitions(spark.createDataFrame([(9, 9.0, "a")], "o int, v double, id string"), str(tmp_path / "t2"), ["id"])
    sinks.replace_partitions(spark.createDataFrame([(8, 8.0, "b")], "o int, v double, id string"), str(tmp_path / "t2"), ["id"])
    assert rows(spark.read.parquet(str(tmp_path / "t2")), "id", "o") == [("a", 9), ("b", 8)]
    assert "loaded_at" in spark.read.parquet(str(tmp_path / "t")).columns
    path = str(tmp_path / "meta" / "m.json")
    sinks.merge_sidecar(path, {"a": 1})
    assert sinks.merge_sidecar(path, {"b": 2}) == {"a": 1, "b": 2}


def test_incremental(spark):
    assert inc.periods_to_fetch([1, 2, 3], [1, 2, 3, 4, 5, 6], [4, 6]) == [2, 3, 4]
    old = spark.createDataFrame([(1, "a"), (2, "b")], "week int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "week int, v string")
    assert rows(inc.replace_periods(old, new, "week")) == [(1, "a"), (2, "B"), (3, "c")]
    chosen, rest = inc.next_from_pool(["x"], ["x", "y", "z"], 2, 1)
    assert chosen[0] == "x" and len(chosen) == 2 and len(set(chosen)) == 2
    assert rows(inc.last_known_good(new, old, "week"), "week", "is_cached") == [(1, True), (2, False), (3, False)]


def test_game_documents_and_leaders(spark):
    side = lambda which, team, score: {"side": which, "team": team, "name": team, "score": score, "winner": which == "home", "linescores": [7.0, 3.0]}
    game = {
        "id": "g", "competitors": [side("away", "B", "10"), side("home", "A", "17")],
        "statistics": [{"team": "A", "items": [{"name": "yards", "value": "300"}, {"name": "yards", "value": "1"}, {"name": "x", "value": "2"}]}],
        "leaders": [{"team": "A", "groups": [{"name": "passing", "leaders": [{"athlete_id": "7", "name": "Q", "line": "200"}]}, {"name": "rushing", "leaders": []}]}],
        "videos": [{"url": "u", "title": "one"}, {"url": "u", "title": "two"}, {"url": None, "title": "x"}, {"url": "v", "title": None}],
    }
    text = spark.createDataFrame([(json.dumps(game),), (json.dumps({"id": "half", "competitors": [side("home", "A", None)]}),)], "t string")
    found = games.game_documents(text.select(F.from_json("t", games.GAME).alias("g")).select("g.*"), ["yards"], {"rushing": "RUSH", "passing": "PASS"})
    (one,) = found.collect()
    assert (one["home"]["score"], one["home"]["linescore"], one["away"]["winner"], one["home_stats"], one["away_stats"]) == (17, [7, 3], False, {"yards": "300"}, {})
    assert [v["title"] for v in one["highlights"]] == ["one"]
    master = spark.createDataFrame([("7", 88)], "espn string, madden int")
    assert rows(games.leader_lines(found, master, "espn", ["madden"]), "game_id", "category", "team", "madden") == [("g", "PASS", "A", 88)]


def test_references_of_one_answer(spark):
    answer = spark.sql("SELECT array(named_struct('id', 1, 'team', 2, 'role', 9), named_struct('id', 3, 'team', 5, 'role', 1)) AS elements, array(named_struct('id', 2, 'name', 'Old'), named_struct('id', 2, 'name', 'New')) AS teams, array(named_struct('id', 9, 'short', 'GK')) AS roles")
    found = games.with_references(answer, "elements", {"team": ("teams", {"name": "team_name"}), "role": ("roles", {"short": "position"})})
    assert rows(found, "id", "team_name", "position") == [(1, "New", "GK"), (3, None, None)]


def test_amounts_of_active_players_win(spark):
    line = lambda name, *cells: f"<tr><td><a href='/p'>{name}</a></td>{''.join(f'<td>{c}</td>' for c in cells)}</tr>"
    page = f"<table>{line('Ann', 'x', '$5', '$9')}{line('Bob', '$1')}<tr><td>TOTAL</td><td>$6</td></tr></table><table>{line('Ann', '$7')}{line('Cy', '$2')}</table>"
    amounts = html.linked_amounts(html.table_rows(spark.createDataFrame([("t", page)], "k string, h string"), "k", "h"), "k")
    of = lambda i: amounts.where(F.col("table_no") == i).drop("table_no")
    assert rows(html.first_listed([("active", of(0)), ("hurt", of(1))], ["k", "name"]), "name", "amount", "listed_in") == [("Ann", "$5", "active"), ("Bob", "$1", "active"), ("Cy", "$2", "hurt")]
