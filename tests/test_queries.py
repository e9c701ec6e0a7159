"""Every registered query against its SQL on the smallest tables, and the hygiene of the plans."""

import glob
import importlib
import math
import os
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

CORE = [n for m in entry._MODULES for n in importlib.import_module(f"gridloom.plans.{m}").QUERIES]
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool | str):
        return value
    if isinstance(value, list):
        return tuple(map(plain, value))
    return float(f"{value:.9g}") if isinstance(value, float | int) else str(value)


def counted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def compare(spark, duck, name):
    found = entry.queries()[name](spark, SMALL)
    expected = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(found.columns)
    assert counted(map(tuple, found.collect()), found.columns) == counted(expected.fetchall(), names)


WITHOUT_SQL = {"display_names", "curve_models"}


@needs_data
@pytest.mark.parametrize("name", [n for n in CORE if n not in WITHOUT_SQL])
def test_query_equals_sql(spark, duck, name):
    compare(spark, duck, name)


@needs_data
def test_display_names_equal_plain_python(spark):
    def title(text):
        return "".join(c.lower() if i and text[i - 1].isalpha() else c.upper() for i, c in enumerate(text))

    def display(name):
        text = re.sub(r"\b(?!IV\b)(?!VI\b)([A-Z])(?!\1)([A-Z])\b", r"\1.\2.", name.strip())
        text = re.sub(r"\b(Jr|Sr)\b", r"\1.", re.sub(r"\b(Jr|Sr)\.", r"\1", title(text)))
        for written in ("Ii", "Iii", "Iv", "Vi"):
            text = re.sub(rf"\b{written}\b", written.upper(), text)
        return text

    found = entry.queries()["display_names"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/ourlads_players.parquet").select("row_id", "name"), "row_id")
    plain_names = [r for r in found.collect() if r["name"].isascii()]
    assert len(plain_names) > 100 and all(r["display"] == display(r["name"]) for r in plain_names)
    for r in plain_names:
        last = r["name"].split()[-1]
        assert (r["head"] is None) == (len(r["name"].split()) < 2 or "-" not in last)


@needs_data
def test_curve_models_equal_least_squares(spark, duck):
    rows = duck.execute("""SELECT DISTINCT r.gsis_id, r.season = 2024 AS flag, r.team, r.draft_number AS pick, m.madden, m.pos FROM nflreadpy_rosters r
        JOIN (SELECT gsis_id, max(madden) AS madden, max(standard_pos) AS pos FROM player_match WHERE madden BETWEEN 1 AND 99 AND gsis_id IS NOT NULL GROUP BY 1) m USING (gsis_id)
        WHERE r.draft_number > 0""").df()
    groups = sorted(rows["pos"].unique())
    dummies = np.array([[float(p == g) for g in groups] for p in rows["pos"]])
    log, y = np.log(rows["pick"].to_numpy(dtype=float))[:, None], rows["madden"].to_numpy(dtype=float)
    flag = rows["flag"].to_numpy(dtype=float)[:, None]
    found = {r["model"]: r for r in entry.queries()["curve_models"](spark, SMALL).collect()}
    for name, design, ridge in (("shared", [dummies, flag, log], 0), ("own", [dummies, flag, dummies * log], 0), ("ridge", [dummies, flag, log, dummies * log], 20.0)):
        x = np.hstack(design)
        penalty = np.zeros(x.shape[1])
        penalty[len(groups) + 2 :] = ridge
        inverse = np.linalg.pinv(x.T @ x + np.diag(penalty))
        residual = y - x @ inverse @ x.T @ y
        left = 1 - np.einsum("ij,jk,ik->i", x, inverse, x)
        left_out = residual[left > 1e-9] / left[left > 1e-9]
        assert found[name]["n"] == len(y)
        assert abs(found[name]["rmse"] - np.sqrt((residual**2).mean())) < 1e-6
        assert abs(found[name]["loo_rmse"] - np.sqrt((left_out**2).mean())) < 1e-3


@needs_data
def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", ["spine_left_joins", "p3_found", "p7_found", "theta_overlap_pairs", "resolve_waterfall"])
def test_plans_have_no_cartesian_product(spark, name):
    plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@needs_data
def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["scan_filter_project"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "In(l_returnflag" in plan and "l_comment" not in plan
