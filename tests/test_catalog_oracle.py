"""Every oracle-backed catalog query equals its DuckDB statement (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from strata.plans.catalog import CATALOG
from strata.plans.standins import TABLES

SF = "/root/testdata/sf0.001"
SLOW = {"fit_candidates", "fit_regressor", "score_table", "feature_importance"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    got = _canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    exp = _canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == exp[0]
    assert got[1] == exp[1]


def test_every_query_has_oracle_or_is_documented():
    missing = set(CATALOG) - set(entry.oracle_sql())
    assert missing <= SLOW | {"multiclass_score", "freshness_report", "stale_check", "metadata_tables"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0


ROWS_ONLY = sorted(set(CATALOG) - set(entry.oracle_sql()))


def _candidates(rows):
    assert {r["model"] for r in rows} == {"logistic_regression", "random_forest"}
    assert all(r["accuracy"] > 0.8 and r["f1"] > 0.85 and r["roc_auc"] > 0.6 for r in rows)


def _regressor(rows):
    assert len(rows) == 1 and rows[0]["n"] == 100 and rows[0]["rmse"] < 3.4 and abs(rows[0]["rse"] + rows[0]["r2"] - 1) < 1e-5


def _multiclass(rows):
    by = {}
    for r in rows:
        assert r["class_name"] == f"class_{r['class_id']}"
        by.setdefault(r["vec_id"], []).append((r["rank"], -r["p"]))
    assert len(by) == 500 and all(len(x) == 10 and sorted(x) == sorted(x, key=lambda t: t[1]) for x in by.values())
    assert all(abs(sum(-p for _, p in x) - 1) < 1e-4 for x in by.values())


def _importance(rows):
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True) and 0.9 < sum(values) <= 1 + 1e-6
    assert {r["feature"] for r in rows[:2]} == {"_num_scaled_0", "_num_scaled_1"}


def _scores(rows):
    names = ("logistic_regression_probability", "random_forest_probability")
    assert len(rows) == len({r["doc_id"] for r in rows}) == 200 and all(0 <= r[n] <= 1 for r in rows for n in names)
    for n in names:  # good documents score higher than bad ones
        good, bad = ([r[n] for r in rows if r["backlog_risk_actual"] == y] for y in (1, 0))
        assert sum(good) / len(good) > sum(bad) / len(bad) + 0.05
    assert all(r["backlog_risk_prediction"] == (r["random_forest_probability"] >= 0.58) for r in rows)


FLOORS = {"fit_candidates": _candidates, "fit_regressor": _regressor, "multiclass_score": _multiclass,
          "feature_importance": _importance, "score_table": _scores}


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    rows = entry.queries()[name](spark, SF).collect()
    assert rows
    FLOORS.get(name, lambda _: None)(rows)
