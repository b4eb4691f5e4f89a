"""Refreshed medians, fences and distinct counts equal a full rebuild."""

import random

import pytest

from strata.operators import clean, profile
from strata.operators import quantiles as Q
from strata.streaming.incremental import refresh_if_new
from strata.streaming.statistics import StatisticsMart

SCHEMA = "g string, v double, w double, name string"


def _write(folder, name, rows):
    (folder / name).write_text("g,v,w,name\n" + "".join(",".join("" if x is None else str(x) for x in r) + "\n" for r in rows))


def _rows(rng, n, shift):
    return [(rng.choice(("a", "a", "a", "b", None)), round(rng.gauss(shift, 3), 3), rng.choice((None, 1.5, 2.0)), f"n{rng.randrange(40 + shift)}")
            for _ in range(n)]


@pytest.mark.parametrize("by", [(), ("g",)])
def test_two_refreshes_equal_a_rebuild(spark, tmp_path, by):
    rng = random.Random(4)
    raw = tmp_path / "raw"
    raw.mkdir()
    mart = StatisticsMart(str(tmp_path / "mart"), ["v", "w"], by, ["g", "w", "name"])
    everything = []
    for i, n in enumerate((4000, 2500, 30)):
        rows = _rows(rng, n, 9 * i)
        everything += rows
        _write(raw, f"p{i}.csv", rows)
        refresh_if_new(spark, str(raw), SCHEMA, str(tmp_path / "stream"), mart.add)
    df = spark.createDataFrame(everything, SCHEMA)

    def table(d, *cols):
        return {tuple(r[c] for c in (*by, "column")): tuple(r[c] for c in cols) for r in d.collect()}

    got, want = table(mart.medians(spark), "value"), table(Q.medians(df, ["v", "w"], by), "value")
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    fences = ("q1", "q3", "lower", "upper")
    want = table(clean.iqr_fences(df, ["v", "w"], by), *fences)
    got = table(mart.fences(spark), *fences)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    audit = {r["column"]: (r["missing_count"], r["missing_pct"], r["n_unique"]) for r in mart.audit(spark).collect()}
    assert audit == {r["column"]: (r["missing_count"], r["missing_pct"], r["n_unique"])
                     for r in profile.data_quality_audit(df, ["g", "w", "name"]).collect()}
    close = table(mart.quantiles(spark, [0.5], exact=False), "value")
    assert close[(*(["a"] if by else []), "v")][0] == pytest.approx(table(mart.medians(spark), "value")[(*(["a"] if by else []), "v")][0], abs=0.5)
    mean = {tuple(r[c] for c in (*by, "column")): r["count"] for r in mart.means(spark).collect()}
    assert sum(c for k, c in mean.items() if k[-1] == "v") == len(everything)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    mart = StatisticsMart(str(tmp_path), ["v"], (), ["name"])
    first = spark.createDataFrame([("a", 1.0, None, "x"), ("a", 5.0, None, "y")], SCHEMA)
    second = spark.createDataFrame([("a", 9.0, None, "x"), ("a", None, None, "z"), ("a", 9.0, None, None)], SCHEMA)
    for batch, epoch in ((first, 0), (second, 1), (second, 1), (first, 0)):
        mart.add(batch, epoch)
    assert [r["value"] for r in mart.medians(spark).collect()] == [7.0]
    assert [(r["missing_count"], r["n_unique"]) for r in mart.audit(spark).collect()] == [(1, 4)]


def test_brackets_that_miss_fall_back(spark, tmp_path, monkeypatch):
    mart = StatisticsMart(str(tmp_path), ["v"])
    mart.add(spark.range(9000).selectExpr("'a' g", "cast(id as double) v", "1.0D w", "'n' name"), 0)
    assert [r["value"] for r in mart.medians(spark).collect()] == [4499.5]
    monkeypatch.setattr(Q, "WIDTH", -1.0)  # empty brackets
    assert [r["value"] for r in mart.medians(spark).collect()] == [4499.5]
