"""Wide correlations, bracketed quantiles and identical rows against pandas."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators import prefix, profile, quantiles
from strata.operators import quantiles as Q


def test_wide_correlation_with_nulls_and_a_constant(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(500, 70)), columns=[f"c{i}" for i in range(70)])
    pdf = pdf.mask(rng.random(pdf.shape) < 0.1)
    pdf["c5"] = 0.1
    pdf["c6"] = pdf["c7"] * 2 + 1e6
    cols = list(pdf.columns)
    got = profile.correlation_matrix(spark.createDataFrame(pdf)).toPandas() \
        .pivot(index="column_a", columns="column_b", values="corr").astype(float).loc[cols, cols]
    want = pdf.corr().drop(index="c5", columns="c5")
    assert got["c5"].isna().all() and got.loc["c5"].isna().all()
    assert np.allclose(got.drop(index="c5", columns="c5"), want, atol=1e-8)


@pytest.mark.parametrize("n", [0, 5, 1999, 2000, 30000])
def test_bracketed_quantiles(spark, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": np.floor(rng.exponential(3, n))})
    pdf.loc[pdf.index % 7 == 0, "a"] = np.nan
    probs = [0, 0.1, 0.25, 0.5, 0.9, 0.999, 1]
    got = quantiles.quantiles(spark.createDataFrame(pdf, "a double, b double"), ["a", "b"], probs).collect()
    assert len(got) == (14 if n else 0)
    for r in got:
        assert r["value"] == pytest.approx(pdf[r["column"]].quantile(r["p"]), abs=1e-9)


def test_rank_outside_its_bracket_is_counted_in_full(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MARGIN", 0)
    monkeypatch.setattr(quantiles, "SKETCH", 20)
    pdf = pd.DataFrame({"a": np.random.default_rng(3).normal(size=4000)})
    got = quantiles.quantiles(spark.createDataFrame(pdf), ["a"], [0.3]).first()["value"]
    assert got == pytest.approx(pdf["a"].quantile(0.3))


def test_identical_rows_are_numbered_over_several_partitions(spark):
    df = spark.range(20000).select(F.lit(1).alias("x")).unionByName(spark.range(50).select(F.lit(2).alias("x")))
    out = prefix.with_row_number(df, ["x"], num_partitions=8)
    rows = out.toPandas()
    assert sorted(rows["row_id"]) == list(range(1, 20051))
    assert set(rows[rows["x"] == 2]["row_id"]) == set(range(20001, 20051))
    hot = out.where("x = 1").select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot > 1


def _grouped_by_pandas(rows, probs):
    pdf = pd.DataFrame(rows, columns=["g", "v", "w"])
    out = {}
    for col in ("v", "w"):
        for g, part in pdf.groupby("g", dropna=False):
            x = part[col].dropna().astype(float)
            for p in probs:
                if len(x):
                    out[(None if g is None or g != g else g, col, p)] = float(np.quantile(x, p))
    return out


def test_grouped_quantiles_by_brackets(spark, monkeypatch):
    """A hot group, many small ones, a null one, constants and nulls; every
    path: brackets, few brackets, brackets that miss."""
    rng = random.Random(12)
    rows = [("hot", rng.gauss(0, 9), float(rng.randrange(4))) for _ in range(9000)]
    rows += [(None, rng.random(), None) for _ in range(3000)] + [("flat", 2.5, 1.0)] * 4000
    rows += [(f"s{i % 50}", rng.random(), rng.choice((None, float("nan"), 1.0))) for i in range(900)]
    rng.shuffle(rows)
    clean = [(g, v, None if w is None or w != w else w) for g, v, w in rows]
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(6)
    probs = [0.0, 0.25, 0.5, 0.9]
    want = _grouped_by_pandas(clean, probs)

    def got():
        return {(r["g"], r["column"], r["p"]): r["value"] for r in Q.quantiles(df, ["v", "w"], probs, ["g"]).collect()}

    counted = []
    real = Q.placed_counts
    monkeypatch.setattr(Q, "placed_counts", lambda *a: counted.append(real(*a)) or counted[-1])
    assert got() == pytest.approx(want)
    kept = counted[0].where("g = 'hot' and _col = 'v'").count()
    assert kept < 9000 * 0.1  # of 9,000 distinct values only those near the ranks travel
    monkeypatch.setattr(Q, "BRACKETS", 8)  # one group gets brackets
    assert got() == pytest.approx(want)
    monkeypatch.setattr(Q, "BRACKETS", 200_000)
    real_table = Q.bracket_table

    def wrong(state, columns, probs, by=()):
        shifted = F.transform("b0", lambda b: F.struct((b["lo"] + 1e6).alias("lo"), (b["hi"] + 1e6).alias("hi")))
        return real_table(state, columns, probs, by).withColumn("b0", shifted)

    monkeypatch.setattr(Q, "bracket_table", wrong)
    assert got() == pytest.approx(want)


def test_top_values_do_not_shuffle_texts(spark):
    """Ties that share a long prefix go to the smallest text; hashes travel, not texts."""
    long = "x" * 5000
    rows = [("a", long + "b"), ("a", long + "a"), ("b", None), ("b", long + "b"), (None, long + "c"), (None, long + "c"), (None, "z")] * 3
    df = spark.createDataFrame(rows, "g string, v string")
    got = {r["column"]: (r["count"], r["unique"], r["top"], r["freq"]) for r in Q.top_values(df, ["g", "v"]).collect()}
    assert got == {"g": (12, 2, "a", 6), "v": (18, 4, long + "b", 6)} and got["v"][2] < long + "c"
    by = {r["g"]: (r["top"], r["freq"]) for r in Q.top_values(df, ["v"], ["g"]).collect()}
    assert by == {"a": (long + "a", 3), "b": (long + "b", 3), None: (long + "c", 6)}
    assert Q.top_values(df.where("v = 'none'"), ["g", "v"]).count() == 0
