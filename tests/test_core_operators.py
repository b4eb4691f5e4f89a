"""Operator tests on small frames, checked against pandas / numpy brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.functions import expressions as X
from strata.operators import align, clean, features, metrics, profile, schema
from strata.operators.prefix import running_total, with_row_number
from strata.operators.quantiles import modes, quantiles


def test_row_number_matches_window_and_survives_hot_key(spark):
    # a third of all rows share one order key value
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    got = with_row_number(df, ["k", "id"], "rn", num_partitions=6)
    exp = df.withColumn("rn2", F.row_number().over(Window.orderBy("k", "id")))
    bad = got.join(exp, "id").where(F.col("rn") != F.col("rn2")).count()
    assert bad == 0
    assert sorted(r.rn for r in got.select("rn").collect()) == list(range(1, 3001))


def test_running_total_per_segment(spark):
    pdf = pd.DataFrame({"g": [1, 1, 1, 2, 2, None], "o": [3, 1, 2, 1, 2, 1], "w": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]})
    df = spark.createDataFrame(pdf.astype({"g": "Int64"}).astype(object).where(pdf.notna(), None))
    got = {(r.g, r.o): r.rt for r in running_total(df, ["o"], "w", ["g"], "rt", num_partitions=3).collect()}
    assert got[(1, 1)] == 2.0 and got[(1, 2)] == 5.0 and got[(1, 3)] == 6.0
    assert got[(2, 2)] == 9.0 and got[(None, 1)] == 6.0


@pytest.mark.parametrize("probs", [[0.25, 0.5, 0.75], [0.0, 0.1, 1.0]])
def test_exact_quantiles_match_pandas(spark, probs):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.integers(0, 50, 500).astype(float), np.full(400, 13.0)])  # hot value
    grp = np.where(np.arange(900) % 4 == 0, "a", "b")
    pdf = pd.DataFrame({"g": grp, "v": vals})
    got = quantiles(spark.createDataFrame(pdf), ["v"], probs, ["g"]).collect()
    for r in got:
        assert abs(pdf[pdf.g == r.g].v.quantile(r.p) - r.value) < 1e-9


def test_median_even_count_and_all_null(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None)], "a double, b double")
    out = clean.impute_median(df.union(spark.createDataFrame([(None, None)], "a double, b double")), ["a", "b"])
    rows = out.collect()
    assert sorted(r.a for r in rows) == [1.0, 2.0, 2.5, 3.0, 10.0]
    assert all(r.b is None for r in rows)


def test_mode_ties_smallest_and_fallback(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert modes(df, ["c"]).first().value == "a"
    out = clean.impute_mode(df, ["c"])
    assert sorted(r.c for r in out.collect()) == ["a", "a", "a", "b", "b"]
    empty = spark.createDataFrame([(None,)], "c string")
    assert clean.impute_mode(empty, ["c"], "Unknown").first().c == "Unknown"


def test_cap_keeps_nulls_and_stays_in_fences(spark):
    pdf = pd.DataFrame({"v": [1.0, 2.0, 3.0, 4.0, 100.0, -50.0, None]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "v double")
    out = [r.v for r in clean.cap_outliers_iqr(df, ["v"]).collect()]
    s = pdf.v.dropna()
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert out.count(None) == 1
    assert all(lo <= v <= hi for v in out if v is not None)


def test_header_rules():
    assert schema.bracket_name("Marks[10th]") == "marks_10th"
    assert schema.bracket_name("Engg. Coaching") == "engg_coaching"
    assert schema.alnum_name("Travelling Time ") == "travelling_time_"
    assert schema.alnum_name("willingness to pursue a career based on their degree  ") == \
        "willingness_to_pursue_a_career_based_on_their_degree__"


def test_time_buckets(spark):
    rows = ["1 - 30 Minute", "1 - 1.30 hour", "2 - 3 hour", "More Than 4 hour", "0 Minute", "More than 2 hour", None,
            "1.30 - 2 hour"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [r.b for r in df.select(X.bucket_time_range("t").alias("b")).collect()]
    assert got == ["0-30_min", "30-60_min", "other", "other", "other", "2+_hour", "other", "1-2_hour"]


def test_coercion_rejects_spark_only_forms(spark):
    df = spark.createDataFrame([("1d",), (" 2.5 ",), ("1e3",), ("abc",), ("nan",), ("7",)], "t string")
    assert [r.v for r in df.select(X.to_number("t").alias("v")).collect()] == [None, 2.5, 1000.0, None, None, 7.0]


def test_threshold_index_matches_arange(spark):
    th = np.arange(0.2, 0.81, 0.02)
    ps = np.concatenate([th, th - 1e-12, np.linspace(0, 1, 301)])
    df = spark.createDataFrame([(float(p),) for p in ps], "p double")
    got = [r.k for r in df.select(metrics.threshold_index(F.col("p")).alias("k")).collect()]
    exp = [int((th <= p).sum()) - 1 for p in ps]
    assert got == exp


def test_report_from_golden_confusion(spark):
    # confusion [[3871, 386], [278, 567]] (rows actual 0/1, cols predicted 0/1)
    cells = [(0, 0)] * 3871 + [(0, 1)] * 386 + [(1, 0)] * 278 + [(1, 1)] * 567
    df = spark.createDataFrame(cells, "y int, p int")
    rep = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert abs(rep["accuracy"]["f1"] - 0.8698549588) < 1e-9
    assert abs(rep["1"]["precision"] - 0.5949632739) < 1e-9
    assert abs(rep["1"]["recall"] - 0.6710059172) < 1e-9
    assert abs(rep["1"]["f1"] - 0.6307007786) < 1e-9
    assert abs(rep["macro avg"]["f1"] - 0.7758547909) < 1e-9
    assert abs(rep["weighted avg"]["f1"] - 0.8729276036) < 1e-9


def test_auc_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    p = np.round(rng.random(400), 2)  # ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    got = metrics.roc_auc(df, "y", "p").first().roc_auc
    pos, neg = p[y == 1], p[y == 0]
    exp = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(got - exp) < 1e-12


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    v = np.round(rng.normal(50, 10, 1000), 1)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    got = [r["count"] for r in profile.histogram(df, "v", 30).collect()]
    exp, _ = np.histogram(v, bins=30)
    assert got == exp.tolist()
    const = spark.createDataFrame([(3.0,)] * 5, "v double")
    assert sum(r["count"] for r in profile.histogram(const, "v", 4).collect()) == 5


def test_qcut_matches_pandas(spark):
    rng = np.random.default_rng(7)
    v = np.concatenate([np.zeros(300), rng.integers(1, 20, 200)]).astype(float)
    pdf = pd.DataFrame({"v": v, "w": rng.random(500)})
    got = {r.segment: r.w for r in profile.quantile_segment_profile(spark.createDataFrame(pdf), "v", ["w"]).collect()}
    labels = ["Low", "Mid-Low", "Mid", "Mid-High"]
    bins = pd.qcut(pdf.v, 4, duplicates="drop")
    n = len(bins.cat.categories)
    exp = pdf.groupby(pd.qcut(pdf.v, 4, labels=labels[:n], duplicates="drop"), observed=False).w.mean()
    for k, val in exp.items():
        assert abs(got[k] - val) < 1e-9


def test_backfill_and_alignment(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9), (4, None)], "o int, k int")
    got = {r.o: r.k for r in align.backfill_keys(df, "k", ["o"]).collect()}
    assert got == {1: 5, 2: 10, 3: 9, 4: 11}
    a = spark.createDataFrame([(10, "x"), (20, "y")], "o int, v string")
    b = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r")], "o2 int, v string")
    out = align.positional_align([a, b], [["o"], ["o2"]], ["a", "b"]).orderBy("student_id").collect()
    assert [(r.student_id, r.v, r.a_record_available, r.b_record_available) for r in out] == \
        [(1, "x", 1, 1), (2, "y", 1, 1), (3, None, 0, 1)]


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 6.3, 5.0)], "a double, b double, c double")
    got = {(r.column_a, r.column_b): r.corr for r in profile.correlation_matrix(df).collect()}
    assert got[("a", "c")] is None and got[("c", "c")] is None
    assert abs(got[("a", "b")] - np.corrcoef([1, 2, 3], [2.0, 4.1, 6.3])[0, 1]) < 1e-12


def test_results_unchanged_by_repartitioning(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    a = quantiles(df, ["value"], [0.25, 0.5], ["event_type"]).collect()
    b = quantiles(df.repartition(7, "user_id"), ["value"], [0.25, 0.5], ["event_type"]).collect()
    key = lambda r: (r.event_type, r.p)
    assert sorted(a, key=key) == sorted(b, key=key)


def test_hot_segment_is_split_across_partitions(spark):
    # segment 0 holds a third of all rows; the running total must not put it in one task
    df = spark.range(6000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1)
                                  .alias("seg"))
    out = running_total(df, ["id"], None, ["seg"], "rt", num_partitions=8, partition_col="pid")
    hot = out.where(F.col("seg") == 0)
    assert hot.select("pid").distinct().count() >= 3
    got = [r.rt for r in hot.orderBy("id").collect()]
    assert got == list(range(1, 2001))


def test_approx_quantiles_close_to_exact(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"v": rng.normal(0, 1, 5000)})
    df = spark.createDataFrame(pdf)
    got = {r.p: r.value for r in quantiles(df, ["v"], [0.1, 0.5, 0.9], method="approx").collect()}
    for p, v in got.items():
        rank = (pdf.v <= v).mean()
        assert abs(rank - p) < 0.01


def test_numbers_are_not_read_back_from_text(spark):
    rows = [(1.5, 7, "8", 0.1), (float("nan"), -3, "1d", 2.5), (float("inf"), None, " 2e3 ", None), (None, 2**53 + 1, "NaN", -0.25),
            (-0.0, 0, None, 1e-9), (1e300, 1, ".5", 3.0)]
    df = spark.createDataFrame(rows, "d double, i long, s string, f float")
    fast = df.select(*[X.to_number(c, df).alias(c) for c in df.columns])
    assert [tuple(r) for r in fast.collect()] == [tuple(r) for r in df.select(*[X.to_number(c).alias(c) for c in df.columns]).collect()]
    plan = features.dashboard_frame(df.select(F.col("d").alias("exam_score"), F.col("i").alias("study_hours_per_day")))
    assert "RLIKE" not in plan._jdf.queryExecution().optimizedPlan().toString()
