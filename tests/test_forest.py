"""The forest that is grown in tasks: its splits, its draws, its jobs."""

import numpy as np
from pyspark.sql import functions as F

from strata.operators import forest, ml


def _rows(spark, n=600):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 2))
    y = x[:, 0] * 2 + (x[:, 1] > 0.5) * 3 + rng.normal(size=n) * 0.1
    return spark.createDataFrame([(i, float(a), float(b), "uvw"[i % 3], float(t), int(t > 1)) for i, ((a, b), t) in enumerate(zip(x, y))],
                                 "id long, a double, b double, c string, t double, y int")


def _brute(keys, target, weight, count):
    """The largest weighted gain over all features and cuts, by its definition."""
    def power(rows):
        w = weight[rows].sum()
        return sum((weight[rows] * target[rows, j]).sum() ** 2 for j in range(target.shape[1])) / w

    everything = np.arange(len(keys))
    best = -1.0
    for f in range(keys.shape[1]):
        for cut in range(forest.BINS - 1):
            low = keys[:, f] <= cut
            if count[low].sum() >= forest.LEAST and count[~low].sum() >= forest.LEAST:
                best = max(best, power(everything[low]) + power(everything[~low]) - power(everything))
    return best


def test_splits_have_the_largest_gain():
    rng = np.random.default_rng(5)
    for classes in (0, 2, 3):
        keys = rng.integers(0, forest.BINS, (80, 3)).astype(np.uint8)
        y = rng.integers(0, max(classes, 1), 80) if classes else rng.normal(size=80)
        target = np.eye(classes)[y] if classes else (y - y.mean())[:, None]
        weight, n = rng.random(80) + 0.5, rng.integers(1, 4, 80)
        tree = forest.grow(keys, target, weight, n, 0, 1, 1, 3, 1.0)
        drawn = np.random.default_rng([1, 0]).poisson(n)  # the draws of tree 0
        at = np.flatnonzero(drawn)
        best = _brute(keys[at], target[at], (weight * drawn)[at], drawn[at])
        feature, cut, left, value, importance = tree
        if feature[0] < 0:  # merged: both sides say the same
            continue
        low = keys[at, feature[0]] <= cut[0]
        w = (weight * drawn)[at]
        side = [sum(((w * target[at, j])[s]).sum() ** 2 for j in range(target.shape[1])) / w[s].sum() for s in (low, ~low, np.ones(len(at), bool))]
        assert abs(side[0] + side[1] - side[2] - best) < 1e-9 and importance[feature[0]] == 1
        for leaf, s in ((left[0], low), (left[0] + 1, ~low)):
            assert np.allclose(value[leaf], (w[s, None] * target[at][s]).sum(axis=0) / w[s].sum())
        assert (forest.walk(tree, keys[at]) == np.where(low, left[0], left[0] + 1)).all()


def test_counted_rows_are_drawn_as_often_as_single_rows():
    y = np.array([0, 1])
    drawn = [forest.grow(np.array([[0], [1]], np.uint8), np.eye(2)[y], np.ones(2), np.array([300, 100]), t, 9, 0, 1, 1.0)[3][0, 1] for t in range(400)]
    single = [forest.grow(np.repeat(np.array([[0], [1]], np.uint8), (300, 100), axis=0), np.eye(2)[np.repeat(y, (300, 100))], np.ones(400), np.ones(400, int), t, 9, 0, 1, 1.0)[3][0, 1] for t in range(400)]
    assert abs(np.mean(drawn) - 0.25) < 0.005 and abs(np.mean(single) - 0.25) < 0.005
    assert 0.8 < np.std(drawn) / np.std(single) < 1.25


def test_forest_does_not_follow_the_partitions(spark):
    df = _rows(spark)
    for fit in (lambda d: ml.fit_regressor(d, ["a", "b", "c"], "t", num_trees=6),
                lambda d: ml.fit_candidates(d.withColumn("w", F.lit(1.0) + F.col("y")), ["a", "b", "c"], "y", weight="w", num_trees=6)["random_forest"]):
        said = [{r["id"]: round(r["prediction"], 9) for r in fit(d).transform(df).collect()} for d in (df, df.repartition(7, "t"))]
        assert said[0] == said[1]


def test_jobs_do_not_follow_the_depth(spark):
    """Trees are grown in tasks: a deeper forest takes no more jobs."""
    df = _rows(spark)
    sc, jobs = spark.sparkContext, []
    for depth in (2, 30):
        sc.setJobGroup(f"forest-{depth}", "fit")
        ml.fit_regressor(df, ["a", "b"], "t", num_trees=20, max_depth=depth)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"forest-{depth}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_forest_learns_scores_and_is_saved(spark, tmp_path, monkeypatch):
    df = _rows(spark)
    model = ml.fit_regressor(df, ["a", "b", "c"], "t", num_trees=20)
    rows = model.transform(df).collect()
    left = sum((r["t"] - r["prediction"]) ** 2 for r in rows) / len(rows)
    assert len(rows) == 600 and left < 0.5
    ml.save_model(model, str(tmp_path / "m"))
    again = ml.load_model(str(tmp_path / "m"))
    assert {r["id"]: r["prediction"] for r in again.transform(df).collect()} == {r["id"]: r["prediction"] for r in rows}
    assert again.stages[-1].getNumTrees() == again.stages[-1].trees.count() == 20
    two = ml.fit_candidates(df.withColumn("w", F.lit(1.0)), ["a", "b", "c"], "y", weight="w", num_trees=20)["random_forest"]
    got = ml.positive_probability(two, df, "p").collect()
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 and r["prediction"] == float(r["p"] > 0.5) for r in got if r["p"] != 0.5)
    assert sum(r["prediction"] == r["y"] for r in got) > 560
    top = {r["feature"]: r["importance"] for r in ml.feature_importance(two, df).collect()}
    assert abs(sum(top.values()) - 1) < 1e-9 and max(top, key=top.get) == "_num_scaled_0"
    # more rows than a task may hold: Spark's own trainer
    monkeypatch.setattr(forest, "TASK_BYTES", 100)
    assert ml.fit_regressor(df, ["a", "b"], "t", num_trees=2, max_depth=3).stages[-1].totalNumNodes > 2


def test_scoring_walks_equal_binned_rows_once(spark, monkeypatch):
    df = spark.createDataFrame([(i, float(i % 4), i % 4 // 2, 1.0) for i in range(400)], "id long, a double, y int, w double")
    model = ml.fit_candidates(df, ["a"], "y", weight="w", num_trees=8)["random_forest"]
    asked, scores = [], forest.ForestModel._scores

    def seen(self, keys):
        asked.append(keys.count())
        return scores(self, keys)

    monkeypatch.setattr(forest.ForestModel, "_scores", seen)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def once(x):
        calls.add(1)
        return x

    out = ml.score_table(model, df.withColumn("a", once("a")), 0.5, ["id"], "y", ["a"]).collect()
    assert asked == [4] and calls.value == 400
    assert len(out) == 400 and all(r["backlog_risk_prediction"] == r["backlog_risk_actual"] for r in out)


def test_importances_take_no_more_jobs_for_deeper_trees(spark):
    df = _rows(spark).withColumn("w", F.lit(1.0) + F.col("y"))
    sc, jobs = spark.sparkContext, []
    for depth in (1, 30):
        sc.setJobGroup(f"classes-{depth}", "fit")
        model = ml.fit_candidates(df, ["a", "b", "c"], "y", weight="w", num_trees=10, max_depth=depth, max_iter=5)["random_forest"]
        top = ml.feature_importance(model, df, 3).collect()
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"classes-{depth}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] and len(top) == 3 and top[0]["feature"] == "_num_scaled_0"
