"""Training flows: fit, choose, evaluate, score every row, write.

``train_classifier`` fits both candidates, takes each one's best threshold on
the validation rows, chooses by the test rows and scores all rows with both;
``train_regressor`` fits and evaluates the regressor.  The split is written
first, so all later steps see the same rows in the same parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import metrics, ml
from strata.session import pinned
from strata.sources.files import write_json_row, write_layer, write_predictions


def _split(df: DataFrame, path: str) -> DataFrame:
    write_layer(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def train_classifier(df: DataFrame, features: Sequence[str], label: str, id_cols: Sequence[str], out_dir: str,
                     prefix: str = "backlog_risk", num_trees: int = 500, seed: int = 42) -> DataFrame:
    """Fit on the rows with a label, score every row, write under ``out_dir``:
    ``split``, ``models/<name>``, ``predictions/`` (all rows, test rows,
    dashboard columns) and ``metrics`` (JSON).  The first of ``id_cols``
    decides the split.  Returns the metrics, one row: the chosen model, its
    threshold, split sizes, class sizes, and an array with the validation and
    test figures of every model.  Raises if a feature or the label is absent."""
    missing = [c for c in [*features, label, *id_cols] if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns for training: {missing}")
    known = ml.stratified_split(df.where(F.col(label).isNotNull()), id_cols[0], label, seed=seed)
    known = _split(known, f"{out_dir}/split")
    numeric, _ = ml.split_feature_types(df, features)
    part = {name: known.where(F.col("split") == name) for name in ("train", "validation", "test")}
    models = ml.fit_candidates(ml.class_weights(part["train"], label), features, label, num_trees=num_trees, seed=seed)

    figures = None
    threshold = {}
    for name, model in models.items():
        ml.save_model(model, f"{out_dir}/models/{name}")
        # scored once: a job that scores ships the whole model to its tasks
        scored = {which: pinned(ml.positive_probability(model, part[which], "_p", numeric).select(label, "_p"))
                  for which in ("validation", "test")}
        best = metrics.best_threshold(metrics.threshold_sweep(scored["validation"], label, "_p")).first()
        threshold[name] = float(best["threshold"]) if best else 0.5
        for which in ("validation", "test"):
            one = metrics.classification_metrics(scored[which], label, "_p", threshold[name]).select(
                F.lit(name).alias("model"), F.lit(which).alias("split"), "*")
            figures = one if figures is None else figures.unionByName(one)
    figures = _split(figures, f"{out_dir}/figures")
    chosen = metrics.select_best_model(figures.where("split = 'test'")).first()["model"]

    both = df
    for name, model in models.items():
        p = f"{name}_probability"
        both = ml.positive_probability(model, both, p, numeric).select(*both.columns, p)
    extra = [f"{name}_probability" for name in models]
    scored = ml.score_table(models[chosen], both, threshold[chosen], [*id_cols, *extra], label, numeric, prefix)
    write_predictions(scored, part["test"].select(*id_cols), f"{out_dir}/predictions", id_cols, prefix)

    sizes = ml.class_distribution(known, label, "split").agg(F.sort_array(F.collect_list(
        F.struct("split", F.col(label).cast("string").alias("class"), "rows"))).alias("s"))
    out = figures.agg(F.sort_array(F.collect_list(F.struct("model", "split", *[
        c for c in figures.columns if c not in ("model", "split")]))).alias("figures")).select(
        F.lit(chosen).alias("best_model"), F.lit(threshold[chosen]).alias("best_threshold"),
        sizes.scalar().alias("split_rows"), "figures")
    write_json_row(out, f"{out_dir}/metrics")
    return df.sparkSession.read.schema(out.schema).json(f"{out_dir}/metrics")


def train_regressor(df: DataFrame, features: Sequence[str], label: str, id_col: str, out_dir: str,
                    num_trees: int = 160, seed: int = 42) -> DataFrame:
    """Fit on the rows with a numeric label, evaluate on the test rows, write
    ``split``, ``models/regressor`` and ``metrics`` (JSON).  Returns the
    metrics, one row."""
    missing = [c for c in [*features, label, id_col] if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns for training: {missing}")
    rows = df.withColumn(label, F.col(label).try_cast("double")).where(F.col(label).isNotNull())
    known = _split(ml.random_split(rows, id_col, seed=seed), f"{out_dir}/split")
    numeric, _ = ml.split_feature_types(df, features)
    train = known.where("split = 'train'")
    model = ml.fit_regressor(train, features, label, num_trees=num_trees, seed=seed)
    ml.save_model(model, f"{out_dir}/models/regressor")
    scored = model.transform(ml.prepare_numeric(known.where("split = 'test'"), numeric))
    out = metrics.regression_metrics(scored, label, "prediction").withColumnRenamed("n", "test_rows").select(
        train.agg(F.count(F.lit(1))).scalar().alias("train_rows"), "*")
    write_json_row(out, f"{out_dir}/metrics")
    return df.sparkSession.read.schema(out.schema).json(f"{out_dir}/metrics")
