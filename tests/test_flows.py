"""Flows that write: the layer run and the training runs."""

import json
import os

from pyspark.sql import functions as F

from conftest import FIXTURES
from strata.plans import student, training
from strata.streaming.incremental import stale_check


def test_layers_are_written_and_read_back(spark, tmp_path):
    out, att = str(tmp_path / "out"), os.path.join(FIXTURES, "attitude_raw.csv")
    status = student.write_layers(spark, out, att, os.path.join(FIXTURES, "research_bronze.csv")).first()
    rows = {(t["layer"], t["table"]): t["rows"] for t in status["layers"]}
    assert rows[("raw", "attitude")] == rows[("bronze", "attitude")] == 235
    assert rows[("silver", "silver")] == rows[("gold", "gold")] == rows[("gold", "features")] == 235
    assert rows[("warehouse", "dim_student")] == 235
    assert status["source_coverage"]["attitude_record_available"] == 235
    assert sorted({f["source"] for f in status["raw_files"]}) == ["attitude", "research"]
    assert sum(r["student_count"] for r in spark.read.parquet(f"{out}/marts/risk_summary").collect()) == 235
    kpi = spark.read.json(f"{out}/status/dashboard_kpis").first()
    assert kpi["student_count"] == 235
    assert not stale_check(spark, att, f"{out}/run_log").first()["stale"]


def test_counts_come_from_the_writing_jobs(spark, tmp_path):
    """Rows, missing cells and coverage equal those of the tables read again."""
    raw = tmp_path / "raw.csv"
    raw.write_text("Gender,Department\nMale,NA\nMale,NA\nFemale,cs\n,\n")
    out = str(tmp_path / "out")
    status = student.write_layers(spark, out, str(raw)).first()
    for t in status["layers"]:
        df = spark.read.parquet(f"{out}/{t['layer'].replace('raw', 'landed')}/{t['table']}")
        assert t["rows"] == df.count() and t["columns"] == len([c for c in df.columns if t["layer"] != "raw" or c != student.ROW])
        if t["layer"] != "warehouse":  # a warehouse table is cast when it is written
            assert t["missing"] == sum(df.where(F.col(c).isNull()).count() for c in df.columns)
    rows = {(t["layer"], t["table"]): t["rows"] for t in status["layers"]}
    assert rows[("raw", "attitude")] == 4 and rows[("bronze", "attitude")] == 3
    assert status["source_coverage"]["attitude_record_available"] == 3 and status["source_coverage"]["research_record_available"] == 0


def test_classifier_run(spark, tmp_path):
    df = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"),
                                 F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"),
                                 F.when(F.col("id") % 10 != 9, (F.col("id") % 20 >= 12).cast("int")).alias("y"))
    out = str(tmp_path / "run")
    got = training.train_classifier(df, ["x", "kind"], "y", ["id"], out, num_trees=10).first()
    assert got["best_model"] in ("logistic_regression", "random_forest")
    test = {f["model"]: f for f in got["figures"] if f["split"] == "test"}
    assert len(test) == 2 and all(f["roc_auc"] > 0.95 for f in test.values())
    assert sum(s["rows"] for s in got["split_rows"]) == 360
    full = spark.read.parquet(f"{out}/predictions/backlog_risk_predictions")
    assert full.count() == 400  # rows without a label are scored too
    assert {"logistic_regression_probability", "random_forest_probability", "risk_label"} <= set(full.columns)
    held = spark.read.parquet(f"{out}/predictions/backlog_risk_test_predictions").count()
    assert held == sum(s["rows"] for s in got["split_rows"] if s["split"] == "test")
    with open([os.path.join(f"{out}/metrics", f) for f in os.listdir(f"{out}/metrics") if f.endswith(".json")][0]) as fh:
        assert json.load(fh)["best_model"] == got["best_model"]


def test_regressor_run(spark, tmp_path):
    df = spark.range(200).select("id", (F.col("id") % 10).cast("double").alias("x"),
                                 F.when(F.col("id") == 7, "none").otherwise((F.col("id") % 10 * 2).cast("string")).alias("y"))
    got = training.train_regressor(df, ["x"], "y", "id", str(tmp_path / "reg"), num_trees=10).first()
    assert got["train_rows"] + got["test_rows"] == 199
    assert got["r2"] > 0.95
