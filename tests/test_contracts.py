"""Schema guards, plan-time helpers, prediction sinks and preprocessing."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from strata.operators import marts, ml, profile, schema
from strata.sources import files


def test_require_columns_raises(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert schema.require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="c"):
        schema.require_columns(df, ["a", "c"])


def test_empty_guard_and_auto_target(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, s string")
    assert marts.empty_guard(df.where("a > 5")) and not marts.empty_guard(df)
    assert profile.auto_target(df, ["exam_score", "b"]) == "b"
    assert profile.auto_target(df, ["nope"]) == "b"


def test_resolve_aliases_and_defaults(spark):
    df = spark.createDataFrame([(1, 3.0)], "id int, total_backlogs double")
    out = schema.dashboard_schema(df)
    row = out.first()
    assert row.current_back == 3.0 and row.noofbacklog == 3.0 and row.ever_back == 0
    assert row.category == "GEN" and row.semester == 1


def test_unknown_category_is_all_zero(spark):
    train = spark.createDataFrame([(1.0, "a", 0), (2.0, "b", 1), (3.0, "a", 0), (4.0, "b", 1)], "x double, c string, y int")
    stages = ml.build_preprocessor(["x"], ["c"])
    model = Pipeline(stages=stages).fit(train)
    test = spark.createDataFrame([(1.0, "zzz", 0)], "x double, c string, y int")
    vec = model.transform(test).first().features.toArray()
    assert len(vec) == 3 and list(vec[1:]) == [0.0, 0.0]  # 1 numeric + 2 category slots; unknown → zeros
    known = model.transform(train.limit(1)).first().features.toArray()
    assert sorted(known[1:]) == [0.0, 1.0]


def test_prediction_sinks(spark, tmp_path):
    scored = spark.createDataFrame(
        [(1, 1, 3.0, 0.8, 1, "High Risk", "Immediate mentor follow-up", 1),
         (2, 1, 3.0, 0.1, 0, "No Risk", "Routine monitoring", 0)],
        "student_id int, semester int, subjectid double, backlog_risk_probability double, "
        "backlog_risk_prediction int, risk_label string, recommended_intervention string, backlog_risk_actual int")
    test_ids = spark.createDataFrame([(2, 1, 3.0)], "student_id int, semester int, subjectid double")
    files.write_predictions(scored, test_ids, str(tmp_path), ["student_id", "semester", "subjectid"])
    assert spark.read.parquet(str(tmp_path / "backlog_risk_predictions")).count() == 2
    t = spark.read.parquet(str(tmp_path / "backlog_risk_test_predictions"))
    assert t.count() == 1 and "recommended_intervention" not in t.columns
    dash = spark.read.parquet(str(tmp_path / "backlog_risk_dashboard_output"))
    assert dash.columns == ["student_id", "semester", "subjectid", "backlog_risk_probability", "risk_label",
                            "recommended_intervention"]
