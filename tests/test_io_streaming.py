"""Sources, sinks, incremental refresh and model persistence."""

import os
import tempfile

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from conftest import FIXTURES
from strata.operators import marts, ml
from strata.sources import files
from strata.streaming import incremental


def test_na_tokens_and_read_table(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b\n1,NA\nn/a,x\n 3 ,null\n")
    df = files.read_table(spark, str(p))
    rows = [tuple(r) for r in df.collect()]
    assert rows == [("1", None), (None, "x"), (" 3 ", None)]


def test_write_layer_and_json_row(spark, tmp_path):
    df = spark.range(5).withColumn("g", F.col("id") % 2)
    files.write_layer(df, str(tmp_path / "layer"), partition_by=["g"])
    assert spark.read.parquet(str(tmp_path / "layer")).count() == 5
    files.write_json_row(marts.dashboard_kpis(df.withColumn("cgpa", F.lit(7.0))), str(tmp_path / "kpi"))
    assert spark.read.json(str(tmp_path / "kpi")).first().avg_cgpa == 7.0


def test_land_new_files_only_once(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.csv").write_text("x,y\n1,2\n")
    landing, log = str(tmp_path / "landing"), str(tmp_path / "log")
    first = files.land_new_files(spark, str(src), landing, log)
    assert [r.file_name for r in first.collect()] == ["a.csv"]
    (src / "b.csv").write_text("x,y\n3,4\n5,6\n")
    second = files.land_new_files(spark, str(src), landing, log)
    assert [r.file_name for r in second.collect()] == ["b.csv"]
    assert spark.read.parquet(landing).count() == 3


def test_refresh_if_new_processes_unseen_files(spark, tmp_path):
    src = tmp_path / "raw"
    src.mkdir()
    (src / "p1.csv").write_text("v\n1\n2\n")
    seen = []

    def rebuild(batch, epoch):
        seen.append(batch.count())

    ck = str(tmp_path / "ck")
    incremental.refresh_if_new(spark, str(src), "v int", ck, rebuild)
    (src / "p2.csv").write_text("v\n3\n")
    incremental.refresh_if_new(spark, str(src), "v int", ck, rebuild)
    assert [n for n in seen if n] == [2, 1]


def test_model_save_load_and_batch_score(spark, tmp_path):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LinearRegression(featuresCol="features", labelCol="y")]).fit(df)
    ml.save_model(model, str(tmp_path / "m"))
    loaded = ml.load_model(str(tmp_path / "m"))
    req = spark.createDataFrame([("3",), ("abc",), (None,)], "x string")
    good, bad = ml.batch_score(loaded, req, ["x"], ["x"])
    assert abs(good.first().prediction - 7.0) < 1e-6
    assert sorted(r.reason for r in bad.collect()) == ["invalid x", "missing x"]


def test_ingest_upload_unions_missing_columns(spark):
    base = spark.createDataFrame([(1, "CSE")], "student_id int, branch string")
    up = spark.createDataFrame([(2, 7.5)], "Student_ID int, CGPA double")
    out = files.ingest_upload(base, up)
    assert out.count() == 2 and "cgpa" in out.columns and "gender" in out.columns


def test_save_warehouse_casts_to_layout(spark, tmp_path):
    gold = spark.createDataFrame([(1, "m", "CSE", 150.5, "yes")], "student_id long, gender string, branch string, "
                                 "heightcm double, parttime_job string")
    tables = marts.star_schema(gold)
    assert set(tables) == {"dim_student", "dim_behavior"} or "dim_student" in tables
    files.save_warehouse({"dim_student": tables["dim_student"]}, str(tmp_path))
    out = spark.read.parquet(str(tmp_path / "dim_student"))
    assert dict(out.dtypes)["student_id"] == "int" and out.count() == 1


def test_upload_aliases_defaults_and_derived_columns(spark):
    base = spark.createDataFrame([(1, 2.0, 7.0)], "student_id long, noofbacklog double, effective_cgpa double")
    up = spark.createDataFrame([(2, 3, 9, 80.0, 4.0)], "student_id int, ` Backlogs` int, No_Of_Backlog int, exam_score double, study_hours_per_day double")
    row = files.ingest_upload(base, up).where("student_id = 2").first()
    assert (row["noofbacklog"], row["current_back"], row["ever_back"]) == (9.0, 9.0, 0.0)  # the first alias wins
    assert row["effective_cgpa"] == 8.0 and row["study_efficiency"] == 100.0 and row["discipline_score"] == 20.0
    bare = files.ingest_upload(base, spark.createDataFrame([(3,)], "student_id int")).where("student_id = 3").first()
    assert (bare["noofbacklog"], bare["current_back"], bare["effective_cgpa"]) == (0.0, 0.0, 0.0) and bare["exam_score"] is None
