"""Rows offered again are scored once; selections read from the slice cube."""

import itertools
import random

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression

from strata.operators import marts
from strata.streaming.incremental import late_rows, score_once

SCHEMA = "id long, at timestamp, x string"


def _write(folder, name, rows):
    (folder / name).write_text("id,at,x\n" + "".join(f"{i},{at},{x}\n" for i, at, x in rows))


def test_a_file_offered_twice_adds_no_row(spark, tmp_path):
    train = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LinearRegression(featuresCol="features", labelCol="y")]).fit(train)
    raw = tmp_path / "raw"
    raw.mkdir()
    first = [(1, "2026-01-01 00:00:00", "3"), (2, "2026-01-03 00:00:00", "abc"), (3, "2026-01-02 00:00:00", "")]
    more = [(4, "2026-01-03 12:00:00", "5"), (2, "2026-01-03 00:00:00", "abc"), ("", "2026-01-03 00:00:00", "7"), ("", "2026-01-03 00:00:00", "8"),
            (6, "", "9")]

    def run():
        stream = spark.readStream.schema(SCHEMA).option("header", True).csv(str(raw))
        return score_once(stream, model, ["x"], ["x"], ["id"], "at", "5 days", str(tmp_path / "sink"), str(tmp_path / "ck"))

    sizes = []
    for name, rows in (("a.csv", first), ("b.csv", first), ("c.csv", more), ("d.csv", more)):
        _write(raw, name, rows)
        run()
        sizes.append(spark.read.parquet(str(tmp_path / "sink")).count())
    assert sizes == [3, 3, 7, 7]
    got = {(r["id"], r["x"]): (r["prediction"], r["reason"]) for r in spark.read.parquet(str(tmp_path / "sink")).collect()}
    assert got[(1, "3")] == (7.0, None) and got[(2, "abc")] == (None, "invalid x") and got[(3, None)] == (None, "missing x")
    assert got[(None, "7")] == (15.0, None) and got[(None, "8")] == (17.0, None) and got[(6, "9")] == (19.0, None)
    _write(raw, "e.csv", [(9, "2035-01-01 00:00:00", "1")])
    run()
    _write(raw, "f.csv", [(1, "2026-01-01 00:00:00", "3"), (10, "2035-01-01 00:00:00", "1")])
    assert late_rows(run()) == 1  # older than the state: dropped, and counted
    assert spark.read.parquet(str(tmp_path / "sink")).count() == 9


def test_every_selection_of_the_cube(spark):
    rng = random.Random(2)
    rows = [(rng.choice(("a", "b", None)), rng.choice(("f", "m")), rng.choice((1, 2, 3, None)), rng.choice((None, rng.random())), rng.random(),
             float(rng.randrange(3)), float(rng.randrange(4)), rng.random(), rng.choice(("yes", "No", None))) for _ in range(400)]
    df = spark.createDataFrame(rows, "branch string, gender string, semester int, effective_cgpa double, study_hours_per_day double, "
                                     "current_back double, technical_projects double, tech_quiz double, certification_course string")
    cube = marts.slice_cube(df).cache()

    def same(got, want):
        assert [{k: round(v, 9) if isinstance(v, float) else v for k, v in r.asDict().items()} for r in got.collect()] == \
            [{k: round(v, 9) if isinstance(v, float) else v for k, v in r.asDict().items()} for r in want.collect()]

    for b, g, s in itertools.product((None, ["a"], []), (None, ["f", "m"]), (None, [1, 3])):
        picked = marts.slice_filter(df, b, g, s)
        same(marts.cube_metric_row(cube, b, g, s), marts.metric_row(picked))
        if b != []:
            same(marts.cube_mean_by(cube, "branch", branches=b, genders=g, semesters=s).orderBy("branch"), marts.branch_performance(picked).orderBy("branch"))
    same(marts.cube_mean_by(cube, "semester", descending=False, dropna=True), marts.semester_trend(df))
    picked = marts.slice_filter(df, ["a"], None, [1, 2])
    same(marts.cube_activity_mix(cube, ["a"], None, [1, 2]).orderBy("activity"), marts.activity_mix(picked).orderBy("activity"))
    assert cube.count() <= 4 * 3 * 5
