"""Cases that once gave wrong or lost rows."""

from pyspark.sql import functions as F

from strata.operators import ml, profile
from strata.plans import student
from strata.sources import files


def test_null_class_rows_are_split_too(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(40)], "id long, y int")
    got = {(r["y"], r["split"]): r["n"] for r in
           ml.stratified_split(df, "id", "y").groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    assert sum(got.values()) == 40 and got[(None, "test")] == 2


def test_small_fractions_are_exact(spark):
    df = spark.range(300_000)
    n = ml.random_split(df, "id", test=1 / 50_000).where("split = 'test'").count()
    assert n == 6


def test_quantile_segments_follow_the_distinct_values(spark):
    df = spark.createDataFrame([(float(v),) for v in [0] * 26 + [1] * 8 + [2] * 66], "v double")
    got = [(r["segment"], r["v"]) for r in profile.quantile_segment_profile(df, "v", ["v"]).collect()]
    assert [s for s, _ in got] == ["Low", "Mid-Low"] and got[1][1] == 2.0
    two = spark.createDataFrame([(float(v % 2),) for v in range(10)], "v double")
    assert profile.quantile_segment_profile(two, "v", ["v"]).count() <= 2
    many = spark.createDataFrame([(float(v),) for v in range(80)], "v double")
    assert [r["segment"] for r in profile.quantile_segment_profile(many, "v", ["v"], q=8).collect()] == \
        [f"Q{i}" for i in range(1, 9)]


def test_null_categories_take_the_mode(spark):
    df = spark.createDataFrame([(float(i), None if i == 0 else "it's" if i % 3 else "b", i % 2, 1.0) for i in range(30)],
                               "x double, c string, y int, w double")
    model = ml.fit_candidates(df, ["x", "c"], "y", weight="w", num_trees=2)["logistic_regression"]
    rows = {r["c"]: r["features"] for r in model.transform(df).where("x <= 1").collect()}
    assert rows[None].toArray()[1:].tolist() == rows["it's"].toArray()[1:].tolist()
    assert rows[None].toArray()[1:].sum() == 1


def test_padded_tokens_stay(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n NA ,NA\n"x\ny",2\n')
    got = [tuple(r) for r in files.read_csv_text(spark, str(tmp_path / "a.csv"), multi_line=True).collect()]
    assert got == [(" NA ", None), ("x\ny", "2")]


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("v\n1\n2\n")
    (tmp_path / "b.csv").write_text("v\n" + "".join(f"{i}\n" for i in range(100, 140)))
    rows = student.read_raw_csv(spark, str(tmp_path)).orderBy(student.ROW).collect()
    assert [r["v"] for r in rows] == ["1", "2", *map(str, range(100, 140))]


def test_duplicates_are_found_on_typed_values(spark):
    raw = spark.createDataFrame([("1", "a", 0), ("1.0", "a", 1), ("2", "b", 2)], "student_id string, major string, _row long")
    assert student.clean_performance(raw).count() == 2


def test_split_by_selection_equals_full_order(spark, monkeypatch):
    """Cuts found by narrowing slices are those of the full order; repeated ids
    stay together; the rows are not shuffled."""
    import hashlib
    import math
    rows = [(i, None if i % 11 == 0 else i % 3) for i in range(2500)]
    df = spark.createDataFrame(rows, "id long, y int")

    def brute(cls):
        order = sorted((i for i, y in rows if y == cls), key=lambda i: (hashlib.md5(f"{i}42".encode()).hexdigest(), i))
        n = len(order)
        t = math.ceil(n / 5)
        v = t + math.ceil((n - t) / 4)
        return {i: "test" if r < t else "validation" if r < v else "train" for r, i in enumerate(order)}

    want = {i: s for cls in (None, 0, 1, 2) for i, s in brute(cls).items()}
    for sort_rows in (10_000, 1):  # sorted at once, or narrowed to single rows first
        monkeypatch.setattr(ml, "SORT_ROWS", sort_rows)
        out = ml.stratified_split(df, "id", "y")
        assert {r["id"]: r["split"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan
    hot = spark.createDataFrame([(7, 1)] * 3000 + [(i, 1) for i in range(100, 1100)], "id long, y int")
    parts = {(r["id"], r["split"]): r["n"] for r in ml.stratified_split(hot, "id", "y").groupBy("id", "split").agg(F.count("*").alias("n")).collect()}
    assert len(parts) == 1001 and sum(parts.values()) == 4000
    assert ml.random_split(hot.where("id < 0"), "id").count() == 0


def test_stored_medians_are_exact_and_saved(spark, tmp_path):
    from pyspark.ml import Pipeline
    df = spark.createDataFrame([(1.0, None, "a"), (2.0, float("nan"), "b"), (5.0, None, None), (8.0, None, "a"), (None, None, "a"),
                                (float("nan"), None, "a")], "x double, empty double, c string")
    medians = ml.column_medians(df, ["x", "empty"])
    assert medians == {"x": 3.5}  # an even count; NULL and NaN are missing
    pipe = Pipeline(stages=ml.build_preprocessor(["x", "empty"], ["c"], modes=ml.category_modes(df, ["c"]), medians=medians)).fit(df)
    ml.save_model(pipe, str(tmp_path / "pipe"))
    out = ml.load_model(str(tmp_path / "pipe")).transform(df).collect()
    assert [r["x__imp"] for r in out] == [1.0, 2.0, 5.0, 8.0, 3.5, 3.5] and {r["empty__imp"] for r in out} == {0.0}


def test_file_positions_move_no_row(spark, tmp_path):
    """Several files, several splits a file, blank lines and quoted commas: the
    numbers follow the files, and only counts are shuffled."""
    from strata.operators.align import surrogate_key
    want = []
    for f in range(3):
        lines = [f'{f}-{i},"a, {i}"' for i in range(4000)]
        want += [f"{f}-{i}" for i in range(4000)]
        (tmp_path / f"part{f}.csv").write_text("k,v\n" + "\n\n".join(lines) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        out = surrogate_key(files.read_csv_text(spark, str(tmp_path)), None, "n")
        assert out.rdd.getNumPartitions() > 6
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [r["k"] for r in sorted(got, key=lambda r: r["n"])] == want
    assert sorted(r["n"] for r in got) == list(range(1, len(want) + 1)) and got[0]["v"].startswith("a, ")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_fitting_computes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def once(x):
        seen.add(1)
        return x

    df = spark.createDataFrame([(float(i), "a" if i % 3 else "b", i % 2, 1.0) for i in range(30)], "x double, c string, y int, w double")
    df = df.withColumn("x", once("x"))
    models = ml.fit_candidates(df, ["x", "c"], "y", weight="w", num_trees=3)
    assert seen.value == 30 and models["random_forest"].stages[-1].getCacheNodeIds()
    assert models["random_forest"].transform(df).count() == 30
    tree = ml.fit_regressor(df, ["x", "c"], "y", num_trees=2)
    assert seen.value <= 90 and tree.stages[-1].getCacheNodeIds()
