"""Bucketed warehouse tables: layout, key checks and joins without a shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from strata.operators import marts
from strata.sources import files


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    gold = spark.range(900).selectExpr(
        "id + 1 as student_id", "if(id % 2 = 0, 'F', 'M') as gender", "concat('b', id % 4) as branch", "cast(id % 9 as double) as marks_10th",
        "cast(id % 5 + 4 as double) as cgpa", "cast(id % 3 as double) as technical_projects", "'good' as stress_level",
        "cast(id % 20 as double) as subjectid", "cast(id % 6 as int) as semester", "cast(id % 10 as double) as sgpa")
    star = marts.star_schema(gold)
    star["fact_student_academic"] = star["fact_student_academic"].unionByName(
        spark.sql("select 5000L student_id, 1 semester, 99.0D subjectid, 7.0D sgpa"))
    star["dim_student"] = star["dim_student"].unionByName(spark.sql("select 1L student_id, 'X' gender, 'b9' branch"))
    return files.save_warehouse_tables(star, "wh_test", str(tmp_path_factory.mktemp("wh")), buckets=4)


def no_key_exchange(df, key):
    return not re.search(rf"hashpartitioning\({key}#", df._jdf.queryExecution().executedPlan().toString())


def test_tables_are_in_the_catalog_and_bucketed(spark, tables):
    assert set(tables) <= {t.name for t in spark.catalog.listTables("wh_test")}
    about = {r["col_name"]: r["data_type"] for r in spark.sql("describe extended wh_test.fact_student_academic").collect()}
    assert about["Num Buckets"] == "4" and "student_id" in about["Bucket Columns"] and about["student_id"] == "int"


def test_checks_find_the_planted_rows(spark, tables):
    got = {(r["table"], r["key"], r["references"]): r["violations"] for r in files.warehouse_violations(tables).collect()}
    assert got[("dim_student", "student_id", None)] == 1
    assert got[("fact_student_academic", "student_id", "dim_student")] == 1
    assert got[("fact_student_academic", "subjectid", "dim_subject")] == 1
    assert got[("dim_subject", "subjectid", None)] == 0 and got[("dim_behavior", "student_id", "dim_student")] == 0


def test_no_exchange_on_the_key(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert no_key_exchange(marts.primary_key_violations(tables["dim_student"], ["student_id"]), "student_id")
        assert no_key_exchange(marts.foreign_key_violations(tables["fact_student_academic"], tables["dim_student"], ["student_id"]), "student_id")
        joined = marts.star_join(tables["fact_student_academic"], [(tables["dim_academic_history"], ["student_id"]),
                                                                   (tables["dim_behavior"], ["student_id"])], ["semester"],
                                 [F.avg("sgpa").alias("avg_sgpa")])
        assert no_key_exchange(joined, "student_id")
        assert not no_key_exchange(marts.primary_key_violations(tables["dim_student"].repartition(3), ["student_id"]), "student_id")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_key_is_written_by_several_tasks(spark, tmp_path):
    hot = spark.range(4000).selectExpr("if(id < 3000, 7, id) as student_id", "cast(id % 6 as int) as semester", "cast(id as double) as sgpa")
    t = files.save_warehouse_tables({"fact_student_academic": hot}, "wh_hot", str(tmp_path / "wh"), buckets=4, salts=6)["fact_student_academic"]
    names = t.select("_metadata.file_name").where("student_id = 7").distinct().count()
    assert t.count() == 4000 and names > 3
    assert no_key_exchange(marts.primary_key_violations(t, ["student_id"]), "student_id")
    again = files.save_warehouse_tables({"fact_student_academic": hot.limit(10)}, "wh_hot", str(tmp_path / "wh"), buckets=4)
    assert again["fact_student_academic"].count() == 10


def test_repeats_are_dropped_where_the_rows_are_dealt(spark, tmp_path):
    """A dimension of mostly different rows is moved once; one of many repeats is made distinct first."""
    gold = spark.range(3000).selectExpr("if(id % 50 = 7, null, id) as student_id", "concat('b', id % 3) as branch", "cast(id % 9 as double) as cgpa",
                                        "cast(id % 4 as double) as subjectid", "1.5D as theorycredit", "cast(id % 10 as double) as sgpa")
    gold = gold.unionByName(gold.where("student_id % 40 = 3"))
    loose, star = marts.star_schema(gold, distinct=False), marts.star_schema(gold)
    assert loose["dim_student"].count() > star["dim_student"].count()
    for salts in (1, 3):
        got = files.save_warehouse_tables(loose, f"wh_late{salts}", str(tmp_path / f"late{salts}"), buckets=4, salts=salts, distinct=files.WAREHOUSE_KEYS)
        want = files.save_warehouse_tables(star, f"wh_early{salts}", str(tmp_path / f"early{salts}"), buckets=4, salts=salts)
        assert set(got) == set(want)
        for t in got:
            assert got[t].schema == want[t].schema
            assert sorted(map(str, got[t].collect())) == sorted(map(str, want[t].collect()))
    exchanges = lambda t, key: files.dealt(loose[t], [F.col(c) for c in loose[t].columns], F.col(key).cast("int"), 4, 1, True
                                           )._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges("dim_student", "student_id") == 1 and exchanges("dim_subject", "subjectid") == 2
    nothing = files.save_warehouse_tables({"dim_student": loose["dim_student"].limit(0)}, "wh_none", str(tmp_path / "none"), buckets=2, distinct=["dim_student"])
    assert nothing["dim_student"].count() == 0


def test_rows_reach_the_writer_in_order_of_the_key(spark, tmp_path):
    """The cheap sort by key stays before the writer's; repeats are dropped without a limit on row numbers."""
    rows = spark.range(3000).selectExpr("if(id % 50 = 7, null, pmod(hash(id), 2000)) as student_id", "concat('b', id % 3) as branch", "cast(id as double) as sgpa")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    key, columns = F.col("student_id").cast("int"), [F.col("student_id").cast("int"), "branch", "sgpa"]
    fact = files.dealt(rows, columns, key, 4)
    assert "Sort [_deal_key" in plan(fact.sortWithinPartitions(F.pmod(F.hash("student_id"), F.lit(4)), "student_id"))
    for df in (fact, files.dealt(rows.unionByName(rows.limit(40)), columns, key, 4, 1, True)):
        assert df.count() == 3000 and "WindowGroupLimit" not in plan(df)
        for part in df.rdd.map(lambda r: r["student_id"]).glom().collect():
            assert part == sorted(part, key=lambda k: (k is not None, k))
    t = files.save_warehouse_tables({"fact_student_academic": rows}, "wh_order", str(tmp_path / "wh"), buckets=4)["fact_student_academic"]
    assert sorted(map(str, t.collect())) == sorted(map(str, rows.select(key.alias("student_id"), "sgpa").collect()))
