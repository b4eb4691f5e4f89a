"""Grouped marts, KPI rows, warehouse projections and key checks
(G1–G14, G35–G37, J7–J9).  Plain ``groupBy().agg()`` — Spark combines map-side,
so a group holding a third of all rows costs one partial aggregate per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import constants as K
from strata.functions import expressions as X
from strata.operators.schema import select_existing


def _means(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> list[Column]:
    return [F.avg(F.col(c)).alias(a) for c, a in pairs if c in df.columns]


def group_summary(df: DataFrame, by: str, pairs: Sequence[tuple[str, str]],
                  count_col: str = "student_count", count_of: str | None = "student_id") -> DataFrame:
    """count + means per group; NULL group kept and sorted last."""
    cnt = F.count(F.col(count_of)) if count_of and count_of in df.columns else F.count(F.lit(1))
    return (df.groupBy(by).agg(cnt.alias(count_col), *_means(df, pairs))
            .orderBy(F.col(by).asc_nulls_last()))


def career_summary(features: DataFrame) -> DataFrame:
    return group_summary(features, "career_path", K.CAREER_SUMMARY_MEANS)


def semester_summary(features: DataFrame) -> DataFrame:
    return group_summary(features, "semester", K.SEMESTER_SUMMARY_MEANS)


def branch_summary(features: DataFrame) -> DataFrame:
    return group_summary(features, "branch", K.BRANCH_SUMMARY_MEANS)


def risk_band_summary(features: DataFrame, source: str | None = None,
                      bands=K.RISK_BANDS) -> DataFrame:
    """Count per right-closed band, zero-count bands included, NULL band last.

    The band dimension is the fixed band list (a handful of rows); it is joined
    to the per-band counts so empty bands appear with 0.
    """
    if source is None:
        source = next((c for c in ("student_support_need", "exam_anxiety_score") if c in features.columns), None)
    spark = features.sparkSession
    if source is None:
        return spark.createDataFrame([], "risk_band string, student_count bigint")
    counts = (features.select(X.risk_band(source, bands).alias("risk_band"))
              .groupBy("risk_band").agg(F.count(F.lit(1)).alias("n")))
    dim = spark.createDataFrame([(label, i) for i, (label, _, _) in enumerate(bands)],
                                "_band string, band_rank int")
    out = dim.join(counts, dim["_band"] == counts["risk_band"], "full")
    return (out.select(F.coalesce("_band", "risk_band").alias("risk_band"),
                       F.coalesce("n", F.lit(0)).cast("long").alias("student_count"),
                       F.coalesce("band_rank", F.lit(len(bands))).alias("band_rank"))
            .orderBy("band_rank").drop("band_rank"))


def dashboard_kpis(features: DataFrame, stage: str = "dashboard") -> DataFrame:
    """One-row KPI table; absent columns give 0."""
    aggs = [F.count(F.lit(1)).alias("student_count"),
            (F.count_distinct("subjectid") if "subjectid" in features.columns else F.lit(0).cast("long"))
            .alias("subject_count")]
    for c, a in K.KPI_MEANS:
        aggs.append((F.round(F.avg(c), 4) if c in features.columns else F.lit(0.0)).alias(a))
    return features.agg(*aggs).withColumn("last_pipeline_stage", F.lit(stage))


def count_distinct(df: DataFrame, column: str, dropna: bool = True, approx: bool = False) -> DataFrame:
    base = F.approx_count_distinct(column) if approx else F.count_distinct(column)
    if not dropna:
        base = base + F.max(F.col(column).isNull().cast("int"))
    return df.agg(base.alias("n_unique"))


def layer_counts(tables: Mapping[str, DataFrame], layer: str = "") -> DataFrame:
    """(layer, table, rows, columns) for many tables in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(layer).alias("layer"), F.lit(name).alias("table"), "rows",
                     F.lit(len(df.columns)).alias("columns"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_coverage(aligned: DataFrame, names: Sequence[str]) -> DataFrame:
    aggs = [(F.sum(f"{n}_record_available") if f"{n}_record_available" in aligned.columns else F.lit(0))
            .cast("long").alias(f"{n}_record_available") for n in names]
    return aligned.agg(*aggs)


def metric_row(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("records"),
                  F.avg("effective_cgpa").alias("avg_cgpa"),
                  F.avg("study_hours_per_day").alias("avg_study_hours"),
                  F.avg("current_back").alias("avg_current_back"))


def mean_by(df: DataFrame, by: str, value: str, alias: str, descending: bool = True,
            dropna: bool = False) -> DataFrame:
    src = df.where(F.col(by).isNotNull()) if dropna else df
    out = src.groupBy(by).agg(F.avg(value).alias(alias))
    return out.orderBy(F.col(alias).desc_nulls_last() if descending else F.col(by).asc_nulls_last())


def branch_performance(df: DataFrame) -> DataFrame:
    return mean_by(df, "branch", "effective_cgpa", "avg_cgpa")


def gender_performance(df: DataFrame) -> DataFrame:
    return mean_by(df, "gender", "effective_cgpa", "avg_cgpa")


def semester_trend(df: DataFrame) -> DataFrame:
    return mean_by(df, "semester", "effective_cgpa", "avg_cgpa", descending=False, dropna=True)


def activity_mix(df: DataFrame) -> DataFrame:
    """(activity, value, share_pct): sums of projects/quiz, count of certification = yes."""
    one = df.agg(
        F.sum("technical_projects").cast("double").alias("technical_projects"),
        F.count_if(F.lower(F.col("certification_course").cast("string")) == "yes").cast("double")
        .alias("certification_course"),
        F.sum("tech_quiz").cast("double").alias("tech_quiz"))
    long = one.unpivot([], ["technical_projects", "certification_course", "tech_quiz"], "activity", "value")
    total = one.select((F.col("technical_projects") + F.col("certification_course") + F.col("tech_quiz"))).scalar()
    return long.withColumn("share_pct", F.try_divide(F.col("value") * 100, total))


def slice_filter(df: DataFrame, branches=None, genders=None, semesters=None) -> DataFrame:
    """AND of three IN-lists (None = no restriction on that axis)."""
    cond = F.lit(True)
    if branches is not None:
        cond = cond & F.col("branch").cast("string").isin(list(branches))
    if genders is not None:
        cond = cond & F.col("gender").cast("string").isin(list(genders))
    if semesters is not None:
        cond = cond & F.col("semester").cast("int").isin([int(s) for s in semesters])
    return df.where(cond)


SLICE_DIMS = ("branch", "gender", "semester")
# FIXED VALUES: the measures of the dashboard's figures (means) and of its activity mix (sums).
SLICE_MEANS = ("effective_cgpa", "study_hours_per_day", "current_back")
SLICE_SUMS = ("technical_projects", "tech_quiz")


def slice_cube(df: DataFrame) -> DataFrame:
    """Mergeable parts of every slice of (branch, gender, semester), one row a
    cell of each grouping set: ``set`` (its grouping id), the dimensions,
    records, and per measure a sum and a count.

    The table has at most the product of the dimensions' sizes (plus one each)
    rows; any selection on the dashboard is answered from it without the detail
    table (``cube_slice``).
    """
    typed = df.select(F.col("branch").cast("string").alias("branch"), F.col("gender").cast("string").alias("gender"),
                      F.col("semester").cast("int").alias("semester"),
                      *[F.col(c).cast("double").alias(c) for c in (*SLICE_MEANS, *SLICE_SUMS) if c in df.columns],
                      *([(F.lower(F.col("certification_course").cast("string")) == "yes").cast("double").alias("certification_course")]
                        if "certification_course" in df.columns else []))
    measures = [c for c in typed.columns if c not in SLICE_DIMS]
    return typed.cube(*SLICE_DIMS).agg(
        F.grouping_id().alias("set"), F.count(F.lit(1)).alias("records"),
        *[x for c in measures for x in (F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}"))])


def cube_slice(cube: DataFrame, branches=None, genders=None, semesters=None, by: str | None = None) -> DataFrame:
    """The cells of ``slice_filter``'s selection, from the coarsest grouping set
    that still tells the restricted dimensions and ``by`` apart."""
    wanted = {"branch": branches, "gender": genders, "semester": semesters}
    rolled = sum(1 << (len(SLICE_DIMS) - 1 - i) for i, d in enumerate(SLICE_DIMS) if wanted[d] is None and d != by)
    out = cube.where(F.col("set") == rolled)
    return slice_filter(out, branches, genders, semesters)


def _cube_mean(c: str) -> Column:
    return F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}"))


def cube_metric_row(cube: DataFrame, branches=None, genders=None, semesters=None) -> DataFrame:
    """``metric_row`` of a selection, read from the cube."""
    return cube_slice(cube, branches, genders, semesters).agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"), _cube_mean("effective_cgpa").alias("avg_cgpa"),
        _cube_mean("study_hours_per_day").alias("avg_study_hours"), _cube_mean("current_back").alias("avg_current_back"))


def cube_mean_by(cube: DataFrame, by: str, value: str = "effective_cgpa", alias: str = "avg_cgpa", descending: bool = True,
                 dropna: bool = False, branches=None, genders=None, semesters=None) -> DataFrame:
    """``mean_by`` of a dimension over a selection, read from the cube."""
    cells = cube_slice(cube, branches, genders, semesters, by)
    cells = cells.where(F.col(by).isNotNull()) if dropna else cells
    out = cells.groupBy(by).agg(_cube_mean(value).alias(alias))
    return out.orderBy(F.col(alias).desc_nulls_last() if descending else F.col(by).asc_nulls_last())


def cube_activity_mix(cube: DataFrame, branches=None, genders=None, semesters=None) -> DataFrame:
    """``activity_mix`` of a selection, read from the cube."""
    names = ["technical_projects", "certification_course", "tech_quiz"]
    one = cube_slice(cube, branches, genders, semesters).agg(*[F.sum(f"sum_{c}").alias(c) for c in names])
    one = one.withColumn("_total", F.col(names[0]) + F.col(names[1]) + F.col(names[2]))
    return one.unpivot(["_total"], names, "activity", "value").select(
        "activity", "value", F.try_divide(F.col("value") * 100, F.col("_total")).alias("share_pct"))


def filter_options(df: DataFrame, column: str, as_int: bool = False) -> DataFrame:
    c = F.col(column).cast("int" if as_int else "string")
    return df.select(c.alias(column)).where(F.col(column).isNotNull()).distinct().orderBy(column)


def target_not_null(df: DataFrame, target: str) -> DataFrame:
    from strata.functions.expressions import to_number
    return df.withColumn(target, to_number(target, df)).where(F.col(target).isNotNull())


def empty_guard(df: DataFrame) -> bool:
    """True when the frame has no rows (one short job: ``isEmpty``)."""
    return df.isEmpty()


def distinct_dim(df: DataFrame, columns: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame | None:
    """Distinct projection on existing columns; None when no column exists."""
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return None
    out = df.select(*[F.col(f"`{c}`") for c in cols]).distinct()
    return out.withColumnsRenamed(dict(renames)) if renames else out


def fact_table(df: DataFrame, columns: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame | None:
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return None
    out = select_existing(df, cols)
    return out.withColumnsRenamed(dict(renames)) if renames else out


def star_schema(gold: DataFrame, distinct: bool = True) -> dict[str, DataFrame]:
    """Five dimensions and one fact; tables with no existing column are skipped.
    Without ``distinct`` the dimensions keep their repeated rows, for a writer
    that drops them (``save_warehouse_tables``)."""
    ren = {"travelling_time_": "travelling_time"}
    dim = distinct_dim if distinct else fact_table
    tables = {
        "dim_student": dim(gold, K.DIM_STUDENT),
        "dim_academic_history": dim(gold, K.DIM_ACADEMIC_HISTORY),
        "dim_student_activity": dim(gold, K.DIM_STUDENT_ACTIVITY),
        "dim_behavior": dim(gold, K.DIM_BEHAVIOR, ren),
        "dim_subject": dim(gold, K.DIM_SUBJECT),
        "fact_student_academic": fact_table(gold, K.FACT_STUDENT_ACADEMIC, ren),
    }
    return {k: v for k, v in tables.items() if v is not None}


def total_missing(df: DataFrame) -> DataFrame:
    terms = [F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return df.agg(total.cast("long").alias("total_missing"))


def primary_key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that repeat or are NULL, with their row counts."""
    key = list(key)
    null_any = None
    for k in key:
        null_any = F.col(k).isNull() if null_any is None else (null_any | F.col(k).isNull())
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
            .where((F.col("rows") > 1) | null_any))


def foreign_key_violations(child: DataFrame, parent: DataFrame, child_key: Sequence[str],
                           parent_key: Sequence[str] | None = None) -> DataFrame:
    """Child key values with no parent row, with their child row counts.

    The child side is pre-aggregated per key first, so a hot key is one row
    before the anti join shuffles anything.
    """
    child_key = list(child_key)
    parent_key = list(parent_key or child_key)
    present = None
    for k in child_key:
        present = F.col(k).isNotNull() if present is None else (present & F.col(k).isNotNull())
    keys = child.where(present).groupBy(*child_key).agg(F.count(F.lit(1)).alias("rows"))
    par = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_key, child_key)]).distinct()
    return keys.join(par, child_key, "left_anti")


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]], group_by: Sequence[str],
              measures: Sequence[Column]) -> DataFrame:
    """Fact ⋈ dims then group; Spark/AQE choose broadcast by measured size."""
    out = fact
    for dim, keys in dims:
        out = out.join(dim, list(keys), "inner")
    return out.groupBy(*group_by).agg(*measures)
