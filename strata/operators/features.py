"""Feature derivation (X1–X27) over a DataFrame.

Each feature is added only when the columns it needs exist (a plan-time
schema check), mirroring the tolerant schema of the source application.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import expressions as X
from strata.operators.clean import impute_median

GPA_COLUMNS = ["gpa_1", "gpa_2", "gpa_3", "gpa_4", "gpa_5", "gpa_6"]


def fill_bmi(df: DataFrame, method: str = "exact") -> DataFrame:
    """Add bmi, its gaps filled with the median: the one feature that needs a
    statistics job, kept apart from the row-wise ones."""
    if "weightkg" not in df.columns or "heightcm" not in df.columns:
        return df
    return impute_median(df.withColumn("bmi", X.bmi_raw()), ["bmi"], method=method)


def add_ml_features(gold: DataFrame) -> DataFrame:
    """Career path, scores, GPA statistics, wellbeing and support signals, BMI."""
    df = gold
    has = lambda *c: X.has(df, *c)
    if has("technical_projects", "gpa_1", "career_willingness"):
        df = df.withColumn("career_path", X.career_path())
    if has("marks_10th", "marks_12th", "cgpa"):
        df = df.withColumn("academic_score", X.academic_score())
    if has("technical_projects", "tech_quiz", "olympiads_qualified"):
        df = df.withColumn("technical_score", X.technical_score(df).cast("double"))
    gpa = [c for c in GPA_COLUMNS if c in df.columns]
    if gpa:
        df = df.withColumns({"avg_gpa": X.row_mean(gpa), "gpa_variance": X.row_var_pop(gpa)})
        if has("gpa_1", "gpa_6"):
            df = df.withColumn("gpa_trend", X.gpa_trend())
    if has("thispresent", "prispresent"):
        df = df.withColumn("attendance_score", X.attendance_score())
    if has("technical_projects", "miscellany_tech_events"):
        df = df.withColumn("engagement_score", X.engagement_score(df).cast("double"))
    df = df.withColumns({"stress_risk": X.stress_risk(df).cast("double"),
                         "productivity_score": X.productivity_score(df).cast("double")})
    if has("current_back", "ever_back", "noofbacklog"):
        df = df.withColumn("backlog_pressure", X.backlog_pressure())
    if has("theorycredit", "practicalcredit"):
        df = df.withColumn("subject_load", X.subject_load())
    if has("sgpa", "prsgpa"):
        df = df.withColumn("academic_momentum", X.academic_momentum())
    if has("theoryagggradepoint", "theorycredit", "practicalagggradepoint", "practicalcredit"):
        df = df.withColumn("credit_efficiency", X.credit_efficiency())
    df = df.withColumn("wellbeing_balance", X.wellbeing_balance())
    df = df.withColumn("employability_signal", X.employability_signal(df).cast("double"))
    df = df.withColumn("student_support_need", X.student_support_need(df).cast("double"))
    return df


def dashboard_frame(df: DataFrame) -> DataFrame:
    """Dashboard schema normalisation plus effective CGPA, study efficiency,
    distraction index and discipline score."""
    from strata.functions import constants as K
    from strata.operators.schema import dashboard_schema
    df = dashboard_schema(df)
    df = df.withColumn("effective_cgpa", X.effective_cgpa(df))
    df = df.withColumns({c: F.coalesce(X.to_number(c, df), F.lit(0.0)) for c in K.DASHBOARD_NUMERIC if c in df.columns})
    return df.withColumns({"study_efficiency": X.study_efficiency(df),
                           "distraction_index": X.distraction_index(df),
                           "discipline_score": X.discipline_score(df)})


def risk_pct_rescale(df: DataFrame, column: str, output: str = "risk_probability_pct") -> DataFrame:
    """×100 when the column's global max ≤ 1.1, then clip to [0, 100]."""
    mx = F.lit(df.agg(F.max(X.to_number(column, df)).alias("m")).first()["m"]).cast("double")
    v = X.to_number(column, df)
    scaled = F.when(mx <= 1.1, v * 100).otherwise(v)
    return df.withColumn(output, X.clip(scaled, 0.0, 100.0))
