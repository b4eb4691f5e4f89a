"""Row-wise column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage code generation.  Helpers that take a DataFrame
only inspect its schema (plan-time, no job) to honour the "absent column counts
as 0" convention of the feature definitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import constants as K

__all__ = [
    "col_or", "has", "to_number", "percent_to_number", "clean_text", "strip_text",
    "yes_no", "bucket_time_range", "lookup", "ordinal", "map_values",
    "round_half_even_int", "clip", "safe_div", "yes01", "time_score",
    "stress_score", "financial_score", "career_path", "academic_score",
    "technical_score", "row_mean", "row_var_pop", "gpa_trend", "attendance_score",
    "engagement_score", "stress_risk", "productivity_score", "backlog_pressure",
    "subject_load", "academic_momentum", "credit_efficiency", "wellbeing_balance",
    "employability_signal", "student_support_need", "bmi_raw", "effective_cgpa",
    "study_efficiency", "distraction_index", "discipline_score", "readiness_score",
    "readiness_status", "segment_insights", "study_hours_from_label",
    "binary_target", "risk_label", "recommended_intervention", "risk_band",
]

_NUMBER_RE = r"^\s*[+-]?((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?\s*$"


def has(df: DataFrame, *cols: str) -> bool:
    return set(cols) <= set(df.columns)


def col_or(df: DataFrame, name: str, default=0) -> Column:
    """``df[name]`` if present, else a literal (the ``df.get(col, 0)`` idiom)."""
    return F.col(name) if name in df.columns else F.lit(default)


def to_number(c: Column | str, df: DataFrame | None = None) -> Column:
    """Coerce to double like ``to_numeric(errors="coerce")``: invalid → NULL.

    Spark casts also accept suffixes such as ``"1d"``; a regex guard keeps only
    plain decimal / scientific text.  NaN becomes NULL.  With the frame that
    holds column ``c``, numbers are not written as text and read again; the
    result is the same (infinite ones are no such text: NULL).
    """
    kind = next((f.dataType for f in df.schema.fields if f.name == c), None) if df is not None and isinstance(c, str) else None
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(kind, T.DoubleType):
        return F.when(F.abs(c) < float("inf"), c)  # NaN is above
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return c.cast("double")
    text = c.cast("string")
    num = F.when(text.rlike(_NUMBER_RE), F.trim(text).try_cast("double"))
    return F.when(F.isnan(num), None).otherwise(num)


def percent_to_number(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return to_number(F.regexp_replace(c.cast("string"), "%", ""))


def strip_text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def clean_text(c: Column | str) -> Column:
    """lower + strip (whitespace of all kinds, not only spaces)."""
    return F.lower(strip_text(c))


def yes_no(c: Column | str) -> Column:
    """'yes' stays 'yes', everything else (incl. NULL) becomes 'no'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "yes", "yes").otherwise("no")


def bucket_time_range(c: Column | str, rules=K.TIME_RANGE_RULES,
                      other: str = K.TIME_RANGE_OTHER) -> Column:
    """Free text → time bucket by substring rules, first match wins."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.lower(c.cast("string"))
    expr = None
    for label, needles in rules:
        cond = None
        for n in needles:
            t = text.contains(n)
            cond = t if cond is None else (cond | t)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(c.isNull(), other).otherwise(expr.otherwise(other))


def lookup(c: Column | str, mapping: Mapping, default=None) -> Column:
    """CASE chain over a small literal mapping; unmapped → ``default``."""
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def ordinal(c: Column | str, mapping: Mapping, default) -> Column:
    """Lower-cased text → score, default for unmapped and NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return lookup(F.lower(c.cast("string")), mapping, default)


def map_values(c: Column | str, mapping: Mapping) -> Column:
    """Exact-match replace; values not in the mapping pass through."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(lookup(c, mapping, None), c)


def round_half_even_int(c: Column | str, fill: float = 0) -> Column:
    """coerce → fill NULL → round half to even → int."""
    return F.bround(F.coalesce(to_number(c), F.lit(float(fill))), 0).cast("int")


def clip(c: Column | str, lo=None, hi=None) -> Column:
    """NULL-preserving clip (``least``/``greatest`` would skip NULLs)."""
    c = F.col(c) if isinstance(c, str) else c
    out = c
    if lo is not None:
        out = F.when(out < F.lit(lo), F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > F.lit(hi), F.lit(hi)).otherwise(out)
    return out


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


# ---------------------------------------------------------------- scores ----

def _term(df: DataFrame, name: str, mapping, default) -> Column:
    if name not in df.columns:
        return F.lit(0)
    return ordinal(name, mapping, default)


def yes01(df: DataFrame, name: str) -> Column:
    return _term(df, name, K.YES_NO_SCORE, K.YES_NO_DEFAULT)


def time_score(df: DataFrame, name: str) -> Column:
    return _term(df, name, K.TIME_SCORE, K.TIME_SCORE_DEFAULT)


def stress_score(df: DataFrame, name: str = "stress_level") -> Column:
    return _term(df, name, K.STRESS_SCORE, K.STRESS_SCORE_DEFAULT)


def financial_score(df: DataFrame, name: str = "financial_status") -> Column:
    return _term(df, name, K.FINANCIAL_SCORE, K.FINANCIAL_DEFAULT)


def career_path(rules=K.CAREER_RULES, default=K.CAREER_DEFAULT) -> Column:
    """First rule whose ``column > threshold`` holds; NULL compares false."""
    expr = None
    for label, name, threshold in rules:
        cond = F.coalesce(F.col(name) > F.lit(threshold), F.lit(False))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def academic_score() -> Column:
    return (F.col("marks_10th") + F.col("marks_12th") + F.col("cgpa")) / 3


def technical_score(df: DataFrame) -> Column:
    return (F.col("technical_projects") + F.col("tech_quiz") + F.col("olympiads_qualified")
            + yes01(df, "certification_course"))


def _count_present(cols: Sequence[str]) -> Column:
    n = F.lit(0)
    for c in cols:
        n = n + F.col(c).isNotNull().cast("int")
    return n


def _sum_present(cols: Sequence[str]) -> Column:
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return total


def row_mean(cols: Sequence[str]) -> Column:
    """Mean of the non-null values across ``cols`` (NULL when all are NULL).
    Plain arithmetic, so it stays inside generated code."""
    n = _count_present(cols)
    return F.when(n > 0, _sum_present(cols) / n)


def row_var_pop(cols: Sequence[str]) -> Column:
    """Population variance (ddof=0) across the non-null values of ``cols``."""
    n = _count_present(cols)
    mean = _sum_present(cols) / n
    ss = F.lit(0.0)
    for c in cols:
        x = F.col(c).cast("double")
        ss = ss + F.when(x.isNotNull(), (x - mean) * (x - mean)).otherwise(F.lit(0.0))
    return F.when(n > 0, ss / n)


def gpa_trend() -> Column:
    return F.col("gpa_6") - F.col("gpa_1")


def attendance_score() -> Column:
    return (F.col("thispresent") + F.col("prispresent")) / 2


def engagement_score(df: DataFrame) -> Column:
    return F.col("technical_projects") + F.col("miscellany_tech_events") + yes01(df, "certification_course")


def stress_risk(df: DataFrame) -> Column:
    return stress_score(df, "stress_level") + time_score(df, "social_media_time")


def productivity_score(df: DataFrame) -> Column:
    return time_score(df, "daily_study_time") - time_score(df, "social_media_time")


def backlog_pressure() -> Column:
    return F.col("current_back") + F.col("ever_back") + F.col("noofbacklog")


def subject_load() -> Column:
    return F.col("theorycredit") + F.col("practicalcredit")


def academic_momentum() -> Column:
    return F.col("sgpa") - F.col("prsgpa")


def credit_efficiency() -> Column:
    total = F.col("theorycredit") + F.col("practicalcredit")
    points = (F.col("theoryagggradepoint") * F.col("theorycredit")
              + F.col("practicalagggradepoint") * F.col("practicalcredit"))
    return F.when(total > 0, F.try_divide(points, total)).otherwise(F.lit(0.0))


def wellbeing_balance() -> Column:
    return F.col("productivity_score") - F.col("stress_risk")


def employability_signal(df: DataFrame) -> Column:
    return (col_or(df, "technical_score") + col_or(df, "engagement_score")
            + yes01(df, "like_degree"))


def student_support_need(df: DataFrame) -> Column:
    return (col_or(df, "backlog_pressure") + F.col("stress_risk") + yes01(df, "parttime_job")
            - financial_score(df, "financial_status"))


def bmi_raw() -> Column:
    """weight / height_m²; height ≤ 0 → NULL (median-filled by the caller)."""
    h = F.col("heightcm") / 100
    return F.when(h > 0, F.col("weightkg") / (h * h))


def effective_cgpa(df: DataFrame) -> Column:
    parts = [to_number(c, df) for c in ("cgpa", "gpa_6", "gpa_1") if c in df.columns]
    if "exam_score" in df.columns:
        parts.append(to_number("exam_score", df) / 10)
    return F.coalesce(*parts, F.lit(0.0)) if parts else F.lit(0.0)


def _hours(df: DataFrame) -> Column:
    h = to_number("study_hours_per_day", df) if "study_hours_per_day" in df.columns else F.lit(0.0)
    return F.when(h != 0, h)


def study_efficiency(df: DataFrame, effective: str = "effective_cgpa") -> Column:
    """(marks/100)·(8/hours)·100 clipped to [0, 100]; no hours → 0."""
    marks = to_number("exam_score", df) if "exam_score" in df.columns else F.lit(None).cast("double")
    marks = F.coalesce(marks, F.col(effective) * 10)
    raw = F.try_divide(marks / 100 * 8, _hours(df)) * 100
    return clip(F.coalesce(raw, F.lit(0.0)), 0.0, 100.0)


def distraction_index(df: DataFrame) -> Column:
    sm = to_number("social_media_hours", df) if "social_media_hours" in df.columns else F.lit(0.0)
    return F.coalesce(F.try_divide(sm, _hours(df)), F.lit(0.0))


def discipline_score(df: DataFrame) -> Column:
    att = to_number("attendance_percentage", df) if "attendance_percentage" in df.columns else F.lit(0.0)
    hrs = to_number("study_hours_per_day", df) if "study_hours_per_day" in df.columns else F.lit(0.0)
    att = clip(F.coalesce(att, F.lit(0.0)), 0.0, 100.0) / 100
    hrs = clip(F.coalesce(hrs, F.lit(0.0)) / 8, 0.0, 1.0)
    return (att * 0.6 + hrs * 0.4) * 100


def readiness_score(cgpa: Column, internships: Column, projects: Column, skills: Column) -> Column:
    w = K.READINESS_WEIGHTS
    raw = (cgpa * w["cgpa"] + internships * w["internships"] + projects * w["projects"]
           + skills * w["skills"])
    return clip(raw, 0.0, 100.0)


def readiness_status(score: Column) -> Column:
    expr = None
    for cut, label in K.READINESS_LEVELS:
        expr = F.when(score >= cut, label) if expr is None else expr.when(score >= cut, label)
    return expr.otherwise(K.READINESS_DEFAULT)


# FIXED VALUES: insight sentences (condition true, condition false).
_INSIGHTS = [
    ("Actively looking for jobs boosts placement likelihood.",
     "A passive job search keeps options open for other paths."),
    ("Entrepreneurship interest leaves room for startup paths.",
     "Lower entrepreneurship interest shifts focus toward jobs or further studies."),
    ("Pursuing further education signals higher-education orientation.",
     "No immediate further education focus detected."),
]


def segment_insights(job_search: Column, entrepreneurship: Column, further_education: Column) -> Column:
    conds = [F.coalesce(job_search == "Actively looking", F.lit(False)),
             F.coalesce(entrepreneurship.isin("High", "Medium"), F.lit(False)),
             F.coalesce(further_education == "Yes", F.lit(False))]
    return F.array(*[F.when(c, yes).otherwise(no) for c, (yes, no) in zip(conds, _INSIGHTS)])


def study_hours_from_label(c: Column | str) -> Column:
    """Study-time label → hours; unmapped → NULL."""
    return lookup(F.lower(F.col(c) if isinstance(c, str) else c), K.STUDY_HOURS, None)


def binary_target(c: Column | str) -> Column:
    """value > 0 → 1 else 0 (NULL → 0)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce((c > 0).cast("int"), F.lit(0))


def risk_label(p: Column | str) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    expr = None
    for cut, label, _ in K.PROBABILITY_BANDS:
        expr = F.when(p >= cut, label) if expr is None else expr.when(p >= cut, label)
    return expr.otherwise(K.PROBABILITY_BAND_DEFAULT[0])


def recommended_intervention(p: Column | str) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    expr = None
    for cut, _, text in K.PROBABILITY_BANDS:
        expr = F.when(p >= cut, text) if expr is None else expr.when(p >= cut, text)
    return expr.otherwise(K.PROBABILITY_BAND_DEFAULT[1])


def risk_band(c: Column | str, bands=K.RISK_BANDS) -> Column:
    """Right-closed bands (lo, hi]; NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for label, lo, hi in bands:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (c > lo)
        if hi is not None:
            cond = cond & (c <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(c.isNotNull(), expr)
