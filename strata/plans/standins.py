"""Stand-in frames derived from the supplied tables.

The supplied tables are order/lineitem/event data, not student records.  The
catalog maps their columns onto the student-record names the operators expect
(and injects NULLs by key arithmetic over the whole table — no row is
dropped).  The derivations are plain SQL understood by both Spark and DuckDB,
so the operator under test and its oracle start from identical input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# events with NULLs: event_type when event_id % 7 = 0, value when event_id % 5 = 0
EV_SQL = """
SELECT event_id, ts, user_id,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value,
       props
FROM events
"""

# one student-like record per lineitem row
STU_SQL = """
SELECT
  l_orderkey * 8 + l_linenumber AS student_id,
  CASE l_returnflag WHEN 'R' THEN 'CSE' WHEN 'A' THEN 'ECE' ELSE 'MECH' END AS branch,
  CASE WHEN l_linestatus = 'O' THEN 'Male' ELSE 'Female' END AS gender,
  CAST(l_linenumber AS INT) AS semester,
  40 + l_quantity AS marks_10th,
  50 + l_discount * 400 AS marks_12th,
  CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 5 + l_tax * 50 END AS cgpa,
  CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE 4 + l_discount * 50 END AS gpa_1,
  5 + l_tax * 40 AS gpa_2,
  CASE WHEN l_orderkey % 6 = 0 THEN NULL ELSE 6 + l_quantity / 25 END AS gpa_3,
  7 - l_discount * 10 AS gpa_4,
  CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE 5.5 + l_tax * 20 END AS gpa_5,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE 6 + l_quantity / 20 END AS gpa_6,
  CAST(l_linenumber AS DOUBLE) - 1 AS technical_projects,
  l_quantity % 5 AS tech_quiz,
  CAST(l_partkey % 3 AS DOUBLE) AS olympiads_qualified,
  CAST(l_partkey % 4 AS DOUBLE) AS miscellany_tech_events,
  CASE l_returnflag WHEN 'R' THEN 'yes' WHEN 'A' THEN 'no' ELSE 'Yes' END AS certification_course,
  l_discount * 1000 AS career_willingness,
  CASE l_partkey % 5 WHEN 0 THEN 'fabulous' WHEN 1 THEN 'Good' WHEN 2 THEN 'bad'
       WHEN 3 THEN 'awful' ELSE 'unknown' END AS stress_level,
  CASE l_suppkey % 6 WHEN 0 THEN '0-30_min' WHEN 1 THEN '30-60_min' WHEN 2 THEN '1-2_hour'
       WHEN 3 THEN '2+_hour' WHEN 4 THEN 'other' ELSE NULL END AS social_media_time,
  CASE l_orderkey % 5 WHEN 0 THEN '0-30_min' WHEN 1 THEN '30-60_min' WHEN 2 THEN '1-2_hour'
       WHEN 3 THEN '2+_hour' ELSE 'other' END AS daily_study_time,
  CASE l_orderkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE NULL END AS like_degree,
  CASE l_suppkey % 2 WHEN 0 THEN 'yes' ELSE 'no' END AS parttime_job,
  CASE l_orderkey % 4 WHEN 0 THEN 'awful' WHEN 1 THEN 'bad' WHEN 2 THEN 'good' ELSE 'fabulous' END
    AS financial_status,
  CASE WHEN l_partkey % 17 = 0 THEN 0 ELSE 140 + l_quantity * 1.2 END AS heightcm,
  45 + l_discount * 300 AS weightkg,
  CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_extendedprice / 1000 END AS exam_score,
  CASE WHEN l_linenumber = 7 THEN 0 ELSE l_quantity / 6 END AS study_hours_per_day,
  l_tax * 50 AS social_media_hours,
  40 + l_discount * 700 AS attendance_percentage,
  CAST(l_partkey % 3 AS DOUBLE) AS current_back,
  CAST(l_suppkey % 3 AS DOUBLE) AS ever_back,
  l_tax * 60 AS exam_anxiety_score
FROM lineitem
"""

# fact-like academic records (credits, grade points, attendance) per lineitem row
ACAD_SQL = """
SELECT
  l_orderkey * 8 + l_linenumber AS student_id,
  CAST(l_linenumber AS INT) AS semester,
  CAST(l_partkey % 50 AS DOUBLE) AS subjectid,
  CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE CAST(l_suppkey % 4 AS DOUBLE) END AS theorycredit,
  CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE CAST(l_partkey % 3 AS DOUBLE) END AS practicalcredit,
  4 + l_discount * 60 AS theoryagggradepoint,
  5 + l_tax * 50 AS practicalagggradepoint,
  5 + l_quantity / 10 AS sgpa,
  5 + l_discount * 40 AS prsgpa,
  CAST(l_partkey % 3 AS DOUBLE) AS current_back,
  CAST(l_suppkey % 3 AS DOUBLE) AS ever_back,
  CAST(l_orderkey % 4 AS DOUBLE) AS noofbacklog,
  50 + l_quantity AS thispresent,
  40 + l_discount * 500 AS prispresent
FROM lineitem
"""

# binary classification stand-in: p from value, label from event type
SCORED_SQL = """
SELECT event_id, user_id, value / (value + 20) AS p,
       CASE WHEN event_type IN ('error', 'purchase') THEN 1 ELSE 0 END AS y,
       1 - value / (value + 60) AS p2
FROM events
"""


_REGISTERED: dict[tuple[int, str], str] = {}


def register(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Temp views for the named tables (all by default), re-created only when
    the view currently points at another folder."""
    for t in (names or TABLES):
        key = (id(spark), t)
        if _REGISTERED.get(key) == sf_dir and spark.catalog.tableExists(t):
            continue
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
        _REGISTERED[key] = sf_dir


def tables_in(sql: str) -> list[str]:
    import re
    words = set(re.findall(r"[a-z_]+", sql.lower()))
    return [t for t in TABLES if t in words]


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    register(spark, sf_dir, tables_in(sql))
    return spark.sql(sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cte(**parts: str) -> str:
    """WITH clause from named SQL parts (for the DuckDB oracles)."""
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in parts.items()) + "\n"


# DuckDB oracle for the feature columns over STU_SQL
FEAT_ORACLE = """
SELECT s.*,
  CASE WHEN technical_projects > 2 THEN 'technical' WHEN gpa_1 > 8 THEN 'academic'
       WHEN career_willingness > 70 THEN 'business' ELSE 'balanced' END AS career_path,
  (marks_10th + marks_12th + cgpa) / 3 AS academic_score,
  CAST(technical_projects + tech_quiz + olympiads_qualified
    + CASE lower(certification_course) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 ELSE 0 END AS DOUBLE) AS technical_score,
  CAST(technical_projects + miscellany_tech_events
    + CASE lower(certification_course) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 ELSE 0 END AS DOUBLE) AS engagement_score,
  gpa_6 - gpa_1 AS gpa_trend,
  CAST((CASE lower(stress_level) WHEN 'fabulous' THEN 0 WHEN 'good' THEN 1 WHEN 'bad' THEN 3 WHEN 'awful' THEN 4 ELSE 2 END)
  + (CASE lower(social_media_time) WHEN '0-30_min' THEN 1 WHEN '30-60_min' THEN 2 WHEN '1-2_hour' THEN 3
          WHEN '2+_hour' THEN 4 WHEN 'other' THEN 2 ELSE 2 END) AS DOUBLE) AS stress_risk,
  CAST((CASE lower(daily_study_time) WHEN '0-30_min' THEN 1 WHEN '30-60_min' THEN 2 WHEN '1-2_hour' THEN 3
          WHEN '2+_hour' THEN 4 WHEN 'other' THEN 2 ELSE 2 END)
  - (CASE lower(social_media_time) WHEN '0-30_min' THEN 1 WHEN '30-60_min' THEN 2 WHEN '1-2_hour' THEN 3
          WHEN '2+_hour' THEN 4 WHEN 'other' THEN 2 ELSE 2 END) AS DOUBLE) AS productivity_score,
  CASE lower(like_degree) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 ELSE 0 END AS like01,
  CASE lower(parttime_job) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 ELSE 0 END AS part01,
  CASE lower(financial_status) WHEN 'awful' THEN 1 WHEN 'bad' THEN 2 WHEN 'good' THEN 3 WHEN 'fabulous' THEN 4 ELSE 2 END AS fin,
  CASE WHEN heightcm / 100 > 0 THEN weightkg / ((heightcm / 100) * (heightcm / 100)) END AS bmi_raw
FROM stu s
"""

FEAT2_ORACLE = """
SELECT f.*,
  productivity_score - stress_risk AS wellbeing_balance,
  technical_score + engagement_score + like01 AS employability_signal,
  0 + stress_risk + part01 - fin AS student_support_need,
  coalesce(bmi_raw, (SELECT median(bmi_raw) FROM feat1)) AS bmi
FROM feat1 f
"""


def features_oracle_cte() -> str:
    return cte(stu=STU_SQL, feat1=FEAT_ORACLE, feat=FEAT2_ORACLE)
