"""Query catalog: every operator run over the supplied tables, each with an
independent DuckDB oracle (or none, for model fitting and file/stream ops).

Each entry: name → (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL | None).
Double outputs are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import expressions as X
from strata.operators import align, clean, features, marts, metrics, ml, profile, schema
from strata.plans import standins as S
from strata.session import pinned

Fn = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Fn, str | None]] = {}

DIGITS = 6


def rnd(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (both engines do the same)."""
    out = {f.name: F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0) for f in df.schema.fields
           if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(out) if out else df


def rsql(sql: str, cols: list[str], digits: int = DIGITS) -> str:
    """Wrap an oracle query so the named double columns are rounded."""
    if not cols:
        return sql
    rep = ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) _q"


def q(name: str, sql: str | None = None, rcols: list[str] | None = None):
    def deco(fn: Fn) -> Fn:
        CATALOG[name] = (lambda spark, sf_dir: rnd(fn(spark, sf_dir)),
                         None if sql is None else rsql(sql, rcols or []))
        return fn
    return deco


def ev(spark, d):
    return S.frame(spark, d, S.EV_SQL)


def stu(spark, d):
    return S.frame(spark, d, S.STU_SQL)


def feat(spark, d):
    return features.add_ml_features(stu(spark, d))


def feat_bmi(spark, d):
    return features.fill_bmi(feat(spark, d))


EV = S.cte(ev=S.EV_SQL)
STU = S.cte(stu=S.STU_SQL)
FEAT = S.features_oracle_cte()
NUM_RE = r"^\s*[+-]?(([0-9]+\.?[0-9]*)|(\.[0-9]+))([eE][+-]?[0-9]+)?\s*$"


def duck_num(expr: str) -> str:
    return (f"CASE WHEN regexp_matches({expr}, '{NUM_RE}') THEN "
            f"CASE WHEN isnan(TRY_CAST(trim({expr}) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim({expr}) AS DOUBLE) END END")


# ------------------------------------------------------------------ cleaning

# all lines, some of them twice
REPEATED_SQL = "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_quantity < 5"


@q("drop_duplicate_rows", "SELECT DISTINCT * FROM lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
def _(spark, d):
    return clean.drop_duplicate_rows(S.frame(spark, d, REPEATED_SQL))


DIRTY_NUM_SQL = """
SELECT event_id,
  CASE WHEN event_id % 6 = 0 THEN CAST(user_id AS STRING) || 'd'
       WHEN event_id % 6 = 1 THEN 'n/a'
       WHEN event_id % 6 = 2 THEN ' ' || regexp_extract(props, '([0-9]+)', 1) || '.5 '
       WHEN event_id % 6 = 3 THEN regexp_extract(props, '([0-9]+)', 1) || 'e-1'
       ELSE regexp_extract(props, '([0-9]+)', 1) END AS txt
FROM events
"""


@q("coerce_numeric", S.cte(t=DIRTY_NUM_SQL) + f"SELECT event_id, {duck_num('txt')} AS txt FROM t", ["txt"])
def _(spark, d):
    return clean.coerce_numeric(S.frame(spark, d, DIRTY_NUM_SQL), ["txt"])


PCT_SQL = "SELECT event_id, CAST(CAST(floor(value * 100) AS BIGINT) AS STRING) || '%' AS pct FROM events"


@q("percent_to_number", S.cte(t=PCT_SQL) + "SELECT event_id, " + duck_num("replace(pct, '%', '')") + " AS pct FROM t", ["pct"])
def _(spark, d):
    return clean.percent_to_number(S.frame(spark, d, PCT_SQL), ["pct"])


TEXT_SQL = "SELECT c_custkey, '  ' || upper(c_name) || ' ' AS name, c_mktsegment FROM customer"


@q("normalize_text", S.cte(t=TEXT_SQL) + "SELECT c_custkey, lower(trim(name)) AS name FROM t")
def _(spark, d):
    return clean.normalize_text(S.frame(spark, d, TEXT_SQL).select("c_custkey", "name"), ["name"])


YN_SQL = """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'yes' WHEN 'AUTOMOBILE' THEN 'no'
  WHEN 'MACHINERY' THEN 'Yes' WHEN 'HOUSEHOLD' THEN NULL ELSE 'maybe' END AS flag FROM customer
"""


@q("yes_no_normalize", S.cte(t=YN_SQL) + "SELECT c_custkey, CASE WHEN flag = 'yes' THEN 'yes' ELSE 'no' END AS flag FROM t")
def _(spark, d):
    return clean.yes_no_normalize(S.frame(spark, d, YN_SQL), ["flag"])


TIME_TEXT_SQL = """
SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN '0 - 30 minute' WHEN 1 THEN '30 - 60 minute'
  WHEN 2 THEN '1 - 2 Hour' WHEN 3 THEN 'More Than 4 hour' WHEN 4 THEN '1 - 1.30 hour'
  WHEN 5 THEN 'More than 2 hour' WHEN 6 THEN '1 - 30 Minute' ELSE NULL END AS spent FROM customer
"""


@q("bucket_time_range", S.cte(t=TIME_TEXT_SQL) + """
SELECT c_custkey, CASE WHEN spent IS NULL THEN 'other'
  WHEN contains(lower(spent), '0 - 30') OR contains(lower(spent), '30 minute') THEN '0-30_min'
  WHEN contains(lower(spent), '30 - 60') OR contains(lower(spent), '1 - 1.30') THEN '30-60_min'
  WHEN contains(lower(spent), '1 - 2') OR contains(lower(spent), '1.30 - 2') THEN '1-2_hour'
  WHEN contains(lower(spent), 'more than 2') OR contains(lower(spent), '2+') THEN '2+_hour'
  ELSE 'other' END AS spent FROM t""")
def _(spark, d):
    return clean.bucket_time_range(S.frame(spark, d, TIME_TEXT_SQL), ["spent"])


P_TYPE_MAP = {"PROMO": "promotion", "STANDARD": "std", "ECONOMY": "eco", "LARGE": "large"}


@q("map_values", """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'promotion' WHEN 'STANDARD' THEN 'std'
  WHEN 'ECONOMY' THEN 'eco' WHEN 'LARGE' THEN 'large' ELSE p_type END AS p_type FROM part""")
def _(spark, d):
    return clean.map_values(S.table(spark, d, "part").select("p_partkey", "p_type"), "p_type", P_TYPE_MAP)


@q("mapping_join", """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'promotion' WHEN 'STANDARD' THEN 'std'
  WHEN 'ECONOMY' THEN 'eco' WHEN 'LARGE' THEN 'large' ELSE p_type END AS p_type FROM part""")
def _(spark, d):
    return clean.map_values(S.table(spark, d, "part").select("p_partkey", "p_type"), "p_type", P_TYPE_MAP,
                            method="join")


PRIORITY_SCORE = {"1-urgent": 5, "2-high": 4, "3-medium": 3, "5-low": 1}


@q("ordinal_score", """SELECT o_orderkey, CASE lower(o_orderpriority) WHEN '1-urgent' THEN 5 WHEN '2-high' THEN 4
  WHEN '3-medium' THEN 3 WHEN '5-low' THEN 1 ELSE 2 END AS priority_score FROM orders""")
def _(spark, d):
    o = S.table(spark, d, "orders")
    return o.select("o_orderkey", X.ordinal("o_orderpriority", PRIORITY_SCORE, 2).alias("priority_score"))


@q("round_half_even_int",
   "SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS half_qty FROM lineitem")
def _(spark, d):
    li = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 2).alias("half_qty"))
    return clean.round_half_even_int(li, "half_qty")


@q("clip_range", "SELECT l_orderkey, l_linenumber, least(greatest(l_discount * 1000, 10), 60) AS d FROM lineitem",
   ["d"])
def _(spark, d):
    li = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") * 1000).alias("d"))
    return clean.clip_range(li, "d", 10, 60)


@q("impute_median", EV + "SELECT event_id, coalesce(value, (SELECT median(value) FROM ev)) AS value FROM ev",
   ["value"])
def _(spark, d):
    return clean.impute_median(ev(spark, d).select("event_id", "value"), ["value"])


MODE_SQL = ("(SELECT event_type FROM ev WHERE event_type IS NOT NULL GROUP BY event_type "
            "ORDER BY count(*) DESC, event_type LIMIT 1)")


@q("impute_mode", EV + f"SELECT event_id, coalesce(event_type, {MODE_SQL}, 'Unknown') AS event_type FROM ev")
def _(spark, d):
    return clean.impute_mode(ev(spark, d).select("event_id", "event_type"), ["event_type"])


@q("impute_constant", EV + "SELECT event_id, coalesce(value, 0) AS value, coalesce(event_type, 'no') AS event_type FROM ev",
   ["value"])
def _(spark, d):
    return clean.impute_constant(ev(spark, d).select("event_id", "value", "event_type"),
                                 {"value": 0.0, "event_type": "no"})


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _fence_sql(cols, src="lineitem"):
    parts = [f"""SELECT '{c}' AS "column", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3
             FROM {src}""" for c in cols]
    return ("SELECT \"column\", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper "
            "FROM (" + " UNION ALL ".join(parts) + ") f")


@q("iqr_fences", _fence_sql(LI_NUM), ["q1", "q3", "iqr", "lower", "upper"])
def _(spark, d):
    return clean.iqr_fences(S.table(spark, d, "lineitem"), LI_NUM)


@q("cap_outliers_iqr", EV + """, f AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ev)
SELECT event_id, CASE WHEN value < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1)
  WHEN value > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1) ELSE value END AS value FROM ev, f""", ["value"])
def _(spark, d):
    return clean.cap_outliers_iqr(ev(spark, d).select("event_id", "value"), ["value"])


@q("cap_outliers_iqr_by_group", EV + """, f AS (SELECT event_type, quantile_cont(value, 0.25) AS q1,
  quantile_cont(value, 0.75) AS q3 FROM ev GROUP BY event_type)
SELECT event_id, ev.event_type, CASE WHEN value < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1)
  WHEN value > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1) ELSE value END AS value
FROM ev LEFT JOIN f ON ev.event_type IS NOT DISTINCT FROM f.event_type""", ["value"])
def _(spark, d):
    return clean.cap_outliers_iqr(ev(spark, d).select("event_id", "event_type", "value"), ["value"],
                                  by=["event_type"])


# -------------------------------------------------------------------- schema

HDR_SQL = 'SELECT l_orderkey AS "Order Key", l_quantity AS "Qty (units)", l_discount AS "Disc.[pct]" FROM lineitem'


@q("normalize_headers_bracket", "SELECT l_orderkey AS order_key, l_quantity AS qty_units, l_discount AS disc_pct FROM lineitem",
   ["qty_units", "disc_pct"])
def _(spark, d):
    li = S.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("Order Key"),
                                              F.col("l_quantity").alias("Qty (units)"),
                                              F.col("l_discount").alias("Disc.[pct]"))
    return schema.normalize_headers_bracket(li)


@q("normalize_headers_alnum", "SELECT l_orderkey AS order_key, l_quantity AS qty_units, l_discount AS discpct FROM lineitem",
   ["qty_units", "discpct"])
def _(spark, d):
    li = S.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("Order Key"),
                                              F.col("l_quantity").alias("Qty (units)"),
                                              F.col("l_discount").alias("Disc.[pct]"))
    return schema.normalize_headers_alnum(li)


DASH_ORACLE = STU + """, b AS (
  SELECT student_id, branch, gender, semester, cgpa, gpa_1, gpa_6, exam_score,
         coalesce(study_hours_per_day, 0) AS study_hours_per_day,
         coalesce(social_media_hours, 0) AS social_media_hours,
         coalesce(attendance_percentage, 0) AS attendance_percentage,
         coalesce(current_back, 0) AS current_back, stress_level AS stress_level_src,
         coalesce(cgpa, gpa_6, gpa_1, exam_score / 10, 0) AS effective_cgpa
  FROM stu)
SELECT student_id, branch, gender, semester, current_back, current_back AS noofbacklog, 0 AS ever_back,
  stress_level_src AS stress_level, 'GEN' AS category, effective_cgpa, study_hours_per_day,
  least(greatest(coalesce(coalesce(exam_score, effective_cgpa * 10) / 100 * 8
     / CASE WHEN study_hours_per_day <> 0 THEN study_hours_per_day END * 100, 0), 0), 100) AS study_efficiency,
  coalesce(social_media_hours / CASE WHEN study_hours_per_day <> 0 THEN study_hours_per_day END, 0) AS distraction_index,
  (least(greatest(attendance_percentage, 0), 100) / 100 * 0.6
   + least(greatest(study_hours_per_day / 8, 0), 1) * 0.4) * 100 AS discipline_score
FROM b"""


def dash(spark, d):
    s = stu(spark, d).select("student_id", "branch", "gender", "semester", "cgpa", "gpa_1", "gpa_6", "exam_score",
                             "study_hours_per_day", "social_media_hours", "attendance_percentage",
                             F.col("current_back").alias("Current_Back"), F.col("stress_level").alias(" Stress "))
    return features.dashboard_frame(s)


@q("dashboard_frame", "SELECT * EXCLUDE (study_hours_per_day) FROM (" + DASH_ORACLE + ") z",
   ["current_back", "noofbacklog", "effective_cgpa", "study_efficiency", "distraction_index", "discipline_score"])
def _(spark, d):
    df = dash(spark, d)
    return df.select("student_id", "branch", "gender", "semester", "current_back", "noofbacklog",
                     F.col("ever_back").cast("int").alias("ever_back"), "stress_level", "category",
                     "effective_cgpa", "study_efficiency", "distraction_index", "discipline_score")


UPLOAD_SQL = """SELECT o_orderkey, CAST(o_custkey % 5 AS DOUBLE) AS backlog, o_totalprice / 5000 AS exam, CAST(1 + o_custkey % 6 AS DOUBLE) AS hours,
  CASE WHEN o_custkey % 4 = 0 THEN 'x' ELSE CAST(o_custkey % 100 AS STRING) END AS attendance FROM orders"""


@q("ingest_upload", "SELECT * FROM (" + DASH_ORACLE.replace("SELECT student_id, branch, gender, semester, current_back, current_back AS noofbacklog, 0 AS ever_back,",
   "SELECT student_id, branch, current_back, current_back AS noofbacklog,").replace(
       "stress_level_src AS stress_level, 'GEN' AS category, effective_cgpa, study_hours_per_day,", "effective_cgpa,") + """) z UNION ALL
SELECT o_orderkey, 'Unknown', CAST(o_custkey % 5 AS DOUBLE), CAST(o_custkey % 5 AS DOUBLE), o_totalprice / 50000,
  least(greatest(o_totalprice / 5000 / 100 * 8 / (1 + o_custkey % 6) * 100, 0), 100), 0,
  (CASE WHEN o_custkey % 4 = 0 THEN 0 ELSE o_custkey % 100 END / 100 * 0.6 + least((1 + o_custkey % 6) / 8, 1) * 0.4) * 100
FROM orders""", ["current_back", "noofbacklog", "effective_cgpa", "study_efficiency", "distraction_index", "discipline_score"])
def _(spark, d):
    """The dashboard's table with an upload under other headers: aliases, defaults, derived columns."""
    upload = S.frame(spark, d, UPLOAD_SQL).toDF("Student_ID", " Backlogs", "Exam_Score ", "Study_Hours_Per_Day", "attendance_percentage")
    from strata.sources.files import ingest_upload
    out = ingest_upload(dash(spark, d), upload)
    return out.select("student_id", "branch", *[F.col(c).cast("double").alias(c) for c in (
        "current_back", "noofbacklog", "effective_cgpa", "study_efficiency", "distraction_index", "discipline_score")])


@q("select_existing", STU + "SELECT student_id, branch, cgpa FROM stu", ["cgpa"])
def _(spark, d):
    return schema.select_existing(stu(spark, d), ["student_id", "not_a_column", "branch", "cgpa"])


@q("rename_columns", "SELECT p_partkey AS part_id, p_name AS name, p_brand, p_type, p_size, p_retailprice FROM part", ["p_retailprice"])
def _(spark, d):
    return schema.rename_columns(S.table(spark, d, "part"), {"p_partkey": "part_id", "p_name": "name", "absent": "never"})


@q("drop_columns", "SELECT * EXCLUDE (p_name, p_type) FROM part", ["p_retailprice"])
def _(spark, d):
    return schema.drop_columns(S.table(spark, d, "part"), ["p_name", "absent", "p_type"])


@q("require_columns", "SELECT event_type, count(*) AS rows, 'Missing required columns: [''grade'']' AS refused FROM events GROUP BY event_type")
def _(spark, d):
    """All events pass the check of columns they have; one they lack is refused by name."""
    e = S.table(spark, d, "events")
    try:
        schema.require_columns(e, ["event_type", "grade"])
        refused = None
    except ValueError as err:
        refused = str(err)
    return schema.require_columns(e, ["event_type"]).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows")) \
        .withColumn("refused", F.lit(refused))


@q("auto_target", """SELECT 'l_tax' AS target, avg(l_tax) AS mean FROM lineitem
UNION ALL SELECT 'l_discount', avg(l_discount) FROM lineitem""", ["mean"])
def _(spark, d):
    """The target picked from the whole table's columns: the last numeric one, or the first candidate present."""
    li, out = S.table(spark, d, "lineitem"), None
    for names in (["cgpa"], ["cgpa", "l_discount", "l_quantity"]):
        target = profile.auto_target(li, names)
        one = li.agg(F.avg(target).alias("mean")).select(F.lit(target).alias("target"), "mean")
        out = one if out is None else out.unionByName(one)
    return out


@q("empty_guard", """SELECT event_type, count(*) AS rows, count_if(value > 1000000) = 0 AS none_large, false AS none FROM events GROUP BY event_type""")
def _(spark, d):
    """Per event type whether a selection of its rows is empty, one short job each."""
    e = S.table(spark, d, "events")
    types = [r["event_type"] for r in marts.filter_options(e, "event_type").collect()]  # a handful of types
    guard = [(t, marts.empty_guard(e.where((F.col("event_type") == t) & (F.col("value") > 1000000))),
              marts.empty_guard(e.where(F.col("event_type") == t))) for t in types]
    counts = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(spark.createDataFrame(guard, "event_type string, none_large boolean, none boolean"), "event_type")


READ_SQL = """SELECT CAST(c_custkey AS STRING) AS k, CASE WHEN c_custkey % 9 = 0 THEN 'NA' WHEN c_custkey % 9 = 1 THEN ' NA '
  ELSE c_mktsegment END AS segment, CAST(c_acctbal AS STRING) AS balance FROM customer"""


@q("read_table", S.cte(t=READ_SQL) + " UNION ALL ".join(
    f"SELECT '{fmt}' AS format, k, {'nullif(segment, ' + repr('NA') + ')' if fmt == 'csv' else 'segment'} AS segment, balance FROM t"
    for fmt in ("csv", "json", "parquet")))
def _(spark, d):
    """The customers written as CSV, JSON and Parquet and read by suffix; NA tokens are a matter of CSV."""
    from strata.sources.files import read_table
    src, base, out = S.frame(spark, d, READ_SQL), _out(spark, "read"), None
    for fmt in ("csv", "json", "parquet"):
        src.write.format(fmt).options(**({"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
                                         if fmt == "csv" else {})).save(f"{base}.{fmt}")
        one = read_table(spark, f"{base}.{fmt}").select(F.lit(fmt).alias("format"), "k", "segment", F.col("balance").cast("string").alias("balance"))
        out = one if out is None else out.unionByName(one)
    return out


@q("scatter_bins", """SELECT CAST(floor(l_quantity / 5) AS BIGINT) AS x_bin,
  CAST(floor(l_extendedprice / 10000) AS BIGINT) AS y_bin, count(*) AS points FROM lineitem GROUP BY ALL""")
def _(spark, d):
    return schema.scatter_bins(S.table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 5, 10000)


@q("preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5", ["o_totalprice"])
def _(spark, d):
    o = S.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return schema.preview(o.orderBy(F.desc("o_totalprice"), "o_orderkey"), 5)


# ------------------------------------------------------------------ features

def _feat_q(name, cols_sql, cols_spark, rcols):
    @q(name, FEAT + f"SELECT student_id, {cols_sql} FROM feat", rcols)
    def _(spark, d):
        return (feat_bmi if "bmi" in cols_spark else feat)(spark, d).select("student_id", *cols_spark)


_feat_q("career_path", "career_path", ["career_path"], [])
_feat_q("academic_score", "academic_score", ["academic_score"], ["academic_score"])
_feat_q("technical_score", "technical_score", ["technical_score"], ["technical_score"])
_feat_q("engagement_score", "engagement_score", ["engagement_score"], ["engagement_score"])
_feat_q("stress_risk", "stress_risk, productivity_score, wellbeing_balance",
        ["stress_risk", "productivity_score", "wellbeing_balance"],
        ["stress_risk", "productivity_score", "wellbeing_balance"])
_feat_q("employability_signal", "employability_signal, student_support_need",
        ["employability_signal", "student_support_need"], ["employability_signal", "student_support_need"])
_feat_q("bmi", "bmi", ["bmi"], ["bmi"])

GPA_ORACLE = """
SELECT *, (coalesce(gpa_1, 0) + coalesce(gpa_2, 0) + coalesce(gpa_3, 0) + coalesce(gpa_4, 0) + coalesce(gpa_5, 0)
   + coalesce(gpa_6, 0)) / nullif(n, 0) AS avg_gpa
FROM (SELECT *, (gpa_1 IS NOT NULL)::INT + (gpa_2 IS NOT NULL)::INT + (gpa_3 IS NOT NULL)::INT
  + (gpa_4 IS NOT NULL)::INT + (gpa_5 IS NOT NULL)::INT + (gpa_6 IS NOT NULL)::INT AS n FROM stu) s
"""


@q("gpa_row_stats", STU + ", g AS (" + GPA_ORACLE + """)
SELECT student_id, avg_gpa,
   (CASE WHEN gpa_1 IS NULL THEN 0 ELSE (gpa_1 - avg_gpa) * (gpa_1 - avg_gpa) END
  + CASE WHEN gpa_2 IS NULL THEN 0 ELSE (gpa_2 - avg_gpa) * (gpa_2 - avg_gpa) END
  + CASE WHEN gpa_3 IS NULL THEN 0 ELSE (gpa_3 - avg_gpa) * (gpa_3 - avg_gpa) END
  + CASE WHEN gpa_4 IS NULL THEN 0 ELSE (gpa_4 - avg_gpa) * (gpa_4 - avg_gpa) END
  + CASE WHEN gpa_5 IS NULL THEN 0 ELSE (gpa_5 - avg_gpa) * (gpa_5 - avg_gpa) END
  + CASE WHEN gpa_6 IS NULL THEN 0 ELSE (gpa_6 - avg_gpa) * (gpa_6 - avg_gpa) END) / nullif(n, 0) AS gpa_variance,
  gpa_6 - gpa_1 AS gpa_trend FROM g""", ["avg_gpa", "gpa_variance", "gpa_trend"])
def _(spark, d):
    return feat(spark, d).select("student_id", "avg_gpa", "gpa_variance", "gpa_trend")


ACAD = S.cte(acad=S.ACAD_SQL)


@q("academic_record_features", ACAD + """SELECT student_id, (thispresent + prispresent) / 2 AS attendance_score,
  current_back + ever_back + noofbacklog AS backlog_pressure, theorycredit + practicalcredit AS subject_load,
  sgpa - prsgpa AS academic_momentum,
  CASE WHEN theorycredit + practicalcredit > 0 THEN (theoryagggradepoint * theorycredit
       + practicalagggradepoint * practicalcredit) / (theorycredit + practicalcredit) ELSE 0 END AS credit_efficiency
FROM acad""", ["attendance_score", "backlog_pressure", "subject_load", "academic_momentum", "credit_efficiency"])
def _(spark, d):
    a = features.add_ml_features(S.frame(spark, d, S.ACAD_SQL))
    return a.select("student_id", "attendance_score", "backlog_pressure", "subject_load", "academic_momentum",
                    "credit_efficiency")


@q("effective_cgpa", DASH_ORACLE.replace("SELECT student_id, branch, gender, semester, current_back,",
                                         "SELECT student_id, effective_cgpa, study_efficiency, distraction_index, discipline_score FROM (SELECT student_id, branch, gender, semester, current_back,") + ") z",
   ["effective_cgpa", "study_efficiency", "distraction_index", "discipline_score"])
def _(spark, d):
    return dash(spark, d).select("student_id", "effective_cgpa", "study_efficiency", "distraction_index",
                                 "discipline_score")


@q("readiness_score", """SELECT l_orderkey, l_linenumber,
  least(greatest((l_tax * 100) * (10 * 0.4) + (l_linenumber - 1) * (0.3 * 10) + (l_quantity / 10) * (0.2 * 10)
     + (l_discount * 100) * (0.1 * 10), 0), 100) AS readiness,
  CASE WHEN least(greatest((l_tax * 100) * (10 * 0.4) + (l_linenumber - 1) * (0.3 * 10) + (l_quantity / 10) * (0.2 * 10)
     + (l_discount * 100) * (0.1 * 10), 0), 100) >= 70 THEN 'Ready'
       WHEN least(greatest((l_tax * 100) * (10 * 0.4) + (l_linenumber - 1) * (0.3 * 10) + (l_quantity / 10) * (0.2 * 10)
     + (l_discount * 100) * (0.1 * 10), 0), 100) >= 40 THEN 'Moderate' ELSE 'Needs Improvement' END AS status
FROM lineitem""", ["readiness"])
def _(spark, d):
    li = S.table(spark, d, "lineitem")
    score = X.readiness_score(F.col("l_tax") * 100, (F.col("l_linenumber") - 1).cast("double"),
                              F.col("l_quantity") / 10, F.col("l_discount") * 100)
    return li.select("l_orderkey", "l_linenumber", score.alias("readiness"),
                     X.readiness_status(score).alias("status"))


@q("segment_insight_text", """SELECT c_custkey,
  [CASE WHEN c_mktsegment = 'BUILDING' THEN 'Actively looking for jobs boosts placement likelihood.'
        ELSE 'A passive job search keeps options open for other paths.' END,
   CASE WHEN c_nationkey % 3 IN (0, 1) THEN 'Entrepreneurship interest leaves room for startup paths.'
        ELSE 'Lower entrepreneurship interest shifts focus toward jobs or further studies.' END,
   CASE WHEN c_acctbal > 5000 THEN 'Pursuing further education signals higher-education orientation.'
        ELSE 'No immediate further education focus detected.' END] AS insights FROM customer""")
def _(spark, d):
    c = S.table(spark, d, "customer")
    job = F.when(F.col("c_mktsegment") == "BUILDING", "Actively looking").otherwise("Passive")
    ent = F.element_at(F.array(F.lit("High"), F.lit("Medium"), F.lit("Low")), (F.col("c_nationkey") % 3 + 1).cast("int"))
    edu = F.when(F.col("c_acctbal") > 5000, "Yes").otherwise("No")
    return c.select("c_custkey", X.segment_insights(job, ent, edu).alias("insights"))


HOURS_SQL = """SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN '0 - 30 minute' WHEN 1 THEN '30 - 60 minute'
  WHEN 2 THEN '1 - 2 Hour' WHEN 3 THEN '2 - 3 hour' WHEN 4 THEN '3 - 4 hour' WHEN 5 THEN 'More Than 4 hour'
  ELSE 'sometimes' END AS label FROM customer"""


@q("study_hours_map", S.cte(t=HOURS_SQL) + """SELECT c_custkey, CASE lower(label) WHEN '0 - 30 minute' THEN 0.25
  WHEN '30 - 60 minute' THEN 0.75 WHEN '1 - 2 hour' THEN 1.5 WHEN '2 - 3 hour' THEN 2.5 WHEN '3 - 4 hour' THEN 3.5
  WHEN 'more than 4 hour' THEN 4.5 END AS hours FROM t""", ["hours"])
def _(spark, d):
    return S.frame(spark, d, HOURS_SQL).select("c_custkey", X.study_hours_from_label("label").alias("hours"))


@q("risk_pct_rescale", S.cte(s=S.SCORED_SQL) + """SELECT event_id, least(greatest(CASE WHEN (SELECT max(p) FROM s) <= 1.1
  THEN p * 100 ELSE p END, 0), 100) AS risk_probability_pct FROM s""", ["risk_probability_pct"])
def _(spark, d):
    s = S.frame(spark, d, S.SCORED_SQL)
    return features.risk_pct_rescale(s, "p").select("event_id", "risk_probability_pct")


# -------------------------------------------------------------- keys & joins

@q("surrogate_key", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id FROM orders")
def _(spark, d):
    o = S.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return align.surrogate_key(o, ["o_orderdate", "o_orderkey"], "row_id", unique=True).select("o_orderkey", "row_id")


@q("surrogate_key_file_order", "SELECT l_orderkey, l_linenumber, row_number() OVER () AS row_id FROM lineitem")
def _(spark, d):
    """Numbers in file order: splits are counted, rows stay where they are."""
    li = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return align.surrogate_key(li, None, "row_id")


ALIGN_ORACLE = """
WITH c AS (SELECT row_number() OVER (ORDER BY c_custkey) AS pos, c_custkey, c_name FROM customer),
 p AS (SELECT row_number() OVER (ORDER BY p_partkey) AS pos, p_partkey, p_name AS c_name FROM part),
 s AS (SELECT row_number() OVER (ORDER BY s_suppkey) AS pos, s_suppkey, s_name FROM supplier),
 cp AS (SELECT coalesce(c.pos, p.pos) AS pos, c.c_custkey, c.c_name, p.p_partkey, c.pos IS NOT NULL AS ca,
        p.pos IS NOT NULL AS pa FROM c FULL JOIN p ON c.pos = p.pos)
SELECT coalesce(cp.pos, s.pos) AS student_id, c_custkey, c_name, p_partkey, s_suppkey, s_name,
  CAST(coalesce(ca, false) AS INT) AS customer_record_available, CAST(coalesce(pa, false) AS INT) AS part_record_available,
  CAST(s.pos IS NOT NULL AS INT) AS supplier_record_available
FROM cp FULL JOIN s ON cp.pos = s.pos
"""


def _aligned(spark, d):
    c = S.table(spark, d, "customer").select("c_custkey", "c_name")
    p = S.table(spark, d, "part").select("p_partkey", F.col("p_name").alias("c_name"))
    s = S.table(spark, d, "supplier").select("s_suppkey", "s_name")
    return align.positional_align([c, p, s], [["c_custkey"], ["p_partkey"], ["s_suppkey"]],
                                  ["customer", "part", "supplier"], unique=True)


@q("positional_align", ALIGN_ORACLE)
def _(spark, d):
    return _aligned(spark, d).select("student_id", "c_custkey", "c_name", "p_partkey", "s_suppkey", "s_name",
                                     "customer_record_available", "part_record_available", "supplier_record_available")


@q("source_coverage", "SELECT CAST(sum(customer_record_available) AS BIGINT) AS customer_record_available, "
   "CAST(sum(part_record_available) AS BIGINT) AS part_record_available, "
   "CAST(sum(supplier_record_available) AS BIGINT) AS supplier_record_available FROM (" + ALIGN_ORACLE + ") a")
def _(spark, d):
    return marts.source_coverage(_aligned(spark, d), ["customer", "part", "supplier"])


BACKFILL_SQL = "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS cust FROM orders"


@q("backfill_keys", S.cte(t=BACKFILL_SQL) + """SELECT o_orderkey, cust FROM t WHERE cust IS NOT NULL
UNION ALL SELECT o_orderkey, (SELECT max(cust) FROM t) + row_number() OVER (ORDER BY o_orderkey) AS cust
FROM t WHERE cust IS NULL""")
def _(spark, d):
    return align.backfill_keys(S.frame(spark, d, BACKFILL_SQL), "cust", ["o_orderkey"])


@q("primary_key_violations", "SELECT l_orderkey, count(*) AS rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def _(spark, d):
    return marts.primary_key_violations(S.table(spark, d, "lineitem"), ["l_orderkey"])


@q("foreign_key_violations", """SELECT l_suppkey, count(*) AS rows FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 0) GROUP BY l_suppkey""")
def _(spark, d):
    sup = S.table(spark, d, "supplier").where(F.col("s_acctbal") > 0)
    return marts.foreign_key_violations(S.table(spark, d, "lineitem"), sup, ["l_suppkey"], ["s_suppkey"])


@q("star_join", """SELECT n_name, o_orderstatus, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
  count(DISTINCT o_orderkey) AS orders, count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, o_orderstatus""", ["revenue"])
def _(spark, d):
    li = S.table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    o = S.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = S.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    n = S.table(spark, d, "nation").select("n_nationkey", "n_name")
    return marts.star_join(li, [(o, ["o_orderkey"]), (c, ["o_custkey"]), (n, ["n_nationkey"])],
                           ["n_name", "o_orderstatus"],
                           [F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
                            F.count_distinct("o_orderkey").alias("orders"), F.count(F.lit(1)).alias("lines")])


GOLD_SQL = S.STU_SQL.replace("FROM lineitem", """, CAST(l_partkey % 50 AS DOUBLE) AS subjectid, CAST(l_partkey % 4 AS DOUBLE) AS theorycredit,
  CAST(l_suppkey % 3 AS DOUBLE) AS practicalcredit, 5 + l_quantity / 10 AS sgpa, 5 + l_discount * 40 AS prsgpa, 50 + l_quantity AS thispresent
FROM lineitem""")


def _star_ctes():
    """The star schema's tables in SQL: distinct dimensions and the fact."""
    from strata.functions import constants as K
    import re
    have = set(re.findall(r"(?i)\bAS (\w+)", GOLD_SQL))
    layout = {"dim_student": K.DIM_STUDENT, "dim_academic_history": K.DIM_ACADEMIC_HISTORY, "dim_student_activity": K.DIM_STUDENT_ACTIVITY,
              "dim_behavior": K.DIM_BEHAVIOR, "dim_subject": K.DIM_SUBJECT, "fact_student_academic": K.FACT_STUDENT_ACADEMIC}
    return S.cte(gold=GOLD_SQL, **{t: f"SELECT {'' if t.startswith('fact') else 'DISTINCT '}{', '.join(c for c in cols if c in have)} FROM gold"
                                   for t, cols in layout.items()})


def _warehouse_oracle():
    from strata.sources.files import WAREHOUSE_KEYS, WAREHOUSE_REFERENCES
    own = [f"""SELECT '{t}' AS "table", '{k}' AS key, NULL AS "references", (SELECT count(*) FROM (
  SELECT {k} FROM {t} GROUP BY 1 HAVING count(*) > 1 OR {k} IS NULL)) AS violations, (SELECT count(*) FROM {t}) AS rows""" for t, k in WAREHOUSE_KEYS.items()]
    other = [f"""SELECT '{t}', '{c}', '{r}', (SELECT count(DISTINCT {c}) FROM {t} WHERE {c} NOT IN (SELECT {c} FROM {r})),
  (SELECT count(*) FROM {t})""" for (t, c), r in WAREHOUSE_REFERENCES.items()]
    return _star_ctes() + " UNION ALL ".join(own + other)


def _warehouse(spark, d):
    from strata.sources.files import WAREHOUSE_KEYS, save_warehouse_tables
    gold = S.frame(spark, d, GOLD_SQL)
    base = _out(spark, "warehouse")
    return save_warehouse_tables(marts.star_schema(gold, distinct=False), base.rsplit("/", 1)[1], base, distinct=WAREHOUSE_KEYS)


@q("warehouse_ddl", _warehouse_oracle())
def _(spark, d):
    """The star schema as bucketed catalog tables: rows and key violations of each."""
    from strata.sources.files import warehouse_violations
    tables = _warehouse(spark, d)
    counts = marts.layer_counts(tables).select(F.col("table").alias("_t"), "rows")
    out = warehouse_violations(tables)
    return out.join(counts, F.col("table") == F.col("_t")).drop("_t")


@q("warehouse_star_join", _star_ctes() + """SELECT branch, stress_level, count(*) AS records, avg(sgpa) AS avg_sgpa, avg(gpa_2) AS avg_gpa_2
FROM fact_student_academic JOIN dim_student USING (student_id) JOIN dim_behavior USING (student_id)
JOIN dim_academic_history USING (student_id) GROUP BY branch, stress_level""", ["avg_sgpa", "avg_gpa_2"])
def _(spark, d):
    """Fact and three dimensions joined on the key they are bucketed by."""
    t = _warehouse(spark, d)
    dims = [(t[n].select("student_id", *cols), ["student_id"]) for n, cols in (
        ("dim_student", ["branch"]), ("dim_behavior", ["stress_level"]), ("dim_academic_history", ["gpa_2"]))]
    return marts.star_join(t["fact_student_academic"], dims, ["branch", "stress_level"],
                           [F.count(F.lit(1)).alias("records"), F.avg("sgpa").alias("avg_sgpa"), F.avg("gpa_2").alias("avg_gpa_2")])


@q("ordinal_reindex", EV + """, m AS (SELECT event_type, avg(value) AS mean FROM ev GROUP BY event_type),
dim AS (SELECT * FROM (VALUES ('view', 0), ('click', 1), ('signup', 2), ('purchase', 3), ('error', 4), ('refund', 5)) v(event_type, r))
SELECT dim.event_type, m.mean FROM dim LEFT JOIN m USING (event_type)""", ["mean"])
def _(spark, d):
    return profile.ordered_group_mean(ev(spark, d), "event_type", "value",
                                      ["view", "click", "signup", "purchase", "error", "refund"])


# ---------------------------------------------------------------------- marts

def _summary_sql(by, pairs):
    means = ", ".join(f"avg({c}) AS {a}" for c, a in pairs)
    return FEAT + f"SELECT {by}, count(student_id) AS student_count, {means} FROM feat GROUP BY {by}"


@q("career_summary", _summary_sql("career_path", [("cgpa", "avg_cgpa"), ("academic_score", "avg_academic_score"),
                                                  ("technical_score", "avg_technical_score"),
                                                  ("employability_signal", "avg_employability_signal")]),
   ["avg_cgpa", "avg_academic_score", "avg_technical_score", "avg_employability_signal"])
def _(spark, d):
    return marts.career_summary(feat(spark, d))


@q("semester_summary", _summary_sql("semester", [("exam_score", "avg_exam_score"), ("cgpa", "avg_cgpa")]),
   ["avg_exam_score", "avg_cgpa"])
def _(spark, d):
    return marts.semester_summary(feat(spark, d))


@q("branch_summary", _summary_sql("branch", [("cgpa", "avg_cgpa"), ("stress_risk", "avg_stress_risk"),
                                             ("productivity_score", "avg_productivity"),
                                             ("student_support_need", "avg_support_need"),
                                             ("exam_score", "avg_exam_score")]),
   ["avg_cgpa", "avg_stress_risk", "avg_productivity", "avg_support_need", "avg_exam_score"])
def _(spark, d):
    return marts.branch_summary(feat(spark, d))


@q("risk_band_summary", FEAT + """, b AS (SELECT CASE WHEN student_support_need <= 1 THEN 'low'
  WHEN student_support_need <= 4 THEN 'medium' ELSE 'high' END AS risk_band FROM feat),
dim AS (SELECT * FROM (VALUES ('low'), ('medium'), ('high')) v(risk_band))
SELECT dim.risk_band, CAST(count(b.risk_band) AS BIGINT) AS student_count FROM dim LEFT JOIN b USING (risk_band)
GROUP BY dim.risk_band""")
def _(spark, d):
    return marts.risk_band_summary(feat(spark, d))


@q("risk_band_summary_empty_band", STU + """, b AS (SELECT CASE WHEN exam_anxiety_score / 5 <= 1 THEN 'low'
  WHEN exam_anxiety_score / 5 <= 4 THEN 'medium' ELSE 'high' END AS risk_band FROM stu),
dim AS (SELECT * FROM (VALUES ('low'), ('medium'), ('high')) v(risk_band))
SELECT dim.risk_band, CAST(count(b.risk_band) AS BIGINT) AS student_count FROM dim LEFT JOIN b USING (risk_band)
GROUP BY dim.risk_band""")
def _(spark, d):
    s = stu(spark, d).select((F.col("exam_anxiety_score") / 5).alias("anxiety"))
    return marts.risk_band_summary(s, source="anxiety")


@q("dashboard_kpis", FEAT + """SELECT count(*) AS student_count, CAST(0 AS BIGINT) AS subject_count,
  round(avg(cgpa), 4) AS avg_cgpa, 0.0 AS avg_sgpa, round(avg(academic_score), 4) AS avg_academic_score,
  round(avg(technical_score), 4) AS avg_technical_score, round(avg(stress_risk), 4) AS avg_stress_risk,
  'dashboard' AS last_pipeline_stage FROM feat""",
   ["avg_cgpa", "avg_sgpa", "avg_academic_score", "avg_technical_score", "avg_stress_risk"])
def _(spark, d):
    return marts.dashboard_kpis(feat(spark, d))


@q("student_overview", FEAT + """SELECT student_id, branch, gender, career_path, cgpa, academic_score, technical_score,
  engagement_score, stress_risk, productivity_score, bmi, student_support_need, employability_signal FROM feat""",
   ["cgpa", "academic_score", "technical_score", "engagement_score", "bmi", "student_support_need",
    "employability_signal"])
def _(spark, d):
    return schema.student_overview(feat_bmi(spark, d))


@q("metric_row", "SELECT count(*) AS records, avg(effective_cgpa) AS avg_cgpa, avg(study_hours_per_day) AS avg_study_hours, "
   "avg(current_back) AS avg_current_back FROM (" + DASH_ORACLE + ") x",
   ["avg_cgpa", "avg_study_hours", "avg_current_back"])
def _(spark, d):
    return marts.metric_row(dash(spark, d))


# The slice filter's IN-lists come from a user selection; these fixed lists are
# the slice under test, not a row cap.
SLICE = (["CSE", "MECH"], ["Female"], [1, 2, 3, 5])


@q("slice_filter", "SELECT count(*) AS records, avg(effective_cgpa) AS avg_cgpa, avg(study_hours_per_day) AS avg_study_hours, "
   "avg(current_back) AS avg_current_back FROM (" + DASH_ORACLE + ") x WHERE branch IN ('CSE', 'MECH') "
   "AND gender IN ('Female') AND semester IN (1, 2, 3, 5)", ["avg_cgpa", "avg_study_hours", "avg_current_back"])
def _(spark, d):
    return marts.metric_row(marts.slice_filter(dash(spark, d), *SLICE))


def _cube(spark, d):
    """The cube of the dashboard's table, written and read back."""
    full = features.dashboard_frame(stu(spark, d))
    base = _out(spark, "cube")
    marts.slice_cube(full).write.parquet(base)
    return spark.read.parquet(base)


@q("slice_cube_metrics", "SELECT count(*) AS records, avg(effective_cgpa) AS avg_cgpa, avg(study_hours_per_day) AS avg_study_hours, "
   "avg(current_back) AS avg_current_back FROM (" + DASH_ORACLE + ") x WHERE branch IN ('CSE', 'MECH') "
   "AND gender IN ('Female') AND semester IN (1, 2, 3, 5)", ["avg_cgpa", "avg_study_hours", "avg_current_back"])
def _(spark, d):
    """The metric row of a selection, read from the slice cube."""
    return marts.cube_metric_row(_cube(spark, d), *SLICE)


@q("slice_cube_means", " UNION ALL ".join(
    f"SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS value, avg(effective_cgpa) AS avg_cgpa FROM ({DASH_ORACLE}) x GROUP BY {c}"
    for c in ("branch", "gender", "semester")), ["avg_cgpa"])
def _(spark, d):
    """Branch, gender and semester means of all records, read from the slice cube."""
    cube, out = _cube(spark, d), None
    for c in marts.SLICE_DIMS:
        one = marts.cube_mean_by(cube, c).select(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value"), "avg_cgpa")
        out = one if out is None else out.unionByName(one)
    return out


@q("slice_cube_activity", STU + """, a AS (SELECT CAST(sum(technical_projects) AS DOUBLE) AS tp,
  CAST(count_if(lower(certification_course) = 'yes') AS DOUBLE) AS cc, CAST(sum(tech_quiz) AS DOUBLE) AS tq FROM stu
  WHERE branch IN ('CSE', 'ECE'))
SELECT 'technical_projects' AS activity, tp AS value, tp * 100 / (tp + cc + tq) AS share_pct FROM a
UNION ALL SELECT 'certification_course', cc, cc * 100 / (tp + cc + tq) FROM a
UNION ALL SELECT 'tech_quiz', tq, tq * 100 / (tp + cc + tq) FROM a""", ["value", "share_pct"])
def _(spark, d):
    """The activity mix of two branches, read from the slice cube."""
    return marts.cube_activity_mix(_cube(spark, d), ["CSE", "ECE"])


@q("filter_options", STU + "SELECT DISTINCT CAST(semester AS INT) AS semester FROM stu WHERE semester IS NOT NULL")
def _(spark, d):
    return marts.filter_options(stu(spark, d), "semester", as_int=True)


@q("branch_performance", "SELECT branch, avg(effective_cgpa) AS avg_cgpa FROM (" + DASH_ORACLE + ") x GROUP BY branch",
   ["avg_cgpa"])
def _(spark, d):
    return marts.branch_performance(dash(spark, d))


@q("gender_performance", "SELECT gender, avg(effective_cgpa) AS avg_cgpa FROM (" + DASH_ORACLE + ") x GROUP BY gender",
   ["avg_cgpa"])
def _(spark, d):
    return marts.gender_performance(dash(spark, d))


@q("semester_trend", "SELECT semester, avg(effective_cgpa) AS avg_cgpa FROM (" + DASH_ORACLE + ") x "
   "WHERE semester IS NOT NULL GROUP BY semester", ["avg_cgpa"])
def _(spark, d):
    return marts.semester_trend(dash(spark, d))


@q("activity_mix", STU + """, a AS (SELECT CAST(sum(technical_projects) AS DOUBLE) AS tp,
  CAST(count_if(lower(certification_course) = 'yes') AS DOUBLE) AS cc, CAST(sum(tech_quiz) AS DOUBLE) AS tq FROM stu)
SELECT 'technical_projects' AS activity, tp AS value, tp * 100 / (tp + cc + tq) AS share_pct FROM a
UNION ALL SELECT 'certification_course', cc, cc * 100 / (tp + cc + tq) FROM a
UNION ALL SELECT 'tech_quiz', tq, tq * 100 / (tp + cc + tq) FROM a""", ["value", "share_pct"])
def _(spark, d):
    return marts.activity_mix(stu(spark, d))


@q("count_distinct", "SELECT count(DISTINCT l_partkey) AS n_unique FROM lineitem")
def _(spark, d):
    return marts.count_distinct(S.table(spark, d, "lineitem"), "l_partkey")


@q("count_distinct_with_null", EV + "SELECT count(DISTINCT event_type) + max(CAST(event_type IS NULL AS INT)) AS n_unique FROM ev")
def _(spark, d):
    return marts.count_distinct(ev(spark, d), "event_type", dropna=False)


LAYER_COLUMNS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
                 "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4}


@q("layer_counts", " UNION ALL ".join(f"""SELECT 'raw' AS layer, '{t}' AS "table", count(*) AS rows, {n} AS columns FROM {t}"""
                                      for t, n in LAYER_COLUMNS.items()))
def _(spark, d):
    return marts.layer_counts({n: S.table(spark, d, n) for n in LAYER_COLUMNS}, "raw")


@q("distinct_dim", STU + "SELECT DISTINCT student_id, gender, branch, heightcm, weightkg, financial_status, parttime_job FROM stu",
   ["heightcm", "weightkg"])
def _(spark, d):
    return marts.star_schema(stu(spark, d))["dim_student"]


@q("fact_table", ACAD + """SELECT student_id, semester, subjectid, theoryagggradepoint, theorycredit,
  practicalagggradepoint, practicalcredit, sgpa, prsgpa, noofbacklog, thispresent, prispresent FROM acad""",
   ["subjectid", "theoryagggradepoint", "theorycredit", "practicalagggradepoint", "practicalcredit", "sgpa", "prsgpa",
    "noofbacklog", "thispresent", "prispresent"])
def _(spark, d):
    return marts.star_schema(S.frame(spark, d, S.ACAD_SQL))["fact_student_academic"]


@q("dim_behavior", STU + """SELECT DISTINCT student_id, daily_study_time, social_media_time, stress_level, like_degree,
  career_willingness FROM stu""", ["career_willingness"])
def _(spark, d):
    return marts.star_schema(stu(spark, d))["dim_behavior"]


@q("total_missing", EV + """SELECT CAST(count_if(event_id IS NULL) + count_if(ts IS NULL) + count_if(user_id IS NULL)
  + count_if(event_type IS NULL) + count_if(value IS NULL) + count_if(props IS NULL) AS BIGINT) AS total_missing FROM ev""")
def _(spark, d):
    return marts.total_missing(ev(spark, d))


@q("gold_projection", STU + "SELECT student_id, branch, marks_10th, marks_12th, gender, gpa_1, cgpa FROM stu",
   ["marks_10th", "marks_12th", "gpa_1", "cgpa"])
def _(spark, d):
    s = stu(spark, d).select("cgpa", "gpa_1", "gender", "marks_12th", "marks_10th", "branch", "student_id",
                             "heightcm")
    return schema.select_existing(schema.gold_projection(s), ["student_id", "branch", "marks_10th", "marks_12th",
                                                             "gender", "gpa_1", "cgpa"])


# ------------------------------------------------------------------- profile

@q("data_quality_audit", EV + """, m AS (SELECT count(*) AS n, count_if(event_id IS NULL) AS event_id,
  count_if(ts IS NULL) AS ts, count_if(user_id IS NULL) AS user_id, count_if(event_type IS NULL) AS event_type,
  count_if(value IS NULL) AS value, count_if(props IS NULL) AS props FROM ev),
u AS (SELECT 'event_id' AS c, count(DISTINCT event_id) + max(CAST(event_id IS NULL AS INT)) AS n_unique, 'bigint' AS dtype FROM ev
  UNION ALL SELECT 'ts', count(DISTINCT ts) + max(CAST(ts IS NULL AS INT)), 'timestamp_ntz' FROM ev
  UNION ALL SELECT 'user_id', count(DISTINCT user_id) + max(CAST(user_id IS NULL AS INT)), 'bigint' FROM ev
  UNION ALL SELECT 'event_type', count(DISTINCT event_type) + max(CAST(event_type IS NULL AS INT)), 'string' FROM ev
  UNION ALL SELECT 'value', count(DISTINCT value) + max(CAST(value IS NULL AS INT)), 'double' FROM ev
  UNION ALL SELECT 'props', count(DISTINCT props) + max(CAST(props IS NULL AS INT)), 'string' FROM ev),
l AS (UNPIVOT m ON event_id, ts, user_id, event_type, value, props INTO NAME c VALUE missing_count)
SELECT l.c AS "column", CAST(missing_count AS BIGINT) AS missing_count, round(missing_count * 100.0 / n, 2) AS missing_pct,
  CAST(n_unique AS BIGINT) AS n_unique, dtype FROM l JOIN u USING (c)""", ["missing_pct"])
def _(spark, d):
    return profile.data_quality_audit(ev(spark, d))


@q("duplicate_row_count", """SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows FROM
  (SELECT count(*) AS c FROM (""" + REPEATED_SQL + """) r GROUP BY ALL) g""".replace("GROUP BY ALL", "GROUP BY r"))
def _(spark, d):
    return profile.duplicate_row_count(S.frame(spark, d, REPEATED_SQL))


def _outlier_sql(cols):
    parts = [f"""SELECT '{c}' AS "column", lower, upper, CAST(count_if({c} < lower OR {c} > upper) AS BIGINT) AS outlier_count,
      count_if({c} < lower OR {c} > upper) * 100.0 / count(*) AS outlier_pct FROM lineitem,
      (SELECT lower, upper FROM f WHERE "column" = '{c}') ff GROUP BY lower, upper""" for c in cols]
    return "WITH f AS (" + _fence_sql(cols) + ")\n" + " UNION ALL ".join(parts)


@q("outlier_summary", _outlier_sql(LI_NUM), ["lower", "upper", "outlier_pct"])
def _(spark, d):
    return profile.outlier_summary(S.table(spark, d, "lineitem"), LI_NUM)


def _describe_sql(cols):
    parts = [f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
      min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
      quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM lineitem""" for c in cols]
    return " UNION ALL ".join(parts)


@q("describe_numeric", _describe_sql(LI_NUM), ["mean", "std", "min", "p25", "p50", "p75", "max"])
def _(spark, d):
    return profile.describe_numeric(S.table(spark, d, "lineitem"), LI_NUM)


@q("describe_categorical", EV + """, v AS (SELECT 'event_type' AS "column", event_type AS v, count(*) AS c FROM ev
  WHERE event_type IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'props', props, count(*) FROM ev GROUP BY 2)
SELECT "column", CAST(sum(c) AS BIGINT) AS count, count(*) AS unique, arg_min(v, (-c, v)) AS top, max(c) AS freq
FROM v GROUP BY "column\"""")
def _(spark, d):
    return profile.describe_categorical(ev(spark, d), ["event_type", "props"])


@q("value_counts", EV + "SELECT event_type, count(*) AS count FROM ev WHERE event_type IS NOT NULL GROUP BY event_type")
def _(spark, d):
    return profile.value_counts(ev(spark, d), "event_type")


CORR_SRC = "SELECT l_quantity, l_extendedprice, l_discount, l_tax, 1.0 AS l_const FROM lineitem"
CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_const"]


def _corr_sql():
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            parts.append(f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
              CASE WHEN stddev_pop({a}) * stddev_pop({b}) = 0 THEN NULL
                   ELSE covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END AS corr FROM t""")
    return S.cte(t=CORR_SRC) + " UNION ALL ".join(parts)


@q("correlation_matrix", _corr_sql(), ["corr"])
def _(spark, d):
    return profile.correlation_matrix(S.frame(spark, d, CORR_SRC), CORR_COLS)


@q("top_correlations", "SELECT column_a, column_b, corr, abs(corr) AS abs_corr FROM (" + _corr_sql() + """) c
WHERE corr IS NOT NULL AND
 ((column_a = 'l_quantity' AND column_b IN ('l_extendedprice', 'l_discount', 'l_tax'))
  OR (column_a = 'l_extendedprice' AND column_b IN ('l_discount', 'l_tax'))
  OR (column_a = 'l_discount' AND column_b = 'l_tax'))
ORDER BY abs(corr) DESC, column_a, column_b LIMIT 3""", ["corr", "abs_corr"])
def _(spark, d):
    return profile.top_correlations(S.frame(spark, d, CORR_SRC), CORR_COLS, k=3)


@q("corr_to_target", "SELECT column_a AS feature, corr, abs(corr) AS abs_corr FROM (" + _corr_sql() + """) c
WHERE column_b = 'l_extendedprice' AND column_a <> 'l_extendedprice' AND corr IS NOT NULL
ORDER BY abs(corr) DESC, feature LIMIT 4""", ["corr", "abs_corr"])
def _(spark, d):
    return profile.corr_to_target(S.frame(spark, d, CORR_SRC), "l_extendedprice", CORR_COLS, k=4)


@q("group_mean_median_count", EV + """SELECT event_type, avg(value) AS mean, median(value) AS median,
  count(value) AS count FROM ev GROUP BY event_type""", ["mean", "median"])
def _(spark, d):
    return profile.group_mean_median_count(ev(spark, d), "event_type", "value")


@q("ordered_group_mean", EV + "SELECT event_type, avg(value) AS mean FROM ev GROUP BY event_type", ["mean"])
def _(spark, d):
    return profile.ordered_group_mean(ev(spark, d), "event_type", "value", "desc")


@q("crosstab_pct_columns", """SELECT l_returnflag, l_linestatus, count(*) AS count,
  count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY l_linestatus) AS pct FROM lineitem
GROUP BY l_returnflag, l_linestatus""", ["pct"])
def _(spark, d):
    return profile.crosstab_pct(S.table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", "columns")


@q("crosstab_pct_index", """SELECT l_returnflag, l_linestatus, count(*) AS count,
  count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY l_returnflag) AS pct FROM lineitem
GROUP BY l_returnflag, l_linestatus""", ["pct"])
def _(spark, d):
    return profile.crosstab_pct(S.table(spark, d, "lineitem"), "l_returnflag", "l_linestatus", "index")


@q("median_split_profile", """SELECT CASE WHEN l_quantity >= (SELECT median(l_quantity) FROM lineitem) THEN 'High'
  ELSE 'Low' END AS segment, avg(l_extendedprice) AS l_extendedprice, avg(l_discount) AS l_discount FROM lineitem
GROUP BY 1""", ["l_extendedprice", "l_discount"])
def _(spark, d):
    return profile.median_split_profile(S.table(spark, d, "lineitem"), "l_quantity", ["l_extendedprice", "l_discount"])


@q("quantile_segment_profile", """WITH e AS (SELECT list_sort(list_distinct([quantile_cont(l_discount, 0.0),
  quantile_cont(l_discount, 0.25), quantile_cont(l_discount, 0.5), quantile_cont(l_discount, 0.75),
  quantile_cont(l_discount, 1.0)])) AS e FROM lineitem),
b AS (SELECT len(list_filter(e[2:], lambda x: x < l_discount)) + 1 AS band_rank, l_extendedprice, l_quantity
  FROM lineitem, e),
dim AS (SELECT unnest(range(1, len(e))) AS band_rank FROM e WHERE len(e) >= 3)
SELECT CAST(dim.band_rank AS INTEGER) AS band_rank, ['Low', 'Mid-Low', 'Mid', 'Mid-High', 'High'][dim.band_rank] AS segment,
  avg(l_extendedprice) AS l_extendedprice, avg(l_quantity) AS l_quantity
FROM dim LEFT JOIN b USING (band_rank) GROUP BY dim.band_rank""", ["l_extendedprice", "l_quantity"])
def _(spark, d):
    return profile.quantile_segment_profile(S.table(spark, d, "lineitem"), "l_discount",
                                            ["l_extendedprice", "l_quantity"], q=4)


def _hist_sql(col, src, bins):
    return f"""WITH mm AS (SELECT CASE WHEN min({col}) = max({col}) THEN min({col}) - 0.5 ELSE min({col}) END AS lo,
  CASE WHEN min({col}) = max({col}) THEN max({col}) + 0.5 ELSE max({col}) END AS hi FROM {src}),
g AS (SELECT {col} AS v, lo, hi, (hi - lo) / {float(bins)} AS step,
  least(greatest(CAST(floor(({col} - lo) / (hi - lo) * {float(bins)}) AS INT), 0), {bins - 1}) AS g0
  FROM {src}, mm WHERE {col} IS NOT NULL),
g1 AS (SELECT *, CASE WHEN v < (CASE WHEN g0 >= {bins} THEN hi ELSE lo + g0 * step END) THEN g0 - 1 ELSE g0 END AS g1 FROM g),
g2 AS (SELECT CASE WHEN v >= (CASE WHEN g1 + 1 >= {bins} THEN hi ELSE lo + (g1 + 1) * step END) AND g1 <> {bins - 1}
  THEN g1 + 1 ELSE g1 END + 1 AS bin FROM g1),
c AS (SELECT bin, count(*) AS n FROM g2 GROUP BY bin),
dim AS (SELECT unnest(range(1, {bins + 1})) AS bin, lo, hi FROM mm)
SELECT CAST(dim.bin AS INTEGER) AS bin, lo + (dim.bin - 1) * ((hi - lo) / {float(bins)}) AS lower,
  CASE WHEN dim.bin = {bins} THEN hi ELSE lo + dim.bin * ((hi - lo) / {float(bins)}) END AS upper,
  CAST(coalesce(n, 0) AS BIGINT) AS count FROM dim LEFT JOIN c USING (bin)"""


@q("histogram", _hist_sql("l_extendedprice", "lineitem", 30), ["lower", "upper"])
def _(spark, d):
    return profile.histogram(S.table(spark, d, "lineitem"), "l_extendedprice", 30)


@q("histogram_events", EV.rstrip() + ", src AS (SELECT value FROM ev),\n" + _hist_sql("value", "src", 25)[5:],
   ["lower", "upper"])
def _(spark, d):
    return profile.histogram(ev(spark, d), "value", 25)


@q("distribution_markers", "SELECT avg(l_extendedprice) AS mean, median(l_extendedprice) AS median FROM lineitem",
   ["mean", "median"])
def _(spark, d):
    return profile.distribution_markers(S.table(spark, d, "lineitem"), "l_extendedprice")


@q("boxplot_stats", EV + """, q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM ev WHERE value IS NOT NULL GROUP BY event_type),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.event_type, count(*) AS count, q1, median, q3, min(value) FILTER (WHERE value >= lo) AS whisker_low,
  max(value) FILTER (WHERE value <= hi) AS whisker_high, CAST(count_if(value < lo OR value > hi) AS BIGINT) AS outliers
FROM ev JOIN f ON ev.event_type IS NOT DISTINCT FROM f.event_type WHERE value IS NOT NULL
GROUP BY f.event_type, q1, median, q3""", ["q1", "median", "q3", "whisker_low", "whisker_high"])
def _(spark, d):
    return profile.boxplot_stats(ev(spark, d), "value", "event_type",
                                 ["view", "click", "signup", "purchase", "error"])


@q("violin_quartiles", """SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
  quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem
GROUP BY l_returnflag""", ["q1", "median", "q3"])
def _(spark, d):
    return profile.violin_quartiles(S.table(spark, d, "lineitem"), "l_extendedprice", "l_returnflag")


@q("regression_line", """SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS slope,
  regr_intercept(l_extendedprice, l_quantity) AS intercept, regr_r2(l_extendedprice, l_quantity) AS r2,
  CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY l_returnflag""", ["slope", "intercept", "r2"])
def _(spark, d):
    return profile.regression_line(S.table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])


@q("wide_series_mean", STU + """SELECT * FROM (VALUES (1, 'gpa_1'), (2, 'gpa_2'), (3, 'gpa_3'), (4, 'gpa_4'), (5, 'gpa_5'),
  (6, 'gpa_6')) v(position, series) JOIN (UNPIVOT (SELECT avg(gpa_1) AS gpa_1, avg(gpa_2) AS gpa_2, avg(gpa_3) AS gpa_3,
  avg(gpa_4) AS gpa_4, avg(gpa_5) AS gpa_5, avg(gpa_6) AS gpa_6 FROM stu) ON COLUMNS(*) INTO NAME series VALUE mean)
  USING (series)""", ["mean"])
def _(spark, d):
    return profile.wide_series_mean(stu(spark, d), ["gpa_1", "gpa_2", "gpa_3", "gpa_4", "gpa_5", "gpa_6"])


# ------------------------------------------------------------------- metrics

SC = S.cte(s=S.SCORED_SQL)
THR = ("(SELECT i AS threshold_index, CAST(0.2 AS DOUBLE) + CAST(i AS DOUBLE) * ((CAST(0.2 AS DOUBLE) "
       "+ CAST(0.02 AS DOUBLE)) - CAST(0.2 AS DOUBLE)) AS t FROM range(31) r(i))")


@q("threshold_sweep", SC + f""", th AS {THR}, c AS (SELECT threshold_index, t,
  count_if(p >= t AND y = 1) AS tp, count_if(p >= t AND y = 0) AS fp, count_if(p < t AND y = 1) AS fn,
  count_if(p < t AND y = 0) AS tn FROM th, s GROUP BY threshold_index, t)
SELECT CAST(threshold_index AS INT) AS threshold_index, round(t, 2) AS threshold, CAST(tp AS BIGINT) AS tp,
  CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
  coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM c""", ["threshold", "precision", "recall", "f1"])
def _(spark, d):
    return metrics.threshold_sweep(S.frame(spark, d, S.SCORED_SQL), "y", "p")


@q("best_threshold", SC + f""", th AS {THR}, c AS (SELECT threshold_index, t,
  count_if(p >= t AND y = 1) AS tp, count_if(p >= t AND y = 0) AS fp, count_if(p < t AND y = 1) AS fn,
  count_if(p < t AND y = 0) AS tn FROM th, s GROUP BY threshold_index, t)
SELECT CAST(threshold_index AS INT) AS threshold_index, round(t, 2) AS threshold, CAST(tp AS BIGINT) AS tp,
  CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
  coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM c ORDER BY f1 DESC, threshold_index LIMIT 1""",
   ["threshold", "precision", "recall", "f1"])
def _(spark, d):
    return metrics.best_threshold(metrics.threshold_sweep(S.frame(spark, d, S.SCORED_SQL), "y", "p"))


AUC_SQL = """(SELECT (sum(CASE WHEN a.y = 1 AND b.y = 0 AND a.p > b.p THEN 1.0 WHEN a.y = 1 AND b.y = 0 AND a.p = b.p
  THEN 0.5 ELSE 0 END)) / (count_if(a.y = 1 AND b.y = 0)) FROM s a, s b WHERE a.y = 1 AND b.y = 0)"""
AUC_FAST = """(WITH g AS (SELECT p, sum(y) AS pos, count(*) - sum(y) AS neg FROM s GROUP BY p),
  r AS (SELECT pos, neg, sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below FROM g)
  SELECT sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) FROM r)"""


@q("roc_auc", SC + f"SELECT {AUC_FAST} AS roc_auc", ["roc_auc"])
def _(spark, d):
    return metrics.roc_auc(S.frame(spark, d, S.SCORED_SQL), "y", "p")


@q("classification_metrics", SC + f""", c AS (SELECT count_if(p >= 0.5 AND y = 1) AS tp, count_if(p >= 0.5 AND y = 0) AS fp,
  count_if(p < 0.5 AND y = 1) AS fn, count_if(p < 0.5 AND y = 0) AS tn FROM s)
SELECT 0.5 AS threshold, (tp + tn) / (tp + tn + fp + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
  {AUC_FAST} AS roc_auc FROM c""", ["threshold", "accuracy", "precision", "recall", "f1", "roc_auc"])
def _(spark, d):
    return metrics.classification_metrics(S.frame(spark, d, S.SCORED_SQL), "y", "p", 0.5)


@q("confusion_matrix", SC + """SELECT a.actual, a.predicted, count(s.y) AS count FROM
  (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(actual, predicted)) a
  LEFT JOIN s ON s.y = a.actual AND CAST(s.p >= 0.3 AS INT) = a.predicted GROUP BY a.actual, a.predicted""")
def _(spark, d):
    return metrics.confusion_matrix(S.frame(spark, d, S.SCORED_SQL), "y", metrics.predict_at("p", 0.3))


@q("classification_report", SC + """, c AS (SELECT count_if(p >= 0.3 AND y = 1) AS tp, count_if(p >= 0.3 AND y = 0) AS fp,
  count_if(p < 0.3 AND y = 1) AS fn, count_if(p < 0.3 AND y = 0) AS tn FROM s),
k AS (SELECT '0' AS class, coalesce(tn / nullif(tn + fn, 0), 0) AS precision, coalesce(tn / nullif(tn + fp, 0), 0) AS recall,
   coalesce(2.0 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f1, CAST(tn + fp AS DOUBLE) AS support FROM c
  UNION ALL SELECT '1', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0),
   coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), CAST(tp + fn AS DOUBLE) FROM c),
n AS (SELECT CAST(tp + tn + fp + fn AS DOUBLE) AS n, (tp + tn) / (tp + tn + fp + fn) AS acc FROM c)
SELECT * FROM k UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM n
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), (SELECT n FROM n) FROM k
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support) FROM k""", ["precision", "recall", "f1", "support"])
def _(spark, d):
    return metrics.classification_report(S.frame(spark, d, S.SCORED_SQL), "y", metrics.predict_at("p", 0.3))


@q("select_best_model", SC + f""", m AS (
  SELECT 'rule_a' AS model, (SELECT sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) FROM
    (SELECT pos, neg, sum(neg) OVER (ORDER BY p ROWS UNBOUNDED PRECEDING) - neg AS below FROM
      (SELECT p, sum(y) AS pos, count(*) - sum(y) AS neg FROM s GROUP BY p) g) r) AS roc_auc
  UNION ALL SELECT 'rule_b', (SELECT sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) FROM
    (SELECT pos, neg, sum(neg) OVER (ORDER BY p2 ROWS UNBOUNDED PRECEDING) - neg AS below FROM
      (SELECT p2, sum(y) AS pos, count(*) - sum(y) AS neg FROM s GROUP BY p2) g) r))
SELECT model, roc_auc FROM m ORDER BY roc_auc DESC, model LIMIT 1""", ["roc_auc"])
def _(spark, d):
    s = S.frame(spark, d, S.SCORED_SQL)
    a = metrics.roc_auc(s, "y", "p").withColumn("model", F.lit("rule_a"))
    b = metrics.roc_auc(s, "y", "p2").withColumn("model", F.lit("rule_b"))
    m = a.unionByName(b).withColumn("f1", F.lit(0.0))
    return metrics.select_best_model(m).select("model", "roc_auc")


@q("regression_metrics", """SELECT count(*) AS n, avg(abs(l_extendedprice - l_quantity * 2000)) AS mae,
  sqrt(avg((l_extendedprice - l_quantity * 2000) * (l_extendedprice - l_quantity * 2000))) AS rmse,
  1 - sum((l_extendedprice - l_quantity * 2000) * (l_extendedprice - l_quantity * 2000)) / (var_pop(l_extendedprice) * count(*)) AS r2,
  sum((l_extendedprice - l_quantity * 2000) * (l_extendedprice - l_quantity * 2000)) / (var_pop(l_extendedprice) * count(*)) AS rse
FROM lineitem""", ["mae", "rmse", "r2", "rse"])
def _(spark, d):
    li = S.table(spark, d, "lineitem").withColumn("pred", F.col("l_quantity") * 2000)
    return metrics.regression_metrics(li, "l_extendedprice", "pred")


@q("class_weights", SC + """SELECT event_id, y, (SELECT count(*) FROM s) / (2 * count(*) OVER (PARTITION BY y)) AS weight
FROM s""", ["weight"])
def _(spark, d):
    return ml.class_weights(S.frame(spark, d, S.SCORED_SQL).select("event_id", "y"), "y")


SPLIT_ORACLE = """WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS STRING) || '42'), doc_id) AS r,
  count(*) OVER (PARTITION BY quality) AS n FROM labels),
k AS (SELECT *, CAST(ceil(n / 5.0) AS BIGINT) AS nt FROM r)
SELECT doc_id, quality, CASE WHEN r <= nt THEN 'test' WHEN r <= nt + CAST(ceil((n - nt) / 4.0) AS BIGINT) THEN 'validation'
  ELSE 'train' END AS split FROM k"""


@q("stratified_split", SPLIT_ORACLE)
def _(spark, d):
    return ml.stratified_split(S.table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "quality")


@q("random_split", """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS STRING) || '42'), doc_id) AS r,
  count(*) OVER () AS n FROM labels)
SELECT doc_id, CASE WHEN r <= CAST(ceil(n / 5.0) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM r""")
def _(spark, d):
    return ml.random_split(S.table(spark, d, "labels").select("doc_id"), "doc_id")


@q("class_distribution", "SELECT split, quality, count(*) AS rows FROM (" + SPLIT_ORACLE + ") x GROUP BY split, quality")
def _(spark, d):
    sp = ml.stratified_split(S.table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "quality")
    return ml.class_distribution(sp, "quality", "split")


@q("one_hot_align", """SELECT o_orderkey, CAST(coalesce(o_orderstatus = 'F', false) AS INT) AS status_F,
  CAST(coalesce(o_orderstatus = 'O', false) AS INT) AS status_O, CAST(coalesce(o_orderstatus = 'X', false) AS INT) AS status_X
FROM orders""")
def _(spark, d):
    o = S.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return ml.one_hot_align(o, "o_orderstatus", ["F", "O", "X"], "status").drop("o_orderstatus")


VOCAB_ORACLE = """SELECT value, CAST(row_number() OVER (ORDER BY n DESC, value) - 1 AS INT) AS index FROM
  (SELECT CAST(c_mktsegment AS STRING) AS value, count(*) AS n FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1) v"""


@q("vocabulary", VOCAB_ORACLE.replace(" WHERE c_mktsegment <> 'MACHINERY'", ""))
def _(spark, d):
    return ml.vocabulary(S.table(spark, d, "customer"), "c_mktsegment")


@q("label_encode_quarantine", f"""WITH v AS ({VOCAB_ORACLE})
SELECT c_custkey, c_mktsegment, index AS c_mktsegment_index FROM customer JOIN v ON c_mktsegment = value""")
def _(spark, d):
    c = S.table(spark, d, "customer")
    vocab = ml.vocabulary(c.where(F.col("c_mktsegment") != "MACHINERY"), "c_mktsegment")
    good, _bad = ml.label_encode(c.select("c_custkey", "c_mktsegment"), "c_mktsegment", vocab, "quarantine")
    return good


@q("label_encode_rejected", """SELECT c_custkey, c_mktsegment, 'unknown c_mktsegment' AS reason FROM customer
WHERE c_mktsegment = 'MACHINERY'""")
def _(spark, d):
    c = S.table(spark, d, "customer")
    vocab = ml.vocabulary(c.where(F.col("c_mktsegment") != "MACHINERY"), "c_mktsegment")
    _good, bad = ml.label_encode(c.select("c_custkey", "c_mktsegment"), "c_mktsegment", vocab, "quarantine")
    return bad


@q("impute_scale_stored", EV + """, st AS (SELECT median(value) AS med, avg(value) AS mu, stddev_pop(value) AS sd FROM ev)
SELECT event_id, coalesce((coalesce(value, med) - mu) / nullif(sd, 0), 0) AS value FROM ev, st""", ["value"])
def _(spark, d):
    e = ev(spark, d).select("event_id", "value")
    stats = ml.fitted_stats(e, ["value"])
    return ml.impute_scale_stored(e, stats, ["value"])


@q("risk_band_label", SC + """SELECT event_id, CASE WHEN p >= 0.7 THEN 'High Risk' WHEN p >= 0.4 THEN 'Medium Risk' ELSE 'No Risk' END AS risk_label,
  CASE WHEN p >= 0.7 THEN 'Immediate mentor follow-up' WHEN p >= 0.4 THEN 'Monitor and counsel' ELSE 'Routine monitoring' END
  AS recommended_intervention FROM s""")
def _(spark, d):
    s = S.frame(spark, d, S.SCORED_SQL)
    return s.select("event_id", X.risk_label("p").alias("risk_label"),
                    X.recommended_intervention("p").alias("recommended_intervention"))


@q("binary_target", ACAD + "SELECT student_id, coalesce(CAST(noofbacklog > 0 AS INT), 0) AS backlog_risk FROM acad")
def _(spark, d):
    return S.frame(spark, d, S.ACAD_SQL).select("student_id", X.binary_target("noofbacklog").alias("backlog_risk"))


@q("target_not_null", STU + "SELECT student_id, cgpa FROM stu WHERE cgpa IS NOT NULL", ["cgpa"])
def _(spark, d):
    return marts.target_not_null(stu(spark, d).select("student_id", "cgpa"), "cgpa")


# ------------------------------------------- model fitting & streams (rows only)

def _emb_frame(spark, d):
    """embedding array → 8 numeric features (means of 8-wide slices) + label."""
    e = S.table(spark, d, "embeddings")
    feats = {f"e{i}": F.aggregate(F.slice("embedding", i * 8 + 1, 8), F.lit(0.0),
                                  lambda acc, x: acc + x.cast("double")) / 8 for i in range(8)}
    return e.select("vec_id", "label", *[v.alias(k) for k, v in feats.items()])


def _doc_frame(spark, d, how="inner"):
    docs = S.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars",
                                                 F.size(F.split("text", r"\s+")).alias("n_words"))
    lab = S.table(spark, d, "labels")
    return docs.join(lab, "doc_id", how).withColumn("n_chars", F.col("n_chars").cast("double")) \
               .withColumn("n_words", F.col("n_words").cast("double"))


DOC_FEATURES = ["n_chars", "n_words", "lang", "source"]


@q("fit_candidates")
def _(spark, d):
    """Both classifiers on documents ⋈ labels; validation metrics per model."""
    df = ml.stratified_split(_doc_frame(spark, d), "doc_id", "quality")
    df = ml.class_weights(df, "quality")
    train = df.where(F.col("split") == "train")
    valid = df.where(F.col("split") == "validation")
    models = ml.fit_candidates(train, DOC_FEATURES, "quality", num_trees=500)
    rows = None
    for name, m in models.items():
        # scored once: a job that scores ships the whole forest to its tasks
        scored = pinned(ml.positive_probability(m, valid, "p", ["n_chars", "n_words"]).select("quality", "p"))
        sweep = metrics.best_threshold(metrics.threshold_sweep(scored, "quality", "p"))
        met = metrics.classification_metrics(scored, "quality", "p", float(sweep.first()["threshold"]))
        met = met.withColumn("model", F.lit(name))
        rows = met if rows is None else rows.unionByName(met)
    return rows


@q("fit_regressor")
def _(spark, d):
    """Random-forest regressor on embedding features; test-split metrics."""
    df = ml.random_split(_emb_frame(spark, d), "vec_id")
    feats = [f"e{i}" for i in range(8)]
    model = ml.fit_regressor(df.where(F.col("split") == "train"), feats, "label", num_trees=160)
    pred = model.transform(ml.prepare_numeric(df.where(F.col("split") == "test"), feats))
    return metrics.regression_metrics(pred, "label", "prediction")


@q("score_table")
def _(spark, d):
    """Every document scored by both models; the forest decides."""
    models = ml.fit_candidates(ml.class_weights(_doc_frame(spark, d), "quality"), DOC_FEATURES, "quality")
    df = _doc_frame(spark, d, "left")  # fitted on labelled rows, scores every row
    for name, model in models.items():
        df = ml.positive_probability(model, df, f"{name}_probability", ["n_chars", "n_words"]).select(*df.columns, f"{name}_probability")
    return ml.score_table(models["random_forest"], df, 0.58, ["doc_id", *[f"{name}_probability" for name in models]],
                          "quality", ["n_chars", "n_words"])


@q("feature_importance")
def _(spark, d):
    df = ml.class_weights(_doc_frame(spark, d), "quality")
    model = ml.fit_candidates(df, DOC_FEATURES, "quality")["random_forest"]
    return ml.feature_importance(model, ml.prepare_numeric(df, ["n_chars", "n_words"]), 15)


@q("multiclass_score")
def _(spark, d):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    e = _emb_frame(spark, d)
    feats = [f"e{i}" for i in range(8)]
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                            LogisticRegression(featuresCol="features", labelCol="label", maxIter=3000)])
    scored = pipe.fit(e).transform(e)
    names = e.select(F.col("label").alias("class_id")).distinct() \
             .withColumn("class_name", F.concat(F.lit("class_"), F.col("class_id").cast("string")))
    return ml.multiclass_score(scored, ["vec_id"], names)


@q("batch_score", EV + """, f AS (SELECT regr_slope(value, user_id) AS s, regr_intercept(value, user_id) AS i FROM ev)
SELECT event_id, CASE WHEN user_id IS NOT NULL AND value IS NOT NULL THEN round(i + s * user_id, 4) END AS prediction
FROM ev, f""", ["prediction"])
def _(spark, d):
    """Validated batch scoring: valid rows scored, invalid rows (NULL value) rejected."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    e = ev(spark, d).select("event_id", "user_id", "value")
    train = e.where(F.col("value").isNotNull())
    model = Pipeline(stages=[VectorAssembler(inputCols=["user_id"], outputCol="features"),
                             LinearRegression(featuresCol="features", labelCol="value")]).fit(train)
    good, bad = ml.batch_score(model, e.select("event_id", "user_id", "value"), ["user_id", "value"], ["user_id"])
    return good.select("event_id", "prediction").unionByName(
        bad.select("event_id", F.lit(None).cast("double").alias("prediction")))


@q("save_load_model", EV + """, f AS (SELECT regr_slope(value, user_id) AS s, regr_intercept(value, user_id) AS i FROM ev)
SELECT event_id, round(i + s * user_id, 4) AS prediction FROM ev, f WHERE user_id IS NOT NULL""", ["prediction"])
def _(spark, d):
    """A fitted pipeline saved, loaded again and applied to every event."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    e = ev(spark, d).where(F.col("user_id").isNotNull())
    base = _out(spark, "model")
    ml.save_model(Pipeline(stages=[VectorAssembler(inputCols=["user_id"], outputCol="features"),
                                   LinearRegression(featuresCol="features", labelCol="value")]).fit(e.where("value IS NOT NULL")), base)
    return ml.load_model(base).transform(e).select("event_id", F.round("prediction", 4).alias("prediction"))


PREDICTIONS_SQL = """SELECT event_id AS student_id, user_id AS subjectid, p, CASE WHEN p >= 0.58 THEN 1 ELSE 0 END AS predicted
FROM (""" + S.SCORED_SQL + ") s"


@q("prediction_sinks", S.cte(s=PREDICTIONS_SQL) + f"""SELECT 'predictions' AS sink, count(*) AS rows, avg(p) AS mean FROM s
UNION ALL SELECT 'test_predictions', count(*), avg(p) FROM s WHERE subjectid % 5 = 0
UNION ALL SELECT 'dashboard_output', count(*), avg(p) FROM s""", ["mean"])
def _(spark, d):
    """Predictions written to the three sinks and read back."""
    from strata.sources.files import write_predictions
    from strata.functions import expressions as X
    p = "backlog_risk_probability"
    scored = S.frame(spark, d, PREDICTIONS_SQL).withColumnRenamed("p", p)
    scored = scored.withColumns({"risk_label": X.risk_label(p), "recommended_intervention": X.recommended_intervention(p)})
    base = _out(spark, "predictions")
    write_predictions(scored, scored.where("subjectid % 5 = 0").select("student_id"), base, ["student_id"])
    out = None
    for sink in ("predictions", "test_predictions", "dashboard_output"):
        t = spark.read.parquet(f"{base}/backlog_risk_{sink}")
        one = t.agg(F.count(F.lit(1)).alias("rows"), F.avg(p).alias("mean")).select(F.lit(sink).alias("sink"), "rows", "mean")
        out = one if out is None else out.unionByName(one)
    return out


@q("freshness_report", "SELECT 'events.parquet' AS file_name, count(*) AS rows FROM events")
def _(spark, d):
    """Rows per input file; the file times differ per copy of the table, so they are left out here."""
    from strata.sources.files import freshness_report
    return freshness_report(spark, f"{d}/events.parquet", fmt="parquet").select("file_name", "rows")


def _out(spark, name):
    """A new folder for what a query writes, below the shared checkpoint folder."""
    import uuid
    from strata.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/{name}_{uuid.uuid4().hex[:8]}"


@q("stale_check", "SELECT * FROM (VALUES ('before', true), ('after', false), ('new file', true)) AS t(step, stale)")
def _(spark, d):
    """Stale without a run, fresh after a logged run, stale again for a file no run has seen."""
    from strata.streaming.incremental import log_run, stale_check
    log = _out(spark, "run_log")
    steps = [("before", f"{d}/events.parquet"), ("after", f"{d}/events.parquet"), ("new file", f"{d}/orders.parquet")]
    out = []
    for step, path in steps:
        out.append(stale_check(spark, path, log).select(F.lit(step).alias("step"), "stale"))
        if step == "before":
            log_run(spark, path, log)
    return out[0].unionByName(out[1]).unionByName(out[2])


CSV_SQL = """SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN ' NA '
  WHEN 3 THEN 'x, "y"' ELSE c_mktsegment END AS note FROM customer"""


@q("csv_na_tokens", S.cte(t=CSV_SQL) + "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, "
   "CASE WHEN note IN ('NA', 'n/a') THEN NULL ELSE note END AS note FROM t")
def _(spark, d):
    """Customers written as CSV and read back as text with the missing-value tokens."""
    from strata.sources.files import read_table
    path = _out(spark, "na") + "/t.csv"
    S.frame(spark, d, CSV_SQL).write.option("header", True).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_table(spark, path)


@q("replace_outputs", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' UNION ALL "
   "SELECT o_orderkey, -o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'", ["o_totalprice"])
def _(spark, d):
    """A layer partitioned by status; one partition is then replaced, the others stay."""
    from strata.sources.files import write_layer
    o = S.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = _out(spark, "layer")
    write_layer(o, path, partition_by=["o_orderstatus"])
    write_layer(o.where("o_orderstatus = 'F'").withColumn("o_totalprice", -F.col("o_totalprice")), path,
                partition_by=["o_orderstatus"], dynamic=True)
    return spark.read.schema(o.schema).parquet(path)


@q("kpi_json_sink", "SELECT count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders", ["total"])
def _(spark, d):
    from strata.sources.files import write_json_row
    row = S.table(spark, d, "orders").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    path = _out(spark, "kpi")
    write_json_row(row, path)
    return spark.read.schema(row.schema).json(path)


@q("land_new_files", "SELECT 'orders' AS landed, count(*) AS files, (SELECT count(*) FROM orders) AS rows FROM (SELECT 1) t "
   "UNION ALL SELECT 'again', 0, (SELECT count(*) FROM orders)")
def _(spark, d):
    """Landed once; a second run finds nothing new and lands nothing twice."""
    from strata.sources.files import land_new_files
    base = _out(spark, "landing")
    out = []
    for step in ("orders", "again"):
        new = land_new_files(spark, f"{d}/orders*.parquet", f"{base}/rows", f"{base}/log", fmt="parquet")
        files = new.agg(F.count(F.lit(1)).alias("files"))
        rows = spark.read.parquet(f"{base}/rows").agg(F.count(F.lit(1)).alias("n"))
        out.append(files.select(F.lit(step).alias("landed"), "files", rows.scalar().alias("rows")))
    return out[0].unionByName(out[1])


@q("stream_score", """WITH f AS (SELECT regr_slope(value, user_id) AS s, regr_intercept(value, user_id) AS i FROM events)
SELECT event_id, CASE WHEN user_id IS NOT NULL THEN round(i + s * user_id, 4) END AS prediction FROM events, f""",
   ["prediction"])
def _(spark, d):
    """Events replayed as a file stream (availableNow) and scored per batch."""
    import uuid
    from strata.session import ensure_checkpoint_dir
    from strata.streaming.incremental import stream_score
    e = S.table(spark, d, "events")
    stream = spark.readStream.schema(e.schema).parquet(f"{d}/events*.parquet")
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    model = Pipeline(stages=[VectorAssembler(inputCols=["user_id"], outputCol="features"),
                             LinearRegression(featuresCol="features", labelCol="value")]).fit(e)
    scored, bad = stream_score(stream, model, ["user_id"], ["user_id"])
    base = f"{ensure_checkpoint_dir(spark)}/stream_score_{uuid.uuid4().hex[:8]}"
    reject = bad.select("event_id", F.lit(None).cast("double").alias("prediction"))
    for name, part in (("scored", scored.select("event_id", "prediction")), ("rejected", reject)):
        (part.writeStream.format("parquet").option("path", f"{base}/{name}")
         .option("checkpointLocation", f"{base}/_{name}").trigger(availableNow=True).start().awaitTermination())
    schema = "event_id long, prediction double"
    return spark.read.schema(schema).parquet(f"{base}/scored").unionByName(
        spark.read.schema(schema).parquet(f"{base}/rejected"))


@q("score_once", """WITH f AS (SELECT regr_slope(value, user_id) AS s, regr_intercept(value, user_id) AS i FROM events)
SELECT event_id, CASE WHEN event_id % 9 > 0 THEN round(i + s * user_id, 4) END AS prediction,
  CASE WHEN event_id % 9 = 0 THEN 'missing user_id' END AS reason FROM events, f""", ["prediction"])
def _(spark, d):
    """All events offered as files, then again under new names: each is scored
    or rejected once, by the state kept behind a watermark."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from strata.streaming.incremental import score_once
    e = S.table(spark, d, "events").select("event_id", "ts", "user_id", "value")
    model = Pipeline(stages=[VectorAssembler(inputCols=["user_id"], outputCol="features"),
                             LinearRegression(featuresCol="features", labelCol="value")]).fit(e)
    base = _out(spark, "score_once")
    span = e.agg(F.ceil((F.unix_timestamp(F.max(F.col("ts").cast("timestamp"))) - F.unix_timestamp(F.min(F.col("ts").cast("timestamp")))) / 86400)
                 .alias("days")).first()["days"] or 0
    offered = e.withColumn("user_id", F.when(F.col("event_id") % 9 > 0, F.col("user_id")))
    for _ in range(2):  # the same rows in new files
        offered.write.mode("append").parquet(f"{base}/raw")
        stream = spark.readStream.schema(offered.schema).parquet(f"{base}/raw")
        score_once(stream, model, ["user_id"], ["user_id"], ["event_id"], "ts", f"{span + 1} days", f"{base}/sink", f"{base}/_stream")
    return spark.read.parquet(f"{base}/sink").select("event_id", "prediction", "reason")


@q("metadata_tables", """WITH x AS (SELECT lang, source FROM documents)
SELECT * FROM (VALUES ('required', 'n_chars', NULL), ('required', 'n_words', NULL), ('required', 'lang', NULL),
  ('required', 'source', NULL), ('numeric', 'n_chars', NULL), ('numeric', 'n_words', NULL)) AS t(kind, field, value)
UNION ALL SELECT DISTINCT 'category', 'lang', lang FROM x WHERE lang IS NOT NULL
UNION ALL SELECT DISTINCT 'category', 'source', source FROM x WHERE source IS NOT NULL""")
def _(spark, d):
    """Required/numeric fields and allowed categories of a fitted indexer."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer
    df = _doc_frame(spark, d, "left")
    model = Pipeline(stages=[StringIndexer(inputCols=["lang", "source"], outputCols=["lang_i", "source_i"],
                                           handleInvalid="keep")]).fit(df)
    meta = ml.metadata_tables(model, DOC_FEATURES, ["n_chars", "n_words"])
    rows = ([("required", f, None) for f in meta["required"]] + [("numeric", f, None) for f in meta["numeric"]]
            + [("category", c, v) for c, vals in meta["categories"].items() for v in vals])
    return spark.createDataFrame(rows, "kind string, field string, value string")


# ------------------------------------------------------------ cleaning chains

# raw header spellings (applied on the Spark side; SQL uses plain aliases)
PERF_HEADERS = ['Student ID', 'Age', 'Gender', 'Major', 'Study Hours Per Day', 'Semester', 'Exam Score', 'Diet Quality']
RESEARCH_HEADERS = ['Branch', 'Marks[10th]', 'Board[10th]', 'Board[12th]', 'CGPA', 'GPA 1', 'Engg. Coaching', 'Current Back', 'Rank']

RAW_PERF_SQL = """
SELECT o_orderkey AS _row,
  CAST(o_custkey AS STRING) AS r_student_id,
  CASE WHEN o_custkey % 13 = 0 THEN 'NA' ELSE CAST(18 + o_custkey % 10 AS STRING) END AS r_age,
  CASE WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS r_gender,
  CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS r_major,
  CASE WHEN o_custkey % 11 = 0 THEN 'n/a' ELSE CAST(o_custkey % 9 AS STRING) || '.25' END AS r_study_hours_per_day,
  CASE WHEN o_custkey % 7 = 0 THEN 'abc' ELSE CAST(o_custkey % 8 AS STRING) || '.5' END AS r_semester,
  CAST(o_custkey % 100 AS STRING) || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '.0' END AS r_exam_score,
  CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 5 = 1 THEN 'Poor' WHEN o_custkey % 5 = 2 THEN 'Good'
       ELSE 'Fair' END AS r_diet_quality
FROM orders
"""


def _mode_sql(col, src):
    return (f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} LIMIT 1)")


PERF_ORACLE = S.cte(raw=RAW_PERF_SQL) + f""", d AS (SELECT DISTINCT {duck_num('r_student_id')} AS student_id, r_age AS age,
  r_gender AS gender, r_major AS major, r_study_hours_per_day AS study_hours_per_day, r_semester AS semester,
  {duck_num('r_exam_score')} AS exam_score, r_diet_quality AS diet_quality FROM raw),
c AS (SELECT student_id, {duck_num('age')} AS age, gender, major,
  {duck_num('study_hours_per_day')} AS study_hours_per_day, {duck_num('semester')} AS semester,
  exam_score, diet_quality FROM d)
SELECT coalesce(student_id, (SELECT median(student_id) FROM c)) AS student_id,
  coalesce(age, (SELECT median(age) FROM c)) AS age,
  coalesce(gender, {_mode_sql('gender', 'c')}, 'unknown') AS gender,
  coalesce(major, {_mode_sql('major', 'c')}, 'unknown') AS major,
  coalesce(study_hours_per_day, (SELECT median(study_hours_per_day) FROM c)) AS study_hours_per_day,
  CAST(round_even(coalesce(semester, (SELECT median(semester) FROM c)), 0) AS INTEGER) AS semester,
  coalesce(exam_score, (SELECT median(exam_score) FROM c)) AS exam_score,
  coalesce(diet_quality, {_mode_sql('diet_quality', 'c')}, 'unknown') AS diet_quality
FROM c"""


@q("clean_performance", PERF_ORACLE, ["student_id", "age", "study_hours_per_day", "exam_score"])
def _(spark, d):
    from strata.plans import student
    raw = S.frame(spark, d, RAW_PERF_SQL).toDF("_row", *PERF_HEADERS)
    return student.clean_performance(raw).drop(student.ROW)


_RESEARCH = """
SELECT c_custkey * 2 + {k} AS _row,
  c_mktsegment AS r_branch,
  CASE WHEN c_custkey % 19 = 0 THEN 'NA' ELSE CAST(c_custkey % 60 + 40 AS STRING) END AS r_marks_10th_,
  CASE c_custkey % 7 WHEN 0 THEN 'BSEB Patna' WHEN 1 THEN 'C.B.S.E' WHEN 2 THEN 'cbse' WHEN 3 THEN 'Unmapped Board'
       WHEN 4 THEN NULL WHEN 5 THEN 'Bihar Board' ELSE 'ICSE' END AS r_board_10th_,
  CASE c_custkey % 6 WHEN 0 THEN 'I Sc' WHEN 1 THEN 'NIOS BOARD' WHEN 2 THEN 'bhopal' WHEN 3 THEN 'state'
       WHEN 4 THEN 'H.S.E.B' ELSE 'CBSE Board' END AS r_board_12th_,
  CAST(c_custkey % 50 AS STRING) || '.' || CAST(c_nationkey % 10 AS STRING) AS r_cgpa,
  CASE WHEN c_custkey % 97 = 0 THEN '99' ELSE CAST(c_custkey % 4 + 6 AS STRING) END AS r_gpa_1,
  CAST(c_nationkey % 3 AS STRING) AS r_engg__coaching,
  '0{zero}' AS r_current_back,
  CASE WHEN c_custkey % 23 = 0 THEN 'x' ELSE CAST(c_nationkey AS STRING) END AS r_rank
FROM customer
"""
# every row twice, once with 0.0 for 0: duplicates only after typing
RAW_RESEARCH_SQL = _RESEARCH.format(k=0, zero="") + "UNION ALL" + _RESEARCH.format(k=1, zero=".0")


def _board_case(col, mapping):
    def lit(v):
        return "'" + v.replace("'", "''") + "'"
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {col} END"


def _cap(col, src):
    f = f"(SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {src})"
    lo = f"(SELECT q1 - 1.5 * (q3 - q1) FROM {f} _f)"
    hi = f"(SELECT q3 + 1.5 * (q3 - q1) FROM {f} _f)"
    return f"CASE WHEN {col} < {lo} THEN {lo} WHEN {col} > {hi} THEN {hi} ELSE {col} END"


def _research_oracle():
    from strata.functions import constants as K
    num = ["marks_10th", "cgpa", "gpa_1", "engg_coaching", "current_back", "rank"]
    filled = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM c)) AS {c}" for c in num)
    txt = ", ".join(f"coalesce({c}, {_mode_sql(c, 'c')}, 'Unknown') AS {c}" for c in ["branch", "board_10th", "board_12th"])
    capped = ", ".join(f"{_cap(c, 'm')} AS {c}" for c in num)
    return S.cte(raw=RAW_RESEARCH_SQL) + f""", d AS (SELECT DISTINCT r_branch AS branch, r_marks_10th_ AS marks_10th,
  r_board_10th_ AS board_10th, r_board_12th_ AS board_12th, {duck_num('r_cgpa')} AS cgpa, {duck_num('r_gpa_1')} AS gpa_1,
  {duck_num('r_engg__coaching')} AS engg_coaching, {duck_num('r_current_back')} AS current_back, r_rank AS rank FROM raw),
c AS (SELECT * REPLACE ({duck_num('marks_10th')} AS marks_10th, {duck_num('rank')} AS rank) FROM d),
i AS (SELECT {filled}, {txt} FROM c),
m AS (SELECT * REPLACE ({_board_case('board_10th', K.BOARD_10TH_MAPPING)} AS board_10th,
  {_board_case('board_12th', K.BOARD_12TH_MAPPING)} AS board_12th) FROM i)
SELECT branch, board_10th, board_12th, {capped} FROM m"""


@q("clean_research", _research_oracle(), ["marks_10th", "cgpa", "gpa_1", "engg_coaching", "current_back", "rank"])
def _(spark, d):
    from strata.plans import student
    raw = S.frame(spark, d, RAW_RESEARCH_SQL).toDF("_row", *RESEARCH_HEADERS)
    return student.clean_research(raw).drop(student.ROW)


@q("refresh_if_new", "SELECT event_type, count(*) AS events, round(avg(value), 6) AS avg_value FROM events "
   "GROUP BY event_type", ["avg_value"])
def _(spark, d):
    """availableNow refresh: unseen event files rebuild a per-type count mart."""
    import uuid
    from strata.session import ensure_checkpoint_dir
    from strata.sources.files import write_layer
    from strata.streaming.incremental import refresh_if_new
    base = f"{ensure_checkpoint_dir(spark)}/refresh_{uuid.uuid4().hex[:8]}"
    schema = S.table(spark, d, "events").schema

    def rebuild(batch, epoch):
        # additive parts per batch (a replayed batch replaces its own part)
        part = batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total"),
                                               F.count("value").alias("valued"))
        write_layer(part, f"{base}/mart/epoch={epoch}")

    refresh_if_new(spark, f"{d}/events*.parquet", schema, f"{base}/_stream", rebuild, fmt="parquet")
    return spark.read.parquet(f"{base}/mart").groupBy("event_type").agg(
        F.sum("events").alias("events"), F.round(F.sum("total") / F.sum("valued"), 6).alias("avg_value"))


REFRESH_ORACLE = f"""{EV}, c AS (
  SELECT event_type, 'value' AS "column", CAST(value AS DOUBLE) AS v FROM ev
  UNION ALL SELECT event_type, 'user_id', CAST(user_id AS DOUBLE) FROM ev),
f AS (SELECT event_type, "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM c WHERE v IS NOT NULL GROUP BY ALL)
SELECT event_type, "column", q1, median, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper, NULL::BIGINT AS missing, NULL::BIGINT AS n_unique FROM f
UNION ALL SELECT NULL, 'event_type', NULL, NULL, NULL, NULL, NULL, count(*) - count(event_type),
  count(DISTINCT event_type) + CAST(count(*) > count(event_type) AS INT) FROM ev
UNION ALL SELECT NULL, 'user_id', NULL, NULL, NULL, NULL, NULL, count(*) - count(user_id),
  count(DISTINCT user_id) + CAST(count(*) > count(user_id) AS INT) FROM ev
UNION ALL SELECT NULL, 'props', NULL, NULL, NULL, NULL, NULL, count(*) - count(props),
  count(DISTINCT props) + CAST(count(*) > count(props) AS INT) FROM ev"""


@q("refresh_statistics", REFRESH_ORACLE, ["q1", "median", "q3", "lower", "upper"])
def _(spark, d):
    """Order statistics and distinct counts of all events after two refreshes
    of a raw folder that grows, from mergeable state."""
    from strata.streaming.incremental import refresh_if_new
    from strata.streaming.statistics import StatisticsMart
    base = _out(spark, "statistics")
    mart = StatisticsMart(f"{base}/mart", ["value", "user_id"], ["event_type"], ["event_type", "user_id", "props"])
    events = ev(spark, d)
    for half in (0, 1):  # the folder gets one half of the rows, then the other
        events.where(F.col("event_id") % 2 == half).write.mode("append").parquet(f"{base}/raw")
        refresh_if_new(spark, f"{base}/raw", events.schema, f"{base}/_stream", mart.add, fmt="parquet")
    med = mart.medians(spark).select(F.col("event_type").alias("_e"), F.col("column").alias("_c"), F.col("value").alias("median"))
    order = mart.fences(spark).join(med, F.col("event_type").eqNullSafe(F.col("_e")) & (F.col("column") == F.col("_c")))
    order = order.select("event_type", "column", "q1", "median", "q3", "lower", "upper")
    audit = mart.audit(spark).select("column", F.col("missing_count").alias("missing"), "n_unique")
    return order.unionByName(audit, allowMissingColumns=True)


# ---------------------------------------------------------------- whole flows

ATTITUDE_HEADERS = ["Gender", "Department", "Height(CM)", "Weight(KG)", "salary expectation", "Do you like your degree?"]
RAW_ATTITUDE_SQL = """
SELECT s_suppkey AS _row,
  CASE WHEN s_suppkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS r_gender,
  CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 'D' || CAST(s_nationkey AS STRING) END AS r_department,
  CAST(150 + s_suppkey % 40 AS STRING) AS r_heightcm,
  CASE WHEN s_suppkey % 21 = 0 THEN 'NA' ELSE CAST(50 + s_suppkey % 30 AS STRING) END AS r_weightkg,
  CAST(1000 * (s_suppkey % 7) AS STRING) AS r_salary_expectation,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Yes' ELSE 'no' END AS r_like_degree
FROM supplier
"""


def _attitude_oracle():
    num = ["heightcm", "weightkg", "salary_expectation"]
    filled = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM c)) AS {c}" for c in num)
    txt = ", ".join(f"lower(coalesce({c}, {_mode_sql(c, 'c')}, 'unknown')) AS {c}" for c in ("gender", "department", "like_degree"))
    return S.cte(raw=RAW_ATTITUDE_SQL) + f""", d AS (SELECT DISTINCT r_gender AS gender, r_department AS department,
  {duck_num('r_heightcm')} AS heightcm, r_weightkg AS weightkg, {duck_num('r_salary_expectation')} AS salary_expectation,
  r_like_degree AS like_degree FROM raw),
c AS (SELECT * REPLACE ({duck_num('weightkg')} AS weightkg) FROM d),
i AS (SELECT {filled}, {txt} FROM c)
SELECT gender, department, CASE WHEN like_degree = 'yes' THEN 'yes' ELSE 'no' END AS like_degree, {', '.join(f"{_cap(c, 'i')} AS {c}" for c in num)} FROM i"""


@q("clean_attitude", _attitude_oracle(), ["heightcm", "weightkg", "salary_expectation"])
def _(spark, d):
    from strata.plans import student
    raw = S.frame(spark, d, RAW_ATTITUDE_SQL).toDF("_row", *ATTITUDE_HEADERS)
    return student.clean_attitude(raw).drop(student.ROW)


RAW_SOURCES = [("research", RAW_RESEARCH_SQL, RESEARCH_HEADERS), ("attitude", RAW_ATTITUDE_SQL, ATTITUDE_HEADERS),
               ("performance", RAW_PERF_SQL, PERF_HEADERS)]


# columns whose every text is a number or a missing-value token
TYPED = {"research": ["r_marks_10th_", "r_cgpa", "r_gpa_1", "r_engg__coaching", "r_current_back"],
         "attitude": ["r_heightcm", "r_weightkg", "r_salary_expectation"],
         "performance": ["r_student_id", "r_age", "r_study_hours_per_day", "r_exam_score"]}


def _layer_run_oracle():
    ctes = [f"{n}_raw AS ({sql.replace(' AS STRING)', ' AS VARCHAR)')})" for n, sql, _h in RAW_SOURCES]
    ctes += [f"{n}_bronze AS (SELECT DISTINCT * EXCLUDE (_row) REPLACE ({', '.join(f'{duck_num(c)} AS {c}' for c in TYPED[n])}) FROM {n}_raw)"
             for n, _s, _h in RAW_SOURCES]
    counts = [f"SELECT '{layer}' AS layer, '{n}' AS \"table\", count(*) AS rows FROM {n}_{layer}"
              for layer in ("raw", "bronze") for n, _s, _h in RAW_SOURCES]
    most = "(SELECT max(rows) FROM c WHERE layer = 'bronze')"
    return ("WITH " + ", ".join(ctes) + ", c AS (" + " UNION ALL ".join(counts) + ") SELECT * FROM c "
            + " ".join(f"UNION ALL SELECT '{layer}', '{t}', {most}"
                       for layer, t in (("silver", "silver"), ("gold", "gold"), ("gold", "features"))))


@q("layer_run", _layer_run_oracle())
def _(spark, d):
    """The whole flow from CSV files to warehouse and marts, every layer
    written; the row counts of the layers as the written record has them."""
    from strata.plans import student
    base = _out(spark, "layers")
    for name, sql, headers in RAW_SOURCES:
        S.frame(spark, d, sql).toDF("_row", *headers).drop("_row").write.option("header", True).csv(f"{base}/raw/{name}")
    status = student.write_layers(spark, base, f"{base}/raw/attitude", f"{base}/raw/research", f"{base}/raw/performance")
    return status.select(F.explode("layers").alias("t")).select("t.layer", "t.table", "t.rows") \
        .where("layer IN ('raw', 'bronze', 'silver', 'gold')")
