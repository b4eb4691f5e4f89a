"""File sources and sinks.

Layers are Parquet tables written with ``mode("overwrite")``; CSV input is read
as text (no inference) so that the configured missing-value tokens and numeric
coercion rules decide types, not the reader.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import constants as K

__all__ = ["read_table", "read_csv_text", "apply_na_tokens", "write_layer", "write_observed", "write_json_row",
           "land_new_files", "freshness_report", "ingest_upload", "write_predictions",
           "warehouse_schemas", "save_warehouse",
           "save_warehouse_tables", "warehouse_violations"]


def read_csv_text(spark: SparkSession, path: str | Sequence[str], na_tokens: Sequence[str] = K.NA_TOKENS,
                  multi_line: bool = False) -> DataFrame:
    """All columns as strings, NA tokens → NULL (Spark's ``nullValue`` takes one).
    Files whose quoted fields hold line ends need ``multi_line``: they cannot
    be split, so each is one task."""
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("multiLine", multi_line).option("escape", '"').csv(path))
    return apply_na_tokens(df, na_tokens)


def apply_na_tokens(df: DataFrame, na_tokens: Sequence[str] = K.NA_TOKENS) -> DataFrame:
    toks = list(na_tokens)
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            c = F.col(f"`{f.name}`")
            out[f.name] = F.when(~F.coalesce(c.isin(toks), F.lit(False)) & c.isNotNull(), c)
    return df.withColumns(out) if out else df


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Dispatch on suffix: .csv (text + NA tokens), .json, else Parquet.
    Spreadsheets are not read (supply CSV or Parquet)."""
    low = path.lower()
    if low.endswith((".xlsx", ".xls")):
        raise ValueError("spreadsheet input is not supported; convert to CSV or Parquet")
    if low.endswith(".csv"):
        return read_csv_text(spark, path)
    if low.endswith(".json"):
        return spark.read.schema(schema).json(path) if schema else spark.read.json(path)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                dynamic: bool = False) -> None:
    """Overwrite a layer table (``dynamic`` replaces only the written partitions)."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.save(path)


def write_observed(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict:
    """Write ``df`` and return what the writing job itself counted: ``rows``,
    ``missing`` (NULL cells) and the given aggregates; nothing is read again.
    ``df`` should be of a session of its own (``session.observing_session``)."""
    terms = [F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), total.cast("long").alias("missing"),
                     *[m.alias(name) for name, m in metrics.items()]))
    return {"rows": 0, "missing": 0, **{k: v for k, v in seen.get.items() if v is not None}}


def write_json_row(df: DataFrame, path: str) -> None:
    """A one-row KPI/status/metrics table as JSON (one small file)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def land_new_files(spark: SparkSession, source_dir: str, landing_path: str, log_path: str,
                   fmt: str = "csv", schema: T.StructType | str | None = None) -> DataFrame:
    """Copy the rows of source files not landed before, then stop.

    A Structured Streaming file source with ``availableNow`` lists the folder
    and remembers processed files in its checkpoint (``<log_path>/_stream``),
    so earlier files are neither re-read nor re-landed.  Every batch writes its
    own part (``epoch=<id>``) of landing and log, so one that is replayed after a
    failure replaces it.  The log has (file_name, run_id, landed_at); the files
    of this run are returned.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if schema is None:
        schema = reader.load(source_dir).schema
    stream = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        stream = stream.option("header", True)
    run_id = uuid.uuid4().hex

    def land(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumn("_file_name", F.col("_metadata.file_name")).drop("_metadata")
        part = f"{landing_path}/epoch={epoch}"
        rows.write.mode("overwrite").parquet(part)
        (spark.read.schema(rows.schema).parquet(part).select(F.col("_file_name").alias("file_name")).distinct()
         .withColumn("run_id", F.lit(run_id)).withColumn("landed_at", F.current_timestamp())
         .write.mode("overwrite").parquet(f"{log_path}/entries/epoch={epoch}"))

    q = (stream.load(source_dir).select("*", "_metadata").writeStream
         .option("checkpointLocation", f"{log_path}/_stream")
         .foreachBatch(land).trigger(availableNow=True).start())
    q.awaitTermination()
    log = read_or_empty(spark, f"{log_path}/entries", "file_name string, run_id string, landed_at timestamp")
    return log.where(F.col("run_id") == run_id)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at ``path``, or no rows where nothing was written yet;
    any other failure is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def freshness_report(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """(file_name, rows, modified_at) per input file, from ``_metadata``."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    df = reader.load(path)
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_modification_time").alias("modified_at"))


def ingest_upload(base: DataFrame, upload: DataFrame) -> DataFrame:
    """Union an uploaded table with the dashboard's: its headers, aliases and
    defaults are aligned, its derived columns (effective CGPA, efficiency,
    distraction, discipline) computed; a column of one table only is NULL in
    the other's rows, a column of two types takes the base's."""
    from strata.operators.features import dashboard_frame
    from strata.operators.schema import upload_schema
    up = dashboard_frame(upload_schema(upload))
    types = {f.name: f.dataType for f in base.schema.fields}
    up = up.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items() if c in up.columns and up.schema[c].dataType != t})
    return base.unionByName(up, allowMissingColumns=True)


def write_predictions(scored: DataFrame, test_ids: DataFrame | None, out_dir: str,
                      id_cols: Sequence[str], prefix: str = "backlog_risk") -> None:
    """Full, test-only and dashboard prediction tables."""
    p = f"{prefix}_probability"
    full = scored
    write_layer(full, f"{out_dir}/{prefix}_predictions")
    if test_ids is not None:
        test = scored.join(test_ids, list(id_cols), "left_semi").drop("recommended_intervention")
        write_layer(test, f"{out_dir}/{prefix}_test_predictions")
    dash = scored.select(*[c for c in ("student_id", "semester", "subjectid") if c in scored.columns],
                         p, "risk_label", "recommended_intervention")
    write_layer(dash, f"{out_dir}/{prefix}_dashboard_output")


def warehouse_schemas() -> dict[str, T.StructType]:
    """Star-schema table layouts (INTEGER→int, REAL→double, TEXT→string)."""
    d, s, i = T.DoubleType(), T.StringType(), T.IntegerType()

    def st(fields):
        return T.StructType([T.StructField(n, t, n not in ("student_id", "subjectid")) for n, t in fields])

    return {
        "dim_student": st([("student_id", i), ("gender", s), ("branch", s), ("department", s), ("category", s),
                           ("heightcm", d), ("weightkg", d), ("financial_status", s), ("parttime_job", s)]),
        "dim_academic_history": st([("student_id", i), ("marks_10th", d), ("marks_12th", d), ("board_10th", s),
                                    ("board_12th", s)] + [(f"gpa_{k}", d) for k in range(1, 7)]
                                   + [("cgpa", d), ("rank", d), ("normalized_rank", d)]),
        "dim_student_activity": st([("student_id", i), ("technical_projects", d), ("tech_quiz", d),
                                    ("olympiads_qualified", d), ("certification_course", s),
                                    ("ntse_scholarships", d), ("miscellany_tech_events", d), ("engg_coaching", d)]),
        "dim_behavior": st([("student_id", i), ("daily_study_time", s), ("prefer_to_study_in", s),
                            ("social_media_time", s), ("travelling_time", s), ("stress_level", s), ("hobbies", s),
                            ("like_degree", s), ("career_willingness", d), ("salary_expectation", d)]),
        "dim_subject": st([("subjectid", d), ("subjectname", s), ("theorycredit", d), ("practicalcredit", d)]),
        "fact_student_academic": st([("student_id", i), ("semester", i), ("subjectid", d),
                                     ("theoryagggradepoint", d), ("theorycredit", d),
                                     ("practicalagggradepoint", d), ("practicalcredit", d), ("sgpa", d),
                                     ("prsgpa", d), ("prcgpa", d), ("noofbacklog", d), ("thispresent", d),
                                     ("prispresent", d)]),
    }


def save_warehouse(tables: Mapping[str, DataFrame], base_path: str) -> None:
    """Cast each table to its declared layout (present columns only) and write."""
    schemas = warehouse_schemas()
    for name, df in tables.items():
        sch = schemas.get(name)
        if sch is not None:
            df = df.select(*[F.col(f.name).cast(f.dataType) for f in sch.fields if f.name in df.columns])
        write_layer(df, f"{base_path}/{name}")


# FIXED VALUES: keys of the star schema (table -> primary key; (table, column) -> referenced table).
WAREHOUSE_KEYS = {"dim_student": "student_id", "dim_academic_history": "student_id", "dim_student_activity": "student_id",
                  "dim_behavior": "student_id", "dim_subject": "subjectid"}
WAREHOUSE_REFERENCES = {("dim_academic_history", "student_id"): "dim_student", ("dim_student_activity", "student_id"): "dim_student",
                        ("dim_behavior", "student_id"): "dim_student", ("fact_student_academic", "student_id"): "dim_student",
                        ("fact_student_academic", "subjectid"): "dim_subject"}


#: Share of distinct rows from which repeats are dropped after a table is dealt by its key, not before.
MOSTLY_DISTINCT = 0.9


def mostly_distinct(df: DataFrame, key: Column) -> bool:
    """Whether nearly all rows differ, judged by the rows in one of 64 classes of
    ``key`` hashes (all repeats of a row are in one class; the other rows'
    columns are not computed).  It chooses between two orders of the same steps
    only: an early distinct of such a table moves it without making it smaller."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    n, different = df.where(F.xxhash64(key).bitwiseAND(63) == 0).agg(F.count(h), F.count_distinct(h)).first()
    return n > 0 and different >= MOSTLY_DISTINCT * n


def dealt(df: DataFrame, columns: Sequence[Column], key: Column, buckets: int, salts: int = 1, distinct: bool = False) -> DataFrame:
    """``columns`` of ``df``, a bucket of ``key`` a task (or ``salts`` of them),
    in order of ``key``: the writer's sort compares whole rows by hashed bucket
    and key, and takes rows in order as one run.

    With ``distinct`` repeated rows are dropped.  Equal rows share key and salt,
    so where they are few that takes no shuffle of its own, and one sort by key
    and row.
    """
    late = distinct and mostly_distinct(df, key)
    if distinct and not late:
        df = df.distinct()
    names = [F.col(f"`{c}`") for c in df.columns]
    deal = {"_deal_key": key}
    if salts > 1:
        deal["_deal_salt"] = F.pmod(F.xxhash64(*names), F.lit(salts))
    out = df.withColumns(deal).repartition(buckets * salts, *deal)
    if late:
        # a lag, not a row number: the optimizer puts two more steps before a limit on row numbers
        same = Window.partitionBy(*deal, *names).orderBy(F.lit(1))
        out = out.withColumn("_deal_again", F.lag(F.lit(True)).over(same)).where("_deal_again IS NULL")
    else:
        # true of every row; without it the optimizer drops this sort before the writer's
        out = out.sortWithinPartitions("_deal_key").where(F.spark_partition_id() >= 0)
    return out.select(*columns)


def save_warehouse_tables(tables: Mapping[str, DataFrame], database: str, location: str, buckets: int | None = None,
                          salts: int = 1, distinct: Collection[str] = ()) -> dict[str, DataFrame]:
    """The star schema as tables of the session's catalog, cast to their layout,
    under ``location`` (a folder all executors share).

    Each table is bucketed and sorted by its key (the fact by ``student_id``)
    into the same number of buckets, so joins and key checks on that key need no
    shuffle.  A task writes one bucket; with ``salts`` a bucket is dealt over that
    many tasks and files (for a key that holds a large share of a table).  Rows
    that repeat in a table named in ``distinct`` are written once.
    Writing replaces.  Returns the catalog's tables.
    """
    spark = next(iter(tables.values())).sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    schemas = warehouse_schemas()
    out = {}
    for name, df in tables.items():
        layout = schemas.get(name)
        columns = {c: F.col(f"`{c}`") for c in df.columns}
        if layout is not None:
            columns = {f.name: F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.fields if f.name in df.columns}
        key = WAREHOUSE_KEYS.get(name, "student_id")
        # a fresh folder a write: a reader of the old table keeps its files until the catalog points here
        path = f"{location}/{name}-{uuid.uuid4().hex[:8]}"
        if key in columns:
            rows = dealt(df, [*columns.values()], columns[key], buckets, salts, name in distinct)
            writer = rows.write.bucketBy(buckets, key).sortBy(key)
        else:
            writer = (df.distinct() if name in distinct else df).select(*columns.values()).write
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        writer.format("parquet").option("path", path).saveAsTable(f"{database}.{name}")
        out[name] = spark.table(f"{database}.{name}")
    return out


def warehouse_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, key, references, violations): key values that repeat or are NULL
    where a key is declared, and key values without a referenced row; bucketed
    tables are checked without a shuffle on the key they are bucketed by."""
    from strata.operators.marts import foreign_key_violations, primary_key_violations

    def line(df: DataFrame, table: str, key: str, references: str | None) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(table).alias("table"), F.lit(key).alias("key"), F.lit(references).cast("string").alias("references"), "violations")

    checks = [line(primary_key_violations(tables[t], [k]), t, k, None) for t, k in WAREHOUSE_KEYS.items()
              if t in tables and k in tables[t].columns]
    checks += [line(foreign_key_violations(tables[t], tables[ref], [c]), t, c, ref) for (t, c), ref in WAREHOUSE_REFERENCES.items()
               if t in tables and ref in tables and c in tables[t].columns and c in tables[ref].columns]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
