"""The student medallion flow, composed from the library operators.

raw CSV → bronze (three cleaning chains) → silver (positional alignment +
imputation) → gold (projection) → features → warehouse (star schema) →
marts + KPIs + layer status.  ``run_layers`` builds every stage as a lazy
DataFrame (only column statistics and key numbering run jobs meanwhile);
``write_layers`` writes each one and reads it back for the next.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import constants as K
from strata.operators import align, clean, features, marts, schema
from strata.operators.prefix import with_file_position
from strata.session import observing_session, pinned
from strata.sources.files import read_csv_text, save_warehouse, write_json_row, write_layer, write_observed
from strata.streaming.incremental import list_files, log_run

ROW = "_row"  # file position of a raw row (monotonic within a file read)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Text CSV with NA tokens as NULL and the row's file position in ``_row``."""
    return with_file_position(read_csv_text(spark, path), ROW)


def _dedupe_keep_first(df: DataFrame) -> DataFrame:
    """Identical rows collapse to the first occurrence (min position)."""
    cols = [c for c in df.columns if c != ROW]
    return df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.min(ROW).alias(ROW))


def _infer_numeric(df: DataFrame, columns) -> DataFrame:
    """Columns whose every non-null text parses as a number become double
    (what a type-inferring reader does); one aggregate decides all columns."""
    from strata.functions.expressions import to_number
    cols = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    if not cols:
        return df
    checks = df.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & to_number(c).isNull()).alias(c) for c in cols]).first()
    numeric = [c for c in cols if checks[c] == 0]
    return clean.coerce_numeric(df, numeric)


def clean_research(raw: DataFrame) -> DataFrame:
    df = _rename_keep_row(raw, schema.bracket_name)
    df = _infer_numeric(df, [c for c in df.columns if c != ROW])
    df = pinned(_dedupe_keep_first(df))  # on typed values: 1 and 1.0 are equal
    df = clean.coerce_numeric(df, K.RESEARCH_NUMERIC)
    num = [c for c in schema.split_by_type(df)[0] if c != ROW]
    df = clean.impute_median(df, num)
    df = clean.impute_mode(df, None, fallback="Unknown")
    df = clean.map_values(df, "board_10th", K.BOARD_10TH_MAPPING)
    df = clean.map_values(df, "board_12th", K.BOARD_12TH_MAPPING)
    num = [c for c in schema.split_by_type(df)[0] if c != ROW]
    df = clean.cap_outliers_iqr(df, num)
    return schema.select_existing(df, K.BRONZE_RESEARCH_COLUMNS + [ROW])


def clean_attitude(raw: DataFrame) -> DataFrame:
    df = _rename_keep_row(raw, schema.alnum_name)
    df = schema.rename_columns(df, K.ATTITUDE_RENAMES)
    df = _infer_numeric(df, [c for c in df.columns if c != ROW])
    df = pinned(_dedupe_keep_first(df))  # on typed values: 1 and 1.0 are equal
    df = clean.coerce_numeric(df, K.ATTITUDE_NUMERIC)
    df = clean.percent_to_number(df, ["career_willingness"])
    num = [c for c in schema.split_by_type(df)[0] if c != ROW]
    df = clean.impute_median(df, num)
    df = clean.impute_mode(df, None, fallback="unknown")
    df = clean.normalize_text(df)
    df = clean.yes_no_normalize(df, K.YES_NO_COLUMNS)
    df = clean.bucket_time_range(df, K.TIME_RANGE_COLUMNS)
    df = clean.cap_outliers_iqr(df, K.ATTITUDE_OUTLIER_COLUMNS)
    return schema.select_existing(df, K.BRONZE_ATTITUDE_COLUMNS + [ROW])


def clean_performance(raw: DataFrame) -> DataFrame:
    df = _rename_keep_row(raw, schema.alnum_name)
    df = _infer_numeric(df, [c for c in df.columns if c != ROW])
    df = pinned(_dedupe_keep_first(df))  # on typed values: 1 and 1.0 are equal
    df = clean.coerce_numeric(df, K.PERFORMANCE_NUMERIC)
    num = [c for c in schema.split_by_type(df)[0] if c != ROW]
    df = clean.impute_median(df, num)
    df = clean.impute_mode(df, None, fallback="unknown")
    df = clean.round_half_even_int(df, "semester", 0)
    return schema.select_existing(df, K.BRONZE_PERFORMANCE_COLUMNS + [ROW])


def _rename_keep_row(df: DataFrame, fn) -> DataFrame:
    return df.toDF(*[c if c == ROW else fn(c) for c in df.columns])


def silver(research: DataFrame, attitude: DataFrame, performance: DataFrame | None = None) -> DataFrame:
    """Positional alignment (first source wins on names) + imputation."""
    frames, orders, names = [research, attitude], [[ROW], [ROW]], ["research", "attitude"]
    if performance is not None:
        frames.append(schema.drop_columns(performance, ["student_id"]))
        orders.append([ROW])
        names.append("performance")
    frames = [f.withColumnRenamed(ROW, f"_row_{n}") for f, n in zip(frames, names)]
    orders = [[f"_row_{n}"] for n in names]
    merged = align.positional_align(frames, orders, names, unique=True)
    merged = pinned(merged.drop(*[f"_row_{n}" for n in names]))  # the statistics below read it several times
    num = [c for c in schema.split_by_type(merged)[0]
           if c != "student_id" and not c.endswith("_record_available")]
    merged = clean.impute_median(merged, num)
    merged = clean.impute_mode(merged, None, fallback="Unknown")
    return merged.withColumn("student_id", F.col("student_id").cast("long"))


def run_layers(spark: SparkSession, research_path: str | None, attitude_path: str,
               performance_path: str | None = None,
               keep: Callable[[str, str, DataFrame], DataFrame] = lambda layer, name, df: df) -> dict[str, DataFrame]:
    """Build every layer; returns name → DataFrame.  ``keep(layer, name, df)``
    may store a table: the next layer is built from what it returns."""
    def bronze(name, chain, path):
        return keep("bronze", name, chain(keep("raw", name, read_raw_csv(spark, path)))) if path else None

    att = bronze("attitude", clean_attitude, attitude_path)
    res = bronze("research", clean_research, research_path)
    perf = bronze("performance", clean_performance, performance_path)
    if res is None:
        res = att.select(ROW).where(F.lit(False))
    sil = keep("silver", "silver", silver(res, att, perf))
    gold = keep("gold", "gold", schema.gold_projection(sil))
    feats = keep("gold", "features", features.fill_bmi(features.add_ml_features(gold)))
    out = {"bronze_research": res.drop(ROW), "bronze_attitude": att.drop(ROW), "silver": sil, "gold": gold,
           "features": feats}
    if perf is not None:
        out["bronze_performance"] = perf.drop(ROW)
    mart = {"student_overview": schema.student_overview(feats),
            "career_summary": marts.career_summary(feats) if "career_path" in feats.columns else None,
            "semester_summary": marts.semester_summary(feats) if "semester" in feats.columns else None,
            "branch_summary": marts.branch_summary(feats) if "branch" in feats.columns else None,
            "risk_summary": marts.risk_band_summary(feats),
            "dashboard_kpis": marts.dashboard_kpis(feats)}
    out |= {name: keep("marts", name, table) for name, table in mart.items() if table is not None}
    out |= {name: keep("warehouse", name, table) for name, table in marts.star_schema(gold).items()}
    return out


SOURCES = ["research", "attitude", "performance"]
LAYER_COUNTS = "array<struct<layer string, table string, rows long, columns int, missing long>>"


def layer_status(spark: SparkSession, sources: Mapping[str, str], counts: Sequence[tuple],
                 coverage: Mapping[str, int]) -> DataFrame:
    """The run's record, one row: status, time, (source, file, modified_at) of
    the raw files, (layer, table, rows, columns, missing cells) of every table as
    the jobs that wrote them counted, and how many rows of silver each source
    covers.  The lists grow with the number of files and tables only."""
    files = None
    for name, path in sources.items():
        one = list_files(spark, path).where(~F.col("file_name").startswith("_")).select(F.lit(name).alias("source"), "*")
        files = one if files is None else files.unionByName(one)
    names = [f"{n}_record_available" for n in SOURCES]
    one = spark.createDataFrame([(sorted(counts), tuple(int(coverage.get(n, 0)) for n in names))],
                                f"layers {LAYER_COUNTS}, source_coverage struct<{', '.join(f'{n} long' for n in names)}>")
    return one.select(
        F.lit("success").alias("pipeline_status"), F.current_timestamp().alias("last_run_at"),
        files.agg(F.sort_array(F.collect_list(F.struct("source", "file_name", "modified_at"))).alias("f")).scalar()
        .alias("raw_files"), "layers", "source_coverage")


def write_layers(spark: SparkSession, out_dir: str, attitude_path: str, research_path: str | None = None,
                 performance_path: str | None = None) -> DataFrame:
    """Run the flow into ``out_dir``: every table is written under
    ``<layer>/<name>`` (raw: ``landed/<name>``) and the next layer reads it from there (raw and bronze
    tables keep ``_row``, the order they are aligned by).  Rows and missing cells
    are counted by the jobs that write.  KPIs and the run's record are JSON rows
    as well, and the raw files go to ``run_log``, which ``stale_check`` reads.
    Writing replaces, so a run that failed half-way is run again.  Returns the
    record."""
    sources = {n: p for n, p in (("attitude", attitude_path), ("research", research_path),
                                 ("performance", performance_path)) if p}
    caller, spark = spark, observing_session(spark)
    counts, coverage = [], {}

    def keep(layer: str, name: str, df: DataFrame) -> DataFrame:
        folder = "landed" if layer == "raw" else layer  # ``raw`` may be where the sources lie
        flags = {f"{n}_record_available": F.sum(f"{n}_record_available") for n in SOURCES
                 if layer == "silver" and f"{n}_record_available" in df.columns}
        if layer == "warehouse":
            seen = write_observed(df, lambda t: save_warehouse({name: t}, f"{out_dir}/warehouse"))
        else:
            seen = write_observed(df, lambda t: write_layer(t, f"{out_dir}/{folder}/{name}"), **flags)
        coverage.update({k: seen.get(k, 0) for k in flags})
        table = spark.read.parquet(f"{out_dir}/{folder}/{name}")
        counts.append((layer, name, seen["rows"], len([c for c in table.columns if layer != "raw" or c != ROW]), seen["missing"]))
        return table

    built = run_layers(spark, research_path, attitude_path, performance_path, keep)
    write_json_row(built["dashboard_kpis"], f"{out_dir}/status/dashboard_kpis")
    status = layer_status(spark, sources, counts, coverage)
    write_json_row(status, f"{out_dir}/status/etl_status")
    for path in sources.values():
        log_run(spark, path, f"{out_dir}/run_log")
    return caller.read.schema(status.schema).json(f"{out_dir}/status/etl_status")
