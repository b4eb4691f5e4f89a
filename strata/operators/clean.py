"""Cleaning operators (C1–C13, C17): dedupe, coercion, imputation, fences.

Statistics (median, mode, quartile fences) are distributed aggregates
(``strata.operators.quantiles``).  Their result — one value per column, so
bounded by the column count — is collected once and applied as literals: no
cross join, and the rewritten frame keeps a flat plan however many cleaning
steps follow.  ``stats_scalar`` offers the lazy scalar-subquery form for
single-reference report use.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import expressions as X
from strata.operators.quantiles import column_stats_row, medians, modes, quantile_table
from strata.operators.schema import split_by_type


def _existing(df: DataFrame, cols: Sequence[str] | None, numeric: bool | None = None) -> list[str]:
    if cols is None:
        num, other = split_by_type(df)
        if numeric is True:
            return num
        if numeric is False:
            return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        return list(df.columns)
    return [c for c in cols if c in df.columns]


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (hash aggregate; hot duplicates collapse map-side)."""
    return df.dropDuplicates()


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cols = _existing(df, columns)
    return df.withColumns({c: X.to_number(c, df) for c in cols}) if cols else df


def percent_to_number(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cols = _existing(df, columns)
    return df.withColumns({c: X.percent_to_number(c) for c in cols}) if cols else df


def nan_to_null(df: DataFrame) -> DataFrame:
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols}) if cols else df


def stats_scalar(stats_row: DataFrame, columns: Sequence[str]) -> Column:
    """One-row stats table → a struct-valued scalar subquery column (lazy;
    for terminal reports, where the plan is not built upon further)."""
    return stats_row.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("s")).scalar()


def stats_literals(stats_row: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """One-row stats table → one literal per column.

    Used by chain operators: the statistics job runs once here, and the
    rewritten frame carries literals instead of a subquery holding the whole
    upstream plan, so plans stay flat however many cleaning steps follow.
    The row is bounded by the number of columns.
    """
    row = stats_row.first()
    out = {}
    for c in columns:
        v = None if row is None else row[c]
        out[c] = F.lit(v) if v is not None else F.lit(None).cast(stats_row.schema[c].dataType)
    return out


def median_values(df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    cols = _existing(df, columns, numeric=True)
    return column_stats_row(medians(df, cols, method=method), cols)


def impute_median(df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """NULL → column median (numeric columns; integral ones become double)."""
    cols = _existing(df, columns, numeric=True)
    if not cols:
        return df
    s = stats_literals(median_values(df, cols, method), cols)
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), s[c].cast("double")) for c in cols})


def mode_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cols = _existing(df, columns, numeric=False)
    return column_stats_row(modes(df, cols), cols)


def impute_mode(df: DataFrame, columns: Sequence[str] | None = None, fallback: str = "Unknown") -> DataFrame:
    """NULL → most frequent value (ties → smallest); no value at all → fallback."""
    cols = _existing(df, columns, numeric=False)
    if not cols:
        return df
    s = stats_literals(mode_values(df, cols), cols)
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("string"), s[c].cast("string"), F.lit(fallback))
                           for c in cols})


def impute_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    cols = {c: F.coalesce(F.col(f"`{c}`"), F.lit(v)) for c, v in values.items() if c in df.columns}
    return df.withColumns(cols) if cols else df


def iqr_fences(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
               method: str = "exact", k: float = 1.5) -> DataFrame:
    """(by..., column, q1, q3, iqr, lower, upper) with exact linear quartiles."""
    cols = _existing(df, columns)
    q = quantile_table(df, cols, [0.25, 0.75], ["q1", "q3"], by, method)
    iqr = F.col("q3") - F.col("q1")
    return (q.withColumn("iqr", iqr)
            .withColumn("lower", F.col("q1") - F.lit(k) * F.col("iqr"))
            .withColumn("upper", F.col("q3") + F.lit(k) * F.col("iqr")))


def _cap(c: Column, lo: Column, hi: Column) -> Column:
    c = F.when(c < lo, lo).otherwise(c)
    return F.when(c > hi, hi).otherwise(c)


def cap_outliers_iqr(df: DataFrame, columns: Sequence[str], method: str = "exact",
                     skip_zero_iqr: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Clip each column to its [q1 − 1.5·IQR, q3 + 1.5·IQR] fences (NULL stays NULL).

    With ``by`` the fences are per group and are joined back on the group keys
    (AQE broadcasts the fence table when its measured size allows).
    """
    cols = _existing(df, columns)
    if not cols:
        return df
    fences = iqr_fences(df, cols, by, method)
    if not by:
        # one row per column (bounded by the column count), one job
        got = {r["column"]: (r["lower"], r["upper"]) for r in fences.select("column", "lower", "upper").collect()}
        out = {}
        for c in cols:
            lo_v, hi_v = got.get(c, (None, None))
            lo_c, hi_c = F.lit(lo_v).cast("double"), F.lit(hi_v).cast("double")
            capped = _cap(F.col(f"`{c}`").cast("double"), lo_c, hi_c)
            if skip_zero_iqr:
                capped = F.when(lo_c == hi_c, F.col(f"`{c}`").cast("double")).otherwise(capped)
            out[c] = capped
        return df.withColumns(out)
    aggs = []
    for c in cols:
        aggs += [F.max(F.when(F.col("column") == c, F.col("lower"))).alias(f"_lo_{c}"),
                 F.max(F.when(F.col("column") == c, F.col("upper"))).alias(f"_hi_{c}")]
    wide = fences.groupBy(*by).agg(*aggs).select(*[F.col(b).alias(f"_by_{b}") for b in by],
                                                 *[F.col(a) for c in cols for a in (f"_lo_{c}", f"_hi_{c}")])
    cond = None
    for b in by:
        t = F.col(b).eqNullSafe(F.col(f"_by_{b}"))
        cond = t if cond is None else cond & t
    joined = df.join(wide, cond, "left").drop(*[f"_by_{b}" for b in by])
    out = {}
    for c in cols:
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        capped = _cap(F.col(f"`{c}`").cast("double"), lo, hi)
        if skip_zero_iqr:
            capped = F.when(lo == hi, F.col(f"`{c}`").cast("double")).otherwise(capped)
        out[c] = capped
    return joined.withColumns(out).drop(*[a for c in cols for a in (f"_lo_{c}", f"_hi_{c}")])


def normalize_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cols = _existing(df, columns, numeric=False)
    return df.withColumns({c: X.clean_text(c) for c in cols}) if cols else df


def yes_no_normalize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cols = _existing(df, columns)
    return df.withColumns({c: X.yes_no(c) for c in cols}) if cols else df


def bucket_time_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cols = _existing(df, columns)
    return df.withColumns({c: X.bucket_time_range(c) for c in cols}) if cols else df


def map_values(df: DataFrame, column: str, mapping: Mapping[str, str], method: str = "case") -> DataFrame:
    """Exact-spelling replace, unmapped values pass through.

    ``case`` compiles the mapping into the projection (best for a few hundred
    entries); ``join`` uses a broadcast left join against a mapping table whose
    size is the mapping's, known on the driver.
    """
    if column not in df.columns:
        return df
    if method == "case":
        return df.withColumn(column, X.map_values(column, mapping))
    spark = df.sparkSession
    table = spark.createDataFrame(list(mapping.items()), "_mv_key string, _mv_val string")
    joined = df.join(F.broadcast(table), F.col(column) == F.col("_mv_key"), "left")
    return joined.withColumn(column, F.coalesce("_mv_val", column)).drop("_mv_key", "_mv_val")


def round_half_even_int(df: DataFrame, column: str, fill: float = 0) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, X.round_half_even_int(column, fill))


def clip_range(df: DataFrame, column: str, lo=None, hi=None) -> DataFrame:
    return df.withColumn(column, X.clip(column, lo, hi))


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """String cells whose trimmed text is one of ``tokens`` become NULL."""
    cols = _existing(df, columns, numeric=False)
    toks = list(tokens)
    return df.withColumns({c: F.when(~F.coalesce(F.col(f"`{c}`").isin(toks), F.lit(False)), F.col(f"`{c}`"))
                           for c in cols}) if cols else df
