"""Profiling operators (G15–G34): audits, describe, counts, correlations,
crosstabs, segments, histograms, box plots and regression lines.

Wide statistics are one ``agg`` over all columns, unpivoted afterwards (the
one-row result, not the data).  Exact quantiles come from the distributed
quantile operator; nothing gathers a group into one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.quantiles import column_stats_row, quantile_table, quantiles, top_values
from strata.operators.schema import split_by_type


def _num(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return split_by_type(df)[0] if cols is None else [c for c in cols if c in df.columns]


def data_quality_audit(df: DataFrame, columns: Sequence[str] | None = None,
                       approx_unique: bool = False) -> DataFrame:
    """Per column: missing count, missing % (2 dp), distinct values incl. NULL, type.

    Exact distinct counts go through one (column, value) aggregation with
    map-side combining; ``approx_unique`` uses HyperLogLog sketches in the same
    single pass as the missing counts instead.
    """
    cols = list(columns or df.columns)
    n = F.count(F.lit(1))
    miss = df.agg(n.alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    missing = miss.unpivot(["_n"], cols, "column", "missing_count")
    if approx_unique:
        one = df.agg(*[(F.approx_count_distinct(F.col(f"`{c}`"))
                        + F.max(F.col(f"`{c}`").isNull().cast("int"))).alias(c) for c in cols])
        uniq = one.unpivot([], cols, "column", "n_unique")
    else:
        def key(c: str) -> Column:  # a 128-bit hash of the value stands for it: long texts are not shuffled
            v = F.col(f"`{c}`").cast("string")
            return F.when(v.isNotNull(), F.struct(F.xxhash64(v).alias("a"), F.xxhash64(F.lit(1), v).alias("b"))).alias(c)

        long = df.select(*[key(c) for c in cols]).unpivot([], [F.col(f"`{c}`") for c in cols], "column", "v")
        uniq = (long.groupBy("column", "v").agg(F.lit(1).alias("_one"))
                .groupBy("column").agg(F.count(F.lit(1)).alias("n_unique")))
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name in cols],
        "column string, dtype string")
    return (missing.join(uniq, "column", "left").join(F.broadcast(types), "column", "left")
            .select("column", F.col("missing_count").cast("long").alias("missing_count"),
                    F.round(F.try_divide(F.col("missing_count") * 100.0, F.col("_n")), 2).alias("missing_pct"),
                    F.coalesce("n_unique", F.lit(0)).cast("long").alias("n_unique"), "dtype")
            .orderBy(F.col("missing_count").desc(), "column"))


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical-row group."""
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def outlier_summary(df: DataFrame, columns: Sequence[str] | None = None, base: str = "all",
                    method: str = "exact") -> DataFrame:
    """Per column: fences, outlier count and % of all rows (``base="all"``) or
    of non-null rows (``base="non_null"``), sorted by % descending."""
    from strata.operators.clean import iqr_fences
    cols = _num(df, columns)
    fences = iqr_fences(df, cols, method=method).select("column", "lower", "upper").collect()  # one row per column
    got = {r["column"]: (r["lower"], r["upper"]) for r in fences}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        v = F.col(f"`{c}`")
        lo, hi = (F.lit(x).cast("double") for x in got.get(c, (None, None)))
        aggs.append(F.count_if((v < lo) | (v > hi)).alias(f"o_{c}"))
        aggs.append(F.count(v).alias(f"n_{c}"))
    one = df.agg(*aggs)
    counts = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"o_{c}").alias("outlier_count"),
                 F.col(f"n_{c}").alias("non_null"), F.col("_rows").alias("rows")) for c in cols])).alias("s")).select("s.*")
    denom = F.col("rows") if base == "all" else F.col("non_null")
    fence_df = df.sparkSession.createDataFrame([(c, *got.get(c, (None, None))) for c in cols],
                                               "column string, lower double, upper double")
    return (counts.join(fence_df, "column")
            .select("column", "lower", "upper", F.col("outlier_count").cast("long").alias("outlier_count"),
                    F.try_divide(F.col("outlier_count") * 100.0, denom).alias("outlier_pct"))
            .orderBy(F.col("outlier_pct").desc_nulls_last(), "column"))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 %, max per numeric column."""
    cols = _num(df, columns)
    aggs = []
    for c in cols:
        v = F.col(f"`{c}`").cast("double")
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(v).alias("count"), F.avg(v).alias("mean"),
                             F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")))
    basic = df.agg(F.array(*aggs).alias("a")).select(F.explode("a").alias("s")).select("s.*")
    q = quantile_table(df, cols, [0.25, 0.5, 0.75], ["p25", "p50", "p75"], method=method)
    return basic.join(q, "column", "left").select("column", "count", "mean", "std", "min",
                                                  "p25", "p50", "p75", "max")


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top, freq per text column (ties for top → smallest value)."""
    cols = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return top_values(df, cols)


def value_counts(df: DataFrame, column: str, by_value: bool = False, dropna: bool = True) -> DataFrame:
    src = df.where(F.col(column).isNotNull()) if dropna else df
    out = src.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.col(column).asc_nulls_last()) if by_value else \
        out.orderBy(F.col("count").desc(), F.col(column).asc_nulls_last())


def _correlations(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """(column_a, column_b, corr) for every pair of a left and a right column.

    One pass: a task sums, per pair, counts, values, squares and products over
    the rows where both are present (matrix products of an Arrow batch, values
    shifted by the column mean), so state and shuffle are tasks x pairs rows of
    sums at any width.  NaN counts as NULL; a column that is constant over a
    pair's rows (variance below 1e-13 of its square sum) gives NULL.
    """
    cols = list(dict.fromkeys([*left, *right]))
    cells = [F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)]
    narrow = df.select(*cells)
    means = narrow.agg(*[F.avg(F.when(~F.isnan(f"x{i}"), F.col(f"x{i}"))) for i in range(len(cols))]).first()
    shift = np.nan_to_num(np.array([0.0 if m is None else m for m in means]), nan=0.0, posinf=0.0, neginf=0.0)
    at, bt = [cols.index(c) for c in left], [cols.index(c) for c in right]
    sums = ["n", "sx", "sy", "sxx", "syy", "sxy"]

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sums), len(at), len(bt)))
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - shift
            there = ~np.isnan(v)
            v = np.where(there, v, 0.0)
            x, y, mx, my = v[:, at].T, v[:, bt], there[:, at].T.astype(float), there[:, bt].astype(float)
            total += np.stack([mx @ my, x @ my, mx @ y, (x * x) @ my, mx @ (y * y), x @ y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(at) * len(bt))), *[pa.array(t.ravel()) for t in total]], ["id", *sums])

    parts = narrow.mapInArrow(moments, "id long, " + ", ".join(f"{c} double" for c in sums))
    pairs = df.sparkSession.range(len(at) * len(bt)).join(
        parts.groupBy("id").agg(*[F.sum(c).alias(c) for c in sums]), "id", "left")

    def spread(s: str, ss: str) -> Column:
        var = F.col(ss) - F.try_divide(F.col(s) * F.col(s), F.col("n"))
        return F.sqrt(F.when(var > 1e-13 * F.col(ss), var).otherwise(0.0))

    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    names = [F.array(*[F.lit(c) for c in side]) for side in (left, right)]
    return pairs.select(F.get(names[0], F.floor(F.col("id") / len(bt)).cast("int")).alias("column_a"),
                        F.get(names[1], (F.col("id") % len(bt)).cast("int")).alias("column_b"),
                        F.try_divide(cov, spread("sx", "sxx") * spread("sy", "syy")).alias("corr"))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long (column_a, column_b, corr): Pearson, pairwise-complete, all ordered
    pairs incl. the diagonal; a constant column gives NULL."""
    cols = _num(df, columns)
    return _correlations(df, cols, cols)


def top_correlations(df: DataFrame, columns: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """Upper-triangle pairs ranked by |corr| (top-k report)."""
    cm = correlation_matrix(df, columns)
    order = {c: i for i, c in enumerate(_num(df, columns))}
    pos = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])
    upper = cm.where(pos[F.col("column_a")] < pos[F.col("column_b")]).where(F.col("corr").isNotNull())
    return (upper.withColumn("abs_corr", F.abs("corr"))
            .orderBy(F.col("abs_corr").desc(), "column_a", "column_b").limit(k))


def corr_to_target(df: DataFrame, target: str, columns: Sequence[str] | None = None, k: int = 4) -> DataFrame:
    cols = [c for c in _num(df, columns) if c != target]
    long = _correlations(df, cols, [target]).select(F.col("column_a").alias("feature"), "corr")
    return (long.where(F.col("corr").isNotNull()).withColumn("abs_corr", F.abs("corr"))
            .orderBy(F.col("abs_corr").desc(), "feature").limit(k))


def auto_target(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First existing candidate, else the last numeric column (plan-time)."""
    for c in candidates:
        if c in df.columns:
            return c
    num = split_by_type(df)[0]
    return num[-1] if num else None


def group_mean_median_count(df: DataFrame, by: str, value: str, method: str = "exact") -> DataFrame:
    basic = df.groupBy(by).agg(F.avg(value).alias("mean"), F.count(value).alias("count"))
    med = quantiles(df, [value], [0.5], [by], method).select(F.col(by).alias("_mk"), F.col("value").alias("median"))
    return (basic.join(med, F.col(by).eqNullSafe(F.col("_mk")), "left")
            .select(by, "mean", "median", "count"))


def ordered_group_mean(df: DataFrame, by: str, value: str, order: Sequence[str] | str = "desc") -> DataFrame:
    """Mean per group, either in a given category order (absent → NULL mean,
    as a reindex does) or sorted by the mean."""
    means = df.groupBy(by).agg(F.avg(value).alias("mean"))
    if isinstance(order, str):
        col = F.col("mean").desc_nulls_last() if order == "desc" else F.col("mean").asc_nulls_last()
        return means.orderBy(col)
    dim = df.sparkSession.createDataFrame([(str(v), i) for i, v in enumerate(order)], f"{by} string, _rank int")
    return (dim.join(means.withColumn(by, F.col(by).cast("string")), by, "left")
            .orderBy("_rank").select(by, "mean"))


def crosstab_pct(df: DataFrame, index: str, columns: str, normalize: str = "columns") -> DataFrame:
    """Long crosstab (index, columns, count, pct); pct sums to 100 within each
    column value (``normalize="columns"``) or each index value (``"index"``)."""
    counts = df.groupBy(index, columns).agg(F.count(F.lit(1)).alias("count"))
    part = columns if normalize == "columns" else index
    totals = counts.groupBy(F.col(part).alias("_ct_k")).agg(F.sum("count").alias("_ct_n"))
    return (counts.join(totals, F.col(part).eqNullSafe(F.col("_ct_k")))
            .select(index, columns, "count", (F.col("count") * 100.0 / F.col("_ct_n")).alias("pct")))


def median_split_profile(df: DataFrame, split: str, columns: Sequence[str] | None = None,
                         method: str = "exact") -> DataFrame:
    """segment = High when split ≥ median else Low (NULL → Low); means per segment."""
    from strata.operators.clean import median_values
    cols = _num(df, columns)
    med = median_values(df, [split], method).select(F.col(split)).scalar()
    seg = F.when(F.coalesce(F.col(split) >= med, F.lit(False)), "High").otherwise("Low")
    return df.withColumn("segment", seg).groupBy("segment").agg(*[F.avg(c).alias(c) for c in cols])


# FIXED VALUES: quantile segment labels, lowest first.
QCUT_LABELS = ["Low", "Mid-Low", "Mid", "Mid-High", "High"]


def quantile_segment_profile(df: DataFrame, column: str, columns: Sequence[str] | None = None,
                             q: int = 4, method: str = "exact") -> DataFrame:
    """qcut ``column`` into ≤ min(q, distinct values) bands (duplicate edges
    dropped; right-closed, lowest edge included) and average ``columns`` per band, empty bands kept.
    Fewer than two bands → empty result."""
    cols = _num(df, columns)
    q = max(1, min(q, df.where(F.col(column).isNotNull()).select(column).distinct().limit(q).count()))
    probs = [i / q for i in range(q + 1)]
    edges_long = quantiles(df, [column], probs, method=method)
    # at most q + 1 edge values: collected once, used as literals
    edges = sorted({r["value"] for r in edges_long.select("value").collect()})
    if len(edges) < 3:
        return df.sparkSession.createDataFrame(
            [], "band_rank int, segment string, " + ", ".join(f"`{c}` double" for c in cols))
    v = F.col(column)
    band = F.lit(1)
    for e_i in edges[1:]:
        band = band + (F.lit(float(e_i)) < v).cast("int")
    band = F.when(v.isNotNull() & (v >= F.lit(float(edges[0]))) & (v <= F.lit(float(edges[-1]))), band)
    rows = df.withColumn("_band", band).where(F.col("_band").isNotNull()) \
        .groupBy("_band").agg(*[F.avg(c).alias(c) for c in cols])
    labels = F.array(*[F.lit(x) for x in (QCUT_LABELS if len(edges) - 1 <= len(QCUT_LABELS)
                                           else [f"Q{i}" for i in range(1, len(edges))])])
    dim = df.sparkSession.range(1, len(edges)).select(F.col("id").cast("int").alias("_band"))
    return (dim.join(rows, "_band", "left")
            .select(F.col("_band").alias("band_rank"), F.element_at(labels, F.col("_band")).alias("segment"), *cols)
            .orderBy("band_rank"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed), all bins listed.

    The bin of a value follows numpy: a first guess from the scaled offset,
    corrected against the exact edges ``lo + i·(hi−lo)/n``.  A constant column
    uses the range (v−0.5, v+0.5).
    """
    v = F.col(column).cast("double")
    # the two range ends are collected once (one bounded row) and used as literals
    r = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    lo_v, hi_v = r["lo"], r["hi"]
    if lo_v is None:
        return df.sparkSession.range(1, bins + 1).select(
            F.col("id").cast("int").alias("bin"), F.lit(None).cast("double").alias("lower"),
            F.lit(None).cast("double").alias("upper"), F.lit(0).cast("long").alias("count"))
    if lo_v == hi_v:
        lo_v, hi_v = lo_v - 0.5, hi_v + 0.5
    lo, hi = F.lit(float(lo_v)), F.lit(float(hi_v))
    step = (hi - lo) / F.lit(float(bins))

    def edge(i: Column) -> Column:
        return F.when(i >= bins, hi).otherwise(lo + i.cast("double") * step)

    guess = F.floor((v - lo) / (hi - lo) * F.lit(float(bins))).cast("int")
    guess = F.least(F.greatest(guess, F.lit(0)), F.lit(bins - 1))
    down = F.when(v < edge(guess), guess - 1).otherwise(guess)
    up = F.when((v >= edge(down + 1)) & (down != bins - 1), down + 1).otherwise(down)
    counts = (df.where(v.isNotNull()).select((up + 1).alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    dim = counts.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"),
                                                        lo.alias("lo"), hi.alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (dim.join(counts, "bin", "left")
            .select("bin", (F.col("lo") + (F.col("bin") - 1).cast("double") * width).alias("lower"),
                    F.when(F.col("bin") == bins, F.col("hi"))
                    .otherwise(F.col("lo") + F.col("bin").cast("double") * width).alias("upper"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count"))
            .orderBy("bin"))


def distribution_markers(df: DataFrame, column: str, method: str = "exact") -> DataFrame:
    """mean and median of a column (the two reference lines of a histogram)."""
    from strata.operators.clean import median_values
    med = median_values(df, [column], method).select(F.col(column)).scalar()
    return df.agg(F.avg(column).alias("mean")).withColumn("median", med)


def boxplot_stats(df: DataFrame, value: str, by: str, order: Sequence[str] | None = None,
                  method: str = "exact") -> DataFrame:
    """Per group: q1, median, q3, whiskers (last points inside 1.5·IQR), outliers."""
    q = quantile_table(df, [value], [0.25, 0.5, 0.75], ["q1", "median", "q3"], [by], method).drop("column")
    q = q.withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    v = F.col(value).cast("double")
    rows = df.select(F.col(by).alias("_k"), v.alias("_v")).where(F.col("_v").isNotNull())
    fences = q.select(F.col(by).alias("_qk"), "_lo", "_hi")
    j = rows.join(fences, F.col("_k").eqNullSafe(F.col("_qk")))
    w = j.groupBy("_k").agg(
        F.min(F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))).alias("whisker_low"),
        F.max(F.when(F.col("_v") <= F.col("_hi"), F.col("_v"))).alias("whisker_high"),
        F.count_if((F.col("_v") < F.col("_lo")) | (F.col("_v") > F.col("_hi"))).alias("outliers"),
        F.count(F.lit(1)).alias("count"))
    out = q.join(w, F.col(by).eqNullSafe(F.col("_k"))).select(
        by, "count", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers")
    if order is not None:
        dim = df.sparkSession.createDataFrame([(str(x), i) for i, x in enumerate(order)], f"_k string, _rank int")
        out = out.join(dim, F.col(by).cast("string") == F.col("_k"), "left") \
                 .orderBy(F.col("_rank").asc_nulls_last(), by).drop("_k", "_rank")
    return out


def violin_quartiles(df: DataFrame, value: str, by: str, method: str = "exact") -> DataFrame:
    return quantile_table(df, [value], [0.25, 0.5, 0.75], ["q1", "median", "q3"], [by], method).drop("column")


def regression_line(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares slope, intercept, r² (NULL when x is constant) and n."""
    xv, yv = F.col(x).cast("double"), F.col(y).cast("double")
    ok = F.var_pop(xv) > 0
    return df.groupBy(*by).agg(
        F.when(ok, F.regr_slope(yv, xv)).alias("slope"),
        F.when(ok, F.regr_intercept(yv, xv)).alias("intercept"),
        F.when(ok, F.regr_r2(yv, xv)).alias("r2"),
        F.regr_count(yv, xv).alias("n"))


def wide_series_mean(df: DataFrame, columns: Sequence[str], label: str = "series") -> DataFrame:
    """Means of several columns as a (position, series, mean) series."""
    one = df.agg(*[F.avg(c).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias(label), F.col(c).alias("mean"))
        for i, c in enumerate(columns)])).alias("s")).select("s.*")
