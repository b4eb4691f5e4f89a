"""Exact and approximate quantiles, medians and modes.

Exact quantiles use linear interpolation between order statistics (the
default of pandas, numpy and DuckDB ``quantile_cont``).  Without groups:

1. one sketch pass over all columns (``percentile_approx``, bounded state)
   brackets the values at the wanted ranks with a margin above its rank error;
2. one counting pass over all columns: cells outside the brackets are counted
   per gap between them, only cells inside keep their value, so the map-side
   combine leaves a few thousandths of the cells to shuffle;
3. a distributed running count over those (``running_total``) and a filter
   for the values that straddle the wanted ranks.

If a rank should lie outside its bracket, every value is counted instead.

With groups the brackets are a table (``bracket_table``): a mergeable sketch
per salted slice of a group, merged per group, read at the wanted ranks.  The
brackets of the largest groups (``BRACKETS`` in all, so the table that is
broadcast is bounded) reduce their cells before any shuffle to one count a gap
and task; all other groups have few cells each and count every value.  A group
whose rank lies outside its bracket is counted again in full.

No step holds a whole group in one task.  ``method="approx"`` switches to
``percentile_approx`` (a bounded sketch per group) when speed matters more than
exact interpolation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.prefix import running_total
from strata.session import checkpoint, if_small


def _long_form(df: DataFrame, columns: Sequence[str], by: Sequence[str],
               value_type: str = "double") -> DataFrame:
    """(by..., _col, _v) with one row per non-null cell of ``columns``."""
    cols = list(columns)
    cast = [F.col(c).cast(value_type).alias(c) for c in cols]
    wide = df.select(*[F.col(b) for b in by], *cast)
    long = wide.unpivot(list(by), cols, "_col", "_v") if by else wide.unpivot([], cols, "_col", "_v")
    cond = F.col("_v").isNotNull()
    if value_type == "double":
        cond = cond & ~F.isnan("_v")
    return long.where(cond)


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              by: Sequence[str] = (), method: str = "exact",
              accuracy: int = 10000) -> DataFrame:
    """Long table ``(by..., column, p, value)`` of quantiles of each column.

    Segments (a ``by`` group × column) with no non-null value produce no row.
    """
    by = list(by)
    long = _long_form(df, columns, by)
    if method == "approx":
        arr = F.array(*[F.lit(float(p)) for p in probs])
        res = (long.groupBy(*by, "_col")
               .agg(F.percentile_approx("_v", arr, accuracy).alias("_q"))
               .select(*by, "_col", F.posexplode("_q").alias("_i", "value")))
        lookup = F.array(*[F.lit(float(p)) for p in probs])
        return res.select(*by, F.col("_col").alias("column"),
                          F.element_at(lookup, F.col("_i") + 1).alias("p"), "value")
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")

    if not by:
        rows = _bracketed(df, list(columns), probs)
        if rows is not None:
            return df.sparkSession.createDataFrame(rows, "column string, p double, value double")
        counts = long.groupBy("_col", "_v").agg(F.count(F.lit(1)).alias("_c"))
        picked = _at_ranks(counts, probs, by)
    else:
        picked = _grouped(df, list(columns), probs, by)
    value = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")
    return picked.select(*by, F.col("_col").alias("column"), F.col("_p").alias("p"),
                         F.when(F.col("_frac") == 0, F.col("_vlo")).otherwise(value).alias("value"))


def _at_ranks(counts: DataFrame, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(by..., _col, _p, _vlo, _vhi, _frac) from value counts (by..., _col,
    _v, _c).  Counts of values between brackets have a ``_gap``: they are
    ordered by (_gap, _v) and a rank that falls on one gives ``_missed``."""
    gaps = "_gap" in counts.columns
    cum = running_total(counts, ["_gap", "_v"] if gaps else ["_v"], "_c", [*by, "_col"], output="_cum", total="_n")
    first = F.col("_cum") - F.col("_c")

    def straddles(rank):
        return (first <= rank) & (rank < F.col("_cum"))

    # keep only distinct values that hold a wanted rank for some probability
    # (≤ 2 per probability and segment) before fanning out over probabilities
    relevant = None
    for p in probs:
        h = (F.col("_n") - 1) * F.lit(float(p))
        t = straddles(F.floor(h)) | straddles(F.ceil(h))
        relevant = t if relevant is None else (relevant | t)
    arr = F.array(*[F.lit(float(p)) for p in probs])
    ranked = (cum.where(relevant).withColumn("_p", F.explode(arr))
              .withColumn("_h", (F.col("_n") - 1) * F.col("_p"))
              .withColumn("_lo", F.floor("_h"))
              .withColumn("_hi", F.ceil("_h")))
    has_lo = straddles(F.col("_lo"))
    has_hi = straddles(F.col("_hi"))
    return (ranked.where(has_lo | has_hi)
            .groupBy(*by, "_col", "_p")
            .agg(F.max(F.when(has_lo, F.col("_v"))).alias("_vlo"),
                 F.max(F.when(has_hi, F.col("_v"))).alias("_vhi"),
                 F.max(F.col("_h") - F.col("_lo")).alias("_frac"),
                 *([F.bool_or(F.col("_gap") % 2 == 0).alias("_missed")] if gaps else [])))


#: Size of a group's sketch (its rank error is about ERROR), a bracket's half
#: width in such errors, salts of a group, brackets that are broadcast at most.
KLL_K, ERROR, WIDTH, SALTS, BRACKETS = 4_000, 0.001, 2.5, 32, 200_000


def sketch_state(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = KLL_K) -> DataFrame:
    """(by..., n0, s0, n1, s1, ...): count and KLL sketch of each column.

    Rows are salted, so a dominant group's sketches are merged by many tasks
    first; the salt is the task's, no row moves before it is in a sketch.
    """
    cells = [_cell(c).alias(f"_c{i}") for i, c in enumerate(columns)]
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt")
    parts = df.select(*by, salt, *cells).groupBy(*by, "_salt").agg(*[x for i in range(len(columns)) for x in (
        F.count(f"_c{i}").alias(f"n{i}"), F.kll_sketch_agg_double(f"_c{i}", k).alias(f"s{i}"))])
    return merge_sketch_states(parts, len(columns), by, k)


def merge_sketch_states(parts: DataFrame, columns: int, by: Sequence[str] = (), k: int = KLL_K) -> DataFrame:
    return parts.groupBy(*by).agg(*[x for i in range(columns) for x in (
        F.sum(f"n{i}").alias(f"n{i}"), F.kll_merge_agg_double(f"s{i}", k).alias(f"s{i}"))])


def bracket_table(state: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., b0, b1, ...): per column the brackets [lo, hi] around the wanted
    ranks, one per probability in ascending order (they may overlap); null for
    a column of fewer than SKETCH values."""
    ends = [e for p in sorted(map(float, probs)) for e in (max(0.0, p - WIDTH * ERROR), min(1.0, p + WIDTH * ERROR))]
    ranks = F.array(*map(F.lit, ends))

    def brackets(i: int) -> Column:
        at = F.when(F.col(f"n{i}") >= SKETCH, F.kll_sketch_get_quantile_double(f"s{i}", ranks))
        pairs = F.array(*[F.struct(F.element_at(at, 2 * j + 1).alias("lo"), F.element_at(at, 2 * j + 2).alias("hi"))
                          for j in range(len(ends) // 2)])
        return F.when(at.isNotNull(), pairs)

    return state.select(*by, *[brackets(i).alias(f"b{i}") for i in range(len(columns))])


def placed_counts(df: DataFrame, brackets: DataFrame, columns: Sequence[str], n_brackets: int,
                  by: Sequence[str] = ()) -> DataFrame:
    """(by..., _col, _gap, _v, _c): cells inside a bracket by value under the odd
    number of their bracket, all others as one count per even gap number; groups
    without brackets by value.

    The brackets are broadcast: at most BRACKETS pairs of doubles and a hash of
    the group's key.  Any bracket is sound, so groups whose hashes collide may
    share one: a rank outside it is noticed.
    """
    cells = df.select(*by, *[_cell(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    if by:
        small = brackets.select(F.xxhash64(*by).alias("_key"), *[f"b{i}" for i in range(len(columns))]).dropDuplicates(["_key"])
        cells = cells.withColumn("_key", F.xxhash64(*by)).join(F.broadcast(small), "_key", "left")
        at = [[(F.col(f"b{i}")[j]["lo"], F.col(f"b{i}")[j]["hi"]) for j in range(n_brackets)] for i in range(len(columns))]
    else:  # one row of brackets, as literals
        row = brackets.first()
        at = [[(F.lit(x["lo"]), F.lit(x["hi"])) for x in (row[f"b{i}"] if row and row[f"b{i}"] else [])] for i in range(len(columns))]
        cells = cells.withColumns({f"b{i}": F.lit(True if at[i] else None) for i in range(len(columns))})

    def place(i: int) -> Column:
        v = F.col(f"_c{i}")
        gap, inside = F.when(F.col(f"b{i}").isNull(), F.lit(1)), F.when(F.col(f"b{i}").isNull(), v)
        for j, (lo, hi) in enumerate(at[i]):
            gap = gap.when(v < lo, F.lit(2 * j)).when(v <= hi, F.lit(2 * j + 1))
            inside = inside.when(v < lo, None).when(v <= hi, v)
        return F.struct(F.lit(columns[i]).alias("_col"), gap.otherwise(2 * n_brackets).alias("_gap"),
                        inside.alias("_v"), v.isNotNull().alias("_has"))

    long = cells.select(*by, F.explode(F.array(*map(place, range(len(columns))))).alias("_x")).select(*by, "_x.*").where("_has")
    return long.groupBy(*by, "_col", "_gap", "_v").agg(F.count(F.lit(1)).alias("_c"))


def _grouped(df: DataFrame, columns: list[str], probs: Sequence[float], by: list[str]) -> DataFrame:
    """``_at_ranks`` of every group and column, from cells inside brackets."""
    state = sketch_state(df, columns, by)
    size = F.greatest(*[F.col(f"n{i}") for i in range(len(columns))]) if len(columns) > 1 else F.col("n0")
    # the largest groups get brackets; the sketches themselves are not kept
    found = bracket_table(state.where(size >= SKETCH).withColumn("_size", size), columns, probs, [*by, "_size"])
    large = checkpoint(found.orderBy(F.desc("_size"), F.xxhash64(*by)).limit(BRACKETS // (len(columns) * len(list(probs)))))
    picked = checkpoint(_at_ranks(placed_counts(df, large, columns, len(list(probs)), by), probs, by))
    missed = picked.where("_missed").select(*[F.col(b).alias(f"_m_{b}") for b in by], F.col("_col").alias("_m_col")).distinct()
    if missed.isEmpty():
        return picked
    same = [F.col(b).eqNullSafe(F.col(f"_m_{b}")) for b in by] + [F.col("_col") == F.col("_m_col")]
    again = _long_form(df, columns, by).join(missed, same, "left_semi")
    full = _at_ranks(again.groupBy(*by, "_col", "_v").agg(F.count(F.lit(1)).alias("_c")), probs, by)
    return picked.join(missed, same, "left_anti").drop("_missed").unionByName(full)


#: Values a sketch resolves (its rank error is one of them), and a bracket's half width in such errors.
SKETCH, MARGIN = 2_000, 4


def _cell(column: str) -> Column:
    v = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(v), v)


def _bracketed(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> list[tuple] | None:
    """(column, p, value) rows from the values inside brackets around the
    wanted ranks; None if a rank lies outside its bracket.

    A value in a gap between brackets is counted as the double that follows
    the bracket below it.  Columns of fewer than SKETCH values have no gap.
    """
    ends = {p: (max(0.0, p - MARGIN / SKETCH), min(1.0, p + MARGIN / SKETCH)) for p in map(float, probs)}
    wanted = sorted({e for pair in ends.values() for e in pair})
    row = df.agg(*[x for i, c in enumerate(columns) for x in (
        F.count(_cell(c)).alias(f"n{i}"), F.percentile_approx(_cell(c), wanted, SKETCH).alias(f"q{i}"))]).first()
    cells, gaps = [], {}
    for i, c in enumerate(columns):
        ranges: list[list[float]] = []
        if row[f"n{i}"] >= SKETCH:
            at = dict(zip(wanted, row[f"q{i}"]))
            for lo, hi in sorted((at[lo], at[hi]) for lo, hi in ends.values()):
                if ranges and lo <= ranges[-1][1]:
                    ranges[-1][1] = max(hi, ranges[-1][1])
                else:
                    ranges.append([lo, hi])
        v = F.col(f"`{c}`").cast("double")
        gaps[c] = [-math.inf, *[math.nextafter(hi, math.inf) for _, hi in ranges]] if ranges else []
        place = F.when(F.isnan(v), None)
        for (lo, hi), gap in zip(ranges, gaps[c]):
            place = place.when(v < lo, gap).when(v <= hi, v)
        cells.append((place.otherwise(gaps[c][-1] if ranges else v) if ranges else v).alias(c))
    nulls = [F.when(F.col(f"`{c}`").isNotNull(), cell).alias(c) for c, cell in zip(columns, cells)]
    long = _long_form(df.select(*nulls), columns, [])
    counts = long.groupBy("_col", "_v").agg(F.count(F.lit(1)).alias("_c"))
    out = []
    for r in _at_ranks(counts, probs, []).collect():  # one row per column and probability
        if r["_vlo"] in gaps[r["_col"]] or r["_vhi"] in gaps[r["_col"]]:
            return None
        out.append((r["_col"], r["_p"], r["_vlo"] if r["_frac"] == 0 else
                    r["_vlo"] + (r["_vhi"] - r["_vlo"]) * r["_frac"]))
    return out


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                   names: Sequence[str], by: Sequence[str] = (), method: str = "exact") -> DataFrame:
    """Wide table ``(by..., column, <name per prob>)``."""
    q = quantiles(df, columns, probs, by, method)
    aggs = [F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(n) for p, n in zip(probs, names)]
    return q.groupBy(*by, "column").agg(*aggs)


def column_stats_row(long_stats: DataFrame, columns: Sequence[str], value: str = "value",
                     key: str = "column") -> DataFrame:
    """Turn a long (column, value) table into a single row with one field per column."""
    aggs = [F.max(F.when(F.col(key) == c, F.col(value))).alias(c) for c in columns]
    return long_stats.agg(*aggs) if aggs else long_stats.limit(0)


def medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
            method: str = "exact") -> DataFrame:
    """Long ``(by..., column, value)`` medians."""
    return quantiles(df, columns, [0.5], by, method).drop("p")


#: Characters of a value that travel with its hash to settle ties.
PREFIX = 16


def top_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, count, unique, top, freq) of the non-null values as text;
    ties for the top go to the smallest.

    Values are counted by a 128-bit hash and their first PREFIX characters, so
    the shuffle does not follow the length of texts.  What is left after the
    highest count and the smallest prefix (one value, unless tied values share
    their prefix) is looked up in the rows, and the smallest text kept.
    """
    by = list(by)

    def cell(c: str) -> Column:
        v = F.col(f"`{c}`").cast("string")
        return F.struct(F.lit(c).alias("column"), F.xxhash64(v).alias("_a"), F.xxhash64(F.lit(1), v).alias("_b"), v.alias("_text"))

    cells = df.select(*by, F.explode(F.array(*map(cell, columns))).alias("_x")).select(*by, "_x.*").where("_text is not null")
    per = checkpoint(cells.groupBy(*by, "column", "_a", "_b", F.substring("_text", 1, PREFIX).alias("_pre"))
                     .agg(F.count(F.lit(1)).alias("_c")))
    best = checkpoint(per.groupBy(*by, "column").agg(
        F.sum("_c").alias("count"), F.count(F.lit(1)).alias("unique"), F.max("_c").alias("freq"),
        F.min(F.struct((-F.col("_c")).alias("n"), F.col("_pre").alias("p"))).getField("p").alias("_first")))

    def same(right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[Column]]:
        named = right.select(*[F.col(k).alias(f"_k_{k}") if k in keys else F.col(k) for k in right.columns])
        return named, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]

    named, cond = same(if_small(best.select(*by, "column", "freq", "_first")), [*by, "column"])
    left = checkpoint(per.join(named, cond).where((F.col("_c") == F.col("freq")) & (F.col("_pre") == F.col("_first")))
                      .select(*by, "column", "_a", "_b"))
    named, cond = same(if_small(left), [*by, "column", "_a", "_b"])
    texts = cells.join(named, cond, "left_semi").groupBy(*by, "column").agg(F.min("_text").alias("top"))
    named, cond = same(texts, [*by, "column"])
    return best.join(named, cond).select(*by, "column", "count", "unique", "top", "freq")


def modes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Most frequent non-null value per column (ties → smallest), as text."""
    if not list(columns):
        return _long_form(df, [df.columns[0]], by, "string").limit(0).select(*by, F.col("_col").alias("column"), F.col("_v").alias("value"))
    return top_values(df, columns, by).select(*by, "column", F.col("top").alias("value"))
