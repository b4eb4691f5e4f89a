"""Schema operators (P1–P15): header normalisation, projections, aliases.

All of these only inspect ``df.columns`` / ``df.schema`` on the driver (no
job) and return a projection, which Catalyst prunes down to the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import constants as K


def bracket_name(name: str) -> str:
    """lower; space→_; [→_; ] dropped; (→_; ) dropped; .→_; one pass __→_; strip _."""
    s = str(name).lower().replace(" ", "_").replace("[", "_").replace("]", "")
    s = s.replace("(", "_").replace(")", "").replace(".", "_").replace("__", "_")
    return s.strip("_")


def alnum_name(name: str) -> str:
    """lower; space→_; drop everything outside [a-z0-9_]."""
    return re.sub(r"[^a-z0-9_]", "", str(name).lower().replace(" ", "_"))


def trim_name(name: str) -> str:
    return str(name).strip().lower().replace(" ", "_")


def _rename_all(df: DataFrame, fn) -> DataFrame:
    return df.toDF(*[fn(c) for c in df.columns])


def normalize_headers_bracket(df: DataFrame) -> DataFrame:
    return _rename_all(df, bracket_name)


def normalize_headers_alnum(df: DataFrame) -> DataFrame:
    return _rename_all(df, alnum_name)


def normalize_headers_trim(df: DataFrame) -> DataFrame:
    return _rename_all(df, trim_name)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in columns if c in have])


def resolve_aliases(df: DataFrame, groups: Mapping[str, Sequence[str]] = K.ALIAS_GROUPS) -> DataFrame:
    """For each absent target, copy the first existing candidate column."""
    lower = {c.strip().lower(): c for c in df.columns}
    for target, candidates in groups.items():
        if target in df.columns:
            continue
        source = next((c for c in candidates if c in df.columns), None)
        if source is None:
            source = next((lower[c.lower()] for c in candidates if c.lower() in lower), None)
        if source is not None:
            df = df.withColumn(target, F.col(f"`{source}`"))
    return df


def fill_default_columns(df: DataFrame, defaults: Mapping[str, object] = K.DASHBOARD_DEFAULTS) -> DataFrame:
    """Add absent columns holding a default literal (None → typed NULL double)."""
    add = {}
    for c, v in defaults.items():
        if c in df.columns:
            continue
        add[c] = F.lit(None).cast("double") if v is None else F.lit(v)
    return df.withColumns(add) if add else df


def dashboard_schema(df: DataFrame) -> DataFrame:
    """Header trim + aliases + defaults + the backlog fallbacks of the dashboard."""
    df = normalize_headers_trim(df)
    df = resolve_aliases(df)
    df = fill_default_columns(df)
    return df


def upload_schema(df: DataFrame) -> DataFrame:
    """The columns an uploaded table must have before the dashboard's schema:
    trimmed lower-case headers, the backlog count under its own name (from the
    first alias present, else 0), backlog columns and defaults."""
    df = normalize_headers_trim(df)
    if "noofbacklog" not in df.columns:
        source = next((c for c in K.UPLOAD_BACKLOG_NAMES if c in df.columns), None)
        df = df.withColumn("noofbacklog", F.col(source) if source else F.lit(0))
    if "current_back" not in df.columns:
        df = df.withColumn("current_back", F.col("noofbacklog"))
    return fill_default_columns(df, {"ever_back": 0, **K.UPLOAD_DEFAULTS})


def split_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric columns, other columns) from the schema."""
    num, other = [], []
    for f in df.schema.fields:
        (num if isinstance(f.dataType, T.NumericType) else other).append(f.name)
    return num, other


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def dedupe_columns_keep_first(frames: Sequence[DataFrame], keep: Sequence[str] = ()) -> list[DataFrame]:
    """Drop from each later frame the names already taken by an earlier one."""
    seen: set[str] = set()
    out = []
    for df in frames:
        cols = [c for c in df.columns if c not in seen or c in keep]
        seen.update(df.columns)
        out.append(df.select(*[F.col(f"`{c}`") for c in cols]))
    return out


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def gold_projection(df: DataFrame) -> DataFrame:
    return select_existing(df, K.GOLD_FINAL_COLUMNS)


def student_overview(features: DataFrame) -> DataFrame:
    return select_existing(features, K.STUDENT_OVERVIEW_COLUMNS)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def scatter_projection(df: DataFrame, x: str, y: str, color: str | None = None,
                       size: str | None = None) -> DataFrame:
    """(x, y[, color, size]) with NULL x or y removed."""
    cols = [F.col(x).alias("x"), F.col(y).alias("y")]
    if color:
        cols.append(F.col(color).alias("color"))
    if size:
        cols.append(F.col(size).alias("size"))
    return df.select(*cols).where(F.col("x").isNotNull() & F.col("y").isNotNull())


def scatter_bins(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """2-D binned scatter: a bounded-size summary of an unbounded point cloud."""
    pts = scatter_projection(df, x, y)
    return (pts.groupBy(F.floor(F.col("x") / x_width).alias("x_bin"),
                        F.floor(F.col("y") / y_width).alias("y_bin"))
            .agg(F.count(F.lit(1)).alias("points")))


def columns_of(cols: Iterable[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in cols]
