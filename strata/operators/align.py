"""Keys and alignment.

Row position carries meaning in the source application: unrelated sources are
glued line by line.  Spark rows have no position, so every operator here takes
an explicit order; numbering uses the distributed running count of
``strata.operators.prefix`` (no single-partition window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.prefix import with_file_position, with_row_number
from strata.operators.schema import dedupe_columns_keep_first


def surrogate_key(df: DataFrame, order_by: Sequence[str] | None, output: str = "student_id",
                  start: int = 1, unique: bool = False) -> DataFrame:
    """``output`` = start, start+1, ... in ``order_by`` order, as first column.

    ``order_by=None`` numbers rows read from files in file order, which moves
    none of them; ``unique`` says that no two rows share an order."""
    out = with_file_position(df, output, start) if order_by is None else with_row_number(df, order_by, output, start, unique=unique)
    return out.select(output, *[F.col(f"`{c}`") for c in df.columns if c != output])


def positional_align(frames: Sequence[DataFrame], order_bys: Sequence[Sequence[str]],
                     names: Sequence[str], key: str = "student_id", unique: bool = False) -> DataFrame:
    """Full outer join of the frames on their row position in the given order.

    Duplicate column names keep the first frame's column; every frame adds a
    ``<name>_record_available`` flag (1 when it had a row at that position).
    ``key`` is the 1-based position; ``unique`` says that no two rows of a frame
    share an order, which saves a shuffle.
    """
    numbered = []
    for df, order, name in zip(frames, order_bys, names):
        df = df.drop(key) if key in df.columns else df
        n = with_row_number(df, order, f"_pos_{name}", unique=unique)
        numbered.append(n.withColumn(f"{name}_record_available", F.lit(1)))
    numbered = dedupe_columns_keep_first(numbered)
    out = numbered[0].withColumnRenamed(f"_pos_{names[0]}", key)
    for df, name in zip(numbered[1:], names[1:]):
        out = (out.join(df, out[key] == df[f"_pos_{name}"], "full")
               .withColumn(key, F.coalesce(F.col(key), F.col(f"_pos_{name}")))
               .drop(f"_pos_{name}"))
    flags = {f"{n}_record_available": F.coalesce(F.col(f"{n}_record_available"), F.lit(0)) for n in names}
    out = out.withColumns(flags)
    return out.select(key, *[c for c in out.columns if c != key])


def backfill_keys(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """NULL keys become max+1, max+2, ... in ``order_by`` order (1, 2, ... if none)."""
    top = F.lit(df.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("m")).first()["m"])
    have = df.where(F.col(key).isNotNull())
    missing = df.where(F.col(key).isNull()).drop(key)
    numbered = with_row_number(missing, order_by, "_bk_rn")
    filled = numbered.withColumn(key, (top + F.col("_bk_rn")).cast(df.schema[key].dataType)).drop("_bk_rn")
    return have.unionByName(filled.select(*df.columns))
