"""Global running totals and row numbering without a single-task window.

``Window.orderBy(...)`` without ``partitionBy`` funnels every row through one
task.  Here the rows are range-partitioned on (segment, order) so that even a
segment holding a third of the data is spread over many tasks; the partition
contents are pinned by a checkpoint, each (partition, segment) slice gets its
exclusive offset from a table of at most ``partitions + segments`` rows, and a
window over the (partition, segment) slice adds the local running total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import checkpoint, if_small


def running_total(df: DataFrame, order_by: Sequence[str], weight: str | None = None,
                  partition_by: Sequence[str] = (), output: str = "running_total",
                  total: str | None = None, num_partitions: int | None = None,
                  partition_col: str | None = None) -> DataFrame:
    """Inclusive running sum of ``weight`` (1 per row when None) over ``order_by``
    within each ``partition_by`` segment.  ``total`` also attaches the segment sum;
    ``partition_col`` keeps the range-partition id (to inspect the split).

    Ties in ``order_by`` are summed in an arbitrary order; pass a unique order
    when the exact position matters (row numbering).
    """
    seg = list(partition_by)
    order = list(order_by)
    w = F.lit(1).cast("long") if weight is None else F.col(weight)
    keys = [F.col(c).asc_nulls_last() for c in seg + order]
    weighted = df.withColumn("_rt_w", w)
    # Without an explicit count the range exchange uses the session's shuffle
    # partitions and AQE may merge adjacent (still contiguous) ranges when the
    # data is small; the partition id is read after that merge, so every id
    # is one contiguous key range either way.
    ranged = (weighted.repartitionByRange(int(num_partitions), *keys) if num_partitions
              else weighted.repartitionByRange(*keys))
    ranged = ranged.withColumn("_rt_pid", F.spark_partition_id())
    ranged = checkpoint(ranged)

    slices = ranged.groupBy("_rt_pid", *seg).agg(F.sum("_rt_w").alias("_rt_tot"))
    before = Window.partitionBy(*seg).orderBy("_rt_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.withColumn("_rt_off", F.coalesce(F.sum("_rt_tot").over(before), F.lit(0)))
    if total:
        seg_tot = Window.partitionBy(*seg)
        offsets = offsets.withColumn(total, F.sum("_rt_tot").over(seg_tot))
    offsets = offsets.drop("_rt_tot")

    local = Window.partitionBy("_rt_pid", *seg).orderBy(*[F.col(c).asc_nulls_last() for c in order]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranged = ranged.withColumn("_rt_loc", F.sum("_rt_w").over(local))
    o = offsets.alias("_rt_o")
    r = ranged.alias("_rt_r")
    cond = F.col("_rt_r._rt_pid") == F.col("_rt_o._rt_pid")
    for c in seg:
        cond = cond & F.col(f"_rt_r.{c}").eqNullSafe(F.col(f"_rt_o.{c}"))
    extra = [F.col(f"_rt_o.{total}")] if total else []
    out = (r.join(o, cond, "inner")
           .select("_rt_r.*", F.col("_rt_o._rt_off"), *extra)
           .withColumn(output, F.col("_rt_off") + F.col("_rt_loc")))
    if partition_col:
        out = out.withColumnRenamed("_rt_pid", partition_col)
    return out.drop("_rt_pid", "_rt_w", "_rt_loc", "_rt_off")


#: Numbers that one row of a group of identical rows is expanded to at a time.
CHUNK = 1000


def with_row_number(df: DataFrame, order_by: Sequence[str], output: str = "row_id",
                    start: int = 1, partition_by: Sequence[str] = (),
                    num_partitions: int | None = None, unique: bool = False) -> DataFrame:
    """Consecutive numbers ``start, start+1, ...`` in ``order_by`` order.

    Two independent hashes of the whole row break ties, so even millions of
    distinct rows sharing one order key are spread over many range partitions.
    The tie-break is a pure function of the row (no per-task id), so a
    recomputed task after an executor loss routes every row exactly as
    before.  Rows identical in every column are interchangeable: they are
    counted (map-side combined), numbered as one weighted row and expanded
    again, in chunks dealt over the partitions where there are many.  Callers
    whose order is unique say so and save that shuffle.
    """
    cols = df.columns
    row = [F.col(f"`{c}`") for c in cols]  # header names may hold dots
    tie = df.withColumn("_rn_h", F.xxhash64(*row)).withColumn("_rn_g", F.hash(*row))
    order = [*order_by, "_rn_h", "_rn_g"]
    if unique and not partition_by:
        return _numbered_ranges(df, order_by, output, start, num_partitions)
    if unique:
        out = running_total(tie, order, None, partition_by, output="_rn_x", num_partitions=num_partitions)
        return (out.withColumn(output, (F.col("_rn_x") + F.lit(start - 1)).cast("long"))
                .drop("_rn_x", "_rn_h", "_rn_g"))
    groups = tie.groupBy(*[F.col(f"`{c}`") for c in tie.columns]).agg(F.count(F.lit(1)).alias("_rn_c"))
    numbered = running_total(groups, order, "_rn_c", partition_by, output="_rn_x", num_partitions=num_partitions)
    first, last = F.col("_rn_x") - F.col("_rn_c") + start, F.col("_rn_x") + F.lit(start - 1)
    few = numbered.where(F.col("_rn_c") <= CHUNK).withColumn(output, F.explode(F.sequence(first, last)))
    parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = (numbered.where(F.col("_rn_c") > CHUNK)
            .withColumn("_rn_s", F.explode(F.sequence(first, last, F.lit(CHUNK).cast("long"))))
            .repartition(parts, "_rn_s")
            .withColumn(output, F.explode(F.sequence("_rn_s", F.least(F.col("_rn_s") + (CHUNK - 1), last)))))
    named = [F.col(f"`{c}`") for c in cols if c != output] + [F.col(output).cast("long").alias(output)]
    return few.select(*named).unionByName(many.select(*named))


#: ``monotonically_increasing_id`` holds a row's place in its partition below this bit.
PLACE_BITS = 33


def _place() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def _numbered_ranges(df: DataFrame, order_by: Sequence[str], output: str, start: int, num_partitions: int | None) -> DataFrame:
    """Numbers in a unique order: one range shuffle, sorted and numbered inside
    each range while it is written, plus the ranges' offsets (a row a range)."""
    keys = [F.col(f"`{c}`").asc_nulls_last() for c in order_by]
    ranged = df.repartitionByRange(int(num_partitions), *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = checkpoint(ranged.sortWithinPartitions(*keys).withColumn("_rn_pid", F.spark_partition_id()).withColumn("_rn_at", _place()))
    sizes = ranged.groupBy("_rn_pid").agg(F.count(F.lit(1)).alias("_rn_n"))
    before = Window.orderBy("_rn_pid").rowsBetween(Window.unboundedPreceding, -1)  # a row a range partition
    offsets = checkpoint(sizes.select("_rn_pid", F.coalesce(F.sum("_rn_n").over(before), F.lit(0)).alias("_rn_off")))
    out = ranged.join(if_small(offsets), "_rn_pid")
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != output],
                      (F.col("_rn_off") + F.col("_rn_at") + start).cast("long").alias(output))


def with_file_position(df: DataFrame, output: str = "row_id", start: int = 1) -> DataFrame:
    """Consecutive numbers in file order (path, then place in the file) for a
    frame read from files, without moving a row.

    Rows are counted per split (file, block); the splits' offsets are a running
    total over that small table, and a row adds its place inside its split.
    ``df`` must be a scan with row-wise steps only (its ``_metadata`` is read).
    """
    place = df.select("*", F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("_fp_key"),
                      F.col("_metadata.file_path").alias("_fp_file"), F.col("_metadata.file_block_start").alias("_fp_block"),
                      F.monotonically_increasing_id().alias("_fp_at"))
    splits = checkpoint(place.groupBy("_fp_key", "_fp_file", "_fp_block").agg(
        F.count(F.lit(1)).alias("_fp_n"), F.min("_fp_at").alias("_fp_min")))
    upto = running_total(splits, ["_fp_file", "_fp_block"], "_fp_n", output="_fp_upto")
    offsets = checkpoint(upto.select("_fp_key", (F.col("_fp_upto") - F.col("_fp_n") - F.col("_fp_min") + start).alias("_fp_off")))
    if not offsets.groupBy("_fp_key").count().where("count > 1").isEmpty():
        raise RuntimeError("two splits have one hash")
    out = place.join(if_small(offsets, FILE_TABLE_BYTES), "_fp_key")
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != output], (F.col("_fp_off") + F.col("_fp_at")).alias(output))


#: Bytes of a table of splits (two numbers each, measured) that is broadcast at most.
FILE_TABLE_BYTES = 64 << 20
