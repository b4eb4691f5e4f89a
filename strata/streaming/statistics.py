"""Refreshable order statistics and distinct counts (T2 with C4, C7, G6, G15).

A mart of sums and counts can be added to; medians, fences and distinct counts
can not.  ``StatisticsMart`` keeps mergeable state instead, one part per batch
of an ``availableNow`` refresh:

* ``data``    the landed rows;
* ``state``   per group the count, sum and KLL sketch of each numeric column;
* ``facts``   per column the rows and missing values;
* ``values``  128-bit hashes of the column values that no earlier batch had, so
  the distinct count of everything is the sum of the parts.

A refresh reads its own batch (and the hashes of earlier values), never earlier
rows.  On reading, states are merged into brackets of the wanted ranks and one
counting pass over the landed rows gives the exact values inside them.  A batch
that is replayed replaces its own part and compares with earlier parts only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quantiles as Q
from strata.session import checkpoint
from strata.sources.files import read_or_empty, write_layer


def value_hashes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, a, b): the distinct non-null values of each column, as hashes."""
    def key(c: str) -> Column:
        v = F.col(f"`{c}`").cast("string")
        return F.struct(F.lit(c).alias("column"), F.xxhash64(v).alias("a"), F.xxhash64(F.lit(1), v).alias("b"),
                        v.isNotNull().alias("has"))

    cells = df.select(F.explode(F.array(*map(key, columns))).alias("k")).select("k.*")
    return cells.where("has").select("column", "a", "b").distinct()


@dataclass
class StatisticsMart:
    """State under ``path`` of numeric columns (by groups) and of the columns
    whose missing and distinct values are counted."""

    path: str
    numeric: Sequence[str]
    by: Sequence[str] = ()
    counted: Sequence[str] = field(default_factory=list)

    def add(self, batch: DataFrame, epoch: int) -> None:
        """Add one batch (the ``foreachBatch`` function of ``refresh_if_new``)."""
        spark = batch.sparkSession
        write_layer(batch, f"{self.path}/data/epoch={epoch}")
        rows = spark.read.schema(batch.schema).parquet(f"{self.path}/data/epoch={epoch}")
        state = Q.sketch_state(rows, self.numeric, self.by)
        sums = rows.groupBy(*self.by).agg(*[F.sum(Q._cell(c)).alias(f"t{i}") for i, c in enumerate(self.numeric)])
        if self.by:
            named = sums.select(*[F.col(b).alias(f"_{b}") for b in self.by], *[f"t{i}" for i in range(len(self.numeric))])
            state = state.join(named, [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in self.by]).drop(*[f"_{b}" for b in self.by])
        else:  # one row each
            row = sums.first()
            state = state.withColumns({f"t{i}": F.lit(row[f"t{i}"]).cast("double") for i in range(len(self.numeric))})
        write_layer(state, f"{self.path}/state/epoch={epoch}")
        if not self.counted:
            return
        facts = rows.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in self.counted])
        write_layer(facts.unpivot(["rows"], [F.col(f"`{c}`") for c in self.counted], "column", "missing"), f"{self.path}/facts/epoch={epoch}")
        earlier = self._part(spark, "values", "column string, a long, b long, epoch int").where(F.col("epoch") < epoch)
        write_layer(value_hashes(rows, self.counted).join(earlier, ["column", "a", "b"], "left_anti"),
                    f"{self.path}/values/epoch={epoch}")

    def _part(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        return read_or_empty(spark, f"{self.path}/{name}", schema)

    def data(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/data").drop("epoch")

    def state(self, spark: SparkSession) -> DataFrame:
        """Merged state: (by..., n0, s0, t0, n1, ...)."""
        parts = spark.read.parquet(f"{self.path}/state")
        return parts.groupBy(*self.by).agg(*[x for i in range(len(self.numeric)) for x in (
            F.sum(f"n{i}").alias(f"n{i}"), F.kll_merge_agg_double(f"s{i}", Q.KLL_K).alias(f"s{i}"), F.sum(f"t{i}").alias(f"t{i}"))])

    def means(self, spark: SparkSession) -> DataFrame:
        """(by..., column, count, mean) from the state alone."""
        cells = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                          F.try_divide(F.col(f"t{i}"), F.col(f"n{i}")).alias("mean")) for i, c in enumerate(self.numeric)]
        return self.state(spark).select(*self.by, F.explode(F.array(*cells)).alias("x")).select(*self.by, "x.*")

    def quantiles(self, spark: SparkSession, probs: Sequence[float], exact: bool = True) -> DataFrame:
        """(by..., column, p, value): exact by one counting pass inside the
        brackets of the merged sketches, or the sketches' estimates."""
        cols, by, probs = list(self.numeric), list(self.by), list(map(float, probs))
        state = self.state(spark)
        if not exact:
            at = F.array(*map(F.lit, probs))
            cells = [F.struct(F.lit(c).alias("column"), at.alias("p"), F.when(
                F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", at)).alias("v")) for i, c in enumerate(cols)]
            long = state.select(*by, F.explode(F.array(*cells)).alias("x")).select(*by, "x.column", F.explode(F.arrays_zip("x.p", "x.v")).alias("q"))
            return long.select(*by, "column", F.col("q.p").alias("p"), F.col("q.v").alias("value")).where("value is not null")
        rows = self.data(spark)
        size = F.greatest(*[F.col(f"n{i}") for i in range(len(cols))]) if len(cols) > 1 else F.col("n0")
        found = Q.bracket_table(state.withColumn("_size", size), cols, probs, [*by, "_size"])
        large = checkpoint(found.orderBy(F.desc("_size"), F.xxhash64(F.lit(0), *by)).limit(Q.BRACKETS // (len(cols) * len(probs))))
        picked = checkpoint(Q._at_ranks(Q.placed_counts(rows, large, cols, len(probs), by), probs, by))
        if not picked.where("_missed").isEmpty():  # a sketch was off by more than its bracket
            return Q.quantiles(rows, cols, probs, by)
        value = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")
        return picked.select(*by, F.col("_col").alias("column"), F.col("_p").alias("p"),
                             F.when(F.col("_frac") == 0, F.col("_vlo")).otherwise(value).alias("value"))

    def medians(self, spark: SparkSession) -> DataFrame:
        return self.quantiles(spark, [0.5]).drop("p")

    def fences(self, spark: SparkSession, k: float = 1.5) -> DataFrame:
        """(by..., column, q1, q3, iqr, lower, upper), as ``clean.iqr_fences``."""
        q = self.quantiles(spark, [0.25, 0.75]).groupBy(*self.by, "column").agg(
            F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"), F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"))
        iqr = F.col("q3") - F.col("q1")
        return q.withColumns({"iqr": iqr, "lower": F.col("q1") - k * iqr, "upper": F.col("q3") + k * iqr})

    def audit(self, spark: SparkSession) -> DataFrame:
        """(column, missing_count, missing_pct, n_unique incl. NULL), as
        ``profile.data_quality_audit``, from the state alone."""
        facts = spark.read.parquet(f"{self.path}/facts").groupBy("column").agg(
            F.sum("missing").alias("missing_count"), F.sum("rows").alias("_n"))
        unique = spark.read.parquet(f"{self.path}/values").groupBy("column").agg(F.count(F.lit(1)).alias("_u"))
        return facts.join(unique, "column", "left").select(
            "column", "missing_count", F.round(F.try_divide(F.col("missing_count") * 100.0, F.col("_n")), 2).alias("missing_pct"),
            (F.coalesce("_u", F.lit(0)) + (F.col("missing_count") > 0).cast("long")).alias("n_unique"))
