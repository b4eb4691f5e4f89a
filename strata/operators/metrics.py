"""Model-evaluation metrics as aggregates.

All metrics are SQL-shaped: conditional sums in one pass.  The threshold
sweep never pairs rows with thresholds: each row is assigned the index of the
highest threshold it clears (arithmetic + exact-edge correction), counts are
aggregated per index (≤ 32 rows), and precision/recall per threshold follow
from suffix sums over that tiny table.  ROC AUC is the exact Mann–Whitney
statistic over distinct scores using the distributed running total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import constants as K
from strata.operators.prefix import running_total


def n_thresholds(start: float = K.THRESHOLD_START, stop: float = K.THRESHOLD_STOP,
                 step: float = K.THRESHOLD_STEP) -> int:
    import math
    return int(math.ceil((stop - start) / step))


def threshold_value(i: Column, start: float = K.THRESHOLD_START, step: float = K.THRESHOLD_STEP) -> Column:
    """The i-th threshold with the float arithmetic of ``arange``:
    start + i·delta where delta = (start + step) − start in doubles."""
    delta = (float(start) + float(step)) - float(start)
    return F.lit(float(start)) + i.cast("double") * F.lit(delta)


def threshold_index(p: Column, start: float = K.THRESHOLD_START, step: float = K.THRESHOLD_STEP,
                    n: int | None = None) -> Column:
    """Index of the highest threshold ≤ p (−1 when p is below all of them)."""
    n = n or n_thresholds(start, K.THRESHOLD_STOP, step)
    delta = (float(start) + float(step)) - float(start)
    g = F.floor((p - F.lit(float(start))) / F.lit(delta)).cast("int")
    g = F.least(F.greatest(g, F.lit(-1)), F.lit(n - 1))
    g = F.when((g >= 0) & (threshold_value(g, start, step) > p), g - 1).otherwise(g)
    g = F.when((g < n - 1) & (threshold_value(g + 1, start, step) <= p), g + 1).otherwise(g)
    return g


def _prf(tp: Column, fp: Column, fn: Column) -> list[Column]:
    precision = F.coalesce(F.try_divide(tp.cast("double"), tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp.cast("double"), tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0))
    return [precision.alias("precision"), recall.alias("recall"), f1.alias("f1")]


def threshold_sweep(df: DataFrame, label: str, score: str,
                    start: float = K.THRESHOLD_START, step: float = K.THRESHOLD_STEP) -> DataFrame:
    """(threshold_index, threshold, tp, fp, fn, tn, precision, recall, f1) per threshold."""
    n = n_thresholds(start, K.THRESHOLD_STOP, step)
    y = F.col(label).cast("int")
    per = (df.select(threshold_index(F.col(score), start, step, n).alias("k"), y.alias("y"))
           .groupBy("k").agg(F.sum("y").alias("pos"), F.count_if(F.col("y") == 0).alias("neg")))
    # grid -1..n-1 (-1 = below every threshold): at most n + 1 rows, so the
    # single-partition windows below run over a bounded table
    grid = per.sparkSession.range(-1, n).select(F.col("id").cast("int").alias("k"))
    everything = Window.partitionBy()
    suffix = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = (grid.join(per, "k", "left")
         .select("k", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg"))
         .withColumn("P", F.sum("pos").over(everything))
         .withColumn("N", F.sum("neg").over(everything))
         .withColumn("tp", F.sum("pos").over(suffix))
         .withColumn("fp", F.sum("neg").over(suffix))
         .where(F.col("k") >= 0))
    fn = F.col("P") - F.col("tp")
    tn = F.col("N") - F.col("fp")
    return j.select(F.col("k").alias("threshold_index"),
                    F.round(threshold_value(F.col("k"), start, step), 2).alias("threshold"),
                    F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
                    fn.cast("long").alias("fn"), tn.cast("long").alias("tn"),
                    *_prf(F.col("tp"), F.col("fp"), fn))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The first (lowest) threshold reaching the maximum F1."""
    return sweep.orderBy(F.col("f1").desc(), F.col("threshold_index")).limit(1)


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve (ties count one half), per ``by`` group."""
    by = list(by)
    y = F.col(label).cast("int")
    per = (df.where(F.col(score).isNotNull())
           .groupBy(*by, F.col(score).cast("double").alias("_s"))
           .agg(F.sum(y).alias("_pos"), F.count_if(y == 0).alias("_neg")))
    cum = running_total(per, ["_s"], "_neg", by, output="_cneg")
    below = F.col("_cneg") - F.col("_neg")
    return cum.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("_pos") * (below + 0.5 * F.col("_neg"))),
                     F.sum("_pos").cast("double") * F.sum("_neg")).alias("roc_auc"))


def confusion_counts(df: DataFrame, label: str, prediction: Column | str) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    p = (F.col(prediction) if isinstance(prediction, str) else prediction).cast("int")
    df = df.select(F.col(label).cast("int").alias("_y"), p.alias("_p"))
    y, p = F.col("_y"), F.col("_p")
    return df.agg(F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def confusion_matrix(df: DataFrame, label: str, prediction: Column | str) -> DataFrame:
    """Long 2×2 matrix (actual, predicted, count), zero cells included."""
    c = confusion_counts(df, label, prediction)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return c.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(n).cast("long").alias("count"))
        for a, p, n in cells])).alias("s")).select("s.*")


def predict_at(score: str, threshold: float | Column) -> Column:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (F.col(score) >= t).cast("int")


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float | Column) -> DataFrame:
    """threshold, accuracy, precision, recall, f1, roc_auc (one row)."""
    c = confusion_counts(df, label, predict_at(score, threshold))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    auc = roc_auc(df, label, score).select("roc_auc").scalar()
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return c.select(t.alias("threshold"),
                    F.try_divide((tp + tn).cast("double"), tp + tn + fp + fn).alias("accuracy"),
                    *_prf(tp, fp, fn), auc.alias("roc_auc"))


def classification_report(df: DataFrame, label: str, prediction: Column | str) -> DataFrame:
    """Per class precision/recall/f1/support, plus accuracy, macro and weighted avg."""
    c = confusion_counts(df, label, prediction)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))

    def row(name, t, f_p, f_n, support):
        return F.struct(F.lit(name).alias("class"), *_prf(t, f_p, f_n), support.cast("double").alias("support"))

    per = c.select(row("0", tn, fn, fp, tn + fp).alias("c0"), row("1", tp, fp, fn, tp + fn).alias("c1"),
                   (tp + tn + fp + fn).alias("n"), F.try_divide((tp + tn).cast("double"), tp + tn + fp + fn).alias("acc"))
    c0, c1, n = F.col("c0"), F.col("c1"), F.col("n").cast("double")

    def avg(field, weighted):
        if weighted:
            return F.try_divide(c0[field] * c0["support"] + c1[field] * c1["support"], n)
        return (c0[field] + c1[field]) / 2

    macro = F.struct(F.lit("macro avg").alias("class"), avg("precision", False).alias("precision"),
                     avg("recall", False).alias("recall"), avg("f1", False).alias("f1"), n.alias("support"))
    weighted = F.struct(F.lit("weighted avg").alias("class"), avg("precision", True).alias("precision"),
                        avg("recall", True).alias("recall"), avg("f1", True).alias("f1"), n.alias("support"))
    accuracy = F.struct(F.lit("accuracy").alias("class"), F.col("acc").alias("precision"),
                        F.col("acc").alias("recall"), F.col("acc").alias("f1"), n.alias("support"))
    return per.select(F.explode(F.array(c0, c1, accuracy, macro, weighted)).alias("s")).select("s.*")


def select_best_model(metrics: DataFrame, model_col: str = "model") -> DataFrame:
    return metrics.orderBy(F.col("roc_auc").desc_nulls_last(), F.col("f1").desc_nulls_last(), model_col).limit(1)


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """mae, rmse, r2 (constant target: 1 if perfect else 0), rse = 1 − r2."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    one = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.avg(F.abs(y - p)).alias("mae"), F.avg((y - p) * (y - p)).alias("mse"),
        F.sum((y - p) * (y - p)).alias("ss_res"), (F.var_pop(y) * F.count(y)).alias("ss_tot"),
        F.count(F.lit(1)).alias("n"))
    r2 = F.when(F.col("ss_tot") > 0, 1 - F.col("ss_res") / F.col("ss_tot")) \
          .otherwise(F.when(F.col("ss_res") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return one.select("n", "mae", F.sqrt("mse").alias("rmse"), r2.alias("r2"), (1 - r2).alias("rse"))
