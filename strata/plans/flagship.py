"""Flagship query: revenue per order, IQR-capped, banded, summarised per
market segment (lineitem ⋈ orders ⋈ customer)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import expressions as X
from strata.operators.clean import cap_outliers_iqr
from strata.session import pinned

# band edges on the capped order revenue (right-closed, like the support-need bands)
REVENUE_BANDS = [("low", None, 50000.0), ("medium", 50000.0, 150000.0), ("high", 150000.0, None)]


def segment_revenue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet")
    per_order = (li.groupBy("l_orderkey")
                 .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")))
    joined = (per_order.join(orders.select("o_orderkey", "o_custkey"), per_order.l_orderkey == orders.o_orderkey)
              .join(cust.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
              .select("l_orderkey", "c_mktsegment", "revenue"))
    # pinned: the fences read it twice, the summary once, and all of them the same sums
    capped = cap_outliers_iqr(pinned(joined), ["revenue"])
    banded = capped.withColumn("revenue_band", X.risk_band("revenue", REVENUE_BANDS))
    out = banded.groupBy("c_mktsegment", "revenue_band").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.avg("revenue"), 3).alias("avg_capped_revenue"),
        F.round(F.sum("revenue"), 1).alias("capped_revenue"))
    return out


FLAGSHIP_ORACLE = """
WITH po AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem GROUP BY l_orderkey),
j AS (SELECT l_orderkey, c_mktsegment, revenue FROM po JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey),
f AS (SELECT quantile_cont(revenue, 0.25) AS q1, quantile_cont(revenue, 0.75) AS q3 FROM j),
c AS (SELECT c_mktsegment, CASE WHEN revenue < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1)
        WHEN revenue > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1) ELSE revenue END AS revenue FROM j, f)
SELECT c_mktsegment, CASE WHEN revenue <= 50000 THEN 'low' WHEN revenue <= 150000 THEN 'medium' ELSE 'high' END
  AS revenue_band, count(*) AS orders, round(avg(revenue), 3) AS avg_capped_revenue,
  round(sum(revenue), 1) AS capped_revenue FROM c GROUP BY ALL
"""
