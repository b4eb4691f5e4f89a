"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..session import ensure_checkpoint_dir

#: ASCII white space: the characters ``[\x20\x09-\x0D]``.
WS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LONG = -(2 ** 63)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``."""
    return spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)


def pin(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: later
    steps neither recompute it nor depend on one executor's disks."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(text: Column, doc_id: Column) -> list[Column]:
    """A row's identity: its doc_id (null: the least long) and a hash of its
    text, so that rows which share a doc_id but not a text stay apart."""
    return [F.coalesce(doc_id.cast("long"), F.lit(MIN_LONG)).alias("_llm_id"),
            F.xxhash64(text).alias("_llm_th")]


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long), the
    component being the smallest node reachable.

    Alternating large-star and small-star steps: each step is two shuffles
    with partial minima, rounds grow with the logarithm of the longest path,
    and the edge table is written to the shared folder after each round.
    """
    e = pin(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .where("a <> b").distinct(), "cc")
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # minima are partial before their shuffle; written, they join by plain exchanges that can be split
        m = pin(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "cc-min")
        large = (both.join(m.hint("merge"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        lm = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lm, "a")
        new = (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(small.select("a", F.col("m").alias("b")))
               .where("a <> b").distinct())
        new = pin(new, "cc")
        # a forest of stars: no node is both a child and a parent
        chained = new.join(new.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1).count()
        multi = new.groupBy("a").count().where("count > 1").limit(1).count()
        e = new
        if not chained and not multi:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


#: A table of at most so many rows and bytes may be broadcast; larger ones are joined by shuffle.
SMALL_ROWS, SMALL_BYTES = 50_000, 8 << 20


def if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` (a pinned table) marked for broadcast if its counted size allows."""
    n = df.count()
    return F.broadcast(df) if n <= SMALL_ROWS and n * row_bytes <= SMALL_BYTES else df


def with_fields(df: DataFrame, *fields: tuple[str, str]) -> StructType:
    """The schema of ``df`` and more fields (a copy: schemas are cached)."""
    return StructType([*df.schema.fields, *(StructField(n, _parse(t)) for n, t in fields)])


def _parse(kind: str):
    return {"string": StringType(), "long": LongType(), "double": DoubleType()}[kind]


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker is handed at once by bytes: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
