"""Document fingerprints of closed syncmers (op 8).

A text's units are its words, long words cut every 16 code points.  A k-mer of
units is chosen when the smallest hash among its inner s-mers is the first or
the last one: a choice made from the k-mer alone, so shared passages choose
the same anchors whatever stands around them.

DataFrame functions only: no Python code runs on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, let, row_key

#: k units to a k-mer, s units to an inner s-mer.
K, S = 8, 2


def _least(x: Column, y: Column, shift: int) -> Column:
    """x[i] and y[i + shift], the smaller one."""
    return F.zip_with(x, F.slice(y, shift + 1, F.greatest(F.size(y) - shift, F.lit(0))),
                      lambda a, b: F.least(a, b))


def closed_syncmers(text: Column) -> Column:
    """Array of (pos, h): unit position and 32-bit hash of each chosen k-mer,
    in text order.  A text with units but no chosen k-mer has one anchor that
    hashes all its units; null, empty and blank texts have none."""
    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]{1,16}"), F.lit(0))
    hashes = F.transform(units, lambda u: F.xxhash64(u))
    w = K - S + 1  # inner s-mers of a k-mer

    def pairs(h):
        return F.zip_with(F.slice(h, 1, F.size(h) - 1), F.slice(h, 2, F.size(h) - 1), lambda a, b: F.xxhash64(a, b))

    def window_min(g):
        return let(_least(g, g, 1), lambda m2: let(_least(m2, m2, 2), lambda m4: _least(m4, m4, w - 4)))

    def chosen(g, m):
        at = F.filter(F.sequence(F.lit(0), F.size(g) - w), lambda i: (
            F.get(m, i) == F.get(g, i)) | (F.get(m, i) == F.get(g, i + (w - 1))))
        return F.transform(at, lambda i: F.struct(i.alias("pos"), F.hash(
            *[F.get(g, i + j) for j in range(0, w, S)]).alias("h")))

    none = F.array().cast("array<struct<pos:int,h:int>>")

    def whole(h):
        return F.array(F.struct(F.lit(0).alias("pos"), F.hash(h).alias("h")))

    def anchors(h):
        found = F.when(F.size(h) >= K, let(pairs(h), lambda g: let(window_min(g), lambda m: chosen(g, m)))) \
            .otherwise(none)
        return let(found, lambda f: F.when(F.size(f) > 0, f).when(F.size(h) > 0, whole(h)).otherwise(none))

    return let(hashes, anchors)


def likeness(a: Column, b: Column) -> Column:
    """Shared share of two anchor sets: 2 |a & b| / (|a| + |b|); 1 if both are empty."""
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(
        2.0 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b)))


def with_next(docs: DataFrame, cols: list[str]) -> DataFrame:
    """``docs`` (doc_id, _id, _th, ...) with next_<c> of the next row in
    descending doc_id order, the first row following the last.

    Rows are dealt into doc_id ranges (bounds from a quantile sketch) and the
    head of each range is also given to the range before it, so no window
    spans the table.  The table of heads has a row per range and is broadcast.
    """
    spark = docs.sparkSession
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.select(F.percentile_approx("_llm_id", [i / n for i in range(1, n)], 20 * n).alias("q")).first()[0] or []
    cuts = sorted(set(cuts))
    bounds = F.lit(cuts).cast("array<bigint>") if cuts else F.array().cast("array<bigint>")
    d = docs.withColumn("_llm_b", let(bounds, lambda q: F.size(F.filter(q, lambda c: c < F.col("_llm_id")))))
    heads = d.groupBy("_llm_b").agg(F.max(F.struct("_llm_id", F.bitwise_not("_llm_th").alias("_nt"))).alias("m")) \
        .select("_llm_b", "m._llm_id", F.bitwise_not(F.col("m._nt")).alias("_llm_th")).orderBy(F.desc("_llm_b")).collect()
    rows = [(h["_llm_id"], h["_llm_th"], heads[i - 1]["_llm_b"]) for i, h in enumerate(heads)]
    to = spark.createDataFrame(rows, "_llm_id long, _llm_th long, _llm_to int")
    slot = F.struct(F.col("_llm_b").alias("_llm_b"), F.lit(0).alias("_llm_extra"))
    extra = F.struct(F.col("_llm_to").alias("_llm_b"), F.lit(1).alias("_llm_extra"))
    names = [c for c in docs.columns]
    d = (d.join(F.broadcast(to), ["_llm_id", "_llm_th"], "left")
         .withColumn("_llm_slot", F.explode(F.when(F.col("_llm_to").isNull(), F.array(slot)).otherwise(F.array(slot, extra))))
         .select(*names, "_llm_slot.*"))
    w = Window.partitionBy("_llm_b").orderBy("_llm_extra", F.desc("_llm_id"), "_llm_th")
    return d.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in cols]).where("_llm_extra = 0").drop("_llm_b", "_llm_extra")


def fingerprint_text(anchors: Column) -> Column:
    """Distinct anchors in text order, 8 hex digits each."""
    return F.array_join(F.transform(anchors, lambda x: F.lpad(
        F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def _anchor_set(text: Column) -> Column:
    return let(closed_syncmers(text), lambda a: F.array_distinct(F.transform(a, lambda x: x["h"])))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.select("doc_id", "text", *row_key(F.col("text"), F.col("doc_id")), _anchor_set(F.col("text")).alias("fp"))
    j = with_next(d, ["text", "fp"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    j = j.select("doc_id", n.cast("long").alias("n_chars"), "fp", "next_fp",
                 F.concat(F.substr("text", F.lit(1), n - half),
                          F.substr("next_text", F.lit(1), half)).alias("edited"))
    j = j.withColumn("efp", _anchor_set(F.col("edited")))
    return j.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_text(F.col("fp")).alias("fingerprint"),
        fingerprint_text(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
