"""Corpus pipeline: toxicity filter, line dedup, near-duplicate removal, secret
redaction, packing.

Each stage reads the documents its predecessor kept (written as Parquet) and
returns documents with the columns it was given; the last one returns the
packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import pin, row_key, shared_dir
from strata.llm.jaccard_join import link_documents
from strata.llm.line_dedup import dedup_lines
from strata.llm.packing import pack
from strata.llm.secrets import redact
from strata.llm.toxicity import score_toxicity


def _bare(docs: DataFrame) -> DataFrame:
    """doc_id, text and, under one name, whatever other columns there are: no
    column of the documents can clash with one of an operator's."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_llm_none"), *rest).alias("_llm_rest"))


def _whole(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again; n_chars is the length of the text."""
    length = F.char_length("text")
    return out.select(*[
        F.col(c) if c in ("doc_id", "text") else
        F.when(F.col("text").isNotNull(), length).otherwise(F.col(f"_llm_rest.{c}")).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col(f"_llm_rest.{c}").alias(c) for c in docs.columns])


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half stay, null texts included."""
    scored = score_toxicity(_bare(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("toxicity < 0.5").select(
        *[c if c in ("doc_id", "text") else F.col(f"_llm_rest.{c}").alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in the smallest doc_id only; n_chars follows.  A
    document stays, also when it has lost every line."""
    return _whole(dedup_lines(_bare(docs)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 over five-word
    shingles the one with the smallest doc_id stays; documents without words
    or without a doc_id are linked with nothing and stay.  Texts that share a
    doc_id are documents of their own; of linked ones under one doc_id the one
    with the smallest text hash stays."""
    key = ["_llm_id", "_llm_th"]
    rows = docs.select("doc_id", "text", *row_key(F.col("text"), F.col("doc_id")))
    firsts = rows.where("doc_id is not null").groupBy("_llm_id").agg(F.min("_llm_th").alias("first"), F.max("_llm_th").alias("last"))
    several = pin(firsts.where("first < last"), "several")
    if several.limit(1).count() == 0:
        groups = link_documents(docs.select("doc_id", "text"), n=5, num=80, den=100)
        gone = pin(groups.where("doc_id <> component_id").select("doc_id").distinct(), "duplicates")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # every further text of a doc_id is linked under a number of its own
    rows = rows.join(several, "_llm_id", "left").withColumn("node", F.when(
        F.col("_llm_th") > F.col("first"), F.xxhash64(*key)).otherwise(F.col("doc_id").cast("long")))
    groups = link_documents(rows.select(F.col("node").alias("doc_id"), "text"), n=5, num=80, den=100)
    linked = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("node"), F.col("component_id").alias("group"))
    linked = linked.unionByName(linked.select(F.col("group").alias("node"), "group")).distinct()
    members = pin(rows.where("doc_id is not null").select("node", *key).distinct().join(linked, "node"), "linked")
    stays = members.groupBy("group").agg(F.min(F.struct(*key)).alias("stays"))
    gone = pin(members.join(stays, "group").where(F.struct(*key) != F.col("stays")).select(*key).distinct(), "duplicates")
    kept = docs.select("*", *row_key(F.col("text"), F.col("doc_id"))).join(gone, key, "left_anti")
    return kept.select(*docs.columns)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    names = [c for c in ("source", "lang") if c in docs.columns]
    return _whole(redact(_bare(docs).select("*", *[F.col(f"_llm_rest.{c}").alias(c) for c in names])), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 ids."""
    return pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_redaction),
    ("packing", packing),
]

#: Model scores and tokenizer ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        out.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
