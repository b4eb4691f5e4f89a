"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and
skip-grams (op 9).

A document's features are the set of its words, adjacent pairs and pairs with
one word between, hashed to ``BITS`` bits.  Training is one pass per epoch of
per-coordinate FTRL over a bounded sample of labelled rows, in one task; L1
leaves a weight table of a few thousand entries at most, which is what the
scoring tasks get.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, small_batches, with_fields

BITS = 40
#: Bounds of the training sample, rows of label 1 and of label 0, picked by hash order.
MAX_TOXIC, MAX_CLEAN = 2500, 6000
_STRIP = ".,;:!?\"'()[]{}<>*#$%&|-_"
_CACHE: dict[str, int] = {}


def _word_hash(word: str) -> int:
    h = _CACHE.get(word)
    if h is None:
        if len(_CACHE) > 400_000:
            _CACHE.clear()
        w = word.strip(_STRIP) or word
        b = w.encode()
        h = _CACHE[word] = zlib.crc32(b) | (zlib.crc32(b, 0x9E3779B9) << 32)
    return h


def features(text: str | None) -> np.ndarray:
    """Distinct feature hashes of a text (none for null and blank texts)."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(_word_hash, words), np.uint64, len(words))
    h *= np.uint64(0x9E3779B97F4A7C15)
    parts = [h]
    for gap in (1, 2):
        if len(h) > gap:
            mixed = (h[:-gap] ^ (h[gap:] >> np.uint64(7))) * np.uint64(0xC2B2AE3D27D4EB4F + 2 * gap)
            parts.append(mixed + h[gap:])
    return np.unique((np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64))


def train(rows: list[tuple[np.ndarray, int]], alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0,
          l2: float = 0.5, epochs: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """(sorted feature hashes, weights, bias).  Without rows of both classes
    there is no feature and the bias is far below or above zero."""
    labels = {y for _, y in rows}
    if labels != {0, 1}:
        return np.empty(0, np.int64), np.empty(0), 8.0 if labels == {1} else -8.0
    keys = np.unique(np.concatenate([f for f, _ in rows]))
    idx = [np.searchsorted(keys, f) for f, _ in rows]
    z, n = np.zeros(len(keys)), np.zeros(len(keys))
    zb = nb = 0.0
    bias = 0.0
    for _ in range(epochs):
        for ix, (_, y) in zip(idx, rows):
            zi, ni = z[ix], n[ix]
            root = np.sqrt(ni)
            w = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + root) / alpha + l2))
            bias = -zb / ((beta + nb ** 0.5) / alpha)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = p - y
            z[ix] = zi + g - (np.sqrt(ni + g * g) - root) / alpha * w
            n[ix] = ni + g * g
            zb += g - ((nb + g * g) ** 0.5 - nb ** 0.5) / alpha * bias
            nb += g * g
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    keep = w != 0
    return keys[keep], w[keep], float(bias)


def score(texts: list[str | None], keys: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(texts), bias)
    if len(keys):
        for i, t in enumerate(texts):
            f = features(t)
            at = np.minimum(np.searchsorted(keys, f), len(keys) - 1)
            out[i] += weights[at][keys[at] == f].sum()
    return 1.0 / (1.0 + np.exp(-np.clip(out, -35, 35)))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Train on labelled rows whose crc32(doc_id as text) mod 5 is not 0.

    Null labels and ids are no labels; a doc_id labelled twice counts as toxic
    if one label says so.  At most MAX_TOXIC + MAX_CLEAN rows are read; the bias
    is put back to the classes' shares of all these labels.
    """
    known = (labels.where("toxic in (0, 1) and doc_id is not null")
             .where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
             .groupBy("doc_id").agg(F.max("toxic").alias("_y")).withColumn("_o", F.xxhash64("doc_id")))
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    picked = known.where("_y = 1").orderBy("_o", "doc_id").limit(MAX_TOXIC).unionByName(
        known.where("_y = 0").orderBy("_o", "doc_id").limit(MAX_CLEAN))
    sample = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
              .select("_o", "_y", "text").repartition(1).sortWithinPartitions("_o", "text"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            rows += [(features(t), y) for t, y in zip(b.column("text").to_pylist(), b.column("_y").to_pylist())]
        keys, w, bias = train(rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(keys, -1)), pa.array(np.append(w, bias))], ["k", "w"])

    rows = sample.mapInArrow(fit, "k long, w double").collect()
    table = sorted((r["k"], r["w"]) for r in rows)
    bias = next((w for k, w in table if k < 0), -8.0)
    table = [(k, w) for k, w in table if k >= 0]
    if len(counts) == 2:
        bias += math.log(counts[1] / min(counts[1], MAX_TOXIC)) - math.log(counts[0] / min(counts[0], MAX_CLEAN))
    return np.array([k for k, _ in table], np.int64), np.array([w for _, w in table]), bias


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with toxicity (0 to 1); null and blank texts get the bias alone."""
    small_batches(docs.sparkSession)
    keys, w, bias = fit_toxicity(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((keys, w, bias))
    names = [c for c in docs.columns if c != "toxicity"]
    docs = docs.select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = score(b.column(names.index("text")).to_pylist(), *shared.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], [*names, "toxicity"])

    return docs.mapInArrow(run, with_fields(docs, ("toxicity", "double")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir).select("doc_id", "text")
    out = score_toxicity(d, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
                      F.col("toxicity").alias("score"),
                      F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"))
