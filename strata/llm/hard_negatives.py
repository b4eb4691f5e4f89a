"""Hard-negative mining by a vertical scan of branch and bound (op 11).

Vectors are quantised to integers, so scores are exact.  Rows are dealt into
blocks by a hash of their id; a block is kept dimension by dimension.  All
anchors visit all blocks (anchors are the replicated, smaller side, and stream
through a task), twice:

1. positives: the first rows of the anchor's label;
2. negatives: per positive the first rows of other labels in its score window.

A visit reads the dimensions in descending magnitude of the anchor.  After
every few of them each candidate's score lies between its partial sum plus the
least and plus the greatest contribution that the remaining dimensions can
make in this block.  Candidates that cannot reach the rank asked for, or whose
range misses every window, leave the candidate bitmap; once half of them are
gone the rest is gathered.  What remains after the last dimension has its exact
score.  Per block and anchor a few rows remain, which are merged by rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pin, shuffle_partitions, small_batches

#: Quantised components are clamped to this magnitude, so that scores fit a long.
LIMIT = 1 << 24
#: Cells of a block at most (a cell is a row's component), and rows of a block at
#: least before a table gets another one for the sake of parallel tasks, of which
#: there are SPREAD by that.
BLOCK_CELLS, LEAST_ROWS, SPREAD = 8_000_000, 4_096, 64
#: Dimensions read between two looks at the bounds.
STEP = 8
SCALE = 256.0


class Block:
    """Rows of one block, dimension by dimension, in order of label and id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((ids, labels))
        self.ids, self.labels = ids[order], labels[order]
        most = int(np.abs(vectors).max(initial=0))
        # sums of products below 2 ** 53 are exact as doubles
        self.kind = np.float64 if most ** 2 * max(1, vectors.shape[1]) < 2 ** 53 else np.int64
        self.most = most
        self.dims = np.ascontiguousarray(vectors[order].T.astype(self.kind))
        self.edges = {int(x): (int(np.searchsorted(self.labels, x)), int(np.searchsorted(self.labels, x, "right")))
                      for x in np.unique(self.labels)}

    def scan(self, query: np.ndarray, keep: np.ndarray, drop) -> tuple[np.ndarray, np.ndarray]:
        """(ids, exact scores) of the rows of ``keep`` (positions) that survive
        ``drop(least, greatest)``, which marks rows that cannot be in the result."""
        dims = self.dims
        d = min(len(query), len(dims))
        query = np.asarray(query[:d])
        kind = self.kind
        if kind is np.float64 and int(np.abs(query).max(initial=0)) * self.most * max(1, d) >= 2 ** 53:
            kind = np.int64
        query = query.astype(kind)
        order = np.argsort(-np.abs(query), kind="stable")
        order = order[query[order] != 0]
        if not len(keep):
            return self.ids[:0], np.empty(0, np.int64)
        whole = len(keep) == dims.shape[1]
        part = dims[order] if whole else dims[order][:, keep]
        part = part.astype(kind, copy=False)
        a, b = query[order] * part.min(axis=1), query[order] * part.max(axis=1)
        rest_low = np.concatenate((np.cumsum(np.minimum(a, b)[::-1])[::-1], [0])).astype(kind)
        rest_high = np.concatenate((np.cumsum(np.maximum(a, b)[::-1])[::-1], [0])).astype(kind)
        score = np.zeros(len(keep), kind)
        alive = np.ones(len(keep), bool)
        for at in range(0, len(order), STEP):
            to = min(at + STEP, len(order))
            score += query[order[at:to]] @ part[at:to]
            if to == len(order):
                break
            gone = drop(score + rest_low[to], score + rest_high[to], alive)
            alive &= ~gone
            left = int(np.count_nonzero(alive))
            if not left:
                return self.ids[:0], np.empty(0, np.int64)
            if 2 * left <= len(alive):  # gather what is left
                keep, score, part, alive = keep[alive], score[alive], part[:, alive], np.ones(left, bool)
        return self.ids[keep[alive]], score[alive].astype(np.int64)

    def same_label(self, anchor: int, label: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.edges.get(label, (0, 0))
        keep = np.arange(lo, hi)
        keep = keep[self.ids[lo:hi] != anchor]

        def drop(least, greatest, alive):
            return greatest < kth(least, alive, k)

        return first(*self.scan(query, keep, drop), k)

    def in_windows(self, label: int, query: np.ndarray, lows: np.ndarray, highs: np.ndarray, k: int) -> list[tuple]:
        """Per window the first k rows of other labels with low <= score <= high."""
        lo, hi = self.edges.get(label, (0, 0))
        keep = np.concatenate((np.arange(lo), np.arange(hi, len(self.ids))))

        def drop(least, greatest, alive):
            out = np.ones(len(least), bool)
            for low, high in zip(lows, highs):
                sure = alive & (least >= low) & (greatest <= high)
                out &= (greatest < max(low, kth(least, sure, k))) | (least > high)
            return out

        if not (lows <= highs).any():
            return [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in lows]
        ids, score = self.scan(query, keep, drop)
        return [first(ids[ok := (score >= low) & (score <= high)], score[ok], k) for low, high in zip(lows, highs)]


def kth(values: np.ndarray, mask: np.ndarray, k: int):
    """The k-th largest of the marked values (minus infinity if there are fewer)."""
    chosen = values[mask]
    return -math.inf if len(chosen) < k else np.partition(chosen, len(chosen) - k)[len(chosen) - k]


def first(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k by descending score, then ascending id."""
    if len(ids) > 4 * k:
        ok = score >= np.partition(score, len(score) - k)[len(score) - k]
        ids, score = ids[ok], score[ok]
    order = np.lexsort((ids, -score))[:k]
    return ids[order], score[order]


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, vector (integers) of the rows that take part, one per vec_id."""
    x = F.col("embedding")
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~F.exists(
        x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    label = F.col("label").cast("long")
    # clamped before the cast: larger values have no long
    whole = F.transform(x, lambda v: F.least(F.greatest(F.floor(F.least(F.greatest(
        v.cast("double") * SCALE, F.lit(-2.0 * LIMIT)), F.lit(2.0 * LIMIT))), F.lit(-LIMIT)), F.lit(LIMIT)).cast("int"))
    rows = embeddings.where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), whole.alias("vector"))
    best = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return best.select("vec_id", "row.label", "row.vector")


def _visit(rows: DataFrame, visitors: DataFrame, blocks: int, width: int, work, schema: str) -> DataFrame:
    """``work(block, visitor rows)`` for all visitors (who, label, vector, tops)
    at all blocks; a task keeps one block and a batch of visitors."""
    n = shuffle_partitions(rows.sparkSession)
    here = rows.select("block", F.lit(0).alias("kind"), F.col("vec_id").alias("who"), "label", "vector",
                       F.array().cast("array<long>").alias("tops"))
    there = visitors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"),
                            "who", "label", "vector", "tops")

    def matrix(column: pa.ListArray, wide: int) -> np.ndarray:
        sizes = np.diff(column.offsets.to_numpy())
        out = np.zeros((len(sizes), wide), np.int32)
        out[np.arange(wide)[None, :] < sizes[:, None]] = column.flatten().to_numpy()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, parts = None, None, []
        for b in batches:
            number = b.column("block").to_numpy()
            kind = b.column("kind").to_numpy()
            cuts = np.flatnonzero(np.diff(number) | np.diff(kind)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(number)]):
                piece = b.slice(lo, hi - lo)
                if number[lo] != at:
                    at, block, parts = number[lo], None, []
                who, label = piece.column("who").to_numpy(), piece.column("label").to_numpy()
                vectors = matrix(piece.column("vector"), width)
                if kind[lo] == 0:
                    parts.append((who, label, vectors))
                    continue
                if block is None and parts:
                    block, parts = Block(*map(np.concatenate, zip(*parts))), []
                if block is not None:
                    yield from work(block, who, label, vectors, piece.column("tops").to_pylist())

    together = here.unionByName(there).repartition(n, "block").sortWithinPartitions("block", "kind")
    return together.mapInArrow(run, schema)


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k (score, vec_id) of each key with their rank; a key has at
    most k rows a block."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``embeddings`` has vec_id, label and embedding; other columns are ignored.
    Rows with a null vec_id, label, vector or any null or non-finite component
    take no part.  Of rows that share a vec_id the one with the smallest label,
    then vector, takes part.  Components are clamped to 65,536 in magnitude.
    Missing components of shorter vectors count as zero (an empty vector scores
    0 with all).  Ties go to the smaller vec_id.  Where no row takes part, or no
    anchor, the result is empty.
    """
    spark = embeddings.sparkSession
    small_batches(spark)
    size = quantised(embeddings)
    size = pin(size, "rows")
    stats = size.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    n, width = stats["n"], max(1, stats["width"] or 1)
    blocks = max(1, -(-n * width // BLOCK_CELLS), min(-(-n // LEAST_ROWS), SPREAD))
    rows = size.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    anchors = size.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "who")

    def batch(*columns) -> pa.RecordBatch:
        names = ["anchor", "top", "vec_id", "score"]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in columns], names)

    def find_positives(block, who, label, vectors, _tops):
        found = [block.same_label(a, lab, q, positives) for a, lab, q in zip(who.tolist(), label.tolist(), vectors)]
        sizes = [len(i) for i, _ in found]
        yield batch([np.repeat(who, sizes)], [np.zeros(sum(sizes), np.int64)], [i for i, _ in found], [s for _, s in found])

    def find_negatives(block, who, label, vectors, tops):
        out = []
        for a, lab, q, top in zip(who.tolist(), label.tolist(), vectors, tops):
            highs = np.array(top, np.int64)
            for j, (ids, score) in enumerate(block.in_windows(lab, q, -(-4 * highs // 5), highs, negatives)):
                if len(ids):
                    out.append((np.full(len(ids), a), np.full(len(ids), j), ids, score))
        if out:
            yield batch(*zip(*out))

    schema = "anchor long, top long, vec_id long, score long"
    near = pin(_ranked(_visit(rows, anchors.withColumn("tops", F.array().cast("array<long>")), blocks, width, find_positives, schema),
                       ["anchor"], positives).select(F.col("anchor").alias("who"), "rank", "vec_id", "score"), "positives")
    tops = near.groupBy("who").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).getField("score").alias("tops"))
    asking = pin(anchors.join(tops, "who"), "anchors")
    far = _ranked(_visit(rows, asking, blocks, width, find_negatives, schema), ["anchor", "top"], negatives)
    far = far.select(F.col("anchor").alias("who"), (F.col("top") + 1).alias("place"), F.col("rank").alias("at"),
                     F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return far.join(near.withColumnRenamed("rank", "place"), ["who", "place"]).select(
        F.col("who").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.col("at").cast("int").alias("rank"), "negative_id",
        F.col("score").alias("positive_score"), "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP11_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5
"""
