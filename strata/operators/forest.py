"""Random forests grown tree by tree in tasks.

The method is Spark's: features cut into at most BINS bins, a Poisson(1) draw of
every row for every tree, a random subset of features per node, weighted Gini or
variance gain, two drawn rows a child at least, subtrees of one prediction merged.

Spark's own trainer runs a job per group of nodes and keeps all trees as objects
on the driver.  Here equal binned rows are counted first (a row counted n times
is drawn Poisson(n) times: the sum of its draws), packed into blocks of bytes and
sent once to each of a few groups of trees; a task grows its trees one after the
other and writes them as arrays.  Trees stay a table: scoring sends the distinct
binned rows to the groups of trees and adds up what they say.

A task holds all distinct binned rows, (features + 24) bytes each, and the arrays
of the tree it grows; ``fit`` gives no forest if they are more than TASK_BYTES.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.tree import _RandomForestParams
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import pinned

#: Bins of a feature; drawn rows a child has at least; rows of a block; nodes looked at together.
BINS, LEAST, BLOCK_ROWS, NODES = 32, 2, 20_000, 4096
#: Bytes of distinct binned rows that a task may hold (growing a tree takes some five times as many).
TASK_BYTES = 64 << 20
#: Share of the target's spread below which a gain counts as rounding.
NOISE = 1e-12
_TREE = "tree int, feature binary, cut binary, left binary, value binary, importance binary"
_KEY = "_forest_key"


# ------------------------------------------------------------------- bins

def bin_cuts(rows: DataFrame, size: int) -> list[list[float]]:
    """Per feature the values that end a bin (the last bin has none): all but the
    largest value where a feature has at most BINS, else its BINS-quantiles."""
    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = [np.empty(0)] * size
        for b in batches:
            x = _matrix(b.column(0), size)
            for f in range(size):
                if len(seen[f]) <= BINS:
                    seen[f] = np.unique(np.concatenate((seen[f], x[:, f])))[:BINS + 1]
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([s.tolist() for s in seen], pa.list_(pa.float64()))], ["f", "v"])

    values = {r["f"]: r["v"] for r in rows.select("x").mapInArrow(few, "f int, v array<double>").groupBy("f")
              .agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("v")))), 1, BINS + 1).alias("v")).collect()}
    many = [f for f in range(size) if len(values.get(f, [])) > BINS]
    cuts = [values.get(f, [])[:-1] for f in range(size)]
    if many:
        at = [i / BINS for i in range(1, BINS)]
        row = rows.agg(*[F.percentile_approx(F.col("x")[f], at, 10_000).alias(str(f)) for f in many],
                       *[F.max(F.col("x")[f]).alias(f"top{f}") for f in many]).first()
        for f in many:
            cuts[f] = sorted(set(row[str(f)]) - {row[f"top{f}"]})
    return cuts


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _binned(cuts: list[list[float]], x: Column) -> Column:
    """The bins of the features as bytes, one a feature."""
    ends = [np.array(c) for c in cuts]

    @F.pandas_udf("binary")
    def key(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype=object)
        m = np.stack(rows.to_numpy())
        out = np.empty(m.shape, np.uint8)
        for f, e in enumerate(ends):
            out[:, f] = np.searchsorted(e, m[:, f])
        return pd.Series([r.tobytes() for r in out])

    return key(x)


# ------------------------------------------------------------------ growing

def grow(keys: np.ndarray, target: np.ndarray, weight: np.ndarray, n: np.ndarray, tree: int, seed: int, max_depth: int,
         subset: int, spread: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature or -1, cut, left child, value, importance) of one tree; the right
    child follows the left one.  ``target`` has a column per class (0 or 1) or the
    one centred number; a row of ``keys`` stands for ``n`` equal rows."""
    rng = np.random.default_rng([seed, tree])
    size, classes = keys.shape[1], target.shape[1]
    drawn = rng.poisson(n)
    at = np.flatnonzero(drawn)
    k, c = keys[at], drawn[at].astype(np.float64)
    w = c * weight[at]
    t = [target[at, j] * w for j in range(classes)]
    square = None if classes > 1 else t[0] * target[at, 0]
    bounds = np.array([0, len(at)])
    levels, offset = [], 0
    for depth in range(max_depth + 1):
        m = len(bounds) - 1
        if not m:
            break
        node = np.repeat(np.arange(m), np.diff(bounds))
        total = lambda x: np.bincount(node, x, m)  # noqa: E731, B023
        cn, wn, tn = total(c), total(w), [total(x) for x in t]
        safe = np.maximum(wn, 1e-300)
        power = sum(x * x for x in tn) / safe
        impure = (wn if square is None else total(square)) - power
        level = {"feature": np.full(m, -1, np.int32), "cut": np.zeros(m, np.uint8), "left": np.zeros(m, np.int32),
                 "value": np.stack([x / safe for x in tn], 1), "gain": np.zeros(m)}
        levels.append(level)
        offset += m
        open_ = (cn >= 2 * LEAST) & (impure > NOISE * spread * wn) & (depth < max_depth)
        best = np.full(m, -1.0)
        for lo in range(0, m, NODES):
            hi = min(m, lo + NODES)
            ask = np.flatnonzero(open_[lo:hi])
            if not len(ask):
                continue
            a, b = bounds[lo], bounds[hi]
            use = open_[node[a:b]]
            where = (np.cumsum(open_[lo:hi]) - 1)[node[a:b][use] - lo]
            kk, cc, ww, tt = k[a:b][use], c[a:b][use], w[a:b][use], [x[a:b][use] for x in t]
            plain = np.array_equal(cc, ww)
            ids = ask + lo
            picked = None if subset >= size else np.argpartition(rng.random((len(ask), size)), subset - 1, axis=1)[:, :subset]
            for j in range(subset):
                f = np.full(len(ask), j) if picked is None else picked[:, j]
                cells = where * BINS + (kk[:, j] if picked is None else kk[np.arange(len(kk)), f[where]])

                def run(x: np.ndarray) -> np.ndarray:
                    return np.cumsum(np.bincount(cells, x, len(ask) * BINS).reshape(-1, BINS), axis=1)[:, :-1]  # noqa: B023

                cl = run(cc)
                wl = cl if plain else run(ww)
                tl = [run(x) for x in tt[:max(1, classes - 1)]]
                if classes > 1:
                    tl.append(wl - sum(tl))
                wr = wn[ids][:, None] - wl
                ok = (cl >= LEAST) & (cn[ids][:, None] - cl >= LEAST)
                gain = sum(x * x for x in tl) / np.where(ok, wl, 1) \
                    + sum((y[ids][:, None] - x) ** 2 for x, y in zip(tl, tn)) / np.where(ok, wr, 1)
                gain = np.where(ok, gain - power[ids][:, None], -1.0)
                top = gain.argmax(axis=1)
                g = gain[np.arange(len(ask)), top]
                better = g > np.maximum(best[ids], NOISE * spread * wn[ids])
                best[ids[better]] = g[better]
                level["feature"][ids[better]], level["cut"][ids[better]] = f[better], top[better]
        split = level["feature"] >= 0
        level["gain"][split] = best[split]
        level["left"][split] = offset + 2 * np.arange(split.sum())
        use = split[node]
        node = (np.cumsum(split) - 1)[node[use]]
        k, c, w, t = k[use], c[use], w[use], [x[use] for x in t]
        square = square if square is None else square[use]
        right = k[np.arange(len(k)), level["feature"][split][node]] > level["cut"][split][node]
        child = 2 * node + right
        order = np.argsort(child, kind="stable")
        k, c, w, t = k[order], c[order], w[order], [x[order] for x in t]
        square = square if square is None else square[order]
        bounds = np.concatenate(([0], np.cumsum(np.bincount(child, minlength=2 * split.sum())))).astype(np.int64)
    return _merged(levels, size, classes > 1)


def _merged(levels: list[dict], size: int, by_class: bool) -> tuple[np.ndarray, ...]:
    """The tree with subtrees of one prediction merged, its nodes numbered anew."""
    feature, cut, left, value, gain = (np.concatenate([x[name] for x in levels]) for name in ("feature", "cut", "left", "value", "gain"))
    says = value.argmax(axis=1) if by_class else value[:, 0]
    ends = np.cumsum([len(x["feature"]) for x in levels])
    for lo, hi in zip(ends[-2::-1] - [len(x["feature"]) for x in levels[-2::-1]], ends[-2::-1]):
        ids = lo + np.flatnonzero(feature[lo:hi] >= 0)
        le = left[ids]
        feature[ids[(feature[le] < 0) & (feature[le + 1] < 0) & (says[le] == says[le + 1])]] = -1
    keep = np.zeros(len(feature), bool)
    keep[0] = True
    for lo, hi in zip(np.concatenate(([0], ends[:-1])), ends):
        le = left[lo:hi][keep[lo:hi] & (feature[lo:hi] >= 0)]
        keep[le] = keep[le + 1] = True
    new = np.cumsum(keep) - 1
    inner = feature >= 0
    importance = np.bincount(feature[keep & inner], gain[keep & inner], size)
    left = np.where(inner, new[left], 0)
    return feature[keep], cut[keep], left[keep].astype(np.int32), value[keep], importance / (importance.sum() or 1.0)


def walk(tree: tuple[np.ndarray, ...], keys: np.ndarray) -> np.ndarray:
    """The leaf of every row of ``keys``."""
    feature, cut, left = tree[:3]
    node, rows = np.zeros(len(keys), np.int32), np.arange(len(keys))
    while len(rows):
        f = feature[node[rows]]
        rows, f = rows[f >= 0], f[f >= 0]
        at = node[rows]
        node[rows] = left[at] + (keys[rows, f] > cut[at])
    return node


# ------------------------------------------------------------------ fitting

def fit(ready: DataFrame, features: str, label: str, weight: str | None, classes: int, num_trees: int, seed: int, max_depth: int,
        subset: str) -> ForestModel | None:
    """The forest of the rows of ``ready`` (``classes`` 0: of a number), or None if
    its distinct binned rows are more than a task may hold."""
    rows = ready.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"),
                        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))
    first = rows.first()
    if first is None:
        return None
    size = len(first["x"])
    cuts = bin_cuts(rows, size)
    rows = pinned(rows.select(_binned(cuts, F.col("x")).alias("k"), "y", "w").groupBy("k", "y", "w").agg(F.count(F.lit(1)).alias("n")))
    facts = rows.agg(F.count(F.lit(1)).alias("g"), (F.sum(F.col("y") * F.col("n")) / F.sum("n")).alias("m"),
                     F.sum("n").alias("n")).first()
    if facts["g"] * (size + 24) > TASK_BYTES:
        return None
    mean = 0.0 if classes else float(f"{facts['m']:.6g}")  # any number near it will do, but the same one in every run
    spread = 1.0 if classes else rows.agg(F.sum(F.col("n") * (F.col("y") - mean) ** 2)).first()[0] / facts["n"]
    blocks = pinned(_packed(rows, ["k", "y", "w", "n"]))
    per_node = size if subset == "all" else int(np.ceil(np.sqrt(size)))
    groups = min(num_trees, 2 * ready.sparkSession.sparkContext.defaultParallelism)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for b in batches:
            for r in b.to_pylist():
                parts.setdefault(r["_group"], []).append(r)
        for group, got in parts.items():
            k = np.concatenate([np.frombuffer(r["k"], np.uint8).reshape(-1, size) for r in got])
            y, w, n = (np.concatenate([np.frombuffer(r[c], d) for r in got]) for c, d in (("y", np.float64), ("w", np.float64), ("n", np.int64)))
            got.clear()
            order = np.lexsort((w, y, *k.T))  # the same draws however the rows were dealt
            k, y, w, n = k[order], y[order], w[order], n[order]
            target = np.eye(classes)[y.astype(int)] if classes else (y - mean)[:, None]
            for tree in range(group, num_trees, groups):
                feature, cut, left, value, importance = grow(k, target, w, n, tree, seed, max_depth, per_node, spread)
                yield pa.RecordBatch.from_pylist([{"tree": tree, "feature": feature.tobytes(), "cut": cut.tobytes(), "left": left.tobytes(),
                                                   "value": (value + mean).tobytes(), "importance": importance.tobytes()}], _schema())

    trees = pinned(_dealt(blocks, groups).mapInArrow(work, _TREE))
    return ForestModel._of(trees, cuts, classes, num_trees, seed, max_depth, subset, features)


def _schema() -> pa.Schema:
    return pa.schema([("tree", pa.int32()), *[(c, pa.binary()) for c in ("feature", "cut", "left", "value", "importance")]])


def _packed(rows: DataFrame, names: list[str]) -> DataFrame:
    """(block, a column of bytes per name): up to BLOCK_ROWS rows a record; a
    binary column's values are joined, a number's are its 8 bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(lo, BLOCK_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(c.to_pylist()) if pa.types.is_binary(c.type) else c.to_numpy(zero_copy_only=False).tobytes()], pa.binary())
                                                  for c in part.columns], names)

    return rows.select(*names).mapInArrow(run, ", ".join(f"{c} binary" for c in names)).withColumn("block", F.monotonically_increasing_id())


def _dealt(blocks: DataFrame, groups: int) -> DataFrame:
    """Every block once for each group of trees, a group a task."""
    return blocks.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartitionById(groups, "_group")


# -------------------------------------------------------------------- model

class ForestModel(Model, _RandomForestParams, HasFeaturesCol, HasPredictionCol, HasRawPredictionCol, HasProbabilityCol, MLWritable, MLReadable):
    """A forest whose trees are a table; ``classes`` 0 is a regression."""

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", rawPredictionCol="rawPrediction", probabilityCol="probability",
                         minInstancesPerNode=LEAST, maxBins=BINS, cacheNodeIds=True)

    @classmethod
    def _of(cls, trees: DataFrame, cuts: list[list[float]], classes: int, num_trees: int, seed: int, max_depth: int, subset: str,
            features: str) -> ForestModel:
        model = cls()
        model._set(numTrees=num_trees, seed=seed, maxDepth=max_depth, featureSubsetStrategy=subset, featuresCol=features)
        model.trees, model.cuts, model.numClasses = trees, cuts, classes
        return model

    @property
    def numFeatures(self) -> int:
        return len(self.cuts)

    @property
    def featureImportances(self) -> DenseVector:
        each = [np.frombuffer(r["importance"]) for r in self.trees.orderBy("tree").select("importance").toLocalIterator()]
        total = np.sum(each, axis=0)
        return DenseVector(total / (total.sum() or 1.0))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Computes ``dataset`` once; its distinct binned rows are scored."""
        keyed = pinned(dataset.withColumn(_KEY, _binned(self.cuts, vector_to_array(self.getFeaturesCol()))))
        scored = pinned(self._scores(keyed.select(_KEY).distinct()))
        out = keyed.join(scored, _KEY, "left")
        trees = self.getNumTrees()
        if not self.numClasses:
            return out.withColumn(self.getPredictionCol(), F.col("_sum")[0] / trees).drop("_sum", _KEY)
        best = (F.array_position("_sum", F.array_max("_sum")) - 1).cast("double")
        return out.withColumns({self.getRawPredictionCol(): array_to_vector("_sum"),
                                self.getProbabilityCol(): array_to_vector(F.transform("_sum", lambda v: v / trees)),
                                self.getPredictionCol(): best}).drop("_sum", _KEY)

    def _scores(self, keys: DataFrame) -> DataFrame:
        """(key, _sum: what the trees say, added up), by groups of trees."""
        size, width = self.numFeatures, max(1, self.numClasses)
        blocks = pinned(_packed(keys, [_KEY]))
        groups = min(self.getNumTrees(), 2 * keys.sparkSession.sparkContext.defaultParallelism)
        trees = self.trees.select(F.pmod("tree", F.lit(groups)).alias("_group"), F.lit(-1).cast("long").alias("block"), "tree", F.lit(None).cast("binary").alias(_KEY),
                                  "feature", "cut", "left", "value")
        ask = blocks.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        both = trees.unionByName(ask, allowMissingColumns=True).repartitionById(groups, "_group").sortWithinPartitions("_group", "block", "tree")

        def say(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forest: list = []
            for b in batches:
                for i in range(b.num_rows):
                    r = b.slice(i, 1).to_pylist()[0]
                    if r[_KEY] is None:
                        forest.append((np.frombuffer(r["feature"], np.int32), np.frombuffer(r["cut"], np.uint8), np.frombuffer(r["left"], np.int32),
                                       np.frombuffer(r["value"]).reshape(-1, width)))
                        continue
                    k = np.frombuffer(r[_KEY], np.uint8).reshape(-1, size)
                    total = np.zeros((len(k), width))
                    for tree in forest:
                        total += tree[3][walk(tree, k)]
                    yield pa.RecordBatch.from_arrays([pa.array([r["block"]], pa.int64()), pa.array([r["_group"]], pa.int32()),
                                                      pa.array([r[_KEY] if r["_group"] == 0 else None], pa.binary()), pa.array([total.tobytes()], pa.binary())],
                                                     ["block", "_group", _KEY, "part"])

        parts = both.mapInArrow(say, f"block long, _group int, {_KEY} binary, part binary")

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last = k = total = None

            def done() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([bytes(x) for x in k], pa.binary()), pa.array(total.reshape(-1, width).tolist(), pa.list_(pa.float64()))],
                                                  [_KEY, "_sum"])

            for b in batches:
                for i in range(b.num_rows):
                    r = b.slice(i, 1).to_pylist()[0]
                    if r["block"] != last:
                        if last is not None:
                            yield done()
                        last, k, total = r["block"], np.frombuffer(r[_KEY], np.uint8).reshape(-1, size), np.frombuffer(r["part"]).copy()
                    else:
                        total += np.frombuffer(r["part"])
            if last is not None:
                yield done()

        return parts.repartition("block").sortWithinPartitions("block", "_group").mapInArrow(add, f"{_KEY} binary, _sum array<double>")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: ForestModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"cuts": self.model.cuts, "classes": self.model.numClasses})
        self.model.trees.write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = ForestModel()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.trees, model.cuts, model.numClasses = self.sparkSession.read.schema(_TREE).parquet(f"{path}/trees"), meta["cuts"], meta["classes"]
        return model
