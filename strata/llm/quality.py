"""Quality rules: an isolation forest on rule statistics (op 3).

Each document is reduced to counts; ratios of them are the forest's features.
Trees split random features at random values over draws of DRAW rows, as is
the method; every labelled row is equally likely in each draw.  Short path
lengths mark anomalous documents.  How often a feature is split on and the
score from which a document goes come from all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import roc_auc
from ..operators.prefix import running_total, with_row_number
from .common import documents, pin, small_batches

TREES, DRAW = 150, 256
#: Share of label-0 rows in a draw, and the share of label-1 rows that may go.
CONTAMINATION, MAX_LOSS = 0.025, 0.01
SYMBOLS = "#*$%&|<>"
_SYMBOL_CODES = np.frombuffer(SYMBOLS.encode(), np.uint8)
_WS_CODES = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_lines", "n_upper", "n_digits", "n_bangs", "n_distinct"]


def repeated_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    m = int(ids.max()) + 1
    pair = np.unique(ids[:-1] * m + ids[1:], return_inverse=True)[1] if m >= 2_000_000 else ids[:-1] * m + ids[1:]
    _, inv, cnt = np.unique(pair[:-1] * m + ids[2:], return_inverse=True, return_counts=True)
    twice = cnt[inv] >= 2
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k:n - 2 + k] |= twice
    return int(hit.sum())


def rule_stats(text: str | None) -> list[int]:
    """STATS of one text (null: the empty text, all 0 but for its one line)."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=128)
    lines = raw.split(b"\n")
    full = [x for x in lines if x.strip()]
    return [len(words), len(text) - int(count[_WS_CODES].sum()), int(count[_SYMBOL_CODES].sum()),
            len(full) - len(set(full)), repeated_words(ids), len(lines), int(count[65:91].sum()),
            int(count[48:58].sum()), int(count[33]), len(seen)]


def rule_features(s: np.ndarray) -> np.ndarray:
    """Ratios from an (n, len(STATS)) array of counts, on log scales: random
    cuts are uniform between the extremes of a draw."""
    c = {k: s[:, i].astype(float) for i, k in enumerate(STATS)}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.column_stack([
        np.log1p(50 * c["n_symbols"] / words), np.log1p(5 * c["n_dup_lines"] / np.maximum(c["n_lines"], 1)),
        np.log1p(5 * c["n_repeat_words"] / words), np.log(chars / words), np.log1p(5 * c["n_upper"] / chars),
        np.log1p(5 * c["n_digits"] / chars), np.log1p(50 * c["n_bangs"] / words),
        np.log1p(c["n_distinct"]) / np.log1p(words)])


FEATURES = ["symbols", "dup_lines", "repeats", "word_length", "upper", "digits", "bangs", "variety"]


def split_weights(auc: np.ndarray) -> np.ndarray:
    """How often a feature is split on: by how well it tells the labels apart
    (twice the distance of its AUC from one half), with a floor for all."""
    w = 0.05 + np.abs(2 * auc - 1)
    return w / w.sum()


def rule_weights(rows: DataFrame) -> np.ndarray:
    """``split_weights`` of FEATURES from all of ``rows`` (STATS, _q): exact
    AUCs, by running totals over ranges of each feature's values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = rule_features(np.column_stack([b.column(c).to_numpy() for c in STATS]))
            yield pa.RecordBatch.from_arrays([b.column("_q"), *(pa.array(x[:, i]) for i in range(x.shape[1]))],
                                             ["_q", *FEATURES])

    x = rows.select("_q", *STATS).mapInArrow(run, "_q int, " + ", ".join(f"{c} double" for c in FEATURES))
    long = x.unpivot([(1 - F.col("_q")).alias("junk")], FEATURES, "feature", "value")
    auc = {r["feature"]: r["roc_auc"] for r in roc_auc(long, "junk", "value", ["feature"]).collect()}
    return split_weights(np.array([0.5 if auc.get(c) is None else auc[c] for c in FEATURES]))


def _norm(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def tree_draws(n_clean: int, n_junk: int, trees: int = TREES, draw: int = DRAW, seed: int = 7):
    """(clean, junk) row numbers of each tree's draw, without repeats."""
    rng = np.random.default_rng(seed)
    bad = min(n_junk, int(round(draw * CONTAMINATION)))
    return [(rng.choice(n_clean, min(n_clean, draw - bad), replace=False),
             rng.choice(n_junk, bad, replace=False) if bad else np.empty(0, np.int64)) for _ in range(trees)]


def grow_forest(clean: np.ndarray, junk: np.ndarray, trees: int = TREES, draw: int = DRAW, seed: int = 7,
                draws=None, weight: np.ndarray | None = None):
    """Flat trees: (feature, cut, left child, path length at a leaf).  ``draws``
    are row numbers in ``clean`` and ``junk`` (by default ``tree_draws`` of
    them), ``weight`` the features' (by default equal)."""
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(draw))) + 3
    forest = []
    draws = tree_draws(len(clean), len(junk), trees, draw, seed) if draws is None else draws
    weight = np.full(clean.shape[1], 1 / clean.shape[1]) if weight is None else weight
    for at_clean, at_junk in draws:
        x = np.vstack([clean[at_clean], junk[at_junk]])
        nodes: list[list[float]] = [[-1, 0.0, 0, 0.0]]
        todo = [(0, x, 0)]
        while todo:
            at, rows, depth = todo.pop()
            lo, hi = rows.min(0), rows.max(0)
            wide = np.flatnonzero(hi > lo)
            if depth >= limit or len(rows) <= 1 or not len(wide):
                nodes[at] = [-1, 0.0, at, depth + _norm(len(rows))]
                continue
            f = int(rng.choice(wide, p=weight[wide] / weight[wide].sum()))
            cut = rng.uniform(lo[f], hi[f])
            nodes[at] = [f, cut, len(nodes), 0.0]
            left = rows[:, f] < cut
            todo += [(len(nodes), rows[left], depth + 1), (len(nodes) + 1, rows[~left], depth + 1)]
            nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
        # a side that got no row is a leaf at once
        forest.append(tuple(np.array(c) for c in zip(*nodes)))
    return forest, limit, _norm(max(map(sum, ((len(c), len(j)) for c, j in draws))))


def anomaly(x: np.ndarray, model) -> np.ndarray:
    """Scores in (0, 1): 2 to the minus mean path length over its norm."""
    forest, limit, norm = model
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for feature, cut, child, length in forest:
        feature, child = feature.astype(int), child.astype(int)
        at = np.zeros(len(x), int)
        for _ in range(limit + 1):
            f = feature[at]
            at = np.where(f < 0, at, child[at] + (x[rows, np.maximum(f, 0)] >= cut[at]))
        total += length[at]
    return 2.0 ** (-(total / len(forest)) / max(norm, 1e-9))


def base_failed(n_words, n_repeat_words):
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def drawn_forest(rows: DataFrame, n_clean: int, n_junk: int):
    """The forest over ``rows`` (STATS, _q).  Rows are numbered by label in an
    order of hashes, so the draws are the same in whatever order they come;
    only drawn rows, at most TREES times DRAW, are fetched."""
    draws = tree_draws(n_clean, n_junk)
    wanted = [np.unique(np.concatenate([d[i] for d in draws])) for i in (0, 1)]
    places = pa.table({"_q": pa.array(np.repeat([1, 0], [len(w) for w in wanted]).astype(np.int32)),
                       "_at": pa.array(np.concatenate(wanted).astype(np.int64))})
    numbered = with_row_number(rows, [], "_at", 0, ["_q"])
    drawn = numbered.join(F.broadcast(rows.sparkSession.createDataFrame(places)), ["_q", "_at"])
    table = np.array([tuple(r) for r in drawn.select("_q", "_at", *STATS).collect()], np.int64).reshape(-1, len(STATS) + 2)
    table = table[np.argsort(table[:, 1])]
    clean, junk = (rule_features(table[table[:, 0] == q][:, 2:]) for q in (1, 0))
    draws = [tuple(np.searchsorted(w, d) for w, d in zip(wanted, pair)) for pair in draws]
    return grow_forest(clean, junk, draws=draws, weight=rule_weights(rows))


def fit_threshold(scores: DataFrame, n_clean: int, n_junk: int) -> float:
    """The score up to which documents stay, from all of ``scores`` (anomaly,
    _q): the cut that catches most of the junk less three times the share of
    clean rows lost, among the cuts that lose at most MAX_LOSS of those."""
    q = F.col("_q")
    per = scores.groupBy("anomaly").agg(F.sum(q.cast("long")).alias("good"), F.sum((1 - q).cast("long")).alias("bad"))
    least = int(np.ceil((1 - MAX_LOSS) * (n_clean - 1))) + 1
    tail = running_total(per, ["anomaly"], "good", output="upto").where(F.col("upto") >= least)
    # shares in whole numbers: times both classes' sizes
    worth = n_clean * F.col("bad") - 3 * max(n_junk, 1) * F.col("good")
    gains = pin(running_total(tail.select("anomaly", worth.alias("worth")), ["anomaly"], "worth", output="below", total="all")
                .select("anomaly", (F.col("all") - F.col("below")).alias("gain")), "cuts")
    best = -gains.agg(F.max(F.struct("gain", (-F.col("anomaly")).alias("cut"))).alias("m")).first()["m"]["cut"]
    # halfway to the next score above, so that neither class sits on the edge
    above = gains.where(F.col("anomaly") > best).agg(F.min("anomaly").alias("a")).first()["a"]
    return (best + (1.0 if above is None else above)) / 2


def fit_quality(rows: DataFrame):
    """(forest, threshold) from ``rows`` (STATS, _q: quality label 0 or 1), all
    of which passed the rules.  Without label-1 rows there is no forest and the
    rules alone decide."""
    n = {r["_q"]: r["count"] for r in rows.groupBy("_q").count().collect()}
    n_clean, n_junk = n.get(1, 0), n.get(0, 0)
    if n_clean < 8:
        return None, 1.0
    model = drawn_forest(rows, n_clean, n_junk)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.column_stack([b.column(c).to_numpy() for c in STATS])
            a = anomaly(rule_features(s), shared.value) if len(s) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("_q"), pa.array(a)], ["_q", "anomaly"])

    scores = rows.select("_q", *STATS).mapInArrow(run, "_q int, anomaly double")
    return model, fit_threshold(scores, n_clean, n_junk)


def document_stats(docs: DataFrame) -> DataFrame:
    """(doc_id, STATS...) for every row; whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.array([rule_stats(t) for t in b.column(1).to_pylist()], np.int64).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(s[:, i]) for i in range(len(STATS)))],
                                             ["doc_id", *STATS])

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {doc_id}, " + ", ".join(f"{c} long" for c in STATS))


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, STATS..., base_failed, anomaly, kept) for every row.

    Null and empty texts have no words and fail the rules; unlabelled tables
    leave the verdict to the rules; rows repeated under one doc_id are judged
    each by its own text.
    """
    small_batches(docs.sparkSession)
    stats = pin(document_stats(docs), "stats")
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("_q"))
    passed = stats.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    rows = pin(passed.join(known, "doc_id").select(*STATS, F.col("_q").cast("int").alias("_q")), "labelled")
    model, threshold = fit_quality(rows)
    shared = docs.sparkSession.sparkContext.broadcast((model, threshold))
    names = stats.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, threshold = shared.value
        for b in batches:
            s = np.column_stack([b.column(names.index(c)).to_numpy() for c in STATS])
            fails = base_failed(s[:, 0], s[:, 4])
            a = anomaly(rule_features(s), model) if model and len(s) else np.zeros(len(s))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(fails), pa.array(a), pa.array(~fails & (a <= threshold))],
                [*names, "base_failed", "anomaly", "kept"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema.fields)
    return stats.mapInArrow(run, f"{schema}, base_failed boolean, anomaly double, kept boolean")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "anomaly")
