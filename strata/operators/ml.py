"""Spark ML training, splitting and scoring.

Fitting runs on executors through ``pyspark.ml`` estimators; splits are
deterministic hash orders numbered with the distributed running count; class
weights are a per-class table (one row per class) joined back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import expressions as X
from strata.operators import forest
from strata.operators.prefix import with_row_number
from strata.operators.quantiles import medians
from strata.session import checkpoint, if_small, pinned


#: Spark's limit on the depth of a tree.
MAX_DEPTH = 30


# ------------------------------------------------------------- preprocessing

def category_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, ties to the smallest (one row each)."""
    out = {}
    for c in columns:
        top = (df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v")).count()
               .orderBy(F.desc("count"), "v").first())
        if top is not None:
            out[c] = top["v"]
    return out


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median per column (one row each, distributed); none for columns without a value."""
    return {r["column"]: r["value"] for r in medians(df, columns).collect()} if columns else {}


def _fill_modes(modes: Mapping[str, str]) -> SQLTransformer:
    def lit(v):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    cols = ", ".join(f"coalesce(CAST(`{c}` AS STRING), {lit(v)}) AS `{c}__cat`" for c, v in modes.items())
    return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")


def _fill_medians(columns: Sequence[str], values: Mapping[str, float]) -> SQLTransformer:
    """Stored medians for missing and NaN cells (0 where a column had no value)."""
    cols = ", ".join(f"coalesce(CASE WHEN NOT isnan(`{c}`) THEN `{c}` END, CAST('{float(values.get(c, 0.0))!r}' AS DOUBLE)) "
                     f"AS `{c}__imp`" for c in columns)
    return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")


def build_preprocessor(numeric: Sequence[str], categorical: Sequence[str],
                       output: str = "features", modes: Mapping[str, str] | None = None,
                       medians: Mapping[str, float] | None = None) -> list:
    """Median impute + standardise numerics (with the sample standard
    deviation); fill NULL categories with ``modes``; index (unknown → extra
    slot that one-hot drops, i.e. all zeros) + one-hot; assemble.

    ``medians`` (``column_medians``) are stored in the pipeline as literals, so
    they are exact and no column's values reach the driver; without them Spark's
    imputer fills the median of a bounded sketch.
    """
    stages = []
    num_out = []
    if numeric:
        imp = [f"{c}__imp" for c in numeric]
        stages.append(Imputer(strategy="median", inputCols=list(numeric), outputCols=imp) if medians is None
                      else _fill_medians(numeric, medians))
        stages.append(VectorAssembler(inputCols=imp, outputCol="_num_vec", handleInvalid="keep"))
        stages.append(StandardScaler(inputCol="_num_vec", outputCol="_num_scaled", withMean=True, withStd=True))
        num_out = ["_num_scaled"]
    cat_out = []
    if categorical:
        idx = [f"{c}__idx" for c in categorical]
        oh = [f"{c}__oh" for c in categorical]
        modes = {c: v for c, v in (modes or {}).items() if c in categorical}
        if modes:
            stages.append(_fill_modes(modes))
        filled = [f"{c}__cat" if c in modes else c for c in categorical]
        stages.append(StringIndexer(inputCols=filled, outputCols=idx, handleInvalid="keep",
                                    stringOrderType="frequencyDesc"))
        # "keep" on the indexer only: unknowns take the last index, which dropLast
        # removes, so an unseen category encodes as all zeros
        stages.append(OneHotEncoder(inputCols=idx, outputCols=oh, dropLast=True))
        cat_out = oh
    stages.append(VectorAssembler(inputCols=num_out + cat_out, outputCol=output))
    return stages


def split_feature_types(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in features:
            (num if isinstance(f.dataType, T.NumericType) else cat).append(f.name)
    return num, cat


def prepare_numeric(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in numeric}) if numeric else df


# -------------------------------------------------------------------- splits

def _ceil_div(n: Column, frac: float) -> Column:
    fr = Fraction(str(frac))  # the decimal text, exactly
    return F.floor((n * F.lit(fr.numerator) + F.lit(fr.denominator - 1)) / F.lit(fr.denominator)).cast("long")


#: Bits of a row's split order that are compared as a number, bits a selection
#: pass looks at, and rows of a group below which they are sorted.
HASH_BITS, PASS_BITS, SORT_ROWS = 60, 14, 10_000


def hash_cuts(rows: DataFrame, by: Sequence[str], wanted: Mapping[str, Column]) -> DataFrame:
    """(by..., n, and per wanted rank ``<name>_h``, ``<name>_id``): the row of that
    rank (1-based, a column over ``n``) in the order of (_h, _id) of each group.

    ``rows`` has by..., _b (the order's leading HASH_BITS as a long), _h and
    _id.  Passes narrow each wanted rank to the slice of _b that holds it, by
    counts per slice (2 ** PASS_BITS a rank and pass, combined map-side); what
    is left is a few rows a rank, which are ordered.  No row moves before that.
    A rank of 0 has no row.
    """
    shift = HASH_BITS - PASS_BITS
    counts = checkpoint(rows.groupBy(*by, F.shiftright("_b", shift).alias("_s")).agg(F.count(F.lit(1)).alias("_c")))
    sizes = counts.groupBy(*by).agg(F.sum("_c").alias("n"))
    ask = sizes.select(*by, "n", F.explode(F.array(*[F.struct(F.lit(k).alias("_w"), v.cast("long").alias("_r"))
                                                      for k, v in wanted.items()])).alias("x")).select(*by, "n", "x.*")
    ask = ask.where("_r > 0").select(*by, "_w", "_r")
    slices = _same(counts, ask, by)
    while True:
        run = Window.partitionBy(*by, "_w").orderBy("_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        at = checkpoint(slices.withColumn("_to", F.sum("_c").over(run)).where((F.col("_to") >= F.col("_r")) & (F.col("_to") - F.col("_c") < F.col("_r")))
                        .select(*by, "_w", "_s", (F.col("_r") - F.col("_to") + F.col("_c")).alias("_r"), "_c"))
        most = at.agg(F.max("_c").alias("m")).first()["m"] or 0
        here = _same(rows.withColumn("_s", F.shiftright("_b", shift)), if_small(at.drop("_c")), [*by, "_s"])
        if most <= SORT_ROWS or shift == 0:
            break
        step = min(PASS_BITS, shift)
        shift -= step
        slices = here.groupBy(*by, "_w", "_r", F.shiftright("_b", shift).alias("_s")).agg(F.count(F.lit(1)).alias("_c"))
    # equal (_h, _id) are counted, so that a repeated id is one row here
    few = here.groupBy(*by, "_w", "_r", "_h", "_id").agg(F.count(F.lit(1)).alias("_c"))
    run = Window.partitionBy(*by, "_w").orderBy("_h", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = few.withColumn("_to", F.sum("_c").over(run)).where((F.col("_to") >= F.col("_r")) & (F.col("_to") - F.col("_c") < F.col("_r")))
    cuts = cut.groupBy(*by).agg(*[x for k in wanted for x in (
        F.max(F.when(F.col("_w") == k, F.col("_h"))).alias(f"{k}_h"), F.max(F.when(F.col("_w") == k, F.col("_id"))).alias(f"{k}_id"))])
    return _same(sizes, cuts, by, "left")


def _same(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, NULL equal to NULL; ``right`` has one row a key and rank."""
    named = right.select(*[F.col(c).alias(f"_k_{c}") if c in by else F.col(c) for c in right.columns])
    return left.join(named, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by], how).drop(*[f"_k_{c}" for c in by])


def stratified_split(df: DataFrame, id_col: str, label: str | None = None, test: float = 0.2,
                     validation: float = 0.25, seed: int = 42, output: str = "split") -> DataFrame:
    """Deterministic per-class split in the order of md5(id ‖ seed) within class:
    the first ⌈test·n⌉ go to test, the next ⌈validation·(n − n_test)⌉ to
    validation, the rest to train.  ``label=None`` gives a plain random split.

    The last row of each part is selected per class (``hash_cuts``); a row's
    part is then a comparison with its class's cuts, and no row is shuffled
    where the cuts (one row a class) are broadcast by their measured size.
    Rows that share an id fall into the same part, so a cut that lies among them
    takes all of them.
    """
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(str(seed))))
    bits = F.conv(F.substring(h, 1, HASH_BITS // 4), 16, 10).cast("long")
    by = ["_class"]
    rows = df.select((F.col(label) if label else F.lit(0)).alias("_class"), bits.alias("_b"), h.alias("_h"), F.col(id_col).alias("_id"))
    n_test = _ceil_div(F.col("n"), test)
    n_val = _ceil_div(F.col("n") - n_test, validation) if validation else F.lit(0)
    cuts = hash_cuts(rows, by, {"test": n_test, "val": n_test + n_val})

    def upto(h_cut: Column, id_cut: Column) -> Column:
        return F.coalesce((F.col("_h") < h_cut) | ((F.col("_h") == h_cut) & (F.col(id_col) <= id_cut)), F.lit(False))

    hashed = df.withColumn("_h", h)
    if label:
        hashed = hashed.join(if_small(checkpoint(cuts.drop("n"))), F.col(label).eqNullSafe(F.col("_class")), "left")
        ends = [(F.col(f"{k}_h"), F.col(f"{k}_id")) for k in ("test", "val")]
    else:
        row = cuts.first()  # one class
        ends = [tuple(F.lit(row[f"{k}_{x}"] if row else None) for x in ("h", "id")) for k in ("test", "val")]
    split = F.when(upto(*ends[0]), "test").when(upto(*ends[1]), "validation").otherwise("train")
    return hashed.select(*[F.col(f"`{c}`") for c in df.columns if c != output], split.alias(output))


def random_split(df: DataFrame, id_col: str, test: float = 0.2, seed: int = 42, output: str = "split") -> DataFrame:
    return stratified_split(df, id_col, None, test, 0.0, seed, output)


def class_weights(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """weight = n / (k · n_class) attached to every row (balanced weighting)."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("_cw_n"))
    tot = per.agg(F.sum("_cw_n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    w = per.select(label, (F.lit(tot["n"]) / (F.lit(tot["k"]) * F.col("_cw_n"))).alias(output))
    # one row per class; AQE broadcasts it after measuring, otherwise a
    # sort-merge join with skew splitting handles a dominant class
    return df.join(w, label, "left")


def class_distribution(df: DataFrame, label: str, split: str | None = None) -> DataFrame:
    by = [split, label] if split else [label]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).orderBy(*by)


# ----------------------------------------------------------------- training

def fit_candidates(train: DataFrame, features: Sequence[str], label: str, weight: str = "weight",
                   num_trees: int = 500, seed: int = 42, max_depth: int = MAX_DEPTH,
                   max_iter: int = 3000) -> dict[str, PipelineModel]:
    """Logistic regression and random forest, both class-weighted; trees grow
    to Spark's depth limit unless ``max_depth`` says otherwise."""
    num, cat = split_feature_types(train, features)
    pre, ready = _prepared(train, num, cat, [F.col(label), F.col(weight)])
    total_w = ready.agg(F.sum(weight)).first()[0] or 1.0
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol=weight, maxIter=max_iter,
                            regParam=1.0 / float(total_w), elasticNetParam=0.0, standardization=False)
    logistic = lr.fit(ready)
    # trees grown in tasks; rows that no task can hold go to Spark's trainer, which grows level by level
    trees = forest.fit(ready, "features", label, weight, logistic.numClasses, num_trees, seed, max_depth, "sqrt")
    if trees is None:
        trees = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol=weight, numTrees=num_trees,
                                       minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=seed,
                                       maxDepth=max_depth, cacheNodeIds=True).fit(ready)
    return {"logistic_regression": _pipeline_model(pre, logistic), "random_forest": _pipeline_model(pre, trees)}


def fit_regressor(train: DataFrame, features: Sequence[str], label: str, num_trees: int = 160,
                  seed: int = 42, max_depth: int = MAX_DEPTH) -> PipelineModel:
    num, cat = split_feature_types(train, features)
    pre, ready = _prepared(train, num, cat, [F.col(label).cast("double").alias(label)])
    trees = forest.fit(ready, "features", label, None, 0, num_trees, seed, max_depth, "all")
    if trees is None:
        trees = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees,
                                      minInstancesPerNode=2, featureSubsetStrategy="all", seed=seed, maxDepth=max_depth,
                                      cacheNodeIds=True).fit(ready)
    return _pipeline_model(pre, trees)


#: Training rows of a task (a forest keeps a count and a node for each of its trees with every row).
FIT_ROWS = 20_000


def _prepared(train: DataFrame, num: Sequence[str], cat: Sequence[str], others: Sequence[Column]) -> tuple[PipelineModel, DataFrame]:
    """The fitted preprocessor and its pinned ``features`` beside ``others``.

    ``train`` is computed once; the modes, medians and scales and every
    candidate read what was written.  The rows are dealt over all cores: a level
    of a forest is a job, and a few small files would be as few tasks.
    """
    train = pinned(prepare_numeric(train, num).select(*num, *cat, *others))
    names = train.columns[len(num) + len(cat):]
    pre = Pipeline(stages=build_preprocessor(num, cat, modes=category_modes(train, cat), medians=column_medians(train, num))).fit(train)
    ready = pinned(pre.transform(train).select("features", *names))
    tasks = max(train.sparkSession.sparkContext.defaultParallelism, -(-ready.count() // FIT_ROWS))
    return pre, ready.repartition(tasks)


def _pipeline_model(pre: PipelineModel, last) -> PipelineModel:
    return PipelineModel(stages=[*pre.stages, last])


def positive_probability(model: PipelineModel, df: DataFrame, output: str = "probability_1",
                         numeric: Sequence[str] = ()) -> DataFrame:
    out = model.transform(prepare_numeric(df, numeric))
    return out.withColumn(output, vector_to_array(F.col("probability"))[1])


# ------------------------------------------------------------------ scoring

def score_table(model: PipelineModel, df: DataFrame, threshold: float, id_cols: Sequence[str],
                label: str | None = None, numeric: Sequence[str] = (),
                prefix: str = "backlog_risk") -> DataFrame:
    """Probability, prediction at ``threshold``, risk label and intervention."""
    p = f"{prefix}_probability"
    scored = positive_probability(model, df, p, numeric)
    cols = [F.col(c) for c in id_cols]
    if label:
        cols.append(F.col(label).alias(f"{prefix}_actual"))
    return scored.select(*cols, F.col(p), (F.col(p) >= threshold).cast("int").alias(f"{prefix}_prediction"),
                         X.risk_label(p).alias("risk_label"),
                         X.recommended_intervention(p).alias("recommended_intervention"))


def feature_importance(model: PipelineModel, sample: DataFrame, k: int = 15) -> DataFrame:
    """(feature, importance) of the final stage, |value| descending, top k.

    Names come from the assembled vector's metadata; the list has one entry per
    model feature, so it is bounded by the feature count, not by the data.
    """
    last = model.stages[-1]
    vec = PipelineModel(stages=model.stages[:-1]).transform(sample.limit(1)).schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {}
    for group in vec.values():
        for a in group:
            names[a["idx"]] = a["name"]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray().tolist()
    else:
        values = last.coefficients.toArray().tolist()
    rows = [(names.get(i, f"f{i}"), float(v)) for i, v in enumerate(values)]
    df = sample.sparkSession.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.abs("importance").desc(), "feature").limit(k)


def label_encode(df: DataFrame, column: str, vocabulary: DataFrame, on_unknown: str = "error",
                 output: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Category → index from a (value, index) table.

    ``on_unknown``: ``error`` raises at run time, ``first`` maps to index 0,
    ``zero`` to NULL-free 0 as well, ``quarantine`` moves the row to the second
    result (rows with their ``reason``).  Returns (encoded, rejected).
    """
    output = output or f"{column}_index"
    vocab = vocabulary.select(F.col("value").alias("_le_v"), F.col("index").alias("_le_i"))
    # the vocabulary grows with the column's cardinality: no forced broadcast,
    # AQE picks broadcast only when the measured size allows
    j = df.join(vocab, F.col(column).cast("string") == F.col("_le_v"), "left")
    miss = F.col("_le_i").isNull()
    if on_unknown == "error":
        idx = F.when(miss, F.raise_error(F.concat(F.lit(f"unknown {column}: "),
                                                  F.coalesce(F.col(column).cast("string"), F.lit("NULL")))))\
               .otherwise(F.col("_le_i"))
        return j.withColumn(output, idx).drop("_le_v", "_le_i"), df.limit(0)
    if on_unknown in ("first", "zero"):
        return j.withColumn(output, F.coalesce("_le_i", F.lit(0))).drop("_le_v", "_le_i"), df.limit(0)
    good = j.where(~miss).withColumn(output, F.col("_le_i")).drop("_le_v", "_le_i")
    bad = j.where(miss).drop("_le_v", "_le_i").withColumn("reason", F.lit(f"unknown {column}"))
    return good, bad


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """(value, index) by descending frequency then value (StringIndexer order)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")) \
        .agg(F.count(F.lit(1)).alias("n"))
    ranked = with_row_number(counts.withColumn("_neg", -F.col("n")), ["_neg", "value"], "_r")
    return ranked.select("value", (F.col("_r") - 1).cast("int").alias("index"))


def one_hot_align(df: DataFrame, column: str, values: Sequence[str], prefix: str | None = None) -> DataFrame:
    """Dummy columns for a stored vocabulary: absent → 0, extra values dropped."""
    prefix = prefix or column
    return df.withColumns({f"{prefix}_{v}": F.coalesce((F.col(column).cast("string") == v).cast("int"), F.lit(0))
                           for v in values})


def fitted_stats(df: DataFrame, columns: Sequence[str], method: str = "exact") -> DataFrame:
    """Stored preprocessing statistics per column: median, mean, std (pop)."""
    med = medians(df, columns, method=method).select("column", F.col("value").alias("median"))
    basic = df.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.avg(F.col(c).cast("double")).alias("mean"),
                                      F.stddev_pop(F.col(c).cast("double")).alias("std")) for c in columns])
                   .alias("a")).select(F.explode("a").alias("s")).select("s.*")
    return basic.join(med, "column", "left")


def impute_scale_stored(df: DataFrame, stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(coalesce(x, median) − mean) / std with stored statistics (std 0 → 0)."""
    # stored statistics: one row per column, collected once
    got = {r["column"]: r for r in stats.select("column", "median", "mean", "std").collect()}
    out = {}
    for c in columns:
        st = got.get(c)
        med, mean, std = ((F.lit(st[k]).cast("double") for k in ("median", "mean", "std")) if st is not None
                          else (F.lit(None).cast("double"),) * 3)
        x = F.coalesce(F.col(c).cast("double"), med)
        out[c] = F.coalesce(F.try_divide(x - mean, std), F.lit(0.0))
    return df.withColumns(out)


def validate_for_scoring(df: DataFrame, required: Sequence[str], numeric: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (valid, rejected with reason): absent or NULL required
    fields and non-numeric numeric fields are rejected."""
    missing_cols = [c for c in required if c not in df.columns]
    if missing_cols:
        raise ValueError(f"Missing required columns: {missing_cols}")
    reasons = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]
    reasons += [F.when(F.col(c).isNotNull() & X.to_number(c).isNull(), F.lit(f"invalid {c}")) for c in numeric]
    checked = df.withColumn("reason", F.concat_ws("; ", F.filter(F.array(*reasons), lambda r: r.isNotNull())))
    good = checked.where(F.col("reason") == "").drop("reason").withColumns({c: X.to_number(c) for c in numeric})
    bad = checked.where(F.col("reason") != "")
    return good, bad


def batch_score(model: PipelineModel, df: DataFrame, required: Sequence[str], numeric: Sequence[str],
                output: str = "prediction", digits: int = 4) -> tuple[DataFrame, DataFrame]:
    good, bad = validate_for_scoring(df, required, numeric)
    scored = model.transform(good).withColumn(output, F.round(F.col("prediction"), digits))
    keep = [c for c in df.columns] + ([output] if output not in df.columns else [])
    return scored.select(*keep), bad


def metadata_tables(model: PipelineModel, required: Sequence[str], numeric: Sequence[str]) -> dict[str, list]:
    """Required fields, numeric fields and allowed categories of a fitted model
    (small driver-side lists derived from the model, bounded by its size)."""
    cats = {}
    for st in model.stages:
        if hasattr(st, "labelsArray") and hasattr(st, "getInputCols"):
            names = st.getInputCols() if st.isSet("inputCols") else [st.getInputCol()]
            cats.update({c: list(labels) for c, labels in zip(names, st.labelsArray)})
    return {"required": list(required), "numeric": list(numeric), "categories": cats}


def multiclass_score(scored: DataFrame, id_cols: Sequence[str], class_names: DataFrame) -> DataFrame:
    """Per row and class: probability %, rank and display name (from a
    (class_id, class_name) table), plus the top class's confidence."""
    # ranked inside the row: sorted by falling probability, then by class
    by_class = F.transform(vector_to_array("probability"), lambda p, i: F.struct((-p).alias("n"), i.alias("class_id")))
    probs = scored.select(*id_cols, F.posexplode(F.sort_array(by_class)).alias("_pos", "_c")) \
        .select(*id_cols, F.col("_c.class_id").alias("class_id"), (-F.col("_c.n")).alias("p"),
                (F.col("_pos") + 1).alias("rank"))
    named = probs.join(class_names, "class_id", "left")
    return named.select("class_id", *id_cols, "p", *[c for c in class_names.columns if c != "class_id"], "rank",
                        F.round(F.col("p") * 100, 2).alias("confidence_pct"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
