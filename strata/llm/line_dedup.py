"""Line deduplication over levelled sorted runs of line hashes (op 6).

Documents arrive in batches of ascending doc_id.  Each batch keeps the hashes
of its line keys; those already in a run belong to an earlier document, the
rest are owned by the batch's smallest doc_id and become a new sorted run
(the merge-anti-join).  ``fanout`` runs of one level are compacted into one
run of the next, so a batch meets logarithmically many runs.

DataFrame functions only: no Python code runs on executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, WS, documents, pin, row_key


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WS)), UPPER, LOWER)


def _runs(levels: dict[int, list[DataFrame]]) -> DataFrame | None:
    runs = [r for level in sorted(levels) for r in levels[level]]
    return reduce(DataFrame.unionByName, runs) if runs else None


def _add_run(levels: dict[int, list[DataFrame]], run: DataFrame, fanout: int) -> None:
    """Add a sorted run; compact full levels into one sorted run above."""
    level = 0
    levels.setdefault(level, []).append(run)
    while len(levels[level]) >= fanout:
        merged = reduce(DataFrame.unionByName, levels[level])
        n = max(1, merged.sparkSession.conf.get("spark.sql.shuffle.partitions").isdigit()
                and int(merged.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        levels[level] = []
        level += 1
        levels.setdefault(level, []).append(
            pin(merged.repartition(n, "h1", "h2").sortWithinPartitions("h1", "h2"), f"run{level}"))


def dropped_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 3) -> DataFrame:
    """(_llm_id, _llm_th, _llm_dropped: array<int>): the line positions each row loses.

    Hashes are 128 bits wide.  A line held by a third of all documents is one
    row per map task before the owner shuffle, and the join back is an
    equi-join that AQE splits.
    """
    d = docs.select("doc_id", "text").where("text is not null and doc_id is not null")
    lines = (
        d.select(*row_key(F.col("text"), F.col("doc_id")),
                 F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .withColumn("k", line_key(F.col("line")))
        .where(F.char_length("k") >= min_chars)
        .select("_llm_id", "_llm_th", "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(11), "k").alias("h2"))
    )
    cuts = d.select(F.percentile_approx(
        "doc_id", [i / batches for i in range(1, batches)], 10000).alias("q")).first()[0] or []
    bounds = [None, *sorted(set(cuts)), None]
    levels: dict[int, list[DataFrame]] = {}
    drops = []
    for i, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        batch = lines
        if lo is not None:
            batch = batch.where(F.col("_llm_id") > lo)
        if hi is not None:
            batch = batch.where(F.col("_llm_id") <= hi)
        batch = pin(batch, f"batch{i}")
        own = batch.groupBy("h1", "h2").agg(F.min("_llm_id").alias("own"), F.max("_llm_id").alias("last"))
        seen = _runs(levels)
        if seen is None:
            own = own.withColumn("old", F.lit(False))
        else:
            own = own.join(seen.withColumn("old", F.lit(True)), ["h1", "h2"], "left")
            own = own.withColumn("old", F.coalesce("old", F.lit(False)))
        if hi is not None:
            own = pin(own.sortWithinPartitions("h1", "h2"), f"own{i}")
            _add_run(levels, own.where("not old").select("h1", "h2"), fanout)
        shared = own.where("old or own < last").select(
            "h1", "h2", F.when(~F.col("old"), F.col("own")).alias("own"))
        drops.append(batch.join(shared, ["h1", "h2"])
                     .where("own is null or _llm_id <> own").select("_llm_id", "_llm_th", "pos"))
    return (reduce(DataFrame.unionByName, drops)
            .groupBy("_llm_id", "_llm_th").agg(F.collect_set("pos").alias("_llm_dropped")))


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 3) -> DataFrame:
    """``docs`` with text replaced by its kept lines, plus n_lines and
    n_dropped (names that ``docs`` may hold already are replaced).

    Null text is one empty line and stays null in ``text``; rows with a null
    doc_id neither own nor lose lines; rows repeated under one doc_id count as
    one document; an empty table gives an empty result.
    """
    drops = dropped_lines(docs, min_chars, batches, fanout)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "_llm_id", "_llm_th", "_llm_k", "_llm_dropped", "_llm_lines")]
    left = docs.select(*names, *row_key(F.col("text"), F.col("doc_id")))
    j = left.join(drops, ["_llm_id", "_llm_th"], "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    j = j.withColumn("_llm_lines", lines)
    j = j.withColumn("_llm_k", F.when(F.col("_llm_dropped").isNotNull(), F.array_except(
        F.sequence(F.lit(1), F.size("_llm_lines")), F.transform("_llm_dropped", lambda p: p + 1))))
    kept = F.when(F.col("_llm_k").isNull(), F.col("text")).otherwise(F.array_join(
        F.transform("_llm_k", lambda p: F.element_at("_llm_lines", p)), "\n"))
    return j.select(*[kept.alias("text") if c == "text" else F.col(c) for c in names],
                    F.size("_llm_lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size("_llm_dropped"), F.lit(0)).cast("long").alias("n_dropped"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
o AS (
  SELECT key, min(doc_id) AS own FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (
  SELECT k.doc_id, k.pos, k.line, o.key IS NOT NULL AND k.doc_id <> o.own AS gone
  FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
