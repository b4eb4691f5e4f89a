"""Incremental refresh (T1, T2) and stream scoring.

The source application rebuilds everything when a raw file is newer than the
gold table.  Here the raw folder is a Structured Streaming file source: each
``availableNow`` run picks up only files it has not seen (tracked in the
query's checkpoint) and ``foreachBatch`` rebuilds the affected outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.files import read_or_empty

__all__ = ["list_files", "log_run", "stale_check", "refresh_if_new", "seen_once", "late_rows", "score_once",
           "stream_score", "file_stream"]


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, modified_at) of the files at ``path``: a listing, no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file_name"),
                        F.col("modificationTime").alias("modified_at"))


def stale_check(spark: SparkSession, raw_path: str, run_log_path: str) -> DataFrame:
    """One row: newest raw file time, last successful run time, and ``stale``
    (true when a raw file is newer, a raw file name was never processed, or no
    run exists).  The run log (``log_run``) has (file_name, run_at)."""
    files = list_files(spark, raw_path)
    log = read_or_empty(spark, run_log_path, "file_name string, run_at timestamp")
    # two one-value results, collected once
    last = F.lit(log.agg(F.max("run_at").alias("r")).first()["r"]).cast("timestamp")
    unseen = files.join(log.select("file_name"), "file_name", "left_anti").count()
    return files.agg(F.max("modified_at").alias("newest_raw_at")).select(
        "newest_raw_at", last.alias("last_run_at"),
        (last.isNull() | (F.col("newest_raw_at") > last) | F.lit(unseen > 0)).alias("stale"))


def log_run(spark: SparkSession, raw_path: str, run_log_path: str) -> None:
    """Append the files of a finished run and its time to the run log."""
    list_files(spark, raw_path).select("file_name", F.current_timestamp().alias("run_at")) \
        .write.mode("append").parquet(run_log_path)


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def refresh_if_new(spark: SparkSession, raw_path: str, schema: T.StructType | str, checkpoint: str,
                   rebuild: Callable[[DataFrame, int], None], fmt: str = "csv") -> None:
    """Process only unseen raw files, then stop (``availableNow``)."""
    q = (file_stream(spark, raw_path, schema, fmt).writeStream
         .option("checkpointLocation", checkpoint)
         .foreachBatch(rebuild)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


def seen_once(stream: DataFrame, key: list[str], event_time: str, delay: str) -> DataFrame:
    """Rows of a stream whose ``key`` has not come before, by keyed state that
    is kept until the watermark (``delay`` behind the newest ``event_time``).

    ``delay`` bounds the state: it must cover how late rows may come or be
    replayed; rows behind the watermark are dropped and counted by the query's
    progress (``late_rows``).  Rows with a NULL in their key are told apart by a
    hash of the whole row.  Rows without an event time neither move the
    watermark nor fall behind it; the state knows them within their batch only.
    """
    marked = stream.withColumns({"_guard_row": F.when(_no_key(key), F.xxhash64(*[F.col(f"`{c}`") for c in stream.columns])),
                                 "_guard_time": F.col(event_time).cast("timestamp")})
    once = marked.withWatermark("_guard_time", delay).dropDuplicatesWithinWatermark([*key, "_guard_row"])
    return once.select(*[F.col(f"`{c}`") for c in stream.columns])


def _no_key(key: list[str]) -> Column:
    nulls = F.lit(False)
    for k in key:
        nulls = nulls | F.col(k).isNull()
    return nulls


def _row_id(key: list[str], columns: list[str]) -> list[Column]:
    """128 bits that tell rows apart as ``seen_once`` does."""
    whole = [F.col(f"`{c}`") for c in columns]
    return [F.when(_no_key(key), F.xxhash64(F.lit(n), *whole)).otherwise(F.xxhash64(F.lit(n + 2), *key)).alias(f"_id{n}") for n in (0, 1)]


def late_rows(query) -> int:
    """Rows that the finished query dropped behind its watermark."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])


def score_once(stream: DataFrame, model: PipelineModel, required: list[str], numeric: list[str], key: list[str], event_time: str,
               delay: str, path: str, checkpoint: str, output: str = "prediction", digits: int = 4):
    """Score each arriving row once into one sink at ``path`` and stop when all
    files are read: scored rows have ``output``, rejected ones a ``reason``.

    The stream is read once; a micro-batch that is replayed after a failure
    replaces its own part (``epoch=<id>``), and a row offered again under a new
    file name is known to the state (``seen_once``) or, where it has no event
    time, found in the sink.  Returns the query.
    """
    from strata.operators.ml import validate_for_scoring
    columns = stream.columns

    def write(batch: DataFrame, epoch: int) -> None:
        held = batch = batch.persist()
        timeless = batch.where(F.col(event_time).isNull())
        if not timeless.isEmpty():
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields) + ", epoch int"
            known = read_or_empty(batch.sparkSession, path, schema).where(F.col(event_time).isNull() & (F.col("epoch") < epoch))
            new = timeless.select("*", *_row_id(key, columns)).join(known.select(*_row_id(key, columns)), ["_id0", "_id1"], "left_anti")
            batch = batch.where(F.col(event_time).isNotNull()).unionByName(new.select(*columns))
        whole = batch.withColumn("_arrived", F.struct(*[F.col(f"`{c}`") for c in columns]))  # rows are kept as they came
        good, bad = validate_for_scoring(whole, required, numeric)
        scored = model.transform(good).select("_arrived.*", F.round(F.col("prediction"), digits).alias(output),
                                              F.lit(None).cast("string").alias("reason"))
        rejected = bad.select("_arrived.*", F.lit(None).cast("double").alias(output), "reason")
        scored.unionByName(rejected).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        held.unpersist()

    query = (seen_once(stream, key, event_time, delay).writeStream.option("checkpointLocation", checkpoint)
             .foreachBatch(write).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def stream_score(stream: DataFrame, model: PipelineModel, required: list[str], numeric: list[str],
                 output: str = "prediction", digits: int = 4) -> tuple[DataFrame, DataFrame]:
    """Stateless scoring of arriving rows: (scored, rejected-with-reason) streams."""
    from strata.operators.ml import validate_for_scoring
    good, bad = validate_for_scoring(stream, required, numeric)
    scored = model.transform(good).withColumn(output, F.round(F.col("prediction"), digits))
    return scored.select(*stream.columns, output), bad
