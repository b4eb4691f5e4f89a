"""Session construction and the checkpoint folder contract."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # wide one-pass statistics (pairwise correlations, audits) carry more than
    # the default 100 aggregate-buffer fields; keep them in generated code
    "spark.sql.codegen.maxFields": "1000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "strata",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew-join handling on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, honouring ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage named by the cluster
    configuration; a private temporary folder is created only for local
    masters (tests and benchmarks) when nothing is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage and pins partition contents."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below the checkpoint folder and read back:
    several jobs read it by column instead of computing it again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/pinned-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes (as text) up to which a measured table is marked for broadcast.
SMALL_BYTES = 8 << 20


def if_small(df: DataFrame, limit: int = SMALL_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its rows, measured by a job, take at most
    ``limit`` bytes as text; else as it is, for a shuffle join.  Pass a table
    that is pinned and cheap to read."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 16).alias("b")).first()["b"] or 0
    return F.broadcast(df) if size <= limit else df


def observing_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` (same context, same settings) for jobs that are
    observed: a session that has observed a job can no longer ship fitted
    binary classifiers to tasks (their training summary holds the session)."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own
