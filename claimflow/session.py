"""Session defaults and the shared scratch location.

Settings already present on the session (cluster defaults, spark-submit
``--conf``) win; the defaults below only fill gaps.  On a cluster size
``spark.sql.shuffle.partitions`` to the data (AQE then coalesces small
partitions and splits skewed ones at runtime).
"""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Operational settings applied when this process starts the context: no web
# UI server, no console progress bar.
STARTUP = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# SQL defaults, applied only where the deployment (spark-defaults, --conf,
# builder) left the key unset.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # chained joins on one key share a partitioning; split a hot partition all the
    # same, at the price of one more shuffle after it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Spark's own size check before broadcasting a join side (static stats,
    # then AQE on actual shuffle sizes); larger sides shuffle instead.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, app_name: str = "claimflow",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Get or create the session; explicit arguments win, then the deployment's
    settings, then :data:`DEFAULTS`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**STARTUP, **conf}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configured = {k for k, _ in spark.sparkContext.getConf().getAll()} | set(conf)
    for k, v in DEFAULTS.items():
        if k not in configured and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only an application whose executors run in this very process (``local``,
    ``local[n]``) gets a temporary folder when it names none, removed when the
    process ends; any cluster, ``local-cluster`` included, must name a shared
    folder, since a machine-local path is not visible to executors and is lost
    with them.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    own = tempfile.TemporaryDirectory(prefix="claimflow-ckpt-")
    atexit.register(own.cleanup)
    sc.setCheckpointDir(own.name)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Shuffle files of a query are removed as it ends, not when the driver's garbage is collected.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block remove their shuffle files as each ends: a run of several
    writes holds those of one at a time, beside what it wrote."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


# Paths staged by materialize() inside the innermost staging_scope(), if any.
_STAGED: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar(
    "claimflow_staged", default=None)


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete ``path`` on whatever file system it names."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


@contextlib.contextmanager
def staging_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that :func:`materialize` stages inside the block are deleted when
    the block exits.

    For end-to-end runs whose actions all finish inside the block (a report
    write); frames returned lazily out of the block must not read staged data.
    """
    paths: list[str] = []
    token = _STAGED.set(paths)
    try:
        yield paths
    finally:
        _STAGED.reset(token)
        for path in paths:
            delete_path(spark, path)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and read
    it back.

    For a frame that a plan reads many times: it is computed once, its
    lineage is cut, its files survive the loss of any executor, and readers
    get column pruning (a branch that needs 4 of 60 columns reads 4) and true
    sizes for the planner.  The shuffle files of the write are removed.  Inside a :func:`staging_scope` the table is
    deleted when the scope exits; otherwise it is left to the cluster's
    retention of the checkpoint folder.
    """
    path = scratch_path(df.sparkSession, name)
    staged = _STAGED.get()
    if staged is not None:
        staged.append(path)  # before the write: a failed one leaves files too
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    # the schema is known: no footer-reading job to infer it on the way back
    schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata)
                           for f in df.schema.fields])
    return df.sparkSession.read.schema(schema).parquet(path)


def once(df: DataFrame, name: str) -> DataFrame:
    """:func:`materialize` for the small result of a :func:`staging_scope`: it outlives the
    scope, whose staged tables can go."""
    token = _STAGED.set(None)
    try:
        return materialize(df, name)
    finally:
        _STAGED.reset(token)


__all__ = ["DEFAULTS", "get_session", "checkpoint_dir", "scratch_path", "materialize",
           "staging_scope", "delete_path", "once", "shuffles_removed"]
