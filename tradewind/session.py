"""Session settings and the shared folder that survives the loss of an executor."""

from __future__ import annotations

import atexit
import logging
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)
_OWN: set[str] = set()

# Whether a side of a join is small is told by the bytes of its files, and sorted keys or few values take a byte or two there:
# a broadcast of a file of 6 MB had millions of rows, hundreds of MB on the driver and on each executor.
ESTIMATES = {"spark.sql.sources.fileCompressionFactor": "10.0"}

# Settings that matter at scale; every one can be overridden by spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    **ESTIMATES,
    # recording the call site of every column costs several driver round trips each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tradewind", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; `conf` keys use `__` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def estimate_sizes(spark: SparkSession) -> None:
    """Let a session from elsewhere tell the size of a table as `build_session` does, unless it has a setting of its own."""
    for key, value in ESTIMATES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: `spark.checkpoint.dir`, else a folder in the session's warehouse.

    Both are settings of the deployment. Without the first one, a warehouse folder that each machine
    has for itself is refused on a cluster, where executors would write to their own disks.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        path = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "tradewind-staging")
        if not context.master.startswith("local") and path.split(":", 1)[0] in ("file", path):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {path} is local to each machine")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one; all folders of an application lie together."""
    return os.path.join(_own_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def _own_dir(spark: SparkSession) -> str:
    own = os.path.join(shared_dir(spark), "tradewind", spark.sparkContext.applicationId)
    if own not in _OWN:
        _OWN.add(own)
        # the context may be stopped by then, so what the removal needs is taken now
        atexit.register(_delete, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), own)
    return own


def _delete(jvm, configuration, path: str) -> None:
    try:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(configuration).delete(target, True)
    except (Py4JError, OSError) as gone:  # the JVM has ended before this process
        log.debug("staged folder %s not removed: %s", path, gone)


def remove_staged(spark: SparkSession, path: str | None = None) -> None:
    """Remove a staged folder, by default all of this application; that also runs when the process ends.

    An application that dies leaves its folder `tradewind/<application id>` below
    the shared one; remove it once the application is gone.
    """
    _delete(spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path or _own_dir(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows read back from the shared folder.

    Written as a table rather than as an RDD checkpoint: one computation, column
    pruning on the way back, and a known size for the joins that follow.
    """
    return stage_table(df, "step")


def stage_table(df: DataFrame, label: str, partition_by: list[str] | None = None, **options: str) -> DataFrame:
    """Write once to the shared folder and read back, so that several readers share one computation; `options` of the writer use `__` in place of dots."""
    path = scratch_path(df.sparkSession, label)
    # read back by this application only, so the smaller files win over the faster codec
    writer = df.write.mode("overwrite").option("compression", "zstd").options(**{k.replace("__", "."): v for k, v in options.items()})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the jobs that are run meanwhile; what was set before comes back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def discard(*staged: DataFrame) -> None:
    """Remove staged tables that no later step reads."""
    for df in staged:
        if path := getattr(df, "_staged_at", None):
            remove_staged(df.sparkSession, path)
