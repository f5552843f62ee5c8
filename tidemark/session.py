"""Session settings shared by every job, and the scoped settings single writes need."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Hour keys are only unique in a zone without daylight saving.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # A repeated key in a payload's list of entries: the last one counts.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    # A hot join key is split over several tasks, also where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stream state grows with the keys; it is kept on disk rather than in the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Only for a new session: recording the Python call site of every column costs more than
# planning the query.
STATIC = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build(app: str, **extra: str) -> SparkSession:
    """Get or create a session with the settings above plus ``extra`` (dots as ``__``)."""
    builder = SparkSession.builder.appName(app)
    for key, value in (STATIC | extra).items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a folder of its own; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


STAGING = "tidemark_staging"


@contextmanager
def staged(df: DataFrame):
    """Rows that feed several jobs, written once as columns and dropped after the block.

    They lie in this session's shared folder, so they outlive executors and cut the lineage.
    """
    spark = df.sparkSession
    path = new_folder(spark, STAGING)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}/{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str):
    """Delete a folder of this library's own, in whatever storage it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Set one SQL setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def dynamic_overwrite(spark: SparkSession):
    """Overwrite only the partitions a write touches, swapped in when the job commits.

    The writer's own ``partitionOverwriteMode`` option does not reach ``insertInto``.
    """
    return setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic")
