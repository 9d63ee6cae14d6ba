"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of keys and short texts that are sent whole to every executor; some tens of megabytes.
BROADCAST_ROWS = 100_000


def build_session(app_name: str = "podwatch", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution; partition counts are left to it and to the cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **{key.replace("__", "."): str(value) for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for ``DataFrame.checkpoint``: what ``spark.checkpoint.dir`` names.

    Only a local session, as in tests, gets a temporary folder when the setting is missing; on a cluster
    a machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="podwatch-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """The frame computed once and kept in the checkpoint folder, for frames that are read repeatedly."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As ``settled``, in parquet: a fraction of the size of a checkpoint, for results of any size."""
    path = f"{use_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is computed inside leaves no shuffle files; else they stay until the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a settled frame has few enough rows to be broadcast; counts no further than it must."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A settled frame, marked for broadcast if its counted size allows; else joins shuffle as usual."""
    return F.broadcast(df) if is_small(df, rows) else df
