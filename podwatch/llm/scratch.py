"""Intermediate tables in the folder that driver and executors share.

Every call of an operator works in a fresh folder under ``spark.checkpoint.dir``. Tables that only an inner
step reads are dropped as soon as that step is written. What a lazy result still reads stays until the
folder is cleared by whoever owns it, as with any checkpoint.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What a Python task holds of its input at a time, beside single long texts. Spark's own bound is 10,000 rows of any size.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def bounded_batches(spark: SparkSession) -> None:
    """Sets BATCH for the session unless it has a value: a lazy result is computed by whoever writes it, beyond ``Scratch.written``."""
    if spark.conf.get(BATCH[0], None) is None:
        spark.conf.set(*BATCH)


class Scratch:
    def __init__(self, spark: SparkSession, name: str) -> None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
            base = tempfile.mkdtemp(prefix="podwatch-llm-")
            spark.conf.set("spark.checkpoint.dir", base)
        self.spark = spark
        self.folder = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """The frame, computed once and read back, so that a lost executor costs one task and not the lineage."""
        path = self.path(name)
        schema = df.schema
        before = self.spark.conf.get(BATCH[0], None)
        self.spark.conf.set(*BATCH)
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(BATCH[0])
            else:
                self.spark.conf.set(BATCH[0], before)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
