"""Landed API answers: price payload files and token-metadata responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podwatch.schemas import METADATA_RESPONSES


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, the whole text in ``body``."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "body")


def stream_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream: each new file is one row."""
    return (
        spark.readStream.format("text")
        .option("wholetext", True)
        .load(path)
        .select(F.col("value").alias("body"))
    )


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed metadata responses, JSON lines of (address, status_code, body)."""
    return spark.read.schema(METADATA_RESPONSES).json(path)
