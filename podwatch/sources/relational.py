"""Relational source of token metadata."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podwatch.schemas import RAW_METADATA_COLUMNS


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str = "token_metadata_raw",
    options: Mapping[str, str] | None = None,
    split_on: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A table over JDBC. ``split_on`` = (numeric column, lowest, highest, parts) reads it in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    if split_on:
        column, lowest, highest, parts = split_on
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", lowest)
            .option("upperBound", highest)
            .option("numPartitions", parts)
        )
    return reader.load()


def extract_raw_metadata(raw: DataFrame, *also: str) -> DataFrame:
    """The five source columns of rows that have an address; both reach the source.

    ``also`` names further columns to keep, such as the one that orders repeated addresses.
    """
    return raw.where(F.col("address").isNotNull()).select(*RAW_METADATA_COLUMNS, *also)
