"""Table scans and parameterised SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podwatch.functions.timing import after_minutes_ago, day_of, instant_like

SWAP_COLUMNS = ("timestamp", "user_address", "swapfromtoken", "swaptotoken", "source")


def run_sql(spark: SparkSession, query: str, **args: object) -> DataFrame:
    """Result of a query; values are bound to ``:name`` markers, never put into the text."""
    return spark.sql(query, args=args)


def swaps_since(
    swaps: DataFrame, as_of: datetime | str, minutes: int, date_column: str | None = None, date_zone: str = "UTC"
) -> DataFrame:
    """The five swap columns of a trailing window.

    The bound is a literal, so it reaches the parquet scan. Where the table is partitioned by a date,
    naming that column prunes the partitions as well. ``date_zone`` is the zone of those dates; the
    session's zone plays no part, as the bound is a date literal.
    """
    recent = swaps.where(after_minutes_ago(swaps, as_of, minutes))
    if date_column:
        recent = recent.where(F.col(date_column) >= F.lit(day_of(as_of, date_zone, minutes)))
    return recent.select(*SWAP_COLUMNS)


def swaps_until(
    swaps: DataFrame,
    until: datetime | str,
    since: datetime | str | None = None,
    minutes_before: int = 0,
    date_column: str | None = None,
    date_zone: str = "UTC",
) -> DataFrame:
    """The five swap columns of a stretch of history: later than ``minutes_before`` before ``since``, up to ``until``."""
    last = instant_like(until, swaps)
    read = swaps.where(F.col("timestamp") <= last)
    if date_column:
        read = read.where(F.col(date_column) <= F.lit(day_of(until, date_zone)))
    if since is not None:
        oldest = instant_like(since, swaps, "timestamp", minutes_before)
        read = read.where(F.col("timestamp") > oldest)
        if date_column:
            read = read.where(F.col(date_column) >= F.lit(day_of(since, date_zone, minutes_before)))
    return read.select(*SWAP_COLUMNS)
