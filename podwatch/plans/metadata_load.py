"""The metadata load: extract, clean, check, upsert."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from podwatch.functions.timing import instant_like, utc_now
from podwatch.operators.catalog import append, create_poll_tables, table_exists
from podwatch.operators.keyed_table import create_keyed_table, current_rows, merge_rows
from podwatch.operators.metadata import clean_metadata, split_rejects
from podwatch.operators.upsert import BATCH_UPDATES, check_keys, upsert
from podwatch.schemas import TOKEN_METADATA_DDL, TableNames
from podwatch.session import is_small, settled


@dataclass(frozen=True)
class LoadResult:
    """Counts of a load."""

    extracted: int
    without_key: int
    unique: int
    rejected: int
    table_rows: int


def create_tables(spark: SparkSession, names: TableNames, root: str | None = None) -> None:
    """Creates what the jobs write to. Given a root folder, each table lies in a folder under it."""
    create_poll_tables(spark, names, root)
    database, _, short = names.token_metadata.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    create_token_metadata_table(spark, names.token_metadata, f"{root}/{short}" if root else None)


def create_token_metadata_table(spark: SparkSession, name: str, folder: str | None = None) -> None:
    """Creates the metadata table, with its defaults, unless it is there."""
    create_keyed_table(spark, name, TOKEN_METADATA_DDL, folder)


def merge_metadata(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    as_of: datetime | str,
    update_columns: Sequence[str] = BATCH_UPDATES,
    keep_known: bool = False,
) -> int:
    """Upserts a batch of distinct addresses into the metadata table; returns how many buckets were written."""
    now = instant_like(as_of, spark.table(table), "inserted_at")

    def merged(target: DataFrame, source: DataFrame) -> DataFrame:
        return upsert(target, source, now, update_columns, keep_known, source_is_small=is_small(source))

    return merge_rows(spark, table, batch, merged)


def load_batch(
    spark: SparkSession, batch: DataFrame, table: str, as_of: datetime | str | None = None, folder: str | None = None
) -> int:
    """Creates the table if it is absent, checks the batch and upserts it. Returns the table's row count."""
    database, _, name = table.rpartition(".")
    if not table_exists(spark, database or spark.catalog.currentDatabase(), name)[0]:
        create_token_metadata_table(spark, table, folder)
    merge_metadata(spark, table, check_keys(batch), utc_now() if as_of is None else as_of)
    return current_rows(spark, table).count()


def run_metadata_load(
    spark: SparkSession,
    raw: DataFrame,
    table: str,
    order_by: str,
    as_of: datetime | str | None = None,
    rejects_table: str | None = None,
    folder: str | None = None,
) -> LoadResult:
    """Loads a raw source. Rows that do not fit go to ``rejects_table``; without one they fail the load."""
    figures = Observation("raw metadata")
    seen = raw.observe(figures, F.count(F.lit(1)).alias("extracted"), F.count_if(F.col("address").isNull()).alias("without_key"))
    # The filter on the address goes after the figures, so that they see the rows it takes away.
    cleaned = settled(clean_metadata(seen, order_by))
    fitting, rejects = split_rejects(cleaned)
    rejected = rejects.count()
    if rejected and rejects_table is None:
        reason = rejects.select(F.min("reason")).first()[0]
        raise ValueError(f"{rejected} rows do not fit the table: {reason}")
    if rejected:
        append(rejects, rejects_table)
    rows = load_batch(spark, fitting, table, as_of, folder)
    return LoadResult(figures.get["extracted"], figures.get["without_key"], cleaned.count(), rejected, rows)
