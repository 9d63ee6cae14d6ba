"""Cleaning of the raw metadata source and its load metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podwatch.schemas import METADATA_WIDTHS
from podwatch.sources.relational import extract_raw_metadata

LOAD_COLUMNS = ("address", "symbol", "name", "decimals", "blockchain")


def drop_null_keys(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("address").isNotNull())


def first_per_address(raw: DataFrame, order_by: str) -> DataFrame:
    """The first row of each address by ``order_by``; ties go by the smallest row.

    An address repeated in a large share of the rows is reduced on the map side.
    """
    row = F.struct(*LOAD_COLUMNS)
    first = F.min(F.struct(F.col(order_by).alias("ord"), row.alias("row")))
    return raw.groupBy(F.col("address").alias("key")).agg(first.alias("first")).select("first.row.*")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in floating-point columns; NULL is NULL already."""
    floating = [f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def upper_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.upper() for c in df.columns))


def clean_metadata(raw: DataFrame, order_by: str) -> DataFrame:
    """Rows ready for the load: keyed, one per address, in the target's column order."""
    rows = extract_raw_metadata(raw, order_by) if order_by not in LOAD_COLUMNS else extract_raw_metadata(raw)
    return nan_to_null(first_per_address(rows, order_by)).select(*LOAD_COLUMNS)


def load_metrics(raw: DataFrame) -> DataFrame:
    """Rows extracted, rows without a key, rows with one, distinct keys; one row.

    Grouping by the key first keeps the distinct count to one small row per key and map task.
    """
    per_key = raw.groupBy("address").agg(F.count(F.lit(1)).alias("n"))
    keyed = F.col("address").isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_extracted"),
        F.coalesce(F.sum(F.when(~keyed, F.col("n"))), F.lit(0)).alias("rows_without_key"),
        F.coalesce(F.sum(F.when(keyed, F.col("n"))), F.lit(0)).alias("rows_with_key"),
        F.count_if(keyed).alias("unique_keys"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def preview(df: DataFrame, order_by: str, n: int = 2) -> DataFrame:
    """The first rows by a column."""
    return df.orderBy(order_by).limit(n)


def reject_reason(widths: dict[str, int] | None = None) -> Column:
    """Why a row cannot be loaded: ``no address``, or the first text column that is too long; else NULL."""
    reason = F.when(F.col("address").isNull(), F.lit("no address"))
    for column, width in (widths or METADATA_WIDTHS).items():
        reason = reason.when(F.length(column) > width, F.lit(f"{column} over {width} characters"))
    return reason


def split_rejects(rows: DataFrame, widths: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the table, rejected rows with their ``reason``)."""
    names = {c.lower() for c in rows.columns}
    present = {c: n for c, n in (widths or METADATA_WIDTHS).items() if c in names}
    marked = rows.withColumn("reason", reject_reason(present))
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())
