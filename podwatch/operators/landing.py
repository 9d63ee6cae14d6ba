"""Landing of JSON payloads as variant rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from podwatch.functions.payload import is_json_array, json_value, json_value_or_null, record_count


def parsed_payloads(payloads: DataFrame) -> DataFrame:
    """(raw_data, record_count): each payload as a list, and its records; a single value is a list of one. Bad JSON fails the job.

    A list is parsed once; only a single value is parsed again, inside its list.
    """
    parsed = payloads.select("body", json_value(F.col("body")).alias("value"))
    listed = is_json_array(F.col("value"))
    wrapped = json_value(F.concat(F.lit("["), F.col("body"), F.lit("]")))
    return parsed.select(
        F.when(listed, F.col("value")).otherwise(wrapped).alias("raw_data"),
        F.when(listed, F.size(F.col("value").cast("array<variant>"))).otherwise(F.lit(1)).cast("bigint").alias("record_count"),
    )


def payload_rows(payloads: DataFrame) -> DataFrame:
    """One ``raw_data`` row per payload, always a list; bad JSON fails the job."""
    return parsed_payloads(payloads).select("raw_data")


def payload_counts(payloads: DataFrame, *keys: str) -> DataFrame:
    """Records of each payload; a single value counts as one."""
    return payloads.select(*keys, record_count(F.col("body")).cast("bigint").alias("record_count"))


def bad_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads that are not JSON."""
    return payloads.where(json_value_or_null(F.col("body")).isNull() & F.col("body").isNotNull())


def append_payloads(payloads: DataFrame, table: str) -> int:
    """Appends every payload as a new row; returns how many records the rows hold, counted as they are written."""
    figures = Observation("landed payloads")
    parsed = parsed_payloads(payloads).observe(figures, F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"))
    parsed.select("raw_data").write.mode("append").format("parquet").saveAsTable(table)
    return figures.get["records"]
