"""The price landing: payload files to variant rows, each run appending what it is given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from podwatch.operators.landing import append_payloads
from podwatch.sources.landed import read_payload_files


def land_payloads(payloads: DataFrame, table: str) -> int:
    """Appends payloads; returns how many records they hold. Bad JSON raises and nothing is stored."""
    return append_payloads(payloads, table)


def run_price_landing(spark: SparkSession, path: str, table: str) -> int:
    return land_payloads(read_payload_files(spark, path), table)
