"""Detection that reads every swap once: a table of each trader's latest swap by slot of time, which polls merge.

New swaps become rows of the table as they arrive, however late: the latest swap of each trader of a token in each slot.
A poll reads the slots of its longest window and takes maxima. As a maximum does not change when a row
is there twice, a batch of swaps may be put in again after a failure.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podwatch import fixed_values as fv
from podwatch.functions.timing import instant_like, parse_instant
from podwatch.operators.catalog import append
from podwatch.operators.detect import candidates_of_counts, counts_of_latest, latest_swaps, over_threshold, swap_legs
from podwatch.rules import RULES, Rule
from podwatch.sources.tables import SWAP_COLUMNS

SLOT_MINUTES = 60
SLOTS = "token string, side string, user_address string, any_ts timestamp, counted_ts timestamp, slot string"


def create_slot_table(spark: SparkSession, name: str, folder: str | None = None) -> None:
    location = f" LOCATION '{folder}'" if folder else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({SLOTS}) USING parquet PARTITIONED BY (slot){location}")


def _slot(moment: Column) -> Column:
    """The slot of an instant, named by its start in UTC so that names are in order of time."""
    start = F.floor(F.unix_micros(moment) / (SLOT_MINUTES * 60_000_000)) * SLOT_MINUTES * 60
    return F.date_format(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=start), "yyyyMMdd'T'HHmm")


def slot_rows(swaps: DataFrame) -> DataFrame:
    """Rows of the slot table for some swaps. Traders are reduced before the shuffle."""
    legs = swap_legs(swaps.select(*SWAP_COLUMNS).withColumn("timestamp", F.col("timestamp").cast("timestamp")))
    return latest_swaps(legs.where("timestamp is not null"), _slot(F.col("timestamp")).alias("slot"))


def add_swaps(swaps: DataFrame, name: str) -> None:
    """Puts swaps that have arrived into the slot table; those put in already change nothing."""
    append(slot_rows(swaps).select(*swaps.sparkSession.table(name).columns), name, "slot")


def slot_candidates(
    slots: DataFrame,
    alert_log: DataFrame,
    as_of: datetime | str,
    rules: Sequence[Rule] = RULES,
    recent_minutes: int = fv.RECENT_MINUTES,
) -> DataFrame:
    """Candidate alerts of one poll from the slot table; slots before its longest window are not read."""
    longest = max([recent_minutes, *(r.length_minutes for r in rules)])
    oldest = parse_instant(as_of) - timedelta(minutes=longest)
    first = oldest - timedelta(minutes=SLOT_MINUTES)
    recent = slots.where((F.col("slot") > first.strftime("%Y%m%dT%H%M")) & (F.col("any_ts") > instant_like(oldest, slots, "any_ts")))
    latest = recent.groupBy("token", "side", "user_address").agg(F.max("any_ts").alias("any_ts"), F.max("counted_ts").alias("counted_ts"))
    counts = counts_of_latest(latest, as_of, rules, recent_minutes).where(over_threshold())
    counts = counts.drop("threshold").withColumn("timestamp", instant_like(as_of, slots, "any_ts"))
    return candidates_of_counts(counts, alert_log)
