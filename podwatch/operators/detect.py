"""Whale detection: distinct buyers and sellers of recently swapped tokens over trailing windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podwatch import fixed_values as fv
from podwatch.functions.timing import instant_like
from podwatch.rules import RULES, Rule
from podwatch.sources.tables import swaps_since


def swap_legs(swaps: DataFrame) -> DataFrame:
    """Two rows per swap, the token bought and the token sold, from one scan.

    ``counted`` tells whether the leg may count as a trader: the venue is known and not the excluded
    one, and the user is known. Legs that are not counted still make a token recent; they carry neither
    side nor user, so that they fall together in the first grouping.
    """
    counted = F.coalesce(F.col("source") != fv.UNCOUNTED_SOURCE, F.lit(False)) & F.col("user_address").isNotNull()
    legs = F.array(
        F.struct(F.col("swaptotoken").alias("token"), F.when(counted, F.lit("buy")).alias("side")),
        F.struct(F.col("swapfromtoken").alias("token"), F.when(counted, F.lit("sell")).alias("side")),
    )
    return (
        swaps.select(
            "timestamp",
            F.when(counted, F.col("user_address")).alias("user_address"),
            counted.alias("counted"),
            F.explode(legs).alias("leg"),
        )
        .select("timestamp", "user_address", "counted", "leg.token", "leg.side")
        .where(F.col("token").isNotNull())
    )


def recent_tokens(
    swaps: DataFrame,
    as_of: datetime | str,
    minutes: int = fv.RECENT_MINUTES,
    date_column: str | None = None,
    date_zone: str = "UTC",
) -> DataFrame:
    """Distinct tokens on either side of a swap in the last minutes, whatever the venue."""
    legs = swap_legs(swaps_since(swaps, as_of, minutes, date_column, date_zone))
    return legs.select(F.col("token").alias("token_address")).distinct()


def _traders(side: str, seen: Column) -> Column:
    return F.count_if((F.col("side") == side) & seen)


def trader_counts(
    swaps: DataFrame,
    tokens: DataFrame,
    as_of: datetime | str,
    minutes: int,
    date_column: str | None = None,
    date_zone: str = "UTC",
) -> DataFrame:
    """Distinct buyers and sellers of the given tokens in one trailing window.

    Repeats of a trader are dropped before the shuffle, and rows meet the token list only once they
    are down to one per token, so a token with a large share of the swaps stays spread out.
    """
    legs = swap_legs(swaps_since(swaps, as_of, minutes, date_column, date_zone)).where("counted")
    traders = legs.select("token", "side", "user_address").distinct()
    per_token = traders.groupBy(F.col("token").alias("token_address")).agg(
        _traders("buy", F.lit(True)).alias("num_users_bought"),
        _traders("sell", F.lit(True)).alias("num_users_sold"),
    )
    return per_token.join(tokens, "token_address", "left_semi")


def last_alerts(alert_log: DataFrame) -> DataFrame:
    """Latest alert of each (token, interval)."""
    return alert_log.groupBy("address", "time_interval").agg(F.max("inserted_at").alias("last_notification"))


def windowed_counts(
    swaps: DataFrame,
    as_of: datetime | str,
    rules: Sequence[Rule] = RULES,
    recent_minutes: int = fv.RECENT_MINUTES,
    date_column: str | None = None,
    date_zone: str = "UTC",
) -> DataFrame:
    """Counts of every rule for every recent token, one row per (token, interval), from a single scan.

    The windows all end now, so a trader is inside one exactly if their latest swap is: the latest
    swap per (token, side, user) answers every rule and the recency gate at once. Both groupings
    reduce on the map side; no task ever holds all the rows of a token.
    """
    longest = max([recent_minutes, *(r.length_minutes for r in rules)])
    recent = swaps_since(swaps, as_of, longest, date_column, date_zone)
    gate = instant_like(as_of, swaps, "timestamp", recent_minutes)
    legs = swap_legs(recent).where(F.col("counted") | (F.col("timestamp") > gate))
    return counts_of_latest(latest_swaps(legs), as_of, rules, recent_minutes)


def latest_swaps(legs: DataFrame, *slots: Column) -> DataFrame:
    """(token, side, user_address, any_ts, counted_ts): the latest swap and the latest that counts of each trader, in each of ``slots`` if any.

    Both are maxima, so rows of several parts of the swaps add up to those of all by taking maxima again.
    """
    return legs.groupBy("token", "side", "user_address", *slots).agg(
        F.max("timestamp").alias("any_ts"), F.max(F.when(F.col("counted"), F.col("timestamp"))).alias("counted_ts")
    )


def counts_of_latest(
    latest: DataFrame, as_of: datetime | str, rules: Sequence[Rule] = RULES, recent_minutes: int = fv.RECENT_MINUTES
) -> DataFrame:
    """Counts of every rule for every recent token, from the latest swap of each trader."""
    start = {m: instant_like(as_of, latest, "any_ts", m) for m in {recent_minutes, *(r.length_minutes for r in rules)}}
    counts = []
    for i, rule in enumerate(rules):
        inside = F.col("counted_ts") > start[rule.length_minutes]
        counts += [_traders("buy", inside).alias(f"bought_{i}"), _traders("sell", inside).alias(f"sold_{i}")]
    per_token = (
        latest.groupBy("token")
        .agg(F.max("any_ts").alias("last_swap"), *counts)
        .where(F.col("last_swap") > start[recent_minutes])
    )
    per_rule = F.array(
        *(
            F.struct(
                F.lit(rule.label).alias("time_interval"),
                F.col(f"bought_{i}").alias("num_users_bought"),
                F.col(f"sold_{i}").alias("num_users_sold"),
                F.lit(rule.threshold).alias("threshold"),
            )
            for i, rule in enumerate(rules)
        )
    )
    return per_token.select("token", F.inline(per_rule))


def over_threshold() -> Column:
    """Strictly more buyers or strictly more sellers than the rule asks for."""
    return (F.col("num_users_bought") > F.col("threshold")) | (F.col("num_users_sold") > F.col("threshold"))


def with_last_alert(counts: DataFrame, alert_log: DataFrame) -> DataFrame:
    """Adds ``last_notification``, NULL where (token, interval) never alerted."""
    last = last_alerts(alert_log).withColumnRenamed("address", "token")
    return counts.join(last, ["token", "time_interval"], "left")


def threshold_counts(
    swaps: DataFrame,
    as_of: datetime | str,
    rules: Sequence[Rule] = RULES,
    recent_minutes: int = fv.RECENT_MINUTES,
    date_column: str | None = None,
    date_zone: str = "UTC",
) -> DataFrame:
    """Counts of one poll that are over their rule's threshold, with the poll's time."""
    counts = windowed_counts(swaps, as_of, rules, recent_minutes, date_column, date_zone).where(over_threshold())
    return counts.drop("threshold").withColumn("timestamp", instant_like(as_of, swaps))


def candidates_of_counts(counts: DataFrame, alert_log: DataFrame) -> DataFrame:
    """Candidate alerts of counts over their threshold: (timestamp, token, time_interval, counts, last_notification)."""
    return with_last_alert(counts, alert_log).select(
        "timestamp",
        "token",
        "time_interval",
        "num_users_bought",
        "num_users_sold",
        "last_notification",
    )


def detect_candidates(
    swaps: DataFrame,
    alert_log: DataFrame,
    as_of: datetime | str,
    rules: Sequence[Rule] = RULES,
    recent_minutes: int = fv.RECENT_MINUTES,
    date_column: str | None = None,
    date_zone: str = "UTC",
) -> DataFrame:
    """Candidate alerts of one poll."""
    counts = threshold_counts(swaps, as_of, rules, recent_minutes, date_column, date_zone)
    return candidates_of_counts(counts, alert_log)
