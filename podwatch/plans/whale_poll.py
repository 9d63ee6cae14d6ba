"""One poll: detect, enrich, suppress, log, publish."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podwatch import fixed_values as fv
from podwatch.functions.text import is_blank
from podwatch.functions.timing import after_minutes_ago, day_of, instant_like, on_grid, parse_instant, utc_now
from podwatch.operators.alerts import alert_log_rows, outbox_rows, poll_texts, suppress_recent, with_message
from podwatch.operators.catalog import add_once, partition_values
from podwatch.operators.detect import detect_candidates
from podwatch.operators.enrich import (
    attach_metadata,
    drop_denied,
    lookup_metadata,
    resolve_responses,
    tokens_to_fetch,
)
from podwatch.operators.keyed_table import current_rows
from podwatch.operators.metadata import split_rejects
from podwatch.operators.upsert import API_UPDATES, upsert
from podwatch.plans.metadata_load import merge_metadata
from podwatch.rules import RULES, Rule
from podwatch.schemas import TableNames
from podwatch.session import broadcast_if_small, settled


def alerts_from_candidates(
    candidates: DataFrame, metadata: DataFrame, rules: Sequence[Rule] = RULES, none_found: bool | None = None
) -> DataFrame:
    """Alerts with their rendered message, from candidates and the metadata known for them."""
    named = drop_denied(attach_metadata(candidates, metadata, none_found))
    return with_message(suppress_recent(named, rules), rules)


def metadata_with_responses(
    candidates: DataFrame, metadata: DataFrame, responses: DataFrame, as_of: datetime | str, keep_known: bool = True
) -> DataFrame:
    """Metadata after the answers for missing and incomplete candidate tokens were put in."""
    fetched = resolve_responses(tokens_to_fetch(candidates, metadata), responses, as_of)
    fitting, _ = split_rejects(fetched)
    now = instant_like(as_of, metadata, "inserted_at")
    return upsert(metadata, fitting, now, API_UPDATES, keep_known)


def poll_alerts(
    swaps: DataFrame,
    alert_log: DataFrame,
    metadata: DataFrame,
    responses: DataFrame,
    as_of: datetime | str,
    rules: Sequence[Rule] = RULES,
    keep_known: bool = True,
) -> DataFrame:
    """A whole poll as one lazy plan."""
    candidates = detect_candidates(swaps, alert_log, as_of, rules)
    refreshed = metadata_with_responses(candidates, metadata, responses, as_of, keep_known)
    return alerts_from_candidates(candidates, refreshed, rules, none_found=False)


def alerts_that_matter(alert_log: DataFrame, as_of: datetime | str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Rows of the log young enough to suppress anything; where the log is partitioned by day, older days are not read.

    A row is never younger than the day it was written under; rows written without one are always looked at.
    """
    longest = max([fv.DEFAULT_COOLDOWN_MINUTES, *(r.cooldown_minutes for r in rules)])
    young = alert_log.where(after_minutes_ago(alert_log, as_of, longest, "inserted_at"))
    if "day" in (c.lower() for c in alert_log.columns):
        young = young.where(F.col("day").isNull() | (F.col("day") >= str(day_of(as_of, minutes_ago=longest))))
    return young


# How the catalog names the partition of rows that have none.
NOWHERE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class PollResult:
    """What a poll wrote."""

    alerts: int
    resumed: bool


def refresh_metadata(
    spark: SparkSession,
    table: str,
    candidates: DataFrame,
    tokens: DataFrame,
    responses: DataFrame,
    as_of: datetime | str,
    keep_known: bool = True,
) -> None:
    """Puts the answers for missing and incomplete tokens into the metadata table. With ``keep_known``, answers that say nothing new write nothing."""
    known = lookup_metadata(current_rows(spark, table), tokens)
    wanted = tokens_to_fetch(candidates, known)
    fetched, _ = split_rejects(resolve_responses(wanted, responses, as_of))
    if keep_known:
        fetched = news(fetched, known)
    merge_metadata(spark, table, fetched, as_of, API_UPDATES, keep_known)


def news(fetched: DataFrame, known: DataFrame) -> DataFrame:
    """Answers that change something: tokens without a row, a symbol or name where there was none, other decimals."""
    before = known.select(F.col("address").alias("a"), F.col("symbol").alias("s"), F.col("name").alias("n"), F.col("decimals").alias("d"))
    new_text = [~is_blank(F.col(c)) & ~F.col(old).eqNullSafe(F.col(c)) for c, old in (("symbol", "s"), ("name", "n"))]
    other = ~F.col("d").cast("decimal(38,0)").eqNullSafe(F.col("decimals").cast("decimal(38,0)"))
    joined = fetched.join(before, F.col("address") == F.col("a"), "left")
    return joined.where(F.col("a").isNull() | new_text[0] | new_text[1] | other).select(*fetched.columns)


def poll_key(as_of: datetime | str) -> dict[str, str]:
    """The partition of a poll in the tables it writes to."""
    moment = parse_instant(as_of)
    return {"day": moment.strftime("%Y-%m-%d"), "poll": moment.strftime("%Y%m%dT%H%M%S.%f")}


def publish(
    spark: SparkSession, names: TableNames, key: dict[str, str], rules: Sequence[Rule] = RULES, polls: DataFrame | None = None
) -> int:
    """Renders what the log holds under a key into its messages and its text, and returns how many messages this call made public.

    Whoever comes first makes them public, and what they say comes from the log alone; so a job that died after its
    log is finished by any later one, and jobs that overlap publish once. ``polls`` (one ``timestamp`` each) get the set
    sentence where they have no message; without it, polls without messages get no text.
    """
    logged = spark.table(names.alert_log).where((F.col("day") == key["day"]) & (F.col("poll") == key["poll"]))
    rendered = settled(outbox_rows(with_message(logged.drop("day", "poll").withColumnRenamed("address", "token"), rules)))
    polls = rendered.select("timestamp").distinct() if polls is None else polls
    add_once(poll_texts(polls, rendered), names.poll_texts, key)
    return rendered.count() if add_once(rendered, names.outbox, key) else 0


def publish_pending(spark: SparkSession, names: TableNames, rules: Sequence[Rule] = RULES) -> int:
    """Publishes whatever was logged and never published, however long ago; only names of partitions are compared."""
    published = {(p["day"], p["poll"]) for p in partition_values(spark, names.outbox)}
    logged = sorted((p["day"], p["poll"]) for p in partition_values(spark, names.alert_log))
    pending = [x for x in logged if x not in published and NOWHERE not in x]
    return sum(publish(spark, names, {"day": day, "poll": poll}, rules) for day, poll in pending)


def run_poll(
    spark: SparkSession,
    names: TableNames,
    responses: DataFrame,
    as_of: datetime | str | None = None,
    rules: Sequence[Rule] = RULES,
    date_column: str | None = None,
    date_zone: str = "UTC",
    keep_known: bool = True,
) -> PollResult:
    """Runs a poll on the catalog tables: metadata is updated, then alerts are logged, then messages and text are published.

    Candidates and alerts feed several writes each, so both are checkpointed: they are computed once
    and survive the loss of an executor. The alerts of a poll are one partition of the log, which
    is there as a whole or not at all and is never written twice: that partition says that the poll was made, and the same
    partition of the outbox that it was published. Every poll first publishes what earlier ones logged and did not publish.
    A poll that was made already is not made again. A quiet poll leaves an empty partition and the set sentence as its text.
    Without ``as_of`` the poll is the last of the regular grid. ``date_column`` holds dates of ``date_zone``. Sides are
    broadcast only after they were counted.
    """
    as_of = on_grid(utc_now(), fv.POLL_MINUTES) if as_of is None else as_of
    key = poll_key(as_of)
    late = publish_pending(spark, names, rules)
    if key in partition_values(spark, names.alert_log):
        return PollResult(late, resumed=late > 0)
    swaps, log = spark.table(names.swaps), spark.table(names.alert_log)
    recent_log = alerts_that_matter(log, as_of, rules)
    candidates = settled(detect_candidates(swaps, recent_log, as_of, rules, date_column=date_column, date_zone=date_zone))
    alerts = None
    if not candidates.isEmpty():
        tokens = broadcast_if_small(candidates.select("token"))
        refresh_metadata(spark, names.token_metadata, candidates, tokens, responses, as_of, keep_known)
        known = lookup_metadata(current_rows(spark, names.token_metadata), tokens)
        alerts = alert_log_rows(settled(alerts_from_candidates(candidates, known, rules)))
    add_once(log.limit(0) if alerts is None else alerts, names.alert_log, key)
    single = spark.range(1).select(instant_like(as_of, log).alias("timestamp"))
    return PollResult(late + publish(spark, names, key, rules, single), resumed=late > 0)
