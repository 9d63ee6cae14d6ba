"""Replay of a history: which alerts every poll would have sent, and what it would have said."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from podwatch import fixed_values as fv
from podwatch.functions.timing import kind_of
from podwatch.operators.alerts import PART_MESSAGES, outbox_rows, poll_texts, with_message
from podwatch.operators.enrich import attach_metadata, drop_denied
from podwatch.operators.replay import poll_grid, replay_counts, suppress_replay
from podwatch.rules import RULES, Rule
from podwatch.session import settled


def replay_alerts(
    swaps: DataFrame,
    metadata: DataFrame,
    until: datetime | str,
    since: datetime | str | None = None,
    rules: Sequence[Rule] = RULES,
    earlier_alerts: DataFrame | None = None,
    recent_minutes: int = fv.RECENT_MINUTES,
    poll_minutes: int = fv.POLL_MINUTES,
    date_column: str | None = None,
    date_zone: str = "UTC",
) -> DataFrame:
    """Rendered alerts of every poll, with the metadata as it is now.

    A poll adds a row for every token it looks up, so none ever finds the metadata empty.
    """
    candidates = replay_counts(swaps, until, since, rules, recent_minutes, poll_minutes, date_column, date_zone)
    named = drop_denied(attach_metadata(candidates, metadata, none_found=False))
    return with_message(suppress_replay(named, rules, earlier_alerts), rules)


def replay_texts(
    alerts: DataFrame,
    since: datetime | str,
    until: datetime | str,
    poll_minutes: int = fv.POLL_MINUTES,
    part_messages: int = PART_MESSAGES,
) -> DataFrame:
    """Text of every poll between two polls, quiet ones included; the messages are checkpointed."""
    kind = kind_of(alerts, "timestamp")
    polls = poll_grid(alerts.sparkSession, since, until, kind, poll_minutes)
    return poll_texts(polls, settled(outbox_rows(alerts)), part_messages)
