"""Starting the streaming jobs. Checkpoint folders must be shared by all executors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from podwatch import fixed_values as fv
from podwatch.operators.alerts import alert_log_rows
from podwatch.operators.catalog import add_once, partition_values
from podwatch.operators.detect import last_alerts
from podwatch.operators.enrich import attach_metadata, drop_denied, lookup_metadata
from podwatch.operators.keyed_table import current_rows
from podwatch.operators.landing import payload_rows
from podwatch.plans.whale_poll import publish, refresh_metadata
from podwatch.rules import RULES, Rule
from podwatch.schemas import TableNames
from podwatch.session import broadcast_if_small, settled
from podwatch.sources.landed import stream_payload_files
from podwatch.streaming.cooldown import stream_alerts
from podwatch.streaming.detect import stream_candidates


def start_payload_landing(spark: SparkSession, path: str, table: str, checkpoint: str) -> StreamingQuery:
    """Lands every file that came in since the last run, each exactly once, and ends."""
    rows = payload_rows(stream_payload_files(spark, path))
    return (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )


def start_candidate_log(candidates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the candidates of closed polls to parquet, up to the data at hand, and ends."""
    return (
        candidates.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def publish_batch(
    alerts: DataFrame,
    names: TableNames,
    batch: str,
    rules: Sequence[Rule] = RULES,
    responses: DataFrame | None = None,
) -> int:
    """Logs and publishes the alerts of one micro-batch, named by the metadata of the moment; returns the new messages.

    What a batch logged is one partition of the log, named ``batch``, and its messages are the same partition of the
    outbox. A batch run again after a failure finds what is there and only adds what is absent; its messages are
    those of the log, even if metadata changed in between. Metadata of tokens that have none is first put in from ``responses``.
    """
    spark = alerts.sparkSession
    found = [p for p in partition_values(spark, names.alert_log) if p["poll"] == batch]
    if found:
        return publish(spark, names, found[0], rules)
    alerts = settled(alerts)
    newest = alerts.agg(F.unix_micros(F.max("timestamp").cast("timestamp"))).first()[0]
    if newest is None:
        return 0
    newest = datetime(1970, 1, 1) + timedelta(microseconds=newest)  # UTC, whatever the session's zone
    tokens = broadcast_if_small(alerts.select("token"))
    if responses is not None:
        refresh_metadata(spark, names.token_metadata, alerts, tokens, responses, newest)
    known = lookup_metadata(current_rows(spark, names.token_metadata), tokens)
    named = drop_denied(attach_metadata(alerts, known))
    key = {"day": str(newest.date()), "poll": batch}
    add_once(alert_log_rows(named), names.alert_log, key)
    return publish(spark, names, key, rules)


def start_alert_publishing(
    alerts: DataFrame,
    names: TableNames,
    checkpoint: str,
    rules: Sequence[Rule] = RULES,
    responses: DataFrame | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Publishes a stream of alerts; up to the data at hand, and then ends, unless another ``trigger`` is given.

    Batches are named by the query's own id, which its checkpoint keeps, and their number.
    """

    def each(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        publish_batch(batch, names, f"stream-{query}-{number:09d}", rules, responses)

    return (
        alerts.writeStream.outputMode("append")
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_whale_stream(
    swaps: DataFrame,
    names: TableNames,
    checkpoint: str,
    responses: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
    lateness: str = "10 minutes",
    recent_minutes: int = fv.RECENT_MINUTES,
    poll_minutes: int = fv.POLL_MINUTES,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """The whole job as one stream: from swaps to published alerts.

    ``swaps`` is a stream with the columns of the swaps table. Counts, cooldowns and their timers are the stream's state; the
    cooldowns of a new stream start from the alert log. Alerts of a poll are published once the watermark, ``lateness`` behind
    the newest swap, has passed it.
    """
    log = swaps.sparkSession.table(names.alert_log)
    candidates = stream_candidates(swaps, lateness, rules, recent_minutes, poll_minutes)
    alerts = stream_alerts(candidates, rules, last_alerts(log))
    return start_alert_publishing(alerts, names, checkpoint, rules, responses, trigger)
