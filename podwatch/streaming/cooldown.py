"""Cooldown over a stream of candidates: the time of the last alert is the state of each key while it matters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from podwatch.functions.timing import kind_of
from podwatch.rules import RULES, Rule, cooldown_minutes

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEY = ("token", "time_interval")
COUNTS = ("num_users_bought", "num_users_sold")


class CooldownProcessor(StatefulProcessor):
    """Lets a candidate through if the last one let through is at least its cooldown ago.

    A timer ends the state once event time is past the cooldown: from then on it would suppress nothing.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last_alert = handle.getValueState("last_alert", "at bigint, until_ms bigint")
        self.row = Row(*KEY, *COUNTS, "tick")

    def _alerted(self, at: int, wait: int) -> None:
        until_ms = -(-(at + wait) // 1000)
        self.last_alert.update((at, until_ms))
        self.handle.registerTimer(until_ms)

    def handleInitialState(self, key: tuple, initialState: Row, timerValues: object) -> None:
        self._alerted(initialState.seen, initialState.wait)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        known = self.last_alert.get()
        last, until_ms = known if known else (None, None)
        before = last
        wait = 0
        for row in sorted(rows, key=lambda r: r.tick):
            if last is None or row.tick - last >= row.wait:
                last, wait = row.tick, row.wait
                yield self.row(*key, row.num_users_bought, row.num_users_sold, last)
        if last != before:
            if until_ms is not None:
                self.handle.deleteTimer(until_ms)
            self._alerted(last, wait)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        self.last_alert.clear()
        yield from ()

    def close(self) -> None:
        pass


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def _wait(rules: Sequence[Rule]) -> Column:
    return cooldown_minutes(F.col("time_interval"), rules).cast("bigint") * 60_000_000


def stream_alerts(
    candidates: DataFrame,
    rules: Sequence[Rule] = RULES,
    earlier_alerts: DataFrame | None = None,
    lateness: str = "10 minutes",
) -> DataFrame:
    """Candidates out of cooldown, for append output; needs the RocksDB state store.

    Rows of a key inside one micro-batch are taken in order of time: at most one per poll. Micro-batches
    must come in order of polls, as closed polls do; those of ``stream_candidates`` carry their event time in ``at``, others
    get a watermark of ``lateness`` on their timestamp. A key is state for one cooldown after its last alert.
    ``earlier_alerts`` (address, time_interval, last_notification) start the state of a new query.
    """
    if "at" not in candidates.columns:
        candidates = candidates.withColumn("at", F.col("timestamp").cast("timestamp")).withWatermark("at", lateness)
    timed = candidates.select("at", *KEY, *COUNTS, _micros("timestamp").alias("tick"), _wait(rules).alias("wait"))
    initial = None
    if earlier_alerts is not None:
        initial = (
            earlier_alerts.where(F.col("last_notification").isNotNull())
            .groupBy(F.col("address").alias("token"), "time_interval")
            .agg(F.max(_micros("last_notification")).alias("seen"))
            .withColumn("wait", _wait(rules))
            .groupBy(*KEY)
        )
    kept = timed.groupBy(*KEY).transformWithState(
        statefulProcessor=CooldownProcessor(),
        outputStructType="token string, time_interval string, num_users_bought bigint, num_users_sold bigint, tick bigint",
        outputMode="Append",
        timeMode="EventTime",
        initialState=initial,
    )
    kind = kind_of(candidates, "timestamp")
    return kept.select(F.timestamp_micros("tick").cast(kind).alias("timestamp"), *KEY, *COUNTS)
