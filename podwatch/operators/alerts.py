"""From candidates to alerts: cooldown, sentiment, message text, log rows, outbox rows, poll text."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podwatch import fixed_values as fv
from podwatch.functions.text import fill_template, stripped
from podwatch.functions.timing import instant, kind_of, minutes
from podwatch.rules import RULES, Rule, cooldown_minutes, rule_order, rule_text
from podwatch.session import settled

# Messages in one part of a poll text.
PART_MESSAGES = 100


def cooled_down(now: Column, last: Column, label: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Never alerted, or at least the cooldown ago. A last alert in the future suppresses."""
    return last.isNull() | (now - last >= minutes(cooldown_minutes(label, rules)))


def suppress_recent(candidates: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Candidates whose interval is out of its cooldown at their ``timestamp``."""
    return candidates.where(
        cooled_down(F.col("timestamp"), F.col("last_notification"), F.col("time_interval"), rules)
    )


def by_sentiment(bullish: object, bearish: object, neutral: object) -> Column:
    """One of three values, by buyers against sellers."""
    bought, sold = F.col("num_users_bought"), F.col("num_users_sold")
    as_column = [v if isinstance(v, Column) else F.lit(v) for v in (bullish, bearish, neutral)]
    return F.when(bought > sold, as_column[0]).when(sold > bought, as_column[1]).otherwise(as_column[2])


def ratio_text() -> Column:
    """``buyers/sellers`` with its unit, the other way round for a bearish alert."""
    bought, sold = F.col("num_users_bought"), F.col("num_users_sold")
    buy = F.format_string(fv.BUY_RATIO_FORMAT, bought, sold)
    return by_sentiment(buy, F.format_string(fv.SELL_RATIO_FORMAT, sold, bought), buy)


def token_link() -> Column:
    return F.concat(F.lit(fv.TOKEN_LINK_PREFIX), F.col("token"))


def with_message(alerts: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds sentiment columns, link and the rendered message."""
    indicator, arrow, sentiment = (
        by_sentiment(*values) for values in zip(fv.BULLISH, fv.BEARISH, fv.NEUTRAL, strict=True)
    )
    parts = alerts.withColumns(
        {
            "rule_order": rule_order(F.col("time_interval"), rules),
            "indicator": indicator,
            "arrow": arrow,
            "sentiment": sentiment,
            "ratio": ratio_text(),
            "link": token_link(),
        }
    )
    message = fill_template(
        fv.MESSAGE_TEMPLATE,
        {
            "indicator": F.col("indicator"),
            "arrow": F.col("arrow"),
            "sentiment": F.col("sentiment"),
            "link": F.col("link"),
            "name": F.col("name"),
            "symbol": F.col("symbol"),
            "rule_text": rule_text(F.col("time_interval"), rules),
            "buys": F.col("num_users_bought"),
            "sells": F.col("num_users_sold"),
            "ratio": F.col("ratio"),
            "token": F.col("token"),
        },
    )
    return parts.withColumn("message", message)


def alert_log_rows(alerts: DataFrame, inserted_at: Column | None = None) -> DataFrame:
    """Rows of the alert log; written at the poll's own time unless another is given."""
    return alerts.select(
        "timestamp",
        F.col("token").alias("address"),
        "symbol",
        "name",
        "time_interval",
        F.col("num_users_bought").cast("bigint").alias("num_users_bought"),
        F.col("num_users_sold").cast("bigint").alias("num_users_sold"),
        (F.col("timestamp") if inserted_at is None else inserted_at).alias("inserted_at"),
    )


def outbox_rows(rendered: DataFrame) -> DataFrame:
    """One row per message, with the columns that order it inside its poll."""
    return rendered.select("timestamp", "rule_order", "token", "time_interval", "message")


def message_places(outbox: DataFrame) -> DataFrame:
    """(timestamp, rule_order, token, time_interval, place, messages) of every message: its place in its poll, and how many there are.

    Places go by rule, then by token, from 0. The narrow keys are sorted over all tasks, each task numbers
    its stretch, and counts per task and poll say where a stretch begins; so no task sees a whole poll that is large. The sorted keys
    are checkpointed.
    """
    keys = outbox.select("timestamp", "rule_order", "token", "time_interval")
    sorted_keys = keys.orderBy("timestamp", "rule_order", "token", "time_interval").withColumn("at", F.monotonically_increasing_id())
    numbered = settled(sorted_keys.withColumn("task", F.shiftright("at", 33)))
    # A row for each task and poll that meet: as many as there are tasks and polls, no more.
    stretches = numbered.groupBy("timestamp", "task").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    poll = Window.partitionBy("timestamp")
    stretches = stretches.select(
        F.col("timestamp").alias("of"), F.col("task").alias("by"), "first",
        (F.sum("n").over(poll.orderBy("task")) - F.col("n")).alias("before"), F.sum("n").over(poll).alias("messages"),
    )
    found = numbered.join(stretches, (F.col("timestamp") == F.col("of")) & (F.col("task") == F.col("by")))
    return found.select(*keys.columns, (F.col("before") + F.col("at") - F.col("first")).alias("place"), "messages")


def poll_text_parts(outbox: DataFrame, part_messages: int = PART_MESSAGES) -> DataFrame:
    """The text of each poll in parts of at most ``part_messages`` messages: (timestamp, part, parts, text).

    Parts joined by a line end, in order, are the whole text; a poll that fits has the single part 0 of 1.
    Messages go by rule, then by token. They join the numbered keys and meet a part at a time. The outbox is read
    twice: give a written or checkpointed one.
    """
    key = ["timestamp", "rule_order", "token", "time_interval"]
    placed = message_places(outbox).join(outbox.select(*key, "message"), key)
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "message"))), lambda m: m["message"]),
        fv.MESSAGE_SEPARATOR,
    )
    parts = F.ceil(F.col("messages") / part_messages).cast("bigint")
    part = F.floor(F.col("place") / part_messages).cast("bigint")
    return placed.groupBy("timestamp", part.alias("part"), parts.alias("parts")).agg(joined.alias("text"))


def poll_texts(polls: DataFrame, outbox: DataFrame, part_messages: int = PART_MESSAGES) -> DataFrame:
    """Text of every poll in ``polls`` (one ``timestamp`` each); a set sentence where nothing alerted."""
    return polls.join(poll_text_parts(outbox, part_messages), "timestamp", "left").select(
        "timestamp",
        F.coalesce("part", F.lit(0).cast("bigint")).alias("part"),
        F.coalesce("parts", F.lit(1).cast("bigint")).alias("parts"),
        F.coalesce("text", F.lit(fv.NOTHING_TO_REPORT)).alias("text"),
    )


def is_quiet(text: Column) -> Column:
    """Whether a poll text says that nothing alerted; white space around it does not matter."""
    return stripped(text) == fv.NOTHING_TO_REPORT


def single_poll(outbox: DataFrame, as_of: datetime | str) -> DataFrame:
    """The one-row poll table of a single run."""
    moment = instant(as_of, kind_of(outbox, "timestamp"))
    return outbox.sparkSession.range(1).select(moment.alias("timestamp"))
