"""Historical replay: what every poll of a regular grid would have counted and alerted.

A swap falls to the first poll at or after it and stays in a trailing window for ``length / grid``
polls. So a trader is inside a window of a poll while polls since their latest swap are fewer than
that, and the counts of a token change only where some trader comes in or drops out. Replay adds up
these changes; it never copies a swap once per window.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podwatch import fixed_values as fv
from podwatch.functions.timing import collected_instants, instant, kind_of, minute_number, minutes, on_grid, parse_instant, poll_tick
from podwatch.operators.detect import over_threshold, swap_legs
from podwatch.rules import RULES, Rule, cooldown_minutes
from podwatch.session import is_small, settled
from podwatch.sources.tables import swaps_until


def _check_grid(poll_minutes: int, lengths: Sequence[int]) -> None:
    if any(length % poll_minutes for length in lengths):
        raise ValueError("window lengths must be multiples of the poll period")


def token_bucket(token: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets))


def swaps_of_part(swaps: DataFrame, part: int, parts: int) -> DataFrame:
    """The swaps as they concern one of ``parts`` parts of the tokens, by hash; a token of another part is NULL, which never matches.

    Tokens are counted apart, so the parts of a history can be replayed one after the other, and its shuffles never lie on disk together.
    """
    if parts == 1:
        return swaps
    own = {c: F.when(token_bucket(c, parts) == part, F.col(c)) for c in ("swapfromtoken", "swaptotoken")}
    return swaps.withColumns(own).where("swapfromtoken IS NOT NULL OR swaptotoken IS NOT NULL")


def tokens_filter(tokens: DataFrame) -> DataFrame:
    """Settled tokens as a frame that is broadcast: themselves if they are few, else the buckets that they are in, at most BUCKETS numbers."""
    if is_small(tokens):
        return F.broadcast(tokens)
    return F.broadcast(tokens.select(token_bucket("token", BUCKETS).alias("bucket")).distinct())


def trader_ticks(swaps: DataFrame, poll_minutes: int = fv.POLL_MINUTES, tokens: DataFrame | None = None) -> DataFrame:
    """(token, side, user, counted, tick) of every leg, of ``tokens``, or of tokens in their buckets, only if they are given; a trader may come
    several times inside a poll period."""
    tick = poll_tick(F.col("timestamp"), poll_minutes)
    legs = swap_legs(swaps)
    if tokens is not None and "bucket" in tokens.columns:
        legs = legs.withColumn("bucket", token_bucket("token", BUCKETS)).join(tokens, "bucket", "left_semi")
    elif tokens is not None:
        legs = legs.join(tokens.select("token"), "token", "left_semi")
    return legs.select("token", "side", "user_address", "counted", tick.alias("tick"))


# Of tokens that are too many to be broadcast.
BUCKETS = 1_000_000
# Histories that are counted together: the prefix of a history's columns, and which rows belong to it (SQL; None: all).
Version = tuple[str, str | None]
WHOLE: tuple[Version, ...] = (("", None),)
KNOWN_AND_ALL: tuple[Version, ...] = (("before_", "NOT late"), ("after_", None))


def _count_names(rules: Sequence[Rule]) -> list[str]:
    return [f"{side}_{i}" for i in range(len(rules)) for side in ("buy", "sell")]


def count_changes(ticks: DataFrame, rules: Sequence[Rule], versions: Sequence[Version] = WHOLE) -> DataFrame:
    """Traders coming in at each (token, tick), and traders last seen there, per version, side and rule; ``seen``: whether a leg of the version is there.

    A trader comes in at a tick unless an earlier tick still covers it, and drops out one length after
    a tick unless a later one takes over before. Of legs with the same tick the first has the gap before and the last the gap after, the
    others have gaps of zero and count nowhere, so repeats need no grouping of their own: nearly all keys differ, and a hash table of them
    on the map side would hold a whole split. Legs that are not counted share one trader and are spread by their tick, which
    other legs lack as a key; each is a trader of its own then, as a window of thousands of rows needs memory that the sums may have taken. The sums reduce on the
    map side. The hash in front of the keys, added after the shuffle, makes the sort compare numbers first, and texts of equal traders only.
    """
    trader = ["token", "side", "user_address", "counted", "tick"]
    spread = ticks.withColumnRenamed("tick", "poll").withColumn("tick", F.when(~F.col("counted"), F.col("poll")))
    alone = F.when(~F.col("counted"), F.monotonically_increasing_id())
    together = spread.repartition(*trader).withColumn("trader", F.xxhash64(*trader, alone))
    over = f"IGNORE NULLS OVER (PARTITION BY trader, {', '.join(trader)} ORDER BY poll)"
    gaps = []
    for name, which in versions:
        mine = f"IF({which}, poll, NULL)" if which else "poll"
        gaps += [F.expr(f"poll - lag({mine}) {over}").alias(f"{name}gap_before"), F.expr(f"lead({mine}) {over} - poll").alias(f"{name}gap_after")]
    spans = together.select("token", "side", "counted", F.col("poll").alias("tick"), *(F.expr(which).alias(f"{name}mine") for name, which in versions if which), *gaps)

    def traders(name: str, which: str | None, side: str, gap: str, rule: Rule) -> Column:
        gap = F.col(f"{name}{gap}")
        alone = F.col("counted") & (F.col("side") == side) & (gap.isNull() | (gap >= minutes(rule.length_minutes)))
        return F.count_if(alone & F.col(f"{name}mine") if which else alone)

    return spans.groupBy("token", "tick").agg(
        *(F.max(f"{name}mine").alias(f"{name}seen") for name, which in versions if which),
        *(
            traders(name, which, side, gap, rule).alias(f"{name}{side}_{end}_{i}")
            for name, which in versions
            for i, rule in enumerate(rules)
            for side in ("buy", "sell")
            for end, gap in (("in", "gap_before"), ("out", "gap_after"))
        ),
    )


def running_counts(
    changes: DataFrame, rules: Sequence[Rule], recent_minutes: int, poll_minutes: int, versions: Sequence[Version] = WHOLE
) -> DataFrame:
    """Traders inside each window at every (token, tick) at which the token is recent; ``recent``: whether it is in that version.

    Those who came in so far, less those last seen a length ago or before. A token has at most one row a poll here, however many
    swaps it had. A row also answers the polls without legs until its token is no longer recent or has a row again; these are made
    after the sums, so the sort holds each (token, tick) once. Frames compare numbers of minutes, as polls are whole minutes.
    """
    own = "PARTITION BY token ORDER BY minute"
    so_far = f"{own} RANGE BETWEEN UNBOUNDED PRECEDING AND"

    def until(length: int) -> str:
        return f"{abs(length)} {'PRECEDING' if length >= 0 else 'FOLLOWING'}"

    laters = range(0, recent_minutes, poll_minutes)
    sums = [F.expr(f"lead(tick) OVER ({own})").alias("next")]
    for name, which in versions:
        if which:
            sums.append(F.expr(f"max(IF({name}seen, tick, NULL)) OVER ({so_far} CURRENT ROW)").alias(f"{name}last"))
        for i, rule in enumerate(rules):
            for side in ("buy", "sell"):
                sums.append(F.expr(f"sum({name}{side}_in_{i}) OVER ({so_far} CURRENT ROW)").alias(f"{name}{side}_{i}"))
                for later in laters:
                    left = f"sum({name}{side}_out_{i}) OVER ({so_far} {until(rule.length_minutes - later)})"
                    sums.append(F.coalesce(F.expr(left), F.lit(0)).alias(f"{name}{side}_left_{i}_{later}"))

    def poll(later: int) -> Column:
        at = F.col("tick") + minutes(later)
        told = F.col("next").isNull() | (F.col("next") > at)
        return F.struct(
            F.when(told, at).alias("tick"),
            *((at - F.col(f"{name}last") < minutes(recent_minutes)).alias(f"{name}recent") for name, which in versions if which),
            *(
                (F.col(f"{name}{side}_{i}") - F.col(f"{name}{side}_left_{i}_{later}")).alias(f"{name}{side}_{i}")
                for name, _ in versions
                for i in range(len(rules))
                for side in ("buy", "sell")
            ),
        )

    summed = changes.repartition("token").withColumn("minute", minute_number(changes, "tick")).select("token", "tick", *sums)
    return summed.select("token", F.inline(F.array(*(poll(later) for later in laters)))).where("tick IS NOT NULL")


def replay_counts(
    swaps: DataFrame,
    until: datetime | str,
    since: datetime | str | None = None,
    rules: Sequence[Rule] = RULES,
    recent_minutes: int = fv.RECENT_MINUTES,
    poll_minutes: int = fv.POLL_MINUTES,
    date_column: str | None = None,
    date_zone: str = "UTC",
    tokens: DataFrame | None = None,
) -> DataFrame:
    """Candidates of every poll up to ``until``: (timestamp, token, time_interval, counts).

    Each poll sees the swaps up to itself. With ``since``, polls before it are left out, and swaps too
    old to matter are not read. ``tokens`` restricts the replay to some tokens.
    """
    _check_grid(poll_minutes, [recent_minutes, *(r.length_minutes for r in rules)])
    kind = kind_of(swaps, "timestamp")
    last = instant(until, kind)
    longest = max([recent_minutes, *(r.length_minutes for r in rules)])
    read = swaps_until(swaps, until, since, longest, date_column, date_zone)
    changes = count_changes(trader_ticks(read, poll_minutes, tokens), rules)
    totals = running_counts(changes, rules, recent_minutes, poll_minutes).where(F.col("tick") <= last)
    if since is not None:
        totals = totals.where(F.col("tick") >= instant(since, kind))
    per_rule = F.array(
        *(
            F.struct(
                F.lit(r.label).alias("time_interval"),
                F.col(f"buy_{i}").alias("num_users_bought"),
                F.col(f"sell_{i}").alias("num_users_sold"),
                F.lit(r.threshold).alias("threshold"),
            )
            for i, r in enumerate(rules)
        )
    )
    return (
        totals.select(F.col("tick").alias("timestamp"), "token", F.inline(per_rule))
        .where(over_threshold())
        .drop("threshold")
    )


def late_corrections(
    swaps: DataFrame,
    late: DataFrame,
    until: datetime | str,
    rules: Sequence[Rule] = RULES,
    recent_minutes: int = fv.RECENT_MINUTES,
    poll_minutes: int = fv.POLL_MINUTES,
    date_column: str | None = None,
    date_zone: str = "UTC",
) -> DataFrame:
    """What swaps that came late change in the candidates of past polls: rows to ``retract`` and rows to ``add``.

    (change, timestamp, token, time_interval, counts); a candidate whose counts changed is both. Only tokens that ``late`` has are
    counted again, and only polls from its first swap until the longest window after its last has passed; of ``swaps``, those
    known before, no others are read. Applied to the candidates of ``swaps`` they give those of all swaps, in whatever order late ones come.
    Both counts, without late swaps and with them, come from one pass and stand in one row a poll, so they meet without a join.
    """
    _check_grid(poll_minutes, [recent_minutes, *(r.length_minutes for r in rules)])
    tick = poll_tick(F.col("timestamp"), poll_minutes)
    touched = settled(swap_legs(late).groupBy("token").agg(F.min(tick).alias("first"), F.max(tick).alias("last")))
    key = ["timestamp", "token", "time_interval"]
    counts = ("num_users_bought", "num_users_sold")
    first, last = collected_instants(touched.agg(F.min("first").alias("first"), F.max("last").alias("last")))
    if first is None:
        nothing = replay_counts(swaps.limit(0), until, None, rules, recent_minutes, poll_minutes)
        return nothing.select(F.lit("add").alias("change"), *key, *counts)
    longest = max([recent_minutes, *(r.length_minutes for r in rules)])
    end = min(parse_instant(until), last + timedelta(minutes=longest))
    # Late swaps have no other tokens. Of those known before, tokens that only share a bucket with a touched one change nothing.
    tokens = tokens_filter(touched.select("token"))

    ticks = None
    for of, wanted, is_late in ((swaps, tokens, False), (late, None, True)):
        read = swaps_until(of, end, first, longest, date_column, date_zone)
        part = trader_ticks(read, poll_minutes, wanted).withColumn("late", F.lit(is_late))
        ticks = part if ticks is None else ticks.unionByName(part)
    totals = running_counts(count_changes(ticks, rules, KNOWN_AND_ALL), rules, recent_minutes, poll_minutes, KNOWN_AND_ALL)
    kind = kind_of(swaps, "timestamp")
    totals = totals.where((F.col("tick") >= instant(first, kind)) & (F.col("tick") <= instant(end, kind)))
    per_rule = []
    for i, r in enumerate(rules):
        (b0, s0), (b1, s1) = (tuple(F.col(f"{name}{side}_{i}") for side in ("buy", "sell")) for name, _ in KNOWN_AND_ALL)
        was = F.coalesce(F.col("before_recent"), F.lit(False)) & ((b0 > r.threshold) | (s0 > r.threshold))
        now = (b1 > r.threshold) | (s1 > r.threshold)
        same = was & now & (b0 == b1) & (s0 == s1)
        for change, there, b, s in (("retract", was, b0, s0), ("add", now, b1, s1)):
            row = [F.when(there & ~same, F.lit(change)).alias("change"), F.col("tick").alias("timestamp"), F.col("token"), F.lit(r.label).alias("time_interval")]
            per_rule.append(F.struct(*row, b.alias("num_users_bought"), s.alias("num_users_sold")))
    return totals.select(F.inline(F.array(*per_rule))).where("change IS NOT NULL")


def corrected(candidates: DataFrame, corrections: DataFrame) -> DataFrame:
    """Candidates after corrections."""
    rows = ["timestamp", "token", "time_interval", "num_users_bought", "num_users_sold"]
    gone = corrections.where("change = 'retract'").select(*rows)
    added = corrections.where("change = 'add'").select(*rows)
    return candidates.select(*rows).join(gone, rows, "left_anti").unionByName(added)


def _reached(c: Column) -> Column:
    """Places, from 1, that are reached from the first by following ``next`` (a place, or one past the end) in an array.

    Steps of 1, 2, 4, ... are tabled by doubling; the s-th place reached is then the sum of the steps in s.
    """
    n = F.size(c)
    one = F.concat(F.transform(c, lambda x: x["next"]), F.array(n + 1))
    doublings = F.sequence(F.lit(1), F.ceil(F.log2(n + 1)).cast("int"))

    def longer(tables: Column, _: Column) -> Column:
        last = F.element_at(tables, -1)
        return F.concat(tables, F.array(F.transform(last, lambda place: F.element_at(last, place))))

    def reached(tables: Column) -> Column:
        def further(at: Column, k: Column) -> Column:
            there = F.element_at(F.element_at(tables, k), at["place"])
            step = F.call_function("shiftleft", F.lit(1), k - 1)
            return F.when(there <= n, F.struct(there.alias("place"), (at["steps"] + step).alias("steps"))).otherwise(at)

        start = F.struct(F.lit(1).alias("place"), F.lit(0).alias("steps"))
        steps = F.aggregate(F.sequence(F.size(tables), F.lit(1)), start, further, lambda at: at["steps"])

        def place(s: Column) -> Column:
            def follow(at: Column, table: Column) -> Column:
                odd = at["left"].bitwiseAND(1) == 1
                there = F.when(odd, F.element_at(table, at["place"])).otherwise(at["place"])
                return F.struct(there.alias("place"), F.shiftright(at["left"], 1).alias("left"))

            return F.aggregate(tables, F.struct(F.lit(1).alias("place"), s.alias("left")), follow, lambda at: at["place"])

        return F.transform(F.sequence(F.lit(0), steps), place)

    tables = F.aggregate(doublings, F.array(one), longer)
    return F.get(F.transform(F.array(tables), reached), F.lit(0))


def suppress_replay(
    candidates: DataFrame, rules: Sequence[Rule] = RULES, earlier_alerts: DataFrame | None = None
) -> DataFrame:
    """Candidates that alert when every alert starts the cooldown of its (token, interval).

    Each alert depends on the one before it. Were a candidate an alert, the next would be the first that is a cooldown
    later; a sliding count finds that successor for all candidates at once, and the alerts are those that successors reach from
    the first candidate of the key, found by doubling steps. A key has at most one row per poll, and keys are spread by hash.
    ``earlier_alerts`` (address, time_interval, last_notification) are alerts sent before the replay.
    """
    key = ["token", "time_interval"]
    cooldown = cooldown_minutes(F.col("time_interval"), rules)
    timed = candidates
    if earlier_alerts is not None:
        seeds = earlier_alerts.select(
            F.col("address").alias("token"), "time_interval", F.col("last_notification").alias("seed")
        )
        out = F.col("seed").isNull() | (F.col("timestamp") - F.col("seed") >= minutes(cooldown))
        timed = timed.join(seeds, key, "left").where(out).drop("seed")
    own = Window.partitionBy(*key).orderBy("timestamp")
    within = None
    for wait in sorted({fv.DEFAULT_COOLDOWN_MINUTES, *(r.cooldown_minutes for r in rules)}):
        n = F.expr(
            "count(1) OVER (PARTITION BY token, time_interval ORDER BY timestamp"
            f" RANGE BETWEEN CURRENT ROW AND INTERVAL '{wait * 60 - 1}.999999' SECOND FOLLOWING)"
        )
        n = n if wait else F.lit(1)
        within = F.when(cooldown == wait, n) if within is None else within.when(cooldown == wait, n)
    place = F.row_number().over(own)
    placed = timed.select(*key, place.alias("place"), (place + within).cast("int").alias("next"), F.struct(*candidates.columns).alias("row"))
    whole = placed.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("place", "next", "row"))).alias("c"))
    sent = whole.select("c", F.explode(_reached(F.col("c"))).alias("at"))
    return sent.select(F.element_at("c", F.col("at"))["row"].alias("row")).select("row.*")


def poll_grid(
    spark: SparkSession, since: datetime | str, until: datetime | str, kind: T.DataType, poll_minutes: int = fv.POLL_MINUTES
) -> DataFrame:
    """The polls of a replay, one ``timestamp`` per row: those of the regular grid from ``since`` to ``until``."""
    first, last = on_grid(since, poll_minutes, up=True), on_grid(until, poll_minutes)
    if first > last:
        raise ValueError(f"no poll of the {poll_minutes}-minute grid between {since} and {until}")
    polls = F.sequence(instant(first, kind), instant(last, kind), minutes(poll_minutes))
    return spark.range(1).select(F.explode(polls).alias("timestamp"))
