"""Replay against the point-in-time form and against brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from podwatch.operators import replay
from podwatch.operators.detect import detect_candidates
from podwatch.operators.replay import corrected, late_corrections, poll_grid, replay_counts, suppress_replay, swaps_of_part
from podwatch.plans.replay import replay_alerts, replay_texts
from podwatch.rules import RULES, Rule
from podwatch.session import settled, shuffles_dropped, stored

START = datetime(2024, 1, 31, 0, 0, 0)
SWAP_SCHEMA = "timestamp timestamp_ntz, user_address string, swapfromtoken string, swaptotoken string, source string"


def random_swaps(seed, n=900, hours=9):
    pick = random.Random(seed)
    rows = []
    for _ in range(n):
        second = pick.choice([pick.randrange(hours * 3600), pick.randrange(hours * 12) * 300])
        micro = pick.choice([0, 0, 1, 999_999])
        rows.append(
            (
                START + timedelta(seconds=second, microseconds=micro),
                pick.choice([None, *(f"u{i}" for i in range(9))]),
                pick.choice(["SOL", "SOL", None, "A", "B", "C"]),
                pick.choice(["A", "B", "C", "D", None]),
                pick.choice(["ORCA", "JUPITER", "PUMP_FUN", None]),
            )
        )
    return rows


def brute_counts(rows, rules, until):
    """Every poll looks at every swap."""
    out = set()
    tick = START
    while tick <= until:
        seen = [r for r in rows if r[0] <= tick]
        recent = {t for r in seen if r[0] > tick - timedelta(minutes=10) for t in (r[2], r[3]) if t}
        for rule in rules:
            inside = [r for r in seen if r[0] > tick - timedelta(minutes=rule.length_minutes)]
            inside = [r for r in inside if r[4] not in (None, "PUMP_FUN") and r[1]]
            for token in recent:
                bought = len({r[1] for r in inside if r[3] == token})
                sold = len({r[1] for r in inside if r[2] == token})
                if bought > rule.threshold or sold > rule.threshold:
                    out.add((tick, token, rule.label, bought, sold))
        tick += timedelta(minutes=5)
    return out


def brute_suppress(candidates, rules, earlier=()):
    wait = {r.label: timedelta(minutes=r.cooldown_minutes) for r in rules}
    last, out = dict(earlier), set()
    for row in sorted(candidates):
        tick, token, label = row[:3]
        before = last.get((token, label))
        if before is None or tick - before >= wait[label]:
            last[token, label] = tick
            out.add(row)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_replay_equals_brute_force(spark, seed):
    rows = random_swaps(seed)
    swaps = spark.createDataFrame(rows, SWAP_SCHEMA)
    until = START + timedelta(hours=8, minutes=35)
    counts = replay_counts(swaps, until)
    expected = brute_counts(rows, RULES, until)
    assert {tuple(r) for r in counts.select("timestamp", "token", "time_interval", "num_users_bought", "num_users_sold").collect()} == expected
    assert counts.count() == len(expected) > 200

    sent = suppress_replay(counts).select(counts.columns)
    got = {tuple(r) for r in sent.select("timestamp", "token", "time_interval", "num_users_bought", "num_users_sold").collect()}
    assert got == brute_suppress(expected, RULES)

    since = START + timedelta(hours=5)
    later = replay_counts(swaps, until, since)
    assert {tuple(r) for r in later.select("timestamp", "token", "time_interval", "num_users_bought", "num_users_sold").collect()} == {
        r for r in expected if r[0] >= since
    }


def test_one_poll_of_a_replay_is_detection_at_its_time(spark):
    rows = [r for r in random_swaps(3) if r[0] <= START + timedelta(hours=6)]
    swaps = spark.createDataFrame(rows, SWAP_SCHEMA)
    log = spark.createDataFrame([], "address string, time_interval string, inserted_at timestamp_ntz")
    tick = START + timedelta(hours=6)
    columns = ["token", "time_interval", "num_users_bought", "num_users_sold"]
    point = detect_candidates(swaps, log, tick).select(columns)
    replayed = replay_counts(swaps, tick, tick).select(columns)
    assert sorted(map(tuple, point.collect())) == sorted(map(tuple, replayed.collect())) != []


def test_other_rules_and_grid(spark):
    rules = (Rule("tiny", 20, 1, 20, "tiny"),)
    rows = random_swaps(4, 300, 4)
    until = START + timedelta(hours=4)
    swaps = spark.createDataFrame(rows, SWAP_SCHEMA)
    got = replay_counts(swaps, until, rules=rules)
    assert {tuple(r) for r in got.select("timestamp", "token", "time_interval", "num_users_bought", "num_users_sold").collect()} == brute_counts(rows, rules, until)
    with pytest.raises(ValueError, match="multiples"):
        replay_counts(swaps, until, rules=(Rule("odd", 7, 1, 5, "odd"),))


def test_suppression_starts_from_earlier_alerts_and_keeps_its_distance(spark):
    ticks = [START + timedelta(minutes=5 * i) for i in range(60) if i % 7]
    candidates = spark.createDataFrame(
        [(t, "A", label, 9, 9) for t in ticks for label in ("30min", "1hour", "3hours")],
        "timestamp timestamp_ntz, token string, time_interval string, num_users_bought bigint, num_users_sold bigint",
    )
    before = START + timedelta(minutes=3)
    earlier = spark.createDataFrame(
        [("A", "30min", before), ("A", "3hours", None), ("B", "1hour", before)],
        "address string, time_interval string, last_notification timestamp_ntz",
    )
    got = {tuple(r) for r in suppress_replay(candidates, RULES, earlier).collect()}
    assert got == brute_suppress({tuple(r) for r in candidates.collect()}, RULES, {("A", "30min"): before})
    for rule in RULES:
        kept = sorted(r[0] for r in got if r[2] == rule.label)
        assert all(b - a >= timedelta(minutes=rule.cooldown_minutes) for a, b in zip(kept, kept[1:]))


def test_replay_works_on_instants_too(spark):
    swaps = spark.createDataFrame(random_swaps(5), SWAP_SCHEMA)
    until = START + timedelta(hours=8)
    plain = replay_counts(swaps, until)
    zoned = replay_counts(swaps.withColumn("timestamp", F.col("timestamp").cast("timestamp")), until)
    zoned = zoned.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert plain.exceptAll(zoned).count() == 0 and zoned.exceptAll(plain).count() == 0
    sent, sent_zoned = suppress_replay(plain).count(), suppress_replay(zoned).count()
    assert sent == sent_zoned > 0


def test_texts_cover_every_poll(spark):
    swaps = spark.createDataFrame(random_swaps(6, 300, 3), SWAP_SCHEMA)
    metadata = spark.createDataFrame([("A", "AAA", "Alpha"), ("SOL", "sol", "Sol")], "address string, symbol string, name string")
    until = START + timedelta(hours=5)
    alerts = replay_alerts(swaps, metadata, until)
    assert alerts.where("token = 'SOL'").count() == 0
    texts = replay_texts(alerts, START, until)
    polls = poll_grid(spark, START, until, alerts.schema["timestamp"].dataType).count()
    assert texts.count() == polls == 61
    assert texts.where("text like 'No new%'").count() == polls - alerts.select("timestamp").distinct().count()


def test_empty_history(spark):
    none = spark.createDataFrame([], SWAP_SCHEMA)
    assert suppress_replay(replay_counts(none, START)).count() == 0


def test_late_swaps_in_any_order_give_the_result_of_swaps_in_order(spark):
    rows = random_swaps(7)
    until = START + timedelta(hours=8)
    expected = {tuple(r) for r in corrected_columns(replay_counts(spark.createDataFrame(rows, SWAP_SCHEMA), until)).collect()}
    rng = random.Random(3)
    rng.shuffle(rows)
    cuts = [0, len(rows) * 5 // 8, len(rows) * 6 // 8, len(rows) * 7 // 8, len(rows)]
    parts = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
    known = spark.createDataFrame(parts[0], SWAP_SCHEMA)
    found = settled(corrected_columns(replay_counts(known, until)))
    for part in parts[1:]:
        late = spark.createDataFrame(part, SWAP_SCHEMA)
        found = settled(corrected(found, settled(late_corrections(known, late, until))))
        known = known.unionByName(late)
    assert {tuple(r) for r in found.collect()} == expected and found.count() == len(expected) > 200


def corrected_columns(df):
    return df.select("timestamp", "token", "time_interval", "num_users_bought", "num_users_sold")


def test_corrections_touch_the_tokens_and_polls_of_late_swaps_only(spark):
    rows = random_swaps(8)
    known = spark.createDataFrame(rows, SWAP_SCHEMA)
    at = START + timedelta(hours=4, minutes=2)
    late = spark.createDataFrame([(at, f"new{k}", "SOL", "A", "RAYDIUM") for k in range(9)], "timestamp timestamp_ntz, user_address string, swapfromtoken string, swaptotoken string, source string").select(*known.columns)
    got = late_corrections(known, late, START + timedelta(hours=8)).collect()
    assert got and {r.token for r in got} <= {"A", "SOL"}
    assert min(r.timestamp for r in got) >= at and max(r.timestamp for r in got) <= at + timedelta(hours=3, minutes=5)
    assert late_corrections(known, late.limit(0), START + timedelta(hours=8)).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_replay_holds_no_table_of_nearly_distinct_keys_before_its_first_shuffle(spark):
    """A hash table of traders and polls on the map side holds a whole split; each (token, tick) is sorted once, before polls are made of it."""
    df = spark.createDataFrame(random_swaps(5), SWAP_SCHEMA)
    plan = plan_of(replay_counts(df, START + timedelta(hours=9)))
    grouped = [line for line in plan.split("\n") if "HashAggregate(" in line and "user_address" in line]
    assert grouped == [] and plan.count("Exchange hashpartitioning(") == 3


def test_repeats_of_a_trader_inside_a_period_count_once(spark):
    rows = [(START + timedelta(minutes=m, seconds=s), f"u{u}", "SOL", "A", "ORCA") for m in (1, 6, 31, 66) for s in (0, 0, 7, 9) for u in range(4)]
    rows += [(START + timedelta(minutes=1), None, "SOL", "A", "ORCA")] * 3
    until = START + timedelta(hours=5)
    got = {tuple(r) for r in replay_counts(spark.createDataFrame(rows, SWAP_SCHEMA), until).collect()}
    assert got == brute_counts(rows, RULES, until) and len(got) > 10


def test_corrections_come_from_one_pass(spark):
    """Counts with and without late swaps stand in one row; known and late swaps of one trader may share a poll period."""
    rows = random_swaps(11)
    until = START + timedelta(hours=9)
    twins = [(t, u, x, y, s) for t, u, x, y, s in rows[:200]]
    known, late = spark.createDataFrame(rows[100:], SWAP_SCHEMA), spark.createDataFrame(twins, SWAP_SCHEMA)
    changes = late_corrections(known, late, until)
    assert "FullOuter" not in plan_of(changes)
    got = corrected(replay_counts(known, until), settled(changes)).collect()
    assert {tuple(r) for r in got} == brute_counts([*rows[100:], *twins], RULES, until) and len({tuple(r) for r in got}) == len(got)


def test_a_history_by_parts_of_its_tokens_is_the_whole_history(spark):
    rows = random_swaps(12)
    until = START + timedelta(hours=9)
    known, late = spark.createDataFrame(rows[:700], SWAP_SCHEMA), spark.createDataFrame(rows[700:], SWAP_SCHEMA)
    got = []
    for part in range(3):
        own, own_late = (swaps_of_part(x, part, 3) for x in (known, late))
        with shuffles_dropped(spark):
            changes = stored(late_corrections(own, own_late, until))
            got += stored(corrected_columns(corrected(replay_counts(own, until), changes))).collect()
    assert {tuple(r) for r in got} == brute_counts(rows, RULES, until) and len({tuple(r) for r in got}) == len(got)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_many_late_tokens_meet_the_known_swaps_without_a_shuffle_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(replay, "is_small", lambda df: False)
    rows = random_swaps(13)
    until = START + timedelta(hours=9)
    known, late = spark.createDataFrame(rows[:700], SWAP_SCHEMA), spark.createDataFrame(rows[700:], SWAP_SCHEMA)
    changes = late_corrections(known, late, until)
    plan = plan_of(changes)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
    got = corrected(replay_counts(known, until), stored(changes)).collect()
    assert {tuple(r) for r in got} == brute_counts(rows, RULES, until)


def test_uncounted_legs_of_a_poll_are_no_large_window(spark):
    """Each is a partition of its own in the window: thousands in one would need memory beside the sums."""
    text = plan_of(replay.count_changes(replay.trader_ticks(spark.createDataFrame(random_swaps(14), SWAP_SCHEMA)), RULES))
    assert "monotonically_increasing_id" in text and "Window" in text
