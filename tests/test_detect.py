"""Edges of detection on hand-written rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from podwatch.operators import detect
from podwatch.operators.replay import replay_counts
from podwatch.rules import RULES, rules_frame

AS_OF = "2024-01-31 12:00:00"
SWAPS = "timestamp string, user_address string, swapfromtoken string, swaptotoken string, source string"
LOG = "address string, time_interval string, inserted_at string"


def make_swaps(spark, rows, kind="timestamp"):
    """Rows are (seconds before the run time, user, from, to, source)."""
    base = F.lit(AS_OF + "Z").cast("timestamp") if kind == "timestamp" else F.lit(AS_OF).cast("timestamp_ntz")
    df = spark.createDataFrame(
        [(float(r[0]), *r[1:]) for r in rows],
        "age double, user_address string, swapfromtoken string, swaptotoken string, source string",
    )
    age = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("age").cast("decimal(18,6)"))
    return df.withColumn("timestamp", base - age).drop("age")


def make_log(spark, rows=()):
    return spark.createDataFrame(list(rows), LOG).withColumn(
        "inserted_at", F.concat("inserted_at", F.lit("Z")).cast("timestamp")
    )


def found(spark, rows, kind="timestamp", log=()):
    df = detect.detect_candidates(make_swaps(spark, rows, kind), make_log(spark, log), AS_OF)
    return {(r.token, r.time_interval): (r.num_users_bought, r.num_users_sold) for r in df.collect()}


def buys(token, users, age=60, source="ORCA", start=0):
    return [(age, f"u{start + i}", None, token, source) for i in range(users)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_threshold_is_strict(spark, kind):
    assert found(spark, buys("A", 2), kind) == {}
    assert found(spark, buys("A", 3), kind) == {("A", "30min"): (3, 0)}


def test_a_repeated_user_counts_once(spark):
    assert found(spark, buys("A", 2) + buys("A", 2)) == {}


def test_null_user_is_not_counted_but_makes_recent(spark):
    rows = buys("A", 3, age=1200) + [(60, None, "A", None, "ORCA")]
    assert found(spark, rows) == {("A", "30min"): (3, 0)}
    assert found(spark, buys("A", 3, age=1200)) == {}


@pytest.mark.parametrize("source", ["PUMP_FUN", None])
def test_uncounted_venue_makes_recent_only(spark, source):
    assert found(spark, buys("A", 9, source=source)) == {}
    rows = buys("A", 3, age=1200) + buys("A", 1, source=source, start=50)
    assert found(spark, rows) == {("A", "30min"): (3, 0)}


def test_null_tokens_never_match(spark):
    assert found(spark, [(60, f"u{i}", None, None, "ORCA") for i in range(9)]) == {}


def test_window_edges_are_strict_and_open_to_the_future(spark):
    on_edge, inside = buys("A", 3, age=1800), buys("A", 3, age=1799.999999)
    recent = [(0, None, "A", None, None)]
    assert ("A", "30min") not in found(spark, on_edge + recent)
    assert found(spark, inside + recent)[("A", "30min")] == (3, 0)
    assert found(spark, buys("A", 3, age=-86400)) == {("A", "30min"): (3, 0)}


def test_recency_edge(spark):
    assert found(spark, buys("A", 3, age=600)) == {}
    assert found(spark, buys("A", 3, age=599.999999)) == {("A", "30min"): (3, 0)}


def test_half_hour_window_is_thirty_minutes(spark):
    rows = buys("A", 3, age=1700) + [(1, None, "A", None, None)]
    assert found(spark, rows)[("A", "30min")] == (3, 0)


def test_all_rules_and_both_sides(spark):
    rows = buys("A", 6) + [(5000, f"s{i}", "A", None, "ORCA") for i in range(7)]
    assert found(spark, rows) == {
        ("A", "30min"): (6, 0),
        ("A", "1hour"): (6, 0),
        ("A", "3hours"): (6, 7),
    }


def test_last_alert_is_per_interval(spark):
    log = [
        ("A", "30min", "2024-01-31 11:00:00"),
        ("A", "30min", "2024-01-31 11:30:00"),
        ("B", "1hour", "2024-01-31 11:00:00"),
    ]
    df = detect.detect_candidates(make_swaps(spark, buys("A", 4)), make_log(spark, log), AS_OF)
    last = {r.time_interval: r.last_notification for r in df.select("time_interval", F.date_format("last_notification", "HH:mm").alias("last_notification")).collect()}
    assert last == {"30min": "11:30", "1hour": None}


def test_upper_case_columns_resolve(spark):
    swaps = make_swaps(spark, buys("A", 3))
    upper = swaps.toDF(*(c.upper() for c in swaps.columns))
    log = make_log(spark)
    df = detect.detect_candidates(upper, log.toDF(*(c.upper() for c in log.columns)), AS_OF)
    assert [r.token for r in df.collect()] == ["A"]
    assert df.columns[0] == "timestamp"


def test_trader_counts_and_windowed_counts_agree(spark):
    rows = buys("A", 4) + buys("B", 5, age=2000) + [(30, "z", "B", "A", "JUPITER")]
    swaps = make_swaps(spark, rows)
    tokens = detect.recent_tokens(swaps, AS_OF)
    wide = detect.windowed_counts(swaps, AS_OF)
    for rule in RULES:
        single = detect.trader_counts(swaps, tokens, AS_OF, rule.length_minutes)
        one = wide.where(F.col("time_interval") == rule.label).select(
            F.col("token").alias("token_address"), "num_users_bought", "num_users_sold"
        )
        assert sorted(map(tuple, single.collect())) == sorted(map(tuple, one.collect()))


def test_empty_inputs(spark):
    assert found(spark, []) == {}
    assert detect.recent_tokens(make_swaps(spark, []), AS_OF).count() == 0


def test_rules_table(spark):
    assert [tuple(r) for r in rules_frame(spark).collect()] == [
        (1, "30min", 30, 2, 15, "30 min"),
        (2, "1hour", 60, 3, 30, "1 hour"),
        (3, "3hours", 180, 5, 60, "3 hours"),
    ]


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
@pytest.mark.parametrize("moment", ["2024-01-31 00:30:00", "2024-01-31 05:10:00", "2024-01-31 15:20:00"])
def test_dates_of_another_zone_prune_no_swap(spark, zone, moment):
    """The table's dates are of the exchange's zone, the session is in UTC."""
    history = spark.range(0, 26 * 60, 7).select(
        (F.lit("2024-01-30 14:00:00Z").cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("timestamp"),
        F.concat(F.lit("u"), F.col("id")).alias("user_address"), F.lit("A").alias("swapfromtoken"), F.lit("B").alias("swaptotoken"), F.lit("X").alias("source"),
    )
    dated = history.withColumn("day", F.to_date(F.from_utc_timestamp("timestamp", zone)))
    kept = {"date_column": "day", "date_zone": zone}

    def same(plain, pruned):
        return sorted(map(tuple, plain.collect())) == sorted(map(tuple, pruned.collect())) != []

    assert same(detect.windowed_counts(history, moment), detect.windowed_counts(dated, moment, **kept))
    assert same(detect.recent_tokens(history, moment), detect.recent_tokens(dated, moment, **kept))
    assert same(replay_counts(history, moment, "2024-01-31 00:00:00"), replay_counts(dated, moment, "2024-01-31 00:00:00", **kept))
