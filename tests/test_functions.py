"""Time, text and payload expressions."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podwatch.functions import payload, text, timing
from podwatch.rules import cooldown_minutes, rule_order, rule_text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def as_text(column):
    return F.lit(column).cast("timestamp_ntz")


def test_parse_instant():
    plain = datetime(2024, 1, 31, 12, 0)
    assert timing.parse_instant("2024-01-31 12:00:00") == plain
    assert timing.parse_instant("2024-01-31T12:00:00Z") == plain
    assert timing.parse_instant("2024-01-31T14:00:00+02:00") == plain
    assert timing.parse_instant(datetime(2024, 1, 31, 14, tzinfo=timezone(timedelta(hours=2)))) == plain


def test_instant_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        micros = value(spark, F.unix_micros(timing.instant("2024-01-31 12:00:00", T.TimestampType())))
        plain = value(spark, timing.instant("2024-01-31 12:00:00", T.TimestampNTZType()).cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert micros == datetime(2024, 1, 31, 12, tzinfo=timezone.utc).timestamp() * 1e6
    assert plain == "2024-01-31 12:00:00"
    with pytest.raises(TypeError):
        timing.instant("2024-01-31", T.StringType())


@pytest.mark.parametrize(
    ("at", "tick"),
    [
        ("2024-01-31 12:00:00", "2024-01-31 12:00:00"),
        ("2024-01-31 12:00:00.000001", "2024-01-31 12:05:00"),
        ("2024-01-31 12:04:59.999999", "2024-01-31 12:05:00"),
        ("2024-01-31 12:05:00", "2024-01-31 12:05:00"),
        ("1969-12-31 23:59:59", "1970-01-01 00:00:00"),
    ],
)
def test_poll_tick(spark, at, tick):
    assert value(spark, timing.poll_tick(as_text(at), 5).cast("string")) == tick


def test_time_texts(spark):
    ts = as_text("2024-01-31 09:08:07.000120")
    assert value(spark, timing.second_text(ts)) == "2024-01-31 09:08:07"
    assert value(spark, timing.stamp_text(ts)) == "20240131090807"
    assert value(spark, timing.iso_text(ts)) == "2024-01-31T09:08:07.000120"
    assert value(spark, timing.iso_text(as_text("2024-01-31 09:08:07"))) == "2024-01-31T09:08:07"


@pytest.mark.parametrize(
    "iso", ["2024-01-31T12:00:00", "2024-01-31T12:00:00Z", "2024-01-31T12:00:00+00:00", "2024-01-31T14:00:00+02:00"]
)
def test_parse_iso(spark, iso):
    assert value(spark, F.unix_seconds(timing.parse_iso_utc(F.lit(iso)))) == 1706702400


def test_elapsed_minutes(spark):
    later, earlier = as_text("2024-01-31 12:34:30"), as_text("2024-01-31 10:00:00")
    assert value(spark, timing.elapsed_minutes_text(later, earlier)) == "154.5"
    assert value(spark, timing.elapsed_minutes_text(earlier, later)) == "-154.5"


def test_text_helpers(spark):
    assert value(spark, text.is_blank(F.lit(None).cast("string"))) is True
    assert value(spark, text.is_blank(F.lit(" "))) is False
    assert value(spark, text.leading(F.lit("añ🟢bc"), 3)) == "añ🟢"
    assert value(spark, text.stripped(F.lit(" \n\t x y \r\n"))) == "x y"
    assert value(spark, text.double_quotes(F.lit("it's ''"))) == "it''s ''''"
    assert value(spark, text.undouble_quotes(text.double_quotes(F.lit("it's ''")))) == "it's ''"
    filled = text.fill_template("{a}-{b}{a}\n", {"a": F.lit(1), "b": F.lit("x")})
    assert value(spark, filled) == "1-x1\n"


def test_payload_helpers(spark):
    body = F.lit('{"data": {"symbol": "S", "decimals": null}, "n": 3}')
    v = payload.json_value(body)
    assert value(spark, payload.json_field(v, "$.data.symbol", "string")) == "S"
    assert value(spark, payload.json_field(v, "$.data.decimals", "bigint", -1)) == -1
    assert value(spark, payload.json_field(v, "$.absent", "string", "")) == ""
    assert value(spark, payload.is_json_array(v)) is False
    assert value(spark, payload.is_json_array(payload.json_value(F.lit("[1]")))) is True
    assert value(spark, payload.json_text(payload.json_value(F.lit(" [1,  2] ")))) == "[1,2]"
    assert value(spark, payload.json_value_or_null(F.lit("{"))) is None
    assert value(spark, payload.as_json_array(F.lit("5"), payload.json_value(F.lit("5")))) == "[5]"


def test_rule_lookups(spark):
    assert value(spark, cooldown_minutes(F.lit("3hours"))) == 60
    assert value(spark, cooldown_minutes(F.lit("other"))) == 30
    assert value(spark, rule_text(F.lit("30min"))) == "30 min"
    assert value(spark, rule_text(F.lit("other"))) == "1 hour"
    assert [value(spark, rule_order(F.lit(x))) for x in ("30min", "1hour", "3hours", "x")] == [1, 2, 3, 4]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_date_pruning_does_not_depend_on_the_session_zone(spark, zone):
    from podwatch.sources.tables import swaps_since, swaps_until

    before = spark.conf.get("spark.sql.session.timeZone")
    rows = spark.range(0, 72).selectExpr(
        "timestamp'2024-01-30 00:00:00Z' + make_dt_interval(0, id) AS timestamp",
        "'u' user_address", "'a' swapfromtoken", "'b' swaptotoken", "'s' source",
        "date_add(date'2024-01-30', cast(id div 24 as int)) AS day",
    )
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for as_of in ("2024-01-31T03:00:00Z", "2024-01-31T23:30:00Z"):
            plain, pruned = swaps_since(rows, as_of, 180), swaps_since(rows, as_of, 180, "day")
            assert pruned.count() == plain.count() > 0
            plain, pruned = swaps_until(rows, as_of, as_of, 300), swaps_until(rows, as_of, as_of, 300, "day")
            assert pruned.count() == plain.count() == 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_poll_grid_off_the_ticks(spark):
    from pyspark.sql.types import TimestampType

    from podwatch.operators.replay import poll_grid

    got = [r.timestamp.minute for r in poll_grid(spark, "2024-01-31T00:02:00Z", "2024-01-31T00:17:30Z", TimestampType()).collect()]
    assert got == [5, 10, 15]
    with pytest.raises(ValueError):
        poll_grid(spark, "2024-01-31T00:02:00Z", "2024-01-31T00:03:00Z", TimestampType())


def test_success_takes_any_true_value(spark):
    from podwatch.functions.payload import is_true

    cases = {"true": True, "1": True, "yes": True, "0.5": True, "false": False, "0": False, "0.0": False, "": False, None: False}
    got = spark.createDataFrame([(k,) for k in cases], "s string").select("s", is_true(F.col("s")).alias("t")).collect()
    assert {r.s: r.t for r in got} == cases


def test_minute_number_is_the_same_in_any_zone(spark):
    texts = spark.createDataFrame([("2024-03-31 02:35:00",), ("1969-12-31 23:58:00",)], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        for kind, text in (("timestamp_ntz", F.col("t")), ("timestamp", F.concat("t", F.lit("Z")))):
            df = texts.select(text.cast(kind).alias("at"))
            assert [r[0] for r in df.select(timing.minute_number(df, "at")).collect()] == [28530875, -2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
