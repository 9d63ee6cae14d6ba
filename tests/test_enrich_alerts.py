"""Metadata, fallbacks, cooldown, sentiment and text."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from podwatch import fixed_values as fv
from podwatch.operators import alerts, enrich
from podwatch.plans.whale_poll import alerts_from_candidates

TOKEN = "So1anaTokenAddressThatIsLong"
CAND = "timestamp string, token string, time_interval string, num_users_bought bigint, num_users_sold bigint, last_notification string"
META = "address string, symbol string, name string, decimals bigint"


def candidates(spark, rows):
    df = spark.createDataFrame(rows, CAND)
    for c in ("timestamp", "last_notification"):
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def one(spark, last=None, interval="30min", now="2024-01-31 12:00:00", bought=3, sold=0, token=TOKEN):
    return candidates(spark, [(now, token, interval, bought, sold, last)])


@pytest.mark.parametrize(
    ("last", "interval", "kept"),
    [
        (None, "30min", True),
        ("2024-01-31 11:45:00", "30min", True),
        ("2024-01-31 11:45:00.000001", "30min", False),
        ("2024-01-31 11:30:00", "1hour", True),
        ("2024-01-31 11:30:01", "1hour", False),
        ("2024-01-31 11:00:00", "3hours", True),
        ("2024-01-31 11:00:01", "3hours", False),
        ("2024-01-31 11:30:00", "2weeks", True),
        ("2024-01-31 11:30:01", "2weeks", False),
        ("2024-01-31 12:30:00", "30min", False),
    ],
)
def test_cooldown(spark, last, interval, kept):
    assert (alerts.suppress_recent(one(spark, last, interval)).count() == 1) is kept


def test_missing_incomplete_and_wanted(spark):
    meta = spark.createDataFrame(
        [("a", "A", "Alpha", 1), ("b", "", "Beta", 1), ("c", "C", None, 1), ("zz", None, None, 1)], META
    )
    tokens = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("d",), (None,)], "token string")
    assert [r[0] for r in enrich.missing_tokens(tokens, meta).collect()] == ["d"]
    found = enrich.lookup_metadata(meta, tokens)
    assert sorted(r[0] for r in found.collect()) == ["a", "b", "c"]
    assert sorted(r[0] for r in enrich.incomplete_tokens(found).collect()) == ["b", "c"]
    assert sorted(r[0] for r in enrich.tokens_to_fetch(tokens, meta).collect()) == ["b", "c", "d"]


def test_the_newest_valid_answer_as_of_the_poll_counts(spark):
    def good(symbol):
        return f'{{"success":true,"data":{{"symbol":"{symbol}","name":"N","decimals":6}}}}'

    answers = spark.createDataFrame(
        [
            ("a", 200, good("Z"), "2024-01-31 10:00:00"),
            ("a", 200, good("A"), "2024-01-31 11:00:00"),
            ("a", 500, good("X"), "2024-01-31 11:30:00"),
            ("a", 200, good("later"), "2024-01-31 12:30:00"),
            ("b", 200, good("untimed"), None),
            ("c", 200, good("untimed"), None),
            ("c", 200, good("C"), "2024-01-30 00:00:00"),
            ("d", 200, good("later"), "2024-01-31 12:30:00"),
        ],
        "address string, status_code int, body string, at string",
    ).withColumn("fetched_at", F.col("at").cast("timestamp")).drop("at")
    asked = spark.createDataFrame([(x,) for x in "abcde"], "address string")
    got = {r.address: r.symbol for r in enrich.resolve_responses(asked, answers, "2024-01-31 12:00:00").collect()}
    assert got == {"a": "A", "b": "untimed", "c": "C", "d": "", "e": ""}
    assert {r.address: r.symbol for r in enrich.resolve_responses(asked, answers).collect()}["a"] == "later"


def test_responses_give_one_row_per_address(spark):
    good = '{"success":true,"data":{"symbol":"S","name":"N","decimals":6}}'
    answers = spark.createDataFrame(
        [
            ("ok", 200, good),
            ("ok", 200, good),
            ("missing", 404, good),
            ("refused", 200, '{"success":false,"data":{"symbol":"S"}}'),
            ("nodata", 200, '{"success":true}'),
            ("nulls", 200, '{"success":true,"data":{"symbol":null,"name":"only","decimals":null}}'),
            ("broken", 200, "{not json"),
            ("never_asked", 200, good),
        ],
        "address string, status_code int, body string",
    )
    asked = spark.createDataFrame(
        [(a,) for a in ("ok", "ok", "missing", "refused", "nodata", "nulls", "broken", "absent", None)], "address string"
    )
    got = {r.address: (r.symbol, r.name, r.decimals) for r in enrich.resolve_responses(asked, answers).collect()}
    nothing = ("", "", None)
    assert got == {
        "ok": ("S", "N", 6),
        "missing": nothing,
        "refused": nothing,
        "nodata": nothing,
        "nulls": ("", "only", None),
        "broken": nothing,
        "absent": nothing,
    }


def test_fallback_from_address(spark):
    meta = spark.createDataFrame([(TOKEN, "", None, 1)], META)
    row = enrich.attach_metadata(one(spark), meta).first()
    assert (row.symbol, row.name) == (TOKEN[:10], TOKEN[:15])


def test_empty_lookup_gives_whole_address(spark):
    meta = spark.createDataFrame([("other", "O", "Other", 1)], META)
    row = enrich.attach_metadata(one(spark), meta).first()
    assert (row.symbol, row.name) == (TOKEN, TOKEN)
    row = enrich.attach_metadata(one(spark), meta, none_found=False).first()
    assert (row.symbol, row.name) == (TOKEN[:10], TOKEN[:15])


def test_deny_list_in_any_case_keeps_null(spark):
    df = spark.createDataFrame([("sol",), ("uSdC",), ("WETH",), ("",), (None,)], "symbol string")
    assert sorted("null" if r[0] is None else r[0] for r in enrich.drop_denied(df).collect()) == ["", "WETH", "null"]


@pytest.mark.parametrize(
    ("bought", "sold", "values", "ratio"),
    [
        (7, 2, fv.BULLISH, "7/2 buy/sell ratio"),
        (2, 7, fv.BEARISH, "7/2 sell/buy ratio"),
        (4, 4, fv.NEUTRAL, "4/4 buy/sell ratio"),
        (4, 0, fv.BULLISH, "4/0 buy/sell ratio"),
    ],
)
def test_message(spark, bought, sold, values, ratio):
    meta = spark.createDataFrame([(TOKEN, "IT'S", "Na'me <b>", 1)], META)
    row = alerts_from_candidates(one(spark, bought=bought, sold=sold, interval="3hours"), meta).first()
    indicator, arrow, sentiment = values
    assert row.message == (
        f"\n{indicator} *WHALE ALERT* {indicator}\n"
        f"{arrow} {sentiment}: <https://dexscreener.com/solana/{TOKEN}|Na'me <b> (IT'S)>\n"
        "• *Time Frame*: Last 3 hours\n"
        f"• *Unique Buyers*: {bought} users\n"
        f"• *Unique Sellers*: {sold} users\n"
        f"• *Activity Ratio*: {ratio}\n"
        f"• *Token Address*: `{TOKEN}`\n"
    )


def test_unknown_interval_reads_one_hour(spark):
    row = alerts.with_message(enrich.attach_metadata(one(spark, interval="x"), spark.createDataFrame([], META))).first()
    assert "Last 1 hour\n" in row.message


def test_poll_text_in_parts_joins_to_the_whole(spark):
    many = spark.range(1234).select(
        F.lit("2024-01-31 12:00:00").cast("timestamp_ntz").alias("timestamp"),
        (F.col("id") % 3 + 1).cast("int").alias("rule_order"),
        F.concat(F.lit("t"), F.col("id")).alias("token"),
        F.lit("30min").alias("time_interval"),
        F.concat(F.lit("m"), F.col("id")).alias("message"),
    ).repartition(7)
    assert {r.parts for r in alerts.poll_text_parts(many, 100).collect()} == {13}
    parts = {r.part: r.text for r in alerts.poll_text_parts(many, 100).collect()}
    assert sorted(parts) == list(range(13))
    assert [len(parts[i].split("\n")) for i in range(13)] == [100] * 12 + [34]
    whole = [m for i in range(13) for m in parts[i].split("\n")]
    assert len(set(whole)) == 1234
    assert whole == sorted(whole, key=lambda m: (int(m[1:]) % 3, "t" + m[1:]))
    single = alerts.poll_text_parts(many, 5000).collect()
    assert len(single) == 1 and single[0].text == "\n".join(whole)


def test_quiet_poll(spark):
    empty = spark.createDataFrame([], "timestamp timestamp_ntz, rule_order int, token string, time_interval string, message string")
    polls = alerts.single_poll(empty, "2024-01-31 12:00:00")
    row = alerts.poll_texts(polls, empty).withColumn("quiet", alerts.is_quiet(F.col("text"))).first()
    assert (row.part, row.parts, row.text, row.quiet) == (0, 1, fv.NOTHING_TO_REPORT, True)
    padded = spark.createDataFrame([("\n " + fv.NOTHING_TO_REPORT + " \n",), ("other",)], "text string")
    assert [r[0] for r in padded.select(alerts.is_quiet(F.col("text"))).collect()] == [True, False]


def test_empty_candidates_flow_through(spark):
    none = candidates(spark, [])
    meta = spark.createDataFrame([], META)
    assert alerts_from_candidates(none, meta).count() == 0


def test_only_responses_of_wanted_addresses_are_parsed(spark):
    good = '{"success":true,"data":{"symbol":"S","name":"N","decimals":6}}'
    rows = [("a", 200, good), ("a", 404, good), ("b", 200, '{"success":false}'), ("b", 200, "not json"), ("c", 200, good), (None, 200, good)]
    responses = spark.createDataFrame(rows, "address string, status_code int, body string")
    wanted = spark.createDataFrame([("a",), ("b",), ("d",), (None,)], "address string")
    found = enrich.resolve_responses(wanted, responses)
    assert sorted(found.collect()) == [("a", "S", "N", 6), ("b", "", "", None), ("d", "", "", None)]
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join = next(k for k, line in enumerate(plan) if "LeftSemi" in line)
    assert any("from_json" in line for line in plan[:join])
    assert not any("from_json" in line for line in plan[join:])
