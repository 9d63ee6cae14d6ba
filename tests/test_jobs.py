"""Whole jobs on catalog tables, and what they leave behind."""

from __future__ import annotations

import json
import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from podwatch import fixed_values as fv
from podwatch.checks import fixtures as fx
from podwatch.checks import job_queries
from podwatch.functions import payload
from podwatch.functions.timing import parse_instant
from podwatch.operators import catalog, landing
from podwatch.operators.keyed_table import current_rows, merge_rows
from podwatch.plans import whale_poll
from podwatch.plans.metadata_load import create_tables
from podwatch.plans.price_landing import run_price_landing
from podwatch.plans.whale_poll import poll_alerts, run_poll
from podwatch.rules import RULES
from podwatch.schemas import TableNames
from podwatch.sources.landed import read_responses
from podwatch.streaming.sinks import publish_batch, start_payload_landing

SF = "/root/testdata/sf0.001"


def names_in(database):
    return TableNames(
        f"{database}.swaps",
        f"{database}.whale_notifications",
        f"{database}.token_metadata",
        f"{database}.whale_outbox",
        f"{database}.btc_historic",
        f"{database}.poll_texts",
    )


def instants(df):
    """Test tables hold plain timestamps; the real ones hold instants."""
    return df.select(
        *(F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else f.name for f in df.schema.fields)
    )


def fill(spark, names, root):
    create_tables(spark, names, root)
    swaps = instants(fx.swaps(spark, SF)).withColumn("day", F.to_date("timestamp"))
    swaps.write.partitionBy("day").format("parquet").saveAsTable(names.swaps)
    log = instants(fx.alert_log(spark, SF))
    for missing, kind in (("timestamp", "timestamp"), ("symbol", "string"), ("name", "string"), ("num_users_bought", "bigint"), ("num_users_sold", "bigint")):
        log = log.withColumn(missing, F.lit(None).cast(kind))
    log = log.withColumns({"day": F.lit(None).cast("string"), "poll": F.lit(None).cast("string")})
    log.select(*spark.table(names.alert_log).columns).write.insertInto(names.alert_log)
    known = instants(fx.token_metadata(spark, SF)).withColumn("decimals", F.col("decimals").cast("decimal(38,0)"))
    merge_rows(spark, names.token_metadata, known, lambda target, source: source)


def test_poll_job(spark, database, tmp_path):
    names = names_in(database)
    fill(spark, names, str(tmp_path))
    answers = fx.responses(spark, SF)
    expected = poll_alerts(
        spark.table(names.swaps), spark.table(names.alert_log), current_rows(spark, names.token_metadata), answers, fx.AS_OF
    )
    want = sorted((r.token, r.time_interval, r.num_users_bought, r.num_users_sold, r.message) for r in expected.collect())
    metadata_before = current_rows(spark, names.token_metadata).count()
    log_before = spark.table(names.alert_log).count()

    first = run_poll(spark, names, answers, fx.AS_OF, date_column="day")
    assert first.alerts == len(want) > 10 and not first.resumed
    outbox = spark.table(names.outbox).join(
        spark.table(names.alert_log).where("timestamp is not null").withColumnRenamed("address", "token").drop("timestamp"),
        ["token", "time_interval"],
    )
    got = sorted((r.token, r.time_interval, r.num_users_bought, r.num_users_sold, r.message) for r in outbox.collect())
    assert got == want
    assert spark.table(names.alert_log).count() == log_before + len(want)
    after = current_rows(spark, names.token_metadata)
    assert after.count() > metadata_before
    assert after.where("inserted_at = timestamp'2024-01-31 00:00:00'").count() > 0
    parts = spark.table(names.poll_texts).orderBy("part").collect()
    rule = {r.label: k for k, r in enumerate(RULES)}
    assert "\n".join(r.text for r in parts) == "\n".join(m for *_, m in sorted(((rule[i], t, m) for t, i, *_, m in want)))
    assert {r.parts for r in parts} == {len(parts)}

    again = run_poll(spark, names, answers, fx.AS_OF, date_column="day")
    assert not again.resumed and again.alerts == 0
    assert spark.table(names.outbox).count() == len(want)

    soon = run_poll(spark, names, answers, "2024-01-31 00:05:00", date_column="day")
    repeated = spark.table(names.outbox).groupBy("token", "time_interval").count().where("count > 1").count()
    assert repeated == 0 and soon.alerts >= 0


def once(spark, names):
    """Messages of the outbox, each of which must be there once; and texts, one per poll and part."""
    outbox = spark.table(names.outbox)
    assert outbox.groupBy("timestamp", "token", "time_interval").count().where("count > 1").count() == 0
    assert spark.table(names.poll_texts).groupBy("timestamp", "part").count().where("count > 1").count() == 0
    return outbox.count()


def test_a_poll_that_died_after_its_log_is_published_two_days_later(spark, database, tmp_path, monkeypatch):
    names = names_in(database)
    fill(spark, names, str(tmp_path))
    answers = fx.responses(spark, SF)

    def dies(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(whale_poll, "publish", dies)
        with pytest.raises(RuntimeError, match="executor lost"):
            run_poll(spark, names, answers, fx.AS_OF)
    logged = spark.table(names.alert_log).where("timestamp is not null").count()
    assert logged > 10 and once(spark, names) == 0
    result = run_poll(spark, names, answers, "2024-02-02 00:00:00")
    assert result.resumed and result.alerts == logged == once(spark, names)
    assert spark.table(names.poll_texts).where("timestamp = timestamp'2024-01-31 00:00:00'").count() > 0
    quiet = spark.table(names.poll_texts).where("timestamp = timestamp'2024-02-02 00:00:00'").collect()
    assert [(r.part, r.parts, r.text) for r in quiet] == [(0, 1, fv.NOTHING_TO_REPORT)]
    assert run_poll(spark, names, answers, "2024-02-02 00:00:00").alerts == 0 and once(spark, names) == logged


@pytest.mark.parametrize("other", [fx.AS_OF, "2024-01-31 00:05:00"])
@pytest.mark.parametrize("between", ["log", "outbox"])
def test_overlapping_polls_publish_once(spark, database, tmp_path, monkeypatch, other, between):
    """Another poll runs as a whole just before this one writes its log, or its outbox."""
    names = names_in(database)
    fill(spark, names, str(tmp_path))
    answers = fx.responses(spark, SF)
    add, calls = catalog.add_once, []

    def other_first(df, name, key):
        if name == getattr(names, "alert_log" if between == "log" else "outbox") and not calls:
            calls.append(1)
            run_poll(spark, names, answers, other)
        return add(df, name, key)

    monkeypatch.setattr(whale_poll, "add_once", other_first)
    run_poll(spark, names, answers, fx.AS_OF)
    logged = spark.table(names.alert_log).where("timestamp is not null")
    assert calls and once(spark, names) == logged.count() > 10
    assert logged.groupBy("timestamp", "address", "time_interval").count().where("count > 1").count() == 0
    assert run_poll(spark, names, answers, "2024-01-31 00:10:00").resumed is False


def test_the_last_poll_of_the_grid_is_made_without_as_of(spark, database, tmp_path, monkeypatch):
    names = names_in(database)
    fill(spark, names, str(tmp_path))
    clock = parse_instant(fx.AS_OF) + timedelta(minutes=2, microseconds=7)
    monkeypatch.setattr("podwatch.plans.whale_poll.utc_now", lambda: clock)
    assert run_poll(spark, names, fx.responses(spark, SF)).alerts > 10
    assert {str(r.timestamp) for r in spark.table(names.outbox).collect()} == {fx.AS_OF}
    assert run_poll(spark, names, fx.responses(spark, SF)).alerts == 0


def test_quiet_poll_leaves_the_sentence(spark, database, tmp_path):
    names = names_in(database)
    fill(spark, names, str(tmp_path))
    result = run_poll(spark, names, fx.responses(spark, SF), "2030-01-01 00:00:00")
    assert (result.alerts, result.resumed) == (0, False)
    assert spark.table(names.outbox).count() == 0
    assert [r.text for r in spark.table(names.poll_texts).collect()] == [fv.NOTHING_TO_REPORT]


def test_a_poll_reads_the_days_of_its_cooldowns_only(spark, database, tmp_path):
    names = names_in(database)
    create_tables(spark, names, str(tmp_path))
    log = spark.table(names.alert_log)
    text = whale_poll.alerts_that_matter(log, fx.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[\(isnull\(day#\d+\) OR \(day#\d+ >= 2024-01-30\)\)\]", text)


def test_answers_that_say_nothing_new_write_nothing(spark, database, tmp_path):
    names = names_in(database)
    fill(spark, names, str(tmp_path))
    answers = fx.responses(spark, SF)
    run_poll(spark, names, answers, fx.AS_OF)
    before = catalog.partition_values(spark, names.token_metadata)
    run_poll(spark, names, answers, "2024-01-31 00:00:00.000001")
    assert catalog.partition_values(spark, names.token_metadata) == before


def test_publishing_a_batch_twice_adds_nothing(spark, database, tmp_path):
    names = names_in(database)
    fill(spark, names, str(tmp_path))
    before = spark.table(names.alert_log).count()
    batch = spark.createDataFrame(
        [("T2solanaMintAddress", "30min", 5, 1), ("T3solanaMintAddress", "30min", 5, 1), ("unknown", "1hour", 1, 4)],
        "token string, time_interval string, num_users_bought bigint, num_users_sold bigint",
    ).withColumn("timestamp", F.lit("2024-01-31 00:00:00").cast("timestamp"))
    assert publish_batch(batch, names, "stream-x-1") == 2
    assert publish_batch(batch, names, "stream-x-1") == 0
    assert sorted(r.token for r in spark.table(names.outbox).collect()) == ["T2solanaMintAddress", "unknown"]
    assert spark.table(names.alert_log).count() == before + 2
    logged = spark.table(names.alert_log).where("address = 'unknown'").first()
    assert (logged.time_interval, logged.num_users_bought, logged.num_users_sold) == ("1hour", 1, 4)
    assert (logged.symbol, logged.name, logged.timestamp) == ("unknown", "unknown", logged.inserted_at)
    sent = spark.table(names.outbox).where("token = 'unknown'").first()
    assert (sent.rule_order, sent.time_interval) == (2, "1hour") and "WHALE ALERT" in sent.message


def payload_files(folder, bodies):
    folder.mkdir(exist_ok=True)
    for name, body in bodies.items():
        (folder / name).write_text(body, encoding="utf-8")
    return str(folder)


def test_price_landing(spark, database, tmp_path):
    table = f"{database}.btc_historic"
    spark.sql(f"CREATE TABLE {table} (raw_data VARIANT) USING parquet")
    listed = json.dumps([{"close": 1.5, "note": "it's"}, {"close": 2}], indent=1)
    path = payload_files(tmp_path / "in", {"a.json": listed, "b.json": '{"error": "limit \\\\ \\"x\\""}'})
    assert run_price_landing(spark, path, table) == 3
    assert run_price_landing(spark, path, table) == 3
    stored = spark.table(table).select(payload.json_text(F.col("raw_data")).alias("t")).collect()
    texts = sorted(r.t for r in stored)
    assert len(texts) == 4
    assert json.loads(texts[0]) == json.loads(listed) or json.loads(texts[-1]) == json.loads(listed)
    assert sorted(json.dumps(json.loads(t)) for t in set(texts)) == sorted(
        [json.dumps(json.loads(listed)), json.dumps([{"error": 'limit \\ "x"'}])]
    )


def test_bad_payload_fails_the_landing(spark, database, tmp_path):
    table = f"{database}.btc_historic"
    spark.sql(f"CREATE TABLE {table} (raw_data VARIANT) USING parquet")
    path = payload_files(tmp_path / "in", {"a.json": "{broken"})
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        run_price_landing(spark, path, table)
    assert spark.table(table).count() == 0
    bodies = spark.createDataFrame([("{broken",), ("[1]",), (None,)], "body string")
    assert [r.body for r in landing.bad_payloads(bodies).collect()] == ["{broken"]


def test_stream_landing_takes_each_file_once(spark, database, tmp_path):
    table = f"{database}.btc_historic"
    spark.sql(f"CREATE TABLE {table} (raw_data VARIANT) USING parquet")
    path = payload_files(tmp_path / "in", {"a.json": "[1, 2]"})
    checkpoint = str(tmp_path / "checkpoint")
    start_payload_landing(spark, path, table, checkpoint).awaitTermination()
    payload_files(tmp_path / "in", {"b.json": '{"x": 1}'})
    for _ in range(2):
        start_payload_landing(spark, path, table, checkpoint).awaitTermination()
    texts = sorted(r[0] for r in spark.table(table).select(payload.json_text(F.col("raw_data"))).collect())
    assert texts == ["[1,2]", '[{"x":1}]']


def test_landed_responses(spark, tmp_path):
    lines = [json.dumps({"address": "a", "status_code": 200, "body": '{"success":true}'}), json.dumps({"address": "b", "status_code": 404, "fetched_at": "2024-01-31T12:00:00Z"})]
    path = payload_files(tmp_path / "answers", {"part.json": "\n".join(lines)})
    found = read_responses(spark, path).withColumn("fetched_at", F.date_format("fetched_at", "yyyy-MM-dd HH:mm"))
    assert sorted(map(tuple, found.collect())) == [("a", 200, '{"success":true}', None), ("b", 404, None, "2024-01-31 12:00")]


def test_record_counts(spark):
    bodies = spark.createDataFrame([("[1,2,3]",), ("[]",), ('{"a":[1,2]}',)], "body string")
    assert [r.record_count for r in landing.payload_counts(bodies).collect()] == [3, 0, 1]


def test_quiet_text_is_the_fixed_sentence():
    assert fv.NOTHING_TO_REPORT == "No new whale notifications triggered."


def test_a_poll_of_the_test_tables_reads_its_swaps_without_writing_them_first(spark):
    names = job_queries._polled(spark, SF)
    assert spark.catalog.getTable(names.swaps).isTemporary
    assert spark.table(names.swaps).count() == fx.swaps(spark, SF).count()
    assert spark.table(names.alert_log).where("poll is not null").count() > 0
