"""Streams give what the batch operators give for the same data."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Row
from pyspark.sql import functions as F

from podwatch.checks import fixtures as fx
from podwatch.operators.enrich import attach_metadata, drop_denied
from podwatch.operators.keyed_table import current_rows
from podwatch.operators.replay import replay_counts, suppress_replay
from podwatch.plans.metadata_load import create_tables, merge_metadata
from podwatch.schemas import TableNames
from podwatch.streaming.cooldown import stream_alerts
from podwatch.streaming.detect import GROUPS, TraderChanges, instant_before, packed, stream_candidates, unpacked
from podwatch.streaming.sinks import start_alert_publishing, start_candidate_log, start_whale_stream

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def write_in_order(df, path, parts):
    """One file after the other in order of time, so that a file stream reads them as they would have come in."""
    start, end = df.agg(F.min("timestamp"), F.max("timestamp")).first()
    for i in range(parts):
        after, before = start + (end - start) * i / parts, start + (end - start) * (i + 1) / parts
        at = F.col("timestamp")
        part = (at >= F.lit(after)) & ((at < F.lit(before)) if i + 1 < parts else F.lit(True))
        df.where(part).coalesce(1).write.mode("append").parquet(path)


def test_stream_candidates_equal_replay_of_closed_polls(spark, tmp_path):
    swaps = fx.swaps(spark, SF)
    write_in_order(swaps, str(tmp_path / "swaps"), 3)
    stream = (
        spark.readStream.schema(swaps.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "swaps"))
    )
    query = start_candidate_log(
        stream_candidates(stream), str(tmp_path / "candidates"), str(tmp_path / "checkpoint")
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "candidates"))
    got = got.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    newest = got.agg(F.max("timestamp")).first()[0]
    expected = replay_counts(swaps, fx.REPLAY_UNTIL).where(F.col("timestamp") <= F.lit(newest))
    columns = ["timestamp", "token", "time_interval", "num_users_bought", "num_users_sold"]
    assert rows(got.select(*columns)) == rows(expected.select(*columns))
    assert got.count() > 1000


def test_stream_cooldown_equals_batch_and_publishes(spark, tmp_path, database):
    swaps = fx.swaps(spark, SF)
    candidates = replay_counts(swaps, fx.REPLAY_UNTIL)
    columns = ["timestamp", "token", "time_interval", "num_users_bought", "num_users_sold"]
    path = str(tmp_path / "candidates")
    write_in_order(candidates.select(*columns), path, 2)
    schema = candidates.select(*columns).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    kept = stream_alerts(stream)
    query = start_candidate_log(kept, str(tmp_path / "alerts"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    expected = rows(suppress_replay(candidates).select(*columns))
    alerts = spark.read.parquet(str(tmp_path / "alerts")).select(*columns)
    assert rows(alerts) == expected

    names = TableNames(
        outbox=f"{database}.outbox",
        alert_log=f"{database}.log",
        token_metadata=f"{database}.metadata",
        btc_historic=f"{database}.btc",
        poll_texts=f"{database}.texts",
    )
    create_tables(spark, names, str(tmp_path / "tables"))
    known = spark.createDataFrame([("T3solanaMintAddress", "sol", "Sol", 9)], "address string, symbol string, name string, decimals int")
    merge_metadata(spark, names.token_metadata, known, fx.AS_OF)
    alerts.withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.parquet(str(tmp_path / "timed"))
    timed = spark.readStream.schema(spark.read.parquet(str(tmp_path / "timed")).schema).parquet(str(tmp_path / "timed"))
    start_alert_publishing(timed, names, str(tmp_path / "publishing")).awaitTermination()
    wanted = alerts.where("token <> 'T3solanaMintAddress'").count()
    assert wanted == spark.table(names.outbox).count() == spark.table(names.alert_log).count() < alerts.count()


def test_stream_cooldown_starts_from_earlier_alerts(spark, tmp_path):
    candidates = spark.createDataFrame(
        [("A", "30min", 5, 0, m) for m in (0, 5, 10, 15, 20, 25, 30)] + [("B", "30min", 5, 0, 5)],
        "token string, time_interval string, num_users_bought bigint, num_users_sold bigint, minute int",
    )
    minute = F.lit("2024-01-31 12:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("minute"))
    candidates = candidates.withColumn("timestamp", minute).drop("minute")
    candidates.write.parquet(str(tmp_path / "in"))
    earlier = spark.createDataFrame(
        [("A", "30min", "2024-01-31 11:55:00"), ("A", "1hour", "2024-01-31 11:59:00"), ("C", "30min", None)],
        "address string, time_interval string, last_notification string",
    ).withColumn("last_notification", F.col("last_notification").cast("timestamp"))
    stream = spark.readStream.schema(candidates.schema).parquet(str(tmp_path / "in"))
    query = start_candidate_log(
        stream_alerts(stream, earlier_alerts=earlier), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("token", F.date_format("timestamp", "HH:mm").alias("at"))
    assert rows(got) == [("A", "12:10"), ("A", "12:25"), ("B", "12:05")]


def test_state_of_traders_and_cooldowns_goes_away(spark, tmp_path):
    """A burst of swaps, then one swap five hours later: what the burst left in the state is gone."""
    burst = [(f"2024-01-31 12:0{k % 5}:01", f"u{k}", "SOL", f"T{k % 3}", "RAYDIUM") for k in range(60)]
    end = [(f"2024-01-31 {t}:01", "z", "SOL", "Z", "RAYDIUM") for t in ("12:20", "12:26", "17:00", "17:30", "18:00")]
    for k, part in enumerate(([*burst], *[[x] for x in end])):
        df = spark.createDataFrame(part, "t string, user_address string, swapfromtoken string, swaptotoken string, source string")
        df.select(F.to_timestamp("t").alias("timestamp"), "user_address", "swapfromtoken", "swaptotoken", "source").coalesce(1).write.mode("append").parquet(str(tmp_path / "swaps"))
    schema = spark.read.parquet(str(tmp_path / "swaps")).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "swaps"))
    query = start_candidate_log(stream_alerts(stream_candidates(stream)), str(tmp_path / "alerts"), str(tmp_path / "state"))
    query.awaitTermination()
    steps = [[(o.operatorName, o.numRowsTotal) for o in p.stateOperators] for p in query.recentProgress]
    most = [max(step[k][1] for step in steps) for k in range(len(steps[0]))]
    last = [n for _, n in steps[-1]]
    # From the last operator to the first: cooldowns, counts of tokens, changes at polls, traders, periods.
    assert [name for name, _ in steps[0]].count("transformWithStateInPySparkExec") == 3
    assert most[0] >= 4 and most[3] >= 60
    assert last[0] == 0 and last[1] <= 2 and last[3] <= 4
    alerts = spark.read.parquet(str(tmp_path / "alerts"))
    assert {r.token for r in alerts.collect()} == {"SOL", "T0", "T1", "T2"}


def test_whole_stream_from_swaps_to_outbox(spark, tmp_path, database):
    """The stream publishes what a replay alerts in the polls it closes, each message once, over two runs."""
    names = TableNames(*(f"{database}.{t}" for t in ("swaps", "log", "metadata", "outbox", "btc", "texts")))
    create_tables(spark, names, str(tmp_path / "tables"))
    swaps = fx.swaps(spark, SF).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    known = fx.token_metadata(spark, SF).drop("inserted_at", "blockchain")
    merge_metadata(spark, names.token_metadata, known, "2024-01-30 00:00:00")
    path, checkpoint = str(tmp_path / "swaps"), str(tmp_path / "state")
    half = F.lit("2024-01-30 22:00:00").cast("timestamp")
    for part in (swaps.where(F.col("timestamp") < half), swaps.where(F.col("timestamp") >= half)):
        part.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(swaps.schema).option("maxFilesPerTrigger", 1).parquet(path)
        start_whale_stream(stream, names, checkpoint, fx.responses(spark, SF)).awaitTermination()
    outbox = spark.table(names.outbox)
    newest = outbox.agg(F.max("timestamp")).first()[0]
    counts = replay_counts(swaps, fx.REPLAY_UNTIL).where(F.col("timestamp") <= F.lit(newest))
    named = drop_denied(attach_metadata(counts, current_rows(spark, names.token_metadata), none_found=False))
    expected = suppress_replay(named).select("timestamp", "token", "time_interval")
    assert rows(outbox.select("timestamp", "token", "time_interval")) == rows(expected) and outbox.count() > 1000
    assert spark.table(names.alert_log).count() == outbox.count()
    assert current_rows(spark, names.token_metadata).count() > known.count()
    assert spark.table(names.poll_texts).select("timestamp").distinct().count() == outbox.select("timestamp").distinct().count()


def test_traders_of_a_group_share_one_state_call_a_batch():
    """Each call to the state crosses to the JVM and back, so their number must not grow with traders."""
    calls, held = [], {}

    class Value:
        def get(self):
            calls.append("get")
            return held.get("v")

        def update(self, value):
            calls.append("update")
            held["v"] = value

        def clear(self):
            held.clear()

    class Handle:
        def getValueState(self, name, schema):
            return Value()

        def registerTimer(self, at):
            calls.append("timer")

    period, names = 300_000_000, ["buy_0", "sell_0"]
    step = TraderChanges([6 * period], 2 * period, period, names)
    step.init(Handle())
    of = Row("traders", "at", "token", "numbers")

    def batch(tick, traders):
        rows = [of(0, None, "A", f"{tick * period},0,{-k},{k}") for k in traders]
        return {int((r.at - instant_before(0)).total_seconds()) // 300: (r.recent, r.buy_0) for r in step.handleInputRows((0,), iter(rows), None)}

    # Fifty come in at 10 and are announced to leave at 16; thirty of them are there again at 14 and stay until 20.
    assert batch(10, range(50)) == {10: ([True], [50]), 11: ([True], [0]), 16: ([False], [-50])}
    assert batch(14, range(30)) == {14: ([True], [0]), 15: ([True], [0]), 16: ([False], [30]), 20: ([False], [-30])}
    assert calls == ["get", "update", "timer", "get", "update"]


def test_swaps_are_neither_rows_of_the_state_nor_of_what_python_is_handed(spark, tmp_path):
    """Many swaps a period, traders that come again, polls without a swap of the token: few rows of state, the counts of a replay."""
    start = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    second = F.col("id") + F.when(F.col("id") % 7 == 0, F.lit(1)).otherwise(F.lit(0)) * 900
    swaps = spark.range(20_000).select(
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), second.cast("decimal(18,6)"))).alias("timestamp"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("u"), F.xxhash64("id") % 4000)).alias("user_address"),
        F.when(F.col("id") % 13 > 0, F.concat(F.lit("S"), F.col("id") % 4)).alias("swapfromtoken"),
        F.concat(F.lit("Ä"), (F.col("id") / 3000).cast("int")).alias("swaptotoken"),
        F.when(F.col("id") % 5 > 0, F.lit("ORCA")).otherwise(F.lit("PUMP_FUN")).alias("source"),
    )
    write_in_order(swaps, str(tmp_path / "swaps"), 4)
    stream = spark.readStream.schema(swaps.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "swaps"))
    query = start_candidate_log(stream_candidates(stream), str(tmp_path / "candidates"), str(tmp_path / "state"))
    query.awaitTermination()
    columns = ["timestamp", "token", "time_interval", "num_users_bought", "num_users_sold"]
    newest = swaps.agg(F.max("timestamp")).first()[0]
    expected = replay_counts(swaps, "2024-01-31 12:00:00").where(F.col("timestamp") < F.lit(newest) - F.expr("INTERVAL 10 MINUTE"))
    got = spark.read.parquet(str(tmp_path / "candidates")).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert rows(got.select(*columns)) == rows(expected.select(*columns)) and got.count() > 200
    # Some 8,000 traders in 17 or 18 periods come in with a batch.
    put = [max(p.stateOperators[k].numRowsUpdated for p in query.recentProgress if p.stateOperators) for k in range(3)]
    assert max(put) <= GROUPS * 18 and len(query.recentProgress[0].stateOperators) == 3


def test_legs_of_one_group_and_period_are_packed_into_one_row():
    period = 300_000_000
    legs = pa.table(
        {
            "micros": pa.array([5, 9, period + 1, 7, 6], pa.int64()),
            "token": ["A", "Ä", "A", "A", "B"],
            "side_number": pa.array([0, 1, 0, 0, -1], pa.int64()),
            "hash_0": pa.array([1, 2, 1, 1, 3], pa.int64()),
            "hash_1": pa.array([1, 2, 1, 1, 3], pa.int64()),
            "traders": pa.array([4, 4, 4, 4, 5], pa.int64()),
        }
    )
    found = pa.Table.from_batches(packed(iter(legs.to_batches(max_chunksize=2)), period)).to_pylist()
    assert [(r["micros"], r["traders"]) for r in found] == [(9, 4), (period + 1, 4), (6, 5)]
    numbers, tokens = unpacked([r["numbers"] for r in found], [r["tokens"] for r in found])
    assert tokens.tolist() == ["A", "Ä", "A", "B"] and numbers.T.tolist() == [[0, 1, 1], [1, 2, 2], [0, 1, 1], [-1, 3, 3]]
