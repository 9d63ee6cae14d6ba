"""The slot table gives what a scan of all swaps gives, and reads new swaps only."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from podwatch.checks import fixtures as fx
from podwatch.functions.timing import parse_instant
from podwatch.operators import incremental
from podwatch.operators.detect import detect_candidates

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_ten_polls_with_late_swaps(spark, database, tmp_path):
    swaps = fx.swaps(spark, SF).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    log = fx.alert_log(spark, SF).withColumn("inserted_at", F.col("inserted_at").cast("timestamp"))
    # A sixth of the swaps arrive up to an hour late, the first of these after polls that should have counted them.
    late = F.when(F.pmod(F.xxhash64("user_address", "timestamp"), F.lit(6)) == 0, F.pmod(F.xxhash64("timestamp"), F.lit(60))).otherwise(0)
    arrival = F.col("timestamp") + F.make_dt_interval(mins=late.cast("int"))
    swaps.withColumn("arrival", arrival).write.parquet(str(tmp_path / "all"))
    arriving = spark.read.parquet(str(tmp_path / "all"))
    table = f"{database}.slots"
    incremental.create_slot_table(spark, table, str(tmp_path / "slots"))
    known, found = parse_instant("2024-01-30 00:00:00"), 0
    for k in range(10):
        as_of = parse_instant(fx.AS_OF) - timedelta(minutes=5 * (9 - k))
        new = arriving.where((F.col("arrival") > F.lit(f"{known}Z").cast("timestamp")) & (F.col("arrival") <= F.lit(f"{as_of}Z").cast("timestamp")))
        incremental.add_swaps(new, table)
        if k == 4:  # the same batch once more, as after a failure
            incremental.add_swaps(new, table)
        known = as_of
        seen = arriving.where(F.col("arrival") <= F.lit(f"{as_of}Z").cast("timestamp")).drop("arrival")
        got = rows(incremental.slot_candidates(spark.table(table), log, as_of))
        assert got == rows(detect_candidates(seen, log, as_of))
        found += len(got)
    assert found > 100


def test_a_poll_reads_the_slots_of_its_windows_only(spark, database, tmp_path):
    table = f"{database}.slots"
    incremental.create_slot_table(spark, table, str(tmp_path / "slots"))
    incremental.add_swaps(fx.swaps(spark, SF).withColumn("timestamp", F.col("timestamp").cast("timestamp")), table)
    log = fx.alert_log(spark, SF).withColumn("inserted_at", F.col("inserted_at").cast("timestamp"))
    found = incremental.slot_candidates(spark.table(table), log, fx.AS_OF)
    files = {f for f in spark.table(table).inputFiles()}
    assert len({f.split("slot=")[1][:13] for f in files}) == 11
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slot" in scan and "slot" in scan.split("PartitionFilters: ")[1].split("]")[0] and "20240130T2000" in scan
