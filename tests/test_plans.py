"""The plans are the ones wanted: one scan, bounds at the scan, no Python where none is needed."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from podwatch.checks import fixtures as fx
from podwatch.operators import detect, enrich, replay
from podwatch.plans.whale_poll import alerts_from_candidates
from podwatch.sources.relational import extract_raw_metadata

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def swaps(spark, tmp_path_factory):
    """Swaps as a real table would be: parquet in folders by day, with columns nobody asks for."""
    path = str(tmp_path_factory.mktemp("tables") / "swaps")
    wide = fx.swaps(spark, SF).withColumns({"fee": F.rand(), "day": F.to_date("timestamp")})
    wide.write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def test_detection_scans_once_with_its_bound(spark, swaps):
    text = plan(detect.windowed_counts(swaps, fx.AS_OF, date_column="day"))
    assert text.count("FileScan") == 1
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(timestamp,2024-01-30T21:00", text)
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= 2024-01-30", text)
    assert "fee" not in re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "Expand" not in text and "Python" not in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
    assert re.search(r"Exchange hashpartitioning\(token#\d+, side#\d+, user_address#\d+", text)


def test_every_shuffle_of_detection_follows_a_partial_aggregate(spark, swaps):
    lines = [x for x in plan(detect.windowed_counts(swaps, fx.AS_OF)).splitlines() if "Exchange" in x or "partial_" in x]
    assert [("Exchange" in x) for x in lines] == [True, False, True, False]


def test_gate_is_one_scan(spark, swaps):
    text = plan(detect.recent_tokens(swaps, fx.AS_OF))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_alerts_have_no_python_and_no_cross_join(spark, swaps):
    metadata = fx.token_metadata(spark, SF)
    candidates = detect.detect_candidates(swaps, fx.alert_log(spark, SF), fx.AS_OF)
    text = plan(alerts_from_candidates(candidates, metadata, none_found=False))
    for word in ("Python", "Arrow", "Cartesian", "NestedLoop"):
        assert word not in text
    assert text.count("FileScan") == 3


def test_wanted_tokens_take_one_pass_over_each_table(spark):
    tokens = fx.swaps(spark, SF).select(F.col("swaptotoken").alias("token"))
    text = plan(enrich.tokens_to_fetch(tokens, fx.token_metadata(spark, SF)))
    assert text.count("FileScan") == 2


def test_replay_shuffles_traders_not_window_copies(spark, swaps):
    text = plan(replay.replay_counts(swaps, fx.REPLAY_UNTIL, "2024-01-30 20:00:00", date_column="day"))
    assert text.count("FileScan") == 1
    assert "Python" not in text and "Arrow" not in text and "Expand" not in text
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(timestamp,2024-01-31T00:00", text)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(timestamp,2024-01-30T17:00", text)
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ <= 2024-01-31[^\]]*day#\d+ >= 2024-01-30", text)
    first = [x for x in text.splitlines() if "Exchange hashpartitioning" in x][-1]
    for key in ("token", "side", "user_address", "counted", "tick"):
        assert re.search(rf"\b{key}#", first)


def test_suppression_adds_no_shuffle(spark, swaps):
    counts = replay.replay_counts(swaps, fx.REPLAY_UNTIL)
    before, after = (plan(x).count("Exchange hashpartitioning") for x in (counts, replay.suppress_replay(counts)))
    assert after == before


def test_source_read_prunes(spark, tmp_path):
    fx.token_metadata_raw(spark, SF).withColumn("extra", F.lit("x")).write.parquet(str(tmp_path / "raw"))
    text = plan(extract_raw_metadata(spark.read.parquet(str(tmp_path / "raw"))))
    assert "IsNotNull(address)" in text
    assert "extra" not in re.search(r"ReadSchema: (\S+)", text).group(1)
