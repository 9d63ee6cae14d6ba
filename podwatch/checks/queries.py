"""Queries run over the test tables, one per group of operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podwatch.checks import fixtures as fx
from podwatch.checks.job_queries import QUERIES as JOB_QUERIES
from podwatch.functions import payload, text, timing
from podwatch.operators import alerts, catalog, detect, enrich, landing, metadata, replay, upsert
from podwatch.plans import replay as replay_plan
from podwatch.plans import whale_poll
from podwatch.session import settled, shuffles_dropped, stored

Query = Callable[[SparkSession, str], DataFrame]

# Swaps of a history whose replay is corrected at once.
PART_SWAPS = 40_000_000
TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.detect_candidates(fx.swaps(spark, sf_dir), fx.alert_log(spark, sf_dir), fx.AS_OF)


def recent_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.recent_tokens(fx.swaps(spark, sf_dir), fx.AS_OF)


def buyers_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    swaps = fx.swaps(spark, sf_dir)
    return detect.trader_counts(swaps, detect.recent_tokens(swaps, fx.AS_OF), fx.AS_OF, 60)


def last_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.last_alerts(fx.alert_log(spark, sf_dir))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir)


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whale_poll.alerts_from_candidates(_candidates(spark, sf_dir), fx.token_metadata(spark, sf_dir))


def alerts_of_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir)


def whole_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whale_poll.poll_alerts(
        fx.swaps(spark, sf_dir),
        fx.alert_log(spark, sf_dir),
        fx.token_metadata(spark, sf_dir),
        fx.responses(spark, sf_dir),
        fx.AS_OF,
        keep_known=False,
    )
    return alerts.alert_log_rows(found)


def missing_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.missing_tokens(_candidates(spark, sf_dir), fx.token_metadata(spark, sf_dir))


def incomplete_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = enrich.lookup_metadata(fx.token_metadata(spark, sf_dir), _candidates(spark, sf_dir))
    return enrich.incomplete_tokens(found)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = enrich.tokens_to_fetch(_candidates(spark, sf_dir), fx.token_metadata(spark, sf_dir))
    return enrich.resolve_responses(wanted, fx.responses(spark, sf_dir))


def fallback_full_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    foreign = fx.token_metadata(spark, sf_dir).withColumn("address", F.concat(F.lit("0x"), "address"))
    named = enrich.attach_metadata(_candidates(spark, sf_dir), foreign)
    return named.select("token", "time_interval", "symbol", "name")


def clean_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.upper_case_columns(metadata.clean_metadata(fx.token_metadata_raw(spark, sf_dir), "ord"))


def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.load_metrics(fx.token_metadata_raw(spark, sf_dir))


def upsert_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = fx.token_metadata(spark, sf_dir)
    source = metadata.clean_metadata(fx.token_metadata_raw(spark, sf_dir), "ord")
    return upsert.upsert(target, source, timing.instant_like(fx.AS_OF, target, "inserted_at"))


def upsert_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whale_poll.metadata_with_responses(
        _candidates(spark, sf_dir),
        fx.token_metadata(spark, sf_dir),
        fx.responses(spark, sf_dir),
        fx.AS_OF,
        keep_known=False,
    )


def upsert_api_keep_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whale_poll.metadata_with_responses(
        _candidates(spark, sf_dir),
        fx.token_metadata(spark, sf_dir),
        fx.responses(spark, sf_dir),
        fx.AS_OF,
        keep_known=True,
    )


def reject_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = metadata.split_rejects(fx.long_metadata(spark, sf_dir))
    return rejects.select("address", F.length("name").cast("bigint").alias("name_chars"), "reason")


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.preview(fx.token_metadata_raw(spark, sf_dir), "ord")


def payload_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.payload_counts(fx.price_payloads(spark, sf_dir), "batch_id")


def payload_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("body")
    landed = fx.price_payloads(spark, sf_dir).select(
        "batch_id", payload.json_value(payload.as_json_array(body, payload.json_value(body))).alias("raw_data")
    )
    raw = F.col("raw_data")
    return landed.select(
        "batch_id",
        payload.json_field(raw, "$[0].k", "bigint").alias("first_k"),
        payload.json_field(raw, "$[0].candles[1].k", "bigint", -1).alias("second_candle_k"),
        payload.json_text(raw).alias("raw_text"),
    )


def schema_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {name: fx.load(spark, sf_dir, name) for name in TEST_TABLES}
    described = [row for name, df in frames.items() for row in catalog.describe_frame(name, df)]
    columns = spark.createDataFrame(described, catalog.LISTING_SCHEMA)
    counts = None
    for name, df in frames.items():
        one = metadata.row_count(df).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts.join(columns, "table_name").select("table_name", "column_name", "nullable", "row_count")


def poll_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox = settled(alerts.outbox_rows(_alerts(spark, sf_dir)))
    texts = alerts.poll_texts(alerts.single_poll(outbox, fx.AS_OF), outbox)
    return texts.withColumn("quiet", alerts.is_quiet(F.col("text")))


def time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    now = timing.instant_like(fx.AS_OF, fx.load(spark, sf_dir, "events"), "ts")
    return fx.load(spark, sf_dir, "events").select(
        "event_id",
        timing.second_text(ts).alias("second_text"),
        timing.stamp_text(ts).alias("stamp_text"),
        timing.iso_text(ts).alias("iso_text"),
        F.unix_micros(timing.parse_iso_utc(F.concat(timing.iso_text(ts), F.lit("Z")))).alias("parsed_us"),
        timing.elapsed_minutes_text(now, ts).alias("elapsed_minutes"),
    )


def quoting(spark: SparkSession, sf_dir: str) -> DataFrame:
    doubled = text.double_quotes(F.col("text"))
    return fx.load(spark, sf_dir, "documents").select(
        "doc_id", doubled.alias("quoted"), (text.undouble_quotes(doubled) == F.col("text")).alias("round_trip")
    )


def _replay_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.replay_counts(fx.swaps(spark, sf_dir), fx.REPLAY_UNTIL)


def replay_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replay_counts(spark, sf_dir)


def late_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All swaps, those of one venue after the polls that should have counted them.

    A long history is taken by parts of its tokens, one after the other, so that disk holds the shuffles of one part and results only.
    """
    swaps = fx.swaps(spark, sf_dir)
    is_late = F.coalesce(F.col("source") == "ORCA", F.lit(False))
    parts = max(1, -(-swaps.count() // PART_SWAPS))
    found = None
    for part in range(parts):
        known, late = (replay.swaps_of_part(swaps.where(of), part, parts) for of in (~is_late, is_late))
        with shuffles_dropped(spark):
            changes = stored(replay.late_corrections(known, late, fx.REPLAY_UNTIL))
            after = replay.corrected(replay.replay_counts(known, fx.REPLAY_UNTIL), changes)
            after = after if parts == 1 else stored(after)
        found = after if found is None else found.unionByName(after)
    return found


def suppressed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.suppress_replay(_replay_counts(spark, sf_dir))


def replay_poll_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = replay_plan.replay_alerts(fx.swaps(spark, sf_dir), fx.token_metadata(spark, sf_dir), fx.REPLAY_UNTIL)
    return replay_plan.replay_texts(found, fx.REPLAY_SINCE, fx.REPLAY_UNTIL)


QUERIES: dict[str, Query] = {
    "D1_recent_tokens": recent_tokens,
    "D2_buyers_sellers": buyers_sellers,
    "D3_last_alert": last_alert,
    "D4_candidates": candidates,
    "D5_alerts": alerts_of_poll,
    "W1_whole_poll": whole_poll,
    "E1_missing_metadata": missing_metadata,
    "E2_incomplete_metadata": incomplete_metadata,
    "E3_enriched": enriched,
    "E4_fallback_full_address": fallback_full_address,
    "M1_clean_metadata": clean_metadata,
    "M2_load_metrics": load_metrics,
    "M3_upsert_batch": upsert_batch,
    "M4_upsert_api": upsert_api,
    "M4_upsert_api_keep_known": upsert_api_keep_known,
    "M5_reject_bad_rows": reject_bad_rows,
    "M6_preview": preview,
    "B1_payload_record_count": payload_record_count,
    "B2_payload_fields": payload_fields,
    "C1_schema_listing": schema_listing,
    "N1_poll_text": poll_text,
    "N2_replay_poll_text": replay_poll_text,
    "X1_time_text": time_text,
    "X2_quoting": quoting,
    "R1_replay_counts": replay_counts,
    "R1_late_corrections": late_corrections,
    "R2_suppressed_alerts": suppressed_alerts,
    **JOB_QUERIES,
}
