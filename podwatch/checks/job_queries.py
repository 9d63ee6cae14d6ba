"""Queries that run whole jobs on tables of their own, filled from the test tables, and return what the jobs wrote.

Each run creates a database under the session's checkpoint folder. Its tables are left for the lazy result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podwatch.checks import fixtures as fx
from podwatch.functions import payload
from podwatch.operators import incremental
from podwatch.operators.catalog import stage_view
from podwatch.operators.keyed_table import current_rows, merge_rows
from podwatch.plans.metadata_load import create_tables, create_token_metadata_table, run_metadata_load
from podwatch.plans.price_landing import land_payloads
from podwatch.plans.whale_poll import run_poll
from podwatch.schemas import TOKEN_METADATA_COLUMNS, TableNames
from podwatch.session import use_checkpoint_dir
from podwatch.streaming.cooldown import ROCKSDB_PROVIDER
from podwatch.streaming.detect import stream_candidates
from podwatch.streaming.sinks import start_candidate_log

ARRIVALS = 4  # parts in which the swaps come in
FILE_ROWS = 1_000_000  # of the smallest part, at least, in each of its files


def _tables(spark: SparkSession) -> tuple[TableNames, str]:
    """Names of a new database, and its folder."""
    name = f"podwatch_{uuid.uuid4().hex}"
    root = f"{use_checkpoint_dir(spark).rstrip('/')}/{name}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}'")
    tables = ("swaps", "whale_notifications", "token_metadata", "whale_outbox", "btc_historic", "whale_poll_texts")
    return TableNames(*(f"{name}.{t}" for t in tables)), root


@contextmanager
def _utc(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Test tables hold plain timestamps of UTC, the jobs' tables instants."""
    wanted = {"spark.sql.session.timeZone": "UTC", **conf}
    before = {c: spark.conf.get(c, None) for c in wanted}
    for c, value in wanted.items():
        spark.conf.set(c, value)
    try:
        yield
    finally:
        for c, value in before.items():
            spark.conf.unset(c) if value is None else spark.conf.set(c, value)


def _instants(df: DataFrame) -> DataFrame:
    of = {f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"}
    return df.withColumns(of) if of else df


def _plain(df: DataFrame) -> DataFrame:
    """Instants as the plain timestamps of UTC that the SQL gives, whatever zone the result is read in."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    second = F.expr("INTERVAL '0.000001' SECOND")
    of = {f.name: epoch + second * F.unix_micros(f.name) for f in df.schema.fields if f.dataType.typeName() == "timestamp"}
    return df.withColumns(of) if of else df


def _fill_metadata(spark: SparkSession, table: str, sf_dir: str) -> None:
    known = _instants(fx.token_metadata(spark, sf_dir)).withColumn("decimals", F.col("decimals").cast("decimal(38,0)"))
    merge_rows(spark, table, known, lambda target, source: source)


def _polled(spark: SparkSession, sf_dir: str) -> TableNames:
    """The tables after a poll. The swaps, which a poll reads once, are a view and not written first."""
    names, root = _tables(spark)
    names = replace(names, swaps=names.swaps.replace(".", "_"))
    with _utc(spark):
        create_tables(spark, names, root)
        stage_view(_instants(fx.swaps(spark, sf_dir)), names.swaps)
        log = _instants(fx.alert_log(spark, sf_dir))
        columns = spark.table(names.alert_log).schema.fields
        log = log.select(*(F.col(f.name) if f.name in log.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in columns))
        log.write.insertInto(names.alert_log)
        _fill_metadata(spark, names.token_metadata, sf_dir)
        try:
            run_poll(spark, names, fx.responses(spark, sf_dir), fx.AS_OF, keep_known=False)
        finally:
            spark.catalog.dropTempView(names.swaps)
    return names


def logged_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _polled(spark, sf_dir)
    return _plain(spark.table(names.alert_log).where("poll is not null").drop("day", "poll"))


def published_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _polled(spark, sf_dir)
    return _plain(spark.table(names.poll_texts).select("timestamp", "part", "parts", "text"))


def refreshed_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _polled(spark, sf_dir)
    found = current_rows(spark, names.token_metadata).withColumn("decimals", F.col("decimals").cast("bigint"))
    return _plain(found.select(*TOKEN_METADATA_COLUMNS))


def loaded_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, root = _tables(spark)
    with _utc(spark):
        create_token_metadata_table(spark, names.token_metadata, f"{root}/token_metadata")
        _fill_metadata(spark, names.token_metadata, sf_dir)
        run_metadata_load(spark, fx.token_metadata_raw(spark, sf_dir), names.token_metadata, "ord", fx.AS_OF)
    found = current_rows(spark, names.token_metadata).withColumn("decimals", F.col("decimals").cast("bigint"))
    return _plain(found.select(*TOKEN_METADATA_COLUMNS))


def load_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, root = _tables(spark)
    with _utc(spark):
        create_token_metadata_table(spark, names.token_metadata, f"{root}/token_metadata")
        done = run_metadata_load(spark, fx.token_metadata_raw(spark, sf_dir), names.token_metadata, "ord", fx.AS_OF)
    figures = ("extracted", "without_key", "unique", "rejected", "table_rows")
    return spark.range(1).select(*(F.lit(getattr(done, f)).cast("bigint").alias(f) for f in figures))


def landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, root = _tables(spark)
    create_tables(spark, names, root)
    land_payloads(fx.price_payloads(spark, sf_dir), names.btc_historic)
    raw = F.col("raw_data")
    return spark.table(names.btc_historic).select(
        payload.json_field(raw, "$[0].k", "bigint").alias("first_k"), payload.json_text(raw).alias("raw_text")
    )


def _arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[DataFrame], Column]:
    """The swaps, their parts by time, and the number of a swap's part."""
    swaps = _instants(fx.swaps(spark, sf_dir))
    first, last = swaps.agg(F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp"))).first()
    part = F.floor((F.unix_micros("timestamp") - F.lit(first)) * ARRIVALS / F.lit(last - first + 1))
    return swaps, [swaps.where(part == k) for k in range(ARRIVALS)], part


def streamed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of the polls that a stream over the swaps closes; they come in as files in order of time.

    Each batch reads the files of one part. A large part is dealt out to several files, and so many rows fill each of them.
    """
    root = f"{use_checkpoint_dir(spark).rstrip('/')}/podwatch_{uuid.uuid4().hex}"
    tasks = str(min(16, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    with _utc(spark, **{"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER, "spark.sql.shuffle.partitions": tasks}):
        swaps, parts, part = _arrivals(spark, sf_dir)
        sizes = [r["count"] for r in swaps.groupBy(part.alias("part")).count().where("part IS NOT NULL").collect()]
        files = max(1, min(spark.sparkContext.defaultParallelism, min(sizes) // FILE_ROWS)) if len(sizes) == ARRIVALS else 1
        for part in parts:
            # By a number of its own each row falls anywhere, so no file stays away for want of rows.
            (part.repartition(files, F.monotonically_increasing_id()) if files > 1 else part.coalesce(1)).write.mode("append").parquet(f"{root}/swaps")
        arriving = spark.readStream.schema(swaps.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/swaps")
        start_candidate_log(stream_candidates(arriving).drop("at"), f"{root}/candidates", f"{root}/state").awaitTermination()
        found = spark.read.parquet(f"{root}/candidates")
    return _plain(found.select("timestamp", "token", "time_interval", "num_users_bought", "num_users_sold"))


def incremental_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of one poll from the slot table, into which the swaps were put in parts, the latest first."""
    names, root = _tables(spark)
    slots = names.swaps
    with _utc(spark):
        incremental.create_slot_table(spark, slots, f"{root}/slots")
        for part in reversed(_arrivals(spark, sf_dir)[1]):
            incremental.add_swaps(part, slots)
        log = _instants(fx.alert_log(spark, sf_dir))
        found = incremental.slot_candidates(spark.table(slots), log, fx.AS_OF)
        # Read while the session is in UTC.
        found.write.parquet(f"{root}/candidates")
    return _plain(spark.read.parquet(f"{root}/candidates"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "K6_logged_alerts": logged_alerts,
    "K8_published_text": published_text,
    "K5_refreshed_metadata": refreshed_metadata,
    "K12_loaded_metadata": loaded_metadata,
    "K12_load_figures": load_figures,
    "K1_landed_rows": landed_rows,
    "A5_incremental_candidates": incremental_candidates,
    "R3_stream_candidates": streamed_candidates,
}
