"""A table with one row per key that is changed a bucket at a time.

The table is partitioned by bucket of the key and version of the bucket. A change writes the buckets that it touches, and
no others, to a new folder, and asks the catalog to add each as the version after the one it has read. The catalog
refuses a version that is there already: then another writer came first, and the change is made again on top
of theirs, for that bucket. So no update is lost, no data is written over, and readers keep what they are reading. The last
KEPT_VERSIONS stay. A job that dies leaves whole buckets, some changed and some not; running the same change again ends it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podwatch.operators.catalog import partition_values, table_location
from podwatch.session import settled

BUCKETS = 64
KEPT_VERSIONS = 16
PARTITION_COLUMNS = "bucket INT, version BIGINT"
PROPERTY = "podwatch.buckets"


def create_keyed_table(spark: SparkSession, name: str, columns: str, folder: str | None = None, buckets: int = BUCKETS) -> None:
    """Creates a keyed table unless it is there, and the view ``<name>_current`` of its current rows for SQL."""
    location = f" LOCATION '{folder}'" if folder else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {PARTITION_COLUMNS}) USING parquet PARTITIONED BY (bucket, version)"
        f"{location} TBLPROPERTIES ('{PROPERTY}' = '{buckets}')"
    )
    listed = ", ".join(c for c in spark.table(name).columns if c not in ("bucket", "version"))
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {name}_current AS SELECT {listed} FROM {name} JOIN "
        f"(SELECT bucket AS b, max(version) AS newest FROM {name} GROUP BY bucket) ON bucket = b AND version = newest"
    )


def _buckets(spark: SparkSession, name: str) -> int:
    found = spark.sql(f"SHOW TBLPROPERTIES {name} ('{PROPERTY}')").first()["value"]
    if not found.isdigit():
        raise ValueError(f"{name} is not a keyed table")
    return int(found)


def _bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def current_versions(spark: SparkSession, name: str) -> dict[int, int]:
    """The current version of each bucket that has rows."""
    found: dict[int, int] = {}
    for part in partition_values(spark, name):
        bucket, version = int(part["bucket"]), int(part["version"])
        found[bucket] = max(version, found.get(bucket, version))
    return found


def current_rows(spark: SparkSession, name: str, buckets: list[int] | None = None) -> DataFrame:
    """The rows of the table as it is now, without the partition columns; other versions, and other buckets if some are named, are not read."""
    spark.catalog.refreshTable(name)
    versions = {b: v for b, v in current_versions(spark, name).items() if buckets is None or b in set(buckets)}
    rows = spark.table(name)
    if versions:
        newest = F.create_map(*(F.lit(x).cast(kind) for b, v in versions.items() for x, kind in ((b, "int"), (v, "bigint"))))
        rows = rows.where(F.col("version") == F.element_at(newest, F.col("bucket")))
    else:
        rows = rows.where(F.lit(False))
    return rows.drop("bucket", "version")


def merge_rows(
    spark: SparkSession, name: str, source: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame], key: str = "address"
) -> int:
    """Changes the buckets that ``source`` has keys in to ``merged(their rows, the rows of source for them)``.

    Returns how many buckets were written; an empty source writes nothing. ``source`` has distinct keys, none NULL.
    """
    buckets = _buckets(spark, name)
    pending = settled(source.withColumn("bucket", _bucket_of(key, buckets)))
    written = 0
    while touched := sorted(r["bucket"] for r in pending.select("bucket").distinct().collect()):  # as many as buckets, at most
        versions = current_versions(spark, name)
        after = merged(current_rows(spark, name, touched), pending.drop("bucket"))
        columns = [c for c in spark.table(name).columns if c not in ("bucket", "version")]
        folder = f"{table_location(spark, name).rstrip('/')}/merge-{uuid.uuid4().hex}"
        after = after.select(*columns, _bucket_of(key, buckets).alias("bucket"))
        after.repartition("bucket").write.partitionBy("bucket").parquet(folder)
        added = {b: versions.get(b, -1) + 1 for b in touched}
        added = {b: v for b, v in added.items() if _add(spark, name, b, v, f"{folder}/bucket={b}")}
        newest = current_versions(spark, name)
        for b, v in list(added.items()):
            # A version may be free because it was dropped: then the change is not in the current one.
            too_late = newest[b] >= v + KEPT_VERSIONS
            _drop(spark, name, b, v if too_late else v - KEPT_VERSIONS)
            if too_late:
                del added[b]
        spark.catalog.refreshTable(name)
        written += len(added)
        lost = [b for b in touched if b not in added]
        pending = pending.where(F.col("bucket").isin(lost) if lost else F.lit(False))
    return written


def _add(spark: SparkSession, name: str, bucket: int, version: int, folder: str) -> bool:
    try:
        spark.sql(f"ALTER TABLE {name} ADD PARTITION (bucket = {bucket}, version = {version}) LOCATION '{folder}'")
    except AnalysisException as refused:
        if refused.getCondition() != "PARTITIONS_ALREADY_EXIST":
            raise
        return False
    return True


def _drop(spark: SparkSession, name: str, bucket: int, version: int) -> None:
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (bucket = {bucket}, version = {version})")
