"""Catalog work: create, find, describe and list tables, append to them, and add partitions once."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podwatch.schemas import ALERT_LOG, BTC_HISTORIC_DDL, OUTBOX, POLL_PARTITION, POLL_TEXTS, TableNames

LISTING_SCHEMA = "table_name string, column_name string, data_type string, nullable boolean"


def _create(spark: SparkSession, name: str, columns: str, folder: str | None, partitions: str = "") -> None:
    location = f" LOCATION '{folder}'" if folder else ""
    parted = f" PARTITIONED BY ({partitions})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parted}{location}")


def create_poll_tables(spark: SparkSession, names: TableNames, root: str | None = None) -> None:
    """Creates what the jobs append to. Given a root folder, each table lies in a folder under it."""
    by_poll = ", ".join(f"{c} STRING" for c in POLL_PARTITION)
    for table, columns, partitions in (
        (names.alert_log, ALERT_LOG, by_poll),
        (names.outbox, OUTBOX, by_poll),
        (names.poll_texts, POLL_TEXTS, by_poll),
        (names.btc_historic, BTC_HISTORIC_DDL, ""),
    ):
        database = table.rpartition(".")[0]
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        _create(spark, table, columns, f"{root}/{table.rpartition('.')[2]}/first" if root else None, partitions)


def _spec(values: Mapping[str, object]) -> str:
    return ", ".join(f"{c} = '{v}'" if isinstance(v, str) else f"{c} = {v}" for c, v in values.items())


def partition_values(spark: SparkSession, name: str) -> list[dict[str, str]]:
    """The partitions of a table, by name only."""
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return [dict(part.split("=", 1) for part in row[0].split("/")) for row in rows]


def add_once(df: DataFrame, name: str, values: Mapping[str, object]) -> bool:
    """Makes ``df`` the partition ``values`` of a table unless that partition exists; returns whether it did.

    The rows are written to a folder of their own first. The catalog then adds the partition or refuses, so
    of any number of writers, retries and stragglers exactly one is seen, and never a part of it. What a loser wrote stays
    unseen in its folder. An empty ``df`` makes an empty partition.
    """
    spark = df.sparkSession
    columns = [c for c in spark.table(name).columns if c not in values]
    where = "/".join(f"{c}={v}" for c, v in values.items())
    folder = f"{table_location(spark, name).rstrip('/')}/{where}/{uuid.uuid4().hex}"
    df.select(*columns).write.parquet(folder)
    try:
        spark.sql(f"ALTER TABLE {name} ADD PARTITION ({_spec(values)}) LOCATION '{folder}'")
    except AnalysisException as refused:
        if refused.getCondition() != "PARTITIONS_ALREADY_EXIST":
            raise
        return False
    spark.catalog.refreshTable(name)
    return True


def table_exists(spark: SparkSession, database: str, name: str) -> tuple[bool, str | None]:
    """Whether a table of exactly this name, in any case, exists, and how the catalog spells it."""
    hits = [t.name for t in spark.catalog.listTables(database) if t.name.lower() == name.lower()]
    return (True, hits[0]) if hits else (False, None)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_name string, table_type string, is_temporary boolean")


def describe_frame(table_name: str, df: DataFrame) -> list[tuple[str, str, str, bool]]:
    return [(table_name, f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Name, type and nullability of each column, as declared."""
    declared = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    rows = [(name, c.name, declared[c.name], c.nullable) for c in spark.catalog.listColumns(name)]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def stage_view(df: DataFrame, name: str) -> str:
    """Names a batch for SQL, for this session only."""
    df.createOrReplaceTempView(name)
    return name


def drop_stage(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def append(df: DataFrame, name: str, *partitions: str) -> None:
    """Appends rows, columns by name, in files of a sensible size however many tasks made them."""
    writer = df.hint("rebalance", *partitions).write.mode("append").format("parquet")
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)


def table_location(spark: SparkSession, name: str) -> str:
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return detail.where(F.col("col_name") == "Location").first()["data_type"]
