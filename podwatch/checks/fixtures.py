"""The job's input tables, derived from whole test tables; Spark frames and the same in SQL.

Times are squeezed so that the whole history of ``lineitem`` lies in the ten hours before ``AS_OF``,
one day being 15 seconds. Windows thus hold a share of the table that does not change with its
size, and the bounds of all windows fall exactly on swap times. About a third of all sells are of
one token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-31 00:00:00"
# Replay covers the polls of the history.
REPLAY_SINCE = "2024-01-30 13:00:00"
REPLAY_UNTIL = AS_OF
CANDLES_PER_PAYLOAD = 24


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _token(key: str) -> str:
    return f"concat('T', CAST({key} AS STRING), 'solanaMintAddress')"


def swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = "INTERVAL '15' SECOND * datediff(DATE'2001-11-05', CAST(l_shipdate AS DATE))"
    return load(spark, sf_dir, "lineitem").selectExpr(
        f"TIMESTAMP_NTZ '{AS_OF}' - {age} AS timestamp",
        "CASE WHEN l_linenumber <> 7 THEN concat('U', CAST(l_orderkey DIV 10 AS STRING)) END AS user_address",
        f"CASE WHEN l_returnflag = 'R' THEN {_token('3')}"
        f" ELSE {_token('l_suppkey * 20 + l_orderkey % 20')} END AS swapfromtoken",
        f"CASE WHEN l_quantity < 50 THEN {_token('l_partkey')} END AS swaptotoken",
        "CASE l_linenumber % 5 WHEN 0 THEN 'PUMP_FUN' WHEN 1 THEN 'RAYDIUM' WHEN 2 THEN 'JUPITER'"
        " WHEN 3 THEN 'ORCA' END AS source",
    )


def alert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").selectExpr(
        f"{_token('user_id * 13 + event_id % 13')} AS address",
        "CASE event_id % 3 WHEN 0 THEN '30min' WHEN 1 THEN '1hour' ELSE '3hours' END AS time_interval",
        f"TIMESTAMP_NTZ '{AS_OF}' - (TIMESTAMP_NTZ '{AS_OF}' - ts) / 60 AS inserted_at",
    )


def token_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").selectExpr(
        f"CASE WHEN p_partkey % 9 = 4 THEN concat('X', CAST(p_partkey AS STRING)) ELSE {_token('p_partkey')} END"
        " AS address",
        "CASE WHEN p_partkey = 3 THEN 'sol' WHEN p_partkey % 101 = 5 THEN 'USDC' WHEN p_partkey % 103 = 8 THEN 'Wbtc'"
        " WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 11 = 0 THEN NULL"
        " ELSE upper(substr(p_name, 1, 4)) END AS symbol",
        "CASE WHEN p_partkey % 5 = 4 THEN '' ELSE p_name END AS name",
        "CAST(p_size % 10 AS BIGINT) AS decimals",
        "CASE WHEN p_partkey % 4 = 1 THEN 'ethereum' ELSE 'solana' END AS blockchain",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS inserted_at",
    )


def token_metadata_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").selectExpr(
        "event_id AS ord",
        f"CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 3 = 0 THEN {_token('1')} ELSE {_token('user_id')} END"
        " AS address",
        "CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_type END AS name",
        "upper(substr(event_type, 1, 3)) AS symbol",
        "'solana' AS blockchain",
        "CAST(event_id % 10 AS BIGINT) AS decimals",
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").selectExpr(
        f"{_token('p_partkey')} AS address",
        "CASE WHEN p_partkey % 6 = 0 THEN 404 ELSE 200 END AS status_code",
        "CASE WHEN p_partkey % 6 = 1 THEN '{\"success\":false}'"
        " WHEN p_partkey % 6 = 2 THEN '{\"success\":true,\"data\":null}'"
        " WHEN p_partkey % 6 = 3 THEN '{\"success\":true,\"data\":{\"name\":\"only name\"}}'"
        " ELSE concat('{\"success\":true,\"data\":{\"symbol\":\"S', CAST(p_partkey AS STRING),"
        " '\",\"name\":\"', p_name, '\",\"decimals\":', CAST(p_size % 10 AS STRING), '}}') END AS body",
    )


def price_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of 24 records each; every seventh is a single object around its records."""
    listed = (
        load(spark, sf_dir, "events")
        .selectExpr(f"event_id DIV {CANDLES_PER_PAYLOAD} AS batch_id", "struct(event_id, props) AS record")
        .groupBy("batch_id")
        .agg({"record": "collect_list"})
        .selectExpr(
            "batch_id",
            "concat('[', array_join(transform(array_sort(`collect_list(record)`), r -> r.props), ','), ']') AS list",
        )
    )
    return listed.selectExpr(
        "batch_id", "CASE WHEN batch_id % 7 = 6 THEN concat('{\"candles\":', list, '}') ELSE list END AS body"
    )


def long_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata rows with whole documents as names, so that many are too long."""
    return load(spark, sf_dir, "documents").selectExpr(
        "CASE WHEN lang <> 'de' THEN concat('D', CAST(doc_id AS STRING)) END AS address",
        "source AS symbol",
        "text AS name",
        "n_chars AS decimals",
        "lang AS blockchain",
    )


def _sql_token(key: str) -> str:
    return f"'T' || CAST({key} AS VARCHAR) || 'solanaMintAddress'"


# The same tables for the SQL the queries are checked against.
SQL = {
    "swaps": f"""
        SELECT TIMESTAMP '{AS_OF}'
                 - to_seconds(date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-11-05') * 15) AS timestamp,
               CASE WHEN l_linenumber <> 7 THEN 'U' || CAST(l_orderkey // 10 AS VARCHAR) END AS user_address,
               CASE WHEN l_returnflag = 'R' THEN {_sql_token("3")}
                    ELSE {_sql_token("l_suppkey * 20 + l_orderkey % 20")} END AS swapfromtoken,
               CASE WHEN l_quantity < 50 THEN {_sql_token("l_partkey")} END AS swaptotoken,
               CASE l_linenumber % 5 WHEN 0 THEN 'PUMP_FUN' WHEN 1 THEN 'RAYDIUM' WHEN 2 THEN 'JUPITER'
                                     WHEN 3 THEN 'ORCA' END AS source
        FROM lineitem""",
    "alert_log": f"""
        SELECT {_sql_token("user_id * 13 + event_id % 13")} AS address,
               CASE event_id % 3 WHEN 0 THEN '30min' WHEN 1 THEN '1hour' ELSE '3hours' END AS time_interval,
               TIMESTAMP '{AS_OF}'
                 - to_microseconds((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts) + 30) // 60) AS inserted_at
        FROM events""",
    "token_metadata": f"""
        SELECT CASE WHEN p_partkey % 9 = 4 THEN 'X' || CAST(p_partkey AS VARCHAR)
                    ELSE {_sql_token("p_partkey")} END AS address,
               CASE WHEN p_partkey = 3 THEN 'sol' WHEN p_partkey % 101 = 5 THEN 'USDC'
                    WHEN p_partkey % 103 = 8 THEN 'Wbtc' WHEN p_partkey % 7 = 0 THEN ''
                    WHEN p_partkey % 11 = 0 THEN NULL ELSE upper(substr(p_name, 1, 4)) END AS symbol,
               CASE WHEN p_partkey % 5 = 4 THEN '' ELSE p_name END AS name,
               CAST(p_size % 10 AS BIGINT) AS decimals,
               CASE WHEN p_partkey % 4 = 1 THEN 'ethereum' ELSE 'solana' END AS blockchain,
               TIMESTAMP '2024-01-01 00:00:00' AS inserted_at
        FROM part""",
    "token_metadata_raw": f"""
        SELECT event_id AS ord,
               CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 3 = 0 THEN {_sql_token("1")}
                    ELSE {_sql_token("user_id")} END AS address,
               CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_type END AS name,
               upper(substr(event_type, 1, 3)) AS symbol, 'solana' AS blockchain,
               CAST(event_id % 10 AS BIGINT) AS decimals
        FROM events""",
    "responses": f"""
        SELECT {_sql_token("p_partkey")} AS address,
               CASE WHEN p_partkey % 6 = 0 THEN 404 ELSE 200 END AS status_code,
               CASE WHEN p_partkey % 6 = 1 THEN '{{"success":false}}'
                    WHEN p_partkey % 6 = 2 THEN '{{"success":true,"data":null}}'
                    WHEN p_partkey % 6 = 3 THEN '{{"success":true,"data":{{"name":"only name"}}}}'
                    ELSE '{{"success":true,"data":{{"symbol":"S' || CAST(p_partkey AS VARCHAR) || '","name":"' || p_name
                         || '","decimals":' || CAST(p_size % 10 AS VARCHAR) || '}}}}' END AS body
        FROM part""",
    "price_payloads": f"""
        SELECT batch_id, CASE WHEN batch_id % 7 = 6 THEN '{{"candles":' || list || '}}' ELSE list END AS body
        FROM (SELECT event_id // {CANDLES_PER_PAYLOAD} AS batch_id,
                     '[' || string_agg(props, ',' ORDER BY event_id) || ']' AS list
              FROM events GROUP BY event_id // {CANDLES_PER_PAYLOAD})""",
    "long_metadata": """
        SELECT CASE WHEN lang <> 'de' THEN 'D' || CAST(doc_id AS VARCHAR) END AS address,
               source AS symbol, text AS name, n_chars AS decimals, lang AS blockchain
        FROM documents""",
}
