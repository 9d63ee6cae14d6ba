"""SQL that gives the result of each registered query, written the long way round on purpose.

Detection counts the distinct traders of every rule's window, replay joins every poll with every swap
of its window, and the cooldown is a recursive query, so none shares its method with the Spark side.
"""

from __future__ import annotations

from podwatch import fixed_values as fv
from podwatch.checks import fixtures as fx
from podwatch.schemas import METADATA_WIDTHS

# By value, so that a wrong change on the Spark side is seen.
PART_MESSAGES = 100

NOW = f"TIMESTAMP '{fx.AS_OF}'"


def _with(tables: str, ctes: dict[str, str], final: str, recursive: bool = False) -> str:
    parts = {**{name: fx.SQL[name] for name in tables.split()}, **ctes}
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n{final}"


RECENT = f"""
    SELECT token_address FROM (
        SELECT unnest([swapfromtoken, swaptotoken]) AS token_address FROM swaps
        WHERE timestamp > {NOW} - INTERVAL {fv.RECENT_MINUTES} MINUTE)
    GROUP BY token_address HAVING token_address IS NOT NULL"""

POLL_RULES = "SELECT * FROM (VALUES {}) r(label, minutes, threshold)".format(
    ", ".join(f"('{label}', {minutes}, {threshold})" for label, minutes, threshold, *_ in fv.RULE_ROWS)
)

# Who traded what in the window of which rule, each once.
TRADERS = f"""
    SELECT DISTINCT r.label, leg.token, leg.side, s.user_address
    FROM swaps s JOIN poll_rules r ON s.timestamp > {NOW} - to_minutes(r.minutes),
         LATERAL (VALUES (s.swaptotoken, 'buy'), (s.swapfromtoken, 'sell')) leg(token, side)
    WHERE s.source <> '{fv.UNCOUNTED_SOURCE}'"""

COUNTED = f"""
    SELECT label, token,
           count(user_address) FILTER (WHERE side = 'buy') AS num_users_bought,
           count(user_address) FILTER (WHERE side = 'sell') AS num_users_sold
    FROM traders t
    WHERE EXISTS (FROM swaps g WHERE g.swapfromtoken = t.token AND g.timestamp > {NOW} - INTERVAL {fv.RECENT_MINUTES} MINUTE)
       OR EXISTS (FROM swaps g WHERE g.swaptotoken = t.token AND g.timestamp > {NOW} - INTERVAL {fv.RECENT_MINUTES} MINUTE)
    GROUP BY label, token"""

CANDIDATES = f"""
    SELECT {NOW} AS timestamp, c.token, c.label AS time_interval, c.num_users_bought, c.num_users_sold, l.last_notification
    FROM counted c JOIN poll_rules r USING (label)
    LEFT JOIN (SELECT address, time_interval, max(inserted_at) AS last_notification FROM alert_log GROUP BY ALL) l
      ON l.address = c.token AND l.time_interval = c.label
    WHERE greatest(c.num_users_bought, c.num_users_sold) > r.threshold"""

COUNTS = {"poll_rules": POLL_RULES, "traders": TRADERS, "counted": COUNTED}


def _case(column: str, index: int, default: object) -> str:
    """Lookup of a rule setting by interval label."""

    def shown(value: object) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    whens = " ".join(f"WHEN '{r[0]}' THEN {shown(r[index])}" for r in fv.RULE_ROWS)
    return f"CASE {column} {whens} ELSE {shown(default)} END"


COOLDOWN = _case("time_interval", 3, fv.DEFAULT_COOLDOWN_MINUTES)
RULE_TEXT = _case("time_interval", 4, fv.DEFAULT_RULE_TEXT)
RULE_ORDER = "CASE time_interval " + " ".join(
    f"WHEN '{r[0]}' THEN {i}" for i, r in enumerate(fv.RULE_ROWS, start=1)
) + f" ELSE {len(fv.RULE_ROWS) + 1} END"
DENIED = ", ".join(f"'{s}'" for s in fv.DENIED_SYMBOLS)


def _named(source: str, metadata: str) -> str:
    """Candidates with names, deny list applied."""
    return f"""
        SELECT * FROM (
            SELECT c.*,
                   CASE WHEN m.symbol IS NULL OR m.symbol = ''
                        THEN substr(c.token, 1, {fv.SYMBOL_FALLBACK_CHARS}) ELSE m.symbol END AS symbol,
                   CASE WHEN m.name IS NULL OR m.name = ''
                        THEN substr(c.token, 1, {fv.NAME_FALLBACK_CHARS}) ELSE m.name END AS name
            FROM {source} c LEFT JOIN {metadata} m ON c.token = m.address)
        WHERE upper(symbol) NOT IN ({DENIED})"""


COOLED = f"""
    (last_notification IS NULL OR {NOW} - last_notification >= to_minutes({COOLDOWN}))"""


def _sentiment(index: int) -> str:
    return (
        f"CASE WHEN num_users_bought > num_users_sold THEN '{fv.BULLISH[index]}'"
        f" WHEN num_users_sold > num_users_bought THEN '{fv.BEARISH[index]}' ELSE '{fv.NEUTRAL[index]}' END"
    )


def _rendered(source: str) -> str:
    ratio = """CASE WHEN num_users_sold > num_users_bought
                    THEN num_users_sold || '/' || num_users_bought || ' sell/buy ratio'
                    ELSE num_users_bought || '/' || num_users_sold || ' buy/sell ratio' END"""
    return f"""
        SELECT *, chr(10) || indicator || ' *WHALE ALERT* ' || indicator || chr(10)
               || arrow || ' ' || sentiment || ': <' || link || '|' || name || ' (' || symbol || ')>' || chr(10)
               || '• *Time Frame*: Last ' || {RULE_TEXT} || chr(10)
               || '• *Unique Buyers*: ' || num_users_bought || ' users' || chr(10)
               || '• *Unique Sellers*: ' || num_users_sold || ' users' || chr(10)
               || '• *Activity Ratio*: ' || ratio || chr(10)
               || '• *Token Address*: `' || token || '`' || chr(10) AS message
        FROM (SELECT *, CAST({RULE_ORDER} AS INTEGER) AS rule_order, {_sentiment(0)} AS indicator,
                     {_sentiment(1)} AS arrow, {_sentiment(2)} AS sentiment, {ratio} AS ratio,
                     '{fv.TOKEN_LINK_PREFIX}' || token AS link
              FROM {source})"""


def _texts(alerts: str) -> str:
    return f"""
        SELECT timestamp, CAST((rn - 1) // {PART_MESSAGES} AS BIGINT) AS part,
               CAST((any_value(n) - 1) // {PART_MESSAGES} + 1 AS BIGINT) AS parts, string_agg(message, chr(10) ORDER BY rn) AS text
        FROM (SELECT timestamp, message, count(*) OVER (PARTITION BY timestamp) AS n,
                     row_number() OVER (PARTITION BY timestamp ORDER BY rule_order, token) AS rn
              FROM {alerts})
        GROUP BY timestamp, (rn - 1) // {PART_MESSAGES}"""


FETCH = """
    SELECT token AS address FROM candidates EXCEPT SELECT address FROM token_metadata
    UNION
    SELECT address FROM token_metadata
    WHERE address IN (SELECT token FROM candidates)
      AND (symbol IS NULL OR symbol = '' OR name IS NULL OR name = '')"""

FETCHED = """
    SELECT f.address, coalesce(r.body ->> '$.data.symbol', '') AS symbol,
           coalesce(r.body ->> '$.data.name', '') AS name,
           CAST(r.body ->> '$.data.decimals' AS BIGINT) AS decimals
    FROM wanted f LEFT JOIN responses r
      ON f.address = r.address AND r.status_code = 200
     AND coalesce(CAST(r.body ->> '$.success' AS BOOLEAN), false)
     AND json_type(r.body, '$.data') = 'OBJECT'"""


def _api_upsert(keep_known: bool) -> str:
    def value(column: str) -> str:
        if keep_known and column != "decimals":
            return (
                f"CASE WHEN s.address IS NULL OR (s.{column} = '' AND t.address IS NOT NULL)"
                f" THEN t.{column} ELSE s.{column} END AS {column}"
            )
        return f"CASE WHEN s.address IS NOT NULL THEN s.{column} ELSE t.{column} END AS {column}"

    return f"""
        SELECT coalesce(t.address, s.address) AS address, {value("symbol")}, {value("name")}, {value("decimals")},
               CASE WHEN t.address IS NOT NULL THEN t.blockchain ELSE '{fv.DEFAULT_BLOCKCHAIN}' END AS blockchain,
               CASE WHEN s.address IS NOT NULL THEN {NOW} ELSE t.inserted_at END AS inserted_at
        FROM token_metadata t FULL JOIN fetched s ON t.address = s.address"""


CLEAN = """
    SELECT address, symbol, name, decimals, blockchain FROM token_metadata_raw WHERE address IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY address ORDER BY ord) = 1"""

# Every poll against every swap of its window.
TICKS = f"""
    SELECT unnest(generate_series(TIMESTAMP '{fx.AS_OF}' - INTERVAL 24 HOUR, {NOW},
                                  INTERVAL {fv.POLL_MINUTES} MINUTE)) AS tick"""
LEGS = """
    SELECT timestamp, user_address, source, swaptotoken AS token, 'buy' AS side FROM swaps
    UNION ALL SELECT timestamp, user_address, source, swapfromtoken, 'sell' FROM swaps"""
TICK_RECENT = f"""
    SELECT DISTINCT tick, token FROM ticks JOIN legs
      ON timestamp > tick - INTERVAL {fv.RECENT_MINUTES} MINUTE AND timestamp <= tick
    WHERE token IS NOT NULL"""


def _tick_counts(label: str, minutes: int, threshold: int) -> str:
    return f"""
        SELECT timestamp, token, time_interval, num_users_bought, num_users_sold FROM (
            SELECT tick AS timestamp, token, '{label}' AS time_interval,
                   count(DISTINCT CASE WHEN side = 'buy' THEN user_address END) AS num_users_bought,
                   count(DISTINCT CASE WHEN side = 'sell' THEN user_address END) AS num_users_sold
            FROM ticks JOIN legs ON timestamp > tick - INTERVAL {minutes} MINUTE AND timestamp <= tick
            WHERE source <> '{fv.UNCOUNTED_SOURCE}' GROUP BY tick, token)
        JOIN tick_recent USING (token)
        WHERE tick = timestamp AND (num_users_bought > {threshold} OR num_users_sold > {threshold})"""


TICK_CANDIDATES = " UNION ALL ".join(_tick_counts(r[0], r[1], r[2]) for r in fv.RULE_ROWS)
REPLAY = {"ticks": TICKS, "legs": LEGS, "tick_recent": TICK_RECENT, "tick_candidates": TICK_CANDIDATES}


def _greedy(source: str) -> str:
    return f"""
        SELECT token, time_interval, min(timestamp) AS timestamp FROM {source} GROUP BY token, time_interval
        UNION ALL
        SELECT c.token, c.time_interval, min(c.timestamp)
        FROM sent s JOIN {source} c ON c.token = s.token AND c.time_interval = s.time_interval
         AND c.timestamp >= s.timestamp + to_minutes({COOLDOWN.replace("time_interval", "c.time_interval")})
        GROUP BY c.token, c.time_interval, s.timestamp"""


POLL = {"recent": RECENT, **COUNTS, "candidates": CANDIDATES}
ALERTS = {
    **POLL,
    "named": _named("candidates", "token_metadata"),
    "cooled": f"SELECT * FROM named WHERE {COOLED}",
    "alerts": _rendered("cooled"),
}
API = {**POLL, "wanted": FETCH, "fetched": FETCHED}
WHOLE = {
    **API,
    "refreshed": _api_upsert(False),
    "named": _named("candidates", "refreshed"),
    "cooled": f"SELECT * FROM named WHERE {COOLED}",
}

REASONS = "CASE WHEN address IS NULL THEN 'no address' " + " ".join(
    f"WHEN length({c}) > {n} THEN '{c} over {n} characters'" for c, n in METADATA_WIDTHS.items()
) + " END"

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

ORACLES: dict[str, str] = {
    "D1_recent_tokens": _with("swaps", {"recent": RECENT}, "SELECT * FROM recent"),
    "D2_buyers_sellers": _with(
        "swaps",
        COUNTS,
        "SELECT token AS token_address, num_users_bought, num_users_sold FROM counted"
        f" WHERE label = '{fv.RULE_ROWS[1][0]}' AND num_users_bought + num_users_sold > 0",
    ),
    "D3_last_alert": _with(
        "alert_log",
        {},
        "SELECT address, time_interval, max(inserted_at) AS last_notification FROM alert_log"
        " GROUP BY address, time_interval",
    ),
    "D4_candidates": _with("swaps alert_log", POLL, "SELECT * FROM candidates"),
    "D5_alerts": _with("swaps alert_log token_metadata", ALERTS, "SELECT * FROM alerts"),
    "W1_whole_poll": _with(
        "swaps alert_log token_metadata responses",
        WHOLE,
        "SELECT timestamp, token AS address, symbol, name, time_interval, num_users_bought, num_users_sold,"
        " timestamp AS inserted_at FROM cooled",
    ),
    "E1_missing_metadata": _with(
        "swaps alert_log token_metadata",
        POLL,
        "SELECT token AS address FROM candidates EXCEPT SELECT address FROM token_metadata",
    ),
    "E2_incomplete_metadata": _with(
        "swaps alert_log token_metadata",
        POLL,
        "SELECT address FROM token_metadata WHERE address IN (SELECT token FROM candidates)"
        " AND (coalesce(symbol, '') = '' OR coalesce(name, '') = '')",
    ),
    "E3_enriched": _with("swaps alert_log token_metadata responses", API, "SELECT * FROM fetched"),
    "E4_fallback_full_address": _with(
        "swaps alert_log", POLL, "SELECT token, time_interval, token AS symbol, token AS name FROM candidates"
    ),
    "M1_clean_metadata": _with(
        "token_metadata_raw",
        {"clean": CLEAN},
        'SELECT address AS "ADDRESS", symbol AS "SYMBOL", name AS "NAME", decimals AS "DECIMALS",'
        ' blockchain AS "BLOCKCHAIN" FROM clean',
    ),
    "M2_load_metrics": _with(
        "token_metadata_raw",
        {},
        "SELECT count(*) AS rows_extracted, count(*) - count(address) AS rows_without_key,"
        " count(address) AS rows_with_key, count(DISTINCT address) AS unique_keys FROM token_metadata_raw",
    ),
    "M3_upsert_batch": _with(
        "token_metadata token_metadata_raw",
        {"clean": CLEAN},
        f"""SELECT coalesce(t.address, s.address) AS address,
                   CASE WHEN s.address IS NULL THEN t.symbol ELSE s.symbol END AS symbol,
                   CASE WHEN s.address IS NULL THEN t.name ELSE s.name END AS name,
                   CASE WHEN s.address IS NULL THEN t.decimals ELSE s.decimals END AS decimals,
                   CASE WHEN s.address IS NULL THEN t.blockchain ELSE s.blockchain END AS blockchain,
                   CASE WHEN s.address IS NULL THEN t.inserted_at ELSE {NOW} END AS inserted_at
            FROM token_metadata t FULL JOIN clean s ON t.address = s.address""",
    ),
    "M4_upsert_api": _with("swaps alert_log token_metadata responses", API, _api_upsert(False)),
    "M4_upsert_api_keep_known": _with("swaps alert_log token_metadata responses", API, _api_upsert(True)),
    "M5_reject_bad_rows": _with(
        "long_metadata",
        {},
        f"SELECT address, length(name) AS name_chars, {REASONS} AS reason FROM long_metadata"
        f" WHERE {REASONS} IS NOT NULL",
    ),
    "M6_preview": _with("token_metadata_raw", {}, "SELECT * FROM token_metadata_raw ORDER BY ord LIMIT 2"),
    "B1_payload_record_count": _with(
        "price_payloads",
        {},
        "SELECT batch_id, CAST(CASE WHEN json_type(body) = 'ARRAY' THEN json_array_length(body) ELSE 1 END AS BIGINT)"
        " AS record_count FROM price_payloads",
    ),
    "B2_payload_fields": _with(
        "price_payloads",
        {
            "landed": "SELECT batch_id, CASE WHEN json_type(body) = 'ARRAY' THEN body ELSE '[' || body || ']' END"
            " AS raw_data FROM price_payloads"
        },
        "SELECT batch_id, CAST(raw_data ->> '$[0].k' AS BIGINT) AS first_k,"
        " coalesce(CAST(raw_data ->> '$[0].candles[1].k' AS BIGINT), -1) AS second_candle_k,"
        " CAST(json(raw_data) AS VARCHAR) AS raw_text FROM landed",
    ),
    "C1_schema_listing": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, column_name, true AS nullable, (SELECT count(*) FROM {t}) AS row_count"
        f" FROM (DESCRIBE SELECT * FROM {t})"
        for t in TEST_TABLES
    ),
    "N1_poll_text": _with(
        "swaps alert_log token_metadata",
        {**ALERTS, "texts": _texts("alerts")},
        f"""SELECT p.timestamp, coalesce(part, 0) AS part, coalesce(parts, 1) AS parts, coalesce(text, '{fv.NOTHING_TO_REPORT}') AS text,
                   coalesce(text, '{fv.NOTHING_TO_REPORT}') = '{fv.NOTHING_TO_REPORT}' AS quiet
            FROM (SELECT {NOW} AS timestamp) p LEFT JOIN texts USING (timestamp)""",
    ),
    "N2_replay_poll_text": _with(
        "swaps token_metadata",
        {
            **REPLAY,
            "named": _named("tick_candidates", "token_metadata"),
            "sent": _greedy("named"),
            "kept": "SELECT named.* FROM named JOIN sent USING (token, time_interval, timestamp)",
            "alerts": _rendered("kept"),
            "texts": _texts("alerts"),
        },
        f"""SELECT p.timestamp, coalesce(part, 0) AS part, coalesce(parts, 1) AS parts, coalesce(text, '{fv.NOTHING_TO_REPORT}') AS text
            FROM (SELECT unnest(generate_series(TIMESTAMP '{fx.REPLAY_SINCE}', TIMESTAMP '{fx.REPLAY_UNTIL}',
                                                INTERVAL {fv.POLL_MINUTES} MINUTE)) AS timestamp) p
            LEFT JOIN texts USING (timestamp)""",
        recursive=True,
    ),
    "X1_time_text": f"""
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second_text, strftime(ts, '%Y%m%d%H%M%S') AS stamp_text,
               replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') AS iso_text, epoch_us(ts) AS parsed_us,
               printf('%.1f', (epoch_us({NOW}) - epoch_us(ts)) / 60000000.0) AS elapsed_minutes
        FROM events""",
    "X2_quoting": """
        SELECT doc_id, replace(text, '''', '''''') AS quoted, true AS round_trip FROM documents""",
    "R1_replay_counts": _with("swaps", REPLAY, "SELECT * FROM tick_candidates"),
    "R2_suppressed_alerts": _with(
        "swaps",
        {**REPLAY, "sent": _greedy("tick_candidates")},
        "SELECT tick_candidates.* FROM tick_candidates JOIN sent USING (token, time_interval, timestamp)",
        recursive=True,
    ),
}

# The jobs leave what the operators give.
ORACLES |= {
    "R1_late_corrections": ORACLES["R1_replay_counts"],
    "K6_logged_alerts": ORACLES["W1_whole_poll"],
    "K8_published_text": _with(
        "swaps alert_log token_metadata responses",
        {**WHOLE, "alerts": _rendered("cooled"), "texts": _texts("alerts")},
        f"""SELECT p.timestamp, coalesce(part, 0) AS part, coalesce(parts, 1) AS parts, coalesce(text, '{fv.NOTHING_TO_REPORT}') AS text
            FROM (SELECT {NOW} AS timestamp) p LEFT JOIN texts USING (timestamp)""",
    ),
    "K5_refreshed_metadata": ORACLES["M4_upsert_api"],
    "K12_loaded_metadata": ORACLES["M3_upsert_batch"],
    "K12_load_figures": _with(
        "token_metadata_raw",
        {},
        "SELECT count(*) AS extracted, count(*) - count(address) AS without_key, count(DISTINCT address) AS unique,"
        " 0 AS rejected, count(DISTINCT address) AS table_rows FROM token_metadata_raw",
    ),
    "K1_landed_rows": f"SELECT first_k, raw_text FROM ({ORACLES['B2_payload_fields']})",
    "A5_incremental_candidates": ORACLES["D4_candidates"],
    "R3_stream_candidates": _with(
        "swaps",
        REPLAY,
        "SELECT * FROM tick_candidates WHERE timestamp < (SELECT max(timestamp) FROM swaps) - INTERVAL 10 MINUTE",
    ),
}
