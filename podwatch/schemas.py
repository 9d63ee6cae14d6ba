"""Table schemas. Column names resolve without regard to case, so upper-case tables work as they are."""

from __future__ import annotations

from dataclasses import dataclass

from podwatch import fixed_values as fv

SWAPS = "timestamp timestamp, user_address string, swapfromtoken string, swaptotoken string, source string"

ALERT_LOG = (
    "timestamp timestamp, address string, symbol string, name string, time_interval string, "
    "num_users_bought bigint, num_users_sold bigint, inserted_at timestamp"
)

OUTBOX = "timestamp timestamp, rule_order int, token string, time_interval string, message string"
POLL_TEXTS = "timestamp timestamp, part bigint, parts bigint, text string"

# Where a row was written: the UTC day of its poll and the poll, or the micro-batch of a stream. No row may be younger than its day.
POLL_PARTITION = ("day", "poll")

TOKEN_METADATA_COLUMNS = ("address", "symbol", "name", "decimals", "blockchain", "inserted_at")
TOKEN_METADATA_DDL = (
    f"address VARCHAR({fv.MAX_ADDRESS_CHARS}) NOT NULL, "
    f"symbol VARCHAR({fv.MAX_SYMBOL_CHARS}), "
    f"name VARCHAR({fv.MAX_NAME_CHARS}), "
    "decimals DECIMAL(38,0), "
    f"blockchain VARCHAR({fv.MAX_BLOCKCHAIN_CHARS}) DEFAULT '{fv.DEFAULT_BLOCKCHAIN}', "
    "inserted_at TIMESTAMP DEFAULT current_timestamp()"
)
METADATA_WIDTHS = {
    "address": fv.MAX_ADDRESS_CHARS,
    "symbol": fv.MAX_SYMBOL_CHARS,
    "name": fv.MAX_NAME_CHARS,
    "blockchain": fv.MAX_BLOCKCHAIN_CHARS,
}

RAW_METADATA_COLUMNS = ("address", "name", "symbol", "blockchain", "decimals")
METADATA_RESPONSES = "address string, status_code int, body string, fetched_at timestamp"
BTC_HISTORIC_DDL = "raw_data VARIANT"


@dataclass(frozen=True)
class TableNames:
    """Where the tables are; any name the catalog resolves will do."""

    swaps: str = "bronze.swaps"
    alert_log: str = "bronze.whale_notifications"
    token_metadata: str = "bronze.token_metadata"
    outbox: str = "bronze.whale_outbox"
    btc_historic: str = "bronze.btc_historic"
    poll_texts: str = "bronze.whale_poll_texts"
