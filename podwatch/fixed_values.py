"""These must be equal to the originals for results to be right."""

# Detection rules: label, trailing length (minutes), threshold (strictly exceeded),
# cooldown (minutes), text shown in the alert. The order is the order of the output.
RULE_ROWS = (
    ("30min", 30, 2, 15, "30 min"),
    ("1hour", 60, 3, 30, "1 hour"),
    ("3hours", 180, 5, 60, "3 hours"),
)
DEFAULT_COOLDOWN_MINUTES = 30
DEFAULT_RULE_TEXT = "1 hour"

# A token is looked at only if it was swapped in the last so many minutes.
RECENT_MINUTES = 10
# One poll every so many minutes.
POLL_MINUTES = 5

# Swaps of this venue make a token recent but are never counted.
UNCOUNTED_SOURCE = "PUMP_FUN"

# Tokens of these symbols never alert.
DENIED_SYMBOLS = ("SOL", "USDT", "USDC", "WSOL", "WBTC", "ETH")

# Characters of the address shown where metadata has no symbol or no name.
SYMBOL_FALLBACK_CHARS = 10
NAME_FALLBACK_CHARS = 15

# Metadata table: column widths and the chain written on insert.
MAX_ADDRESS_CHARS = 255
MAX_SYMBOL_CHARS = 50
MAX_NAME_CHARS = 255
MAX_BLOCKCHAIN_CHARS = 50
DEFAULT_BLOCKCHAIN = "solana"

# Alert text. The arrows end in U+FE0F; the bullets are U+2022.
TOKEN_LINK_PREFIX = "https://dexscreener.com/solana/"
BULLISH = ("🟢", "↗️", "*BULLISH ACTIVITY*")
BEARISH = ("🔴", "↘️", "*BEARISH ACTIVITY*")
NEUTRAL = ("⚪", "↔️", "*NEUTRAL ACTIVITY*")
BUY_RATIO_FORMAT = "%d/%d buy/sell ratio"
SELL_RATIO_FORMAT = "%d/%d sell/buy ratio"
MESSAGE_TEMPLATE = """
{indicator} *WHALE ALERT* {indicator}
{arrow} {sentiment}: <{link}|{name} ({symbol})>
• *Time Frame*: Last {rule_text}
• *Unique Buyers*: {buys} users
• *Unique Sellers*: {sells} users
• *Activity Ratio*: {ratio}
• *Token Address*: `{token}`
"""
MESSAGE_SEPARATOR = "\n"
NOTHING_TO_REPORT = "No new whale notifications triggered."
