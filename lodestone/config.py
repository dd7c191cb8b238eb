"""Domain lists and fixed settings of the daily feeds."""

from __future__ import annotations

# --- Fixed values (must equal the reference configuration) -----------------
# Macro series, news keywords (also the metal list), and currencies, in the
# order the reference configures them.
FRED_SERIES = ("DGS10", "DTWEXBGS", "CPIAUCSL")
NEWS_KEYWORDS = ("gold", "silver", "platinum", "copper", "nickel")
METALS = NEWS_KEYWORDS
CURRENCIES = ("USD", "IDR", "EUR", "JPY", "GBP", "AUD", "CAD", "CNY", "SGD")
# Look-back of the macro request: 180 days for CPIAUCSL, 7 days for the rest.
LOOKBACK_DAYS = {"CPIAUCSL": 180}
DEFAULT_LOOKBACK_DAYS = 7
# News request window: yesterday to today.
NEWS_WINDOW_DAYS = 1
# Macro series -> fact column.
MACRO_COLUMNS = (("DGS10", "yield_10y"), ("DTWEXBGS", "usd_index"), ("CPIAUCSL", "cpi_index"))
# Fact currency and the first visible partition of the silver tables.
TARGET_CURRENCY = "IDR"
PROJECTION_START = "2026-01-01"
# Metal document must carry this status; news rows must carry "ok".
METAL_STATUS_OK = "success"
NEWS_STATUS_OK = "ok"
NEWS_STATUS_DEFAULT = "unknown"
# Back-fill: feed classified by the first matching name, in this order.
FEED_PATTERNS = (
    ("metal", ("metal_prices", "metal")),
    ("currency", ("currency_rates", "currency")),
    ("fred", ("fred_data", "fred")),
    ("news", ("news_data", "news")),
)
PARTITION_MARKER = "ingested_at="
# --------------------------------------------------------------------------

FEEDS = tuple(name for name, _ in FEED_PATTERNS)
