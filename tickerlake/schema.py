"""Bar schemas and the fixed values that results must agree on."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 2)

# Raw (bronze) bar: one row per symbol x trading date x load.
RAW_BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", PRICE),
    T.StructField("high", PRICE),
    T.StructField("low", PRICE),
    T.StructField("close", PRICE),
    T.StructField("volume", T.LongType()),
    T.StructField("ingestion_timestamp", T.TimestampNTZType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("pipeline_run_id", T.StringType()),
])

RAW_COLUMNS = tuple(f.name for f in RAW_BAR_SCHEMA.fields)
MEASURES = ("open", "high", "low", "close", "volume")
METADATA = ("ingestion_timestamp", "source_system", "pipeline_run_id")

# Staged (silver) bar columns, in published order.
STAGED_COLUMNS = (
    "symbol", "date", "open_price", "high_price", "low_price", "close_price",
    "volume", "daily_range", "daily_change_pct",
    "ingestion_timestamp", "source_system", "pipeline_run_id",
)

# Mart columns, in published order.
DAILY_RETURNS_COLUMNS = (
    "symbol", "date", "close_price", "prev_close_price", "daily_change_inr",
    "daily_return_pct", "volume", "return_category", "ingestion_timestamp",
)
MOVING_AVERAGES_COLUMNS = (
    "symbol", "date", "close_price", "ma_7_day", "ma_30_day", "avg_volume_7_day",
    "volume", "distance_from_ma7_pct", "distance_from_ma30_pct",
    "crossover_signal", "ingestion_timestamp",
)
VOLUME_ANALYSIS_COLUMNS = (
    "symbol", "date", "close_price", "volume", "avg_volume_7d", "volume_vs_avg_pct",
    "price_change_pct", "volume_category", "trend_strength", "ingestion_timestamp",
)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the original pipeline's values for results
# to agree; they are stated here once, in their natural order.
# ---------------------------------------------------------------------------

# Default symbol universe (NSE tickers).
DEFAULT_SYMBOLS = (
    "RELIANCE.NS", "TCS.NS", "HDFCBANK.NS", "INFY.NS", "ICICIBANK.NS",
    "HINDUNILVR.NS", "ITC.NS", "SBIN.NS", "BHARTIARTL.NS", "KOTAKBANK.NS",
)

# Layer (schema) names and the bronze table name.
BRONZE_LAYER = "RAW"
SILVER_LAYER = "STAGING"
GOLD_LAYER = "MARTS"
BRONZE_TABLE = "STOCK_PRICES_RAW"

# Source system tag written by the extractor, and the run-id time format.
DEFAULT_SOURCE_SYSTEM = "yfinance"
RUN_ID_FORMAT = "yyyyMMdd_HHmmss"

# Strings the CSV loader reads as NULL.
CSV_NULL_STRINGS = ("NULL", "null", "")

# Required columns of a batch, and the columns that must not be NULL.
REQUIRED_COLUMNS = ("symbol", "date", "open", "high", "low", "close", "volume")
NOT_NULL_AT_LOAD = ("symbol", "date", "close")

# Daily return categories: pct > 3, > 1, >= -1, >= -3, else.
RETURN_LARGE_GAIN = "Large Gain"
RETURN_MODERATE_GAIN = "Moderate Gain"
RETURN_FLAT = "Flat"
RETURN_MODERATE_LOSS = "Moderate Loss"
RETURN_LARGE_LOSS = "Large Loss"

# Crossover signals.
GOLDEN_CROSS = "Golden Cross"
DEATH_CROSS = "Death Cross"

# Volume categories: pct > 200, > 150, > 80, > 50, else.
VOLUME_VERY_HIGH = "Very High Volume"
VOLUME_HIGH = "High Volume"
VOLUME_NORMAL = "Normal"
VOLUME_LOW = "Low Volume"
VOLUME_VERY_LOW = "Very Low Volume"

# Trend strength: price beyond +/-2 with volume pct > 150 or < 80.
TREND_STRONG_UP = "Strong Uptrend"
TREND_STRONG_DOWN = "Strong Downtrend"
TREND_WEAK_UP = "Weak Uptrend"
TREND_WEAK_DOWN = "Weak Downtrend"
TREND_NEUTRAL = "Neutral"

# Moving-average frames (rows, current row included).
FAST_MA_ROWS = 7
SLOW_MA_ROWS = 30
VOLUME_MA_ROWS = 7

# Redaction: replacement marker and the sensitive dictionary keys.
REDACTED = "***REDACTED***"
SENSITIVE_KEYS = (
    "password", "passwd", "pwd",
    "token", "api_key", "apikey", "secret",
    "authorization", "auth",
    "private_key", "privatekey",
)

# Retention: files older than this many days are archived.
RETENTION_DAYS = 7

# Business-day calendar guard, for callers that want one.
MAX_CALENDAR_DAYS = 1000
