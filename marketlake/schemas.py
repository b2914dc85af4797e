"""Fixed schemas for every layer (no inference pass over Bronze).

Field names of the envelope, the ticker and the 12 candle positions are the
exchange payload's names and must stay as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The 12 positional candle fields, in payload order.
KLINE_FIELDS = (
    "open_time", "open", "high", "low", "close", "volume",
    "close_time", "quote_asset_volume", "num_trades",
    "taker_buy_base_vol", "taker_buy_quote_vol", "ignore",
)
# Candle fields carried as epoch-ms / counts (long); the rest are decimal strings.
KLINE_LONG_FIELDS = ("open_time", "close_time", "num_trades")

# Candle arrays in the envelope and the interval label of each.
KLINE_ARRAYS = {"klines_1m": "1m", "klines_5m": "5m", "klines_1h": "1h"}

KLINE = T.StructType([
    T.StructField(f, T.LongType() if f in KLINE_LONG_FIELDS else T.StringType(), True)
    for f in KLINE_FIELDS
])

METADATA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("asset_class", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
    T.StructField("pipeline_ver", T.StringType()),
])

# 24h ticker fields of the payload (strings except count).
TICKER_STRING_FIELDS = (
    "lastPrice", "openPrice", "highPrice", "lowPrice", "volume", "quoteVolume",
    "priceChange", "priceChangePercent", "weightedAvgPrice",
)
TICKER = T.StructType(
    [T.StructField(f, T.StringType()) for f in TICKER_STRING_FIELDS]
    + [T.StructField("count", T.LongType())]
)

CORRUPT = "_corrupt_record"

# order_book / recent_trades are landed but never read downstream; they are
# kept as raw JSON text so nothing is lost and no inner schema is invented.
BRONZE = T.StructType([
    T.StructField("metadata", METADATA),
    T.StructField("ticker", TICKER),
    T.StructField("order_book", T.StringType()),
    T.StructField("recent_trades", T.StringType()),
    T.StructField("klines_1m", T.ArrayType(KLINE)),
    T.StructField("klines_5m", T.ArrayType(KLINE)),
    T.StructField("klines_1h", T.ArrayType(KLINE)),
    T.StructField(CORRUPT, T.StringType()),
])

# Compacted Bronze: the parsed documents with their file, asset folder and event day.
COMPACT_BRONZE = T.StructType(BRONZE.fields + [
    T.StructField("_file", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("date", T.DateType()),
])

TICK = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.StringType()),
])

SILVER_TICKERS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("asset_class", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("last_price", T.DoubleType()),
    T.StructField("open_price", T.DoubleType()),
    T.StructField("high_price", T.DoubleType()),
    T.StructField("low_price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("quote_volume", T.DoubleType()),
    T.StructField("price_change", T.DoubleType()),
    T.StructField("price_change_pct", T.DoubleType()),
    T.StructField("vwap", T.DoubleType()),
    T.StructField("trade_count", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("hour", T.IntegerType()),
])

INDICATOR_COLUMNS = ("sma_7", "sma_14", "sma_21", "bb_mid", "bb_std", "bb_upper",
                     "bb_lower", "rsi_14", "vwap")

SILVER_KLINES = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("num_trades", T.LongType()),
    T.StructField("open_time", T.TimestampType()),
    T.StructField("interval", T.StringType()),
] + [T.StructField(c, T.DoubleType()) for c in INDICATOR_COLUMNS])

# Candle tables as read: the Silver columns, the position and the VWAP sums of the series, the day.
CANDLE_TABLE = T.StructType(SILVER_KLINES.fields + [
    T.StructField("_i", T.LongType()),
    T.StructField("_cum_pv", T.DoubleType()),
    T.StructField("_cum_v", T.DoubleType()),
    T.StructField("date", T.DateType()),
])

# Candle tables as stored: nothing that a change on an earlier day would change, but for the look-back.
CANDLE_ROWS = T.StructType([f for f in SILVER_KLINES.fields if f.name != "vwap"] + [
    T.StructField("_j", T.LongType()),
    T.StructField("_day_pv", T.DoubleType()),
    T.StructField("_day_v", T.DoubleType()),
    T.StructField("date", T.DateType()),
])

# One row per series and day of a candle table: its candles and their VWAP sums.
CANDLE_DAYS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("n", T.LongType()),
    T.StructField("pv", T.DoubleType()),
    T.StructField("v", T.DoubleType()),
    T.StructField("month", T.DateType()),
])

GOLD_DAILY = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("total_volume", T.DoubleType()),
    T.StructField("avg_vwap", T.DoubleType()),
    T.StructField("total_trades", T.LongType()),
    T.StructField("avg_price_change_pct", T.DoubleType()),
    T.StructField("snapshot_count", T.LongType()),
    T.StructField("pct_return", T.DoubleType()),
    T.StructField("processed_at", T.TimestampType()),
])

# Rows after each ticker rule, of one run or micro-batch.
QUALITY_LOG = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("batch", T.LongType()),
    T.StructField("n_input", T.LongType()),
    T.StructField("n_valid", T.LongType()),
    T.StructField("n_unique", T.LongType()),
    T.StructField("n_output", T.LongType()),
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("date", T.DateType()),
])

# Damaged documents: the file, a digest and the whole text, the day in the file's path.
QUARANTINE = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("digest", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("date", T.DateType()),
])

INGEST_LOG = T.StructType([
    T.StructField("cycle", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("elapsed_s", T.DoubleType()),
])
