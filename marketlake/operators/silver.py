"""Bronze -> Silver: tickers and candles (PRJ-1..9, FLT-1..4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.scalar import epoch_ms_to_ts, interval_label, parse_double, parse_ts
from marketlake.operators.clean import dedup_latest, drop_invalid, keep_positive

# Payload ticker field -> Silver column.
TICKER_COLUMNS = (
    ("lastPrice", "last_price"),
    ("openPrice", "open_price"),
    ("highPrice", "high_price"),
    ("lowPrice", "low_price"),
    ("volume", "volume"),
    ("quoteVolume", "quote_volume"),
    ("priceChange", "price_change"),
    ("priceChangePercent", "price_change_pct"),
    ("weightedAvgPrice", "vwap"),
)

TICKER_VALUE_COLUMNS = tuple(dst for _, dst in TICKER_COLUMNS) + ("trade_count",)
CANDLE_VALUE_COLUMNS = ("open", "high", "low", "close", "volume", "num_trades")


def project_ticker(df: DataFrame) -> DataFrame:
    """Flatten ``metadata`` + ``ticker`` into typed columns, one row per document.

    A document whose ticker is NULL yields a row with NULL prices, which the
    cleaning rules then drop.
    """
    ts = parse_ts(F.col("metadata.ingested_at"))
    return df.select(
        F.col("metadata.symbol").alias("symbol"),
        F.col("metadata.name").alias("name"),
        F.col("metadata.asset_class").alias("asset_class"),
        ts.alias("ingested_at"),
        *[parse_double(F.col(f"ticker.{src}")).alias(dst) for src, dst in TICKER_COLUMNS],
        F.col("ticker.count").alias("trade_count"),
        F.to_date(ts).alias("date"),
        F.hour(ts).alias("hour"),
    )


def clean_tickers(df: DataFrame) -> DataFrame:
    """FLT-1 (symbol, last_price) -> FLT-3 dedup on (symbol, ingested_at) -> FLT-2.

    Exact duplicates of (symbol, ingested_at) are the same snapshot landed
    twice; the survivor is fixed by ordering on the remaining columns.
    """
    df = drop_invalid(df, ["symbol", "last_price"])
    df = dedup_latest(df, ["symbol", "ingested_at"], None,
                      tiebreak=["name", "asset_class", *TICKER_VALUE_COLUMNS])
    return keep_positive(df, "last_price")


def extract_ticker(df: DataFrame) -> DataFrame:
    """Silver ``tickers`` from Bronze envelopes."""
    return clean_tickers(project_ticker(df))


def project_klines(df: DataFrame, array_name: str = "klines_1m") -> DataFrame:
    """Explode one candle array into typed rows (no row for a NULL/empty array)."""
    label = interval_label(array_name)
    exploded = df.select(
        F.col("metadata.symbol").alias("symbol"),
        parse_ts(F.col("metadata.ingested_at")).alias("ingested_at"),
        F.explode(F.col(array_name)).alias("k"),
    )
    return exploded.select(
        "symbol", "ingested_at",
        parse_double("k.open").alias("open"),
        parse_double("k.high").alias("high"),
        parse_double("k.low").alias("low"),
        parse_double("k.close").alias("close"),
        parse_double("k.volume").alias("volume"),
        F.col("k.num_trades").alias("num_trades"),
        epoch_ms_to_ts("k.open_time").alias("open_time"),
        label.alias("interval"),
    )


def clean_candles(df: DataFrame, keys=("symbol", "interval", "open_time"),
                  latest: str = "ingested_at", price: str = "close") -> DataFrame:
    """FLT-1 (symbol, close) -> FLT-4 latest snapshot wins -> FLT-2.

    The same candle is fetched on many polls, first while still forming and
    later final; the copy with the latest ``ingested_at`` is kept, and only
    then is the price rule applied (a latest copy with close 0 removes the key).
    """
    df = drop_invalid(df, [keys[0], price])
    tiebreak = [c for c in CANDLE_VALUE_COLUMNS if c in df.columns]
    df = dedup_latest(df, list(keys), latest if latest in df.columns else None, tiebreak=tiebreak)
    return keep_positive(df, price)


def extract_klines(df: DataFrame, array_name: str = "klines_1m") -> DataFrame:
    """Silver candles of one interval from Bronze envelopes."""
    return clean_candles(project_klines(df, array_name))
