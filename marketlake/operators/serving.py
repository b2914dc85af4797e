"""Dashboard / warehouse views (QRY-1..6) over Silver and Gold.

Every view takes ``symbols`` (QRY-6 slicer); ``None`` means all symbols.  On a
table partitioned by ``symbol`` the slicer prunes partitions at the scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.clean import select_symbols


def kpi_latest(tickers: DataFrame, symbols: Iterable[str] | None = None,
               time: str = "ingested_at", price: str = "last_price",
               volume: str = "volume") -> DataFrame:
    """QRY-1: latest price per symbol (and when), plus the symbol's summed volume."""
    t = F.col(time)
    return select_symbols(tickers, symbols).groupBy("symbol").agg(
        F.max_by(price, t).alias("latest_price"),
        F.max(t).alias("latest_at"),
        F.sum(volume).alias("total_volume"),
        F.count(F.lit(1)).alias("snapshots"),
    )


def price_trend(tickers: DataFrame, symbols: Iterable[str] | None = None,
                time: str = "ingested_at", price: str = "last_price") -> DataFrame:
    """QRY-2: (symbol, time, price) in time order (a range-partitioned sort)."""
    return (select_symbols(tickers, symbols)
            .select("symbol", F.col(time).alias("time"), F.col(price).alias("price"))
            .orderBy("symbol", "time"))


def daily_return(gold: DataFrame, symbols: Iterable[str] | None = None) -> DataFrame:
    """QRY-3: daily return % per symbol and date."""
    return select_symbols(gold, symbols).select("symbol", "date", "pct_return")


def volume_by_symbol(gold: DataFrame, symbols: Iterable[str] | None = None) -> DataFrame:
    """QRY-4: summed daily volume and trades per symbol."""
    return select_symbols(gold, symbols).groupBy("symbol").agg(
        F.sum("total_volume").alias("volume"),
        F.sum("total_trades").alias("trades"),
        F.count(F.lit(1)).alias("days"),
    )


def high_low_range(gold: DataFrame, symbols: Iterable[str] | None = None) -> DataFrame:
    """QRY-5: high, low and their spread per symbol and date."""
    return select_symbols(gold, symbols).select(
        "symbol", "date", "high", "low", (F.col("high") - F.col("low")).alias("range"))
