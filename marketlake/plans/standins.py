"""Market-shaped inputs derived from the driver's ``events`` table.

The driver tables carry no market data, so the operators run on stand-ins
built from ``events`` by Spark (they grow with it):

* candles -- hourly OHLC bars per ``event_type`` (= symbol): open/close =
  first/last ``value`` by ``ts``, high/low, volume = sum(value), count;
* ticker snapshots -- one payload ticker per event: ``event_type`` = symbol,
  ``ts`` = ingestion time, ``value`` = price, ``props.k`` = volume,
  ``user_id`` = trade count -- wrapped in a Bronze envelope;
* dirty ticks -- the same prices rendered as text, with some made unparseable,
  NaN, negative, zero or NULL by a fixed rule on ``props.k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.bronze import build_envelope, ticker_struct
from marketlake.operators.clean import drop_invalid, keep_positive
from marketlake.operators.gold import ohlc_bars
from marketlake.operators.silver import extract_ticker
from marketlake.session import ensure_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def props_k(col: str = "props"):
    """``props`` is JSON text like ``{"k": 69}``; k as double (bad -> NULL)."""
    return F.from_json(F.col(col), "k string")["k"].try_cast("double")


def candles(ev: DataFrame) -> DataFrame:
    """Hourly bars per event type under the Silver candle rules; the bars are
    groups already, so there are no copies to remove."""
    bars = ohlc_bars(ev, key="event_type", time="ts", price="value", unit="hour", interval="1h")
    return keep_positive(drop_invalid(bars, ["symbol", "close"]), "close")


def ticker_envelopes(ev: DataFrame) -> DataFrame:
    # parse props once; the optimizer does not inline a JSON parse used 3 times
    ev = ev.select("event_type", "ts", "value", "user_id", props_k().alias("_k"))
    k = F.col("_k")
    v = F.col("value")
    ticker = ticker_struct(lastPrice=v, openPrice=v, highPrice=v, lowPrice=v, volume=k,
                           quoteVolume=k * v, priceChange=F.lit(0.0), priceChangePercent=k,
                           weightedAvgPrice=v, count=F.col("user_id"))
    return build_envelope(ev, name=F.upper("event_type"), symbol="event_type", ingested_at="ts",
                          ticker=ticker, source="events", asset_class="events")


def depth_envelopes(ev: DataFrame) -> DataFrame:
    """Envelopes with an order book (12 levels a side, in no order) and 6 trades per event, some of them malformed."""
    ev = ev.select("event_id", "event_type", "ts", "value", props_k().alias("_k"))
    k, v = F.col("_k"), F.col("value")
    text = lambda c: c.cast("string")
    places = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: i * 5 % 12)

    def side(sign: int, weight: int):
        return F.transform(places, lambda j: F.array(
            F.when((j == 0) & (k < 7), F.lit("abc")).otherwise(text(v + sign * j)), text(k + weight * j)))

    book = F.to_json(F.struct(side(-1, 1).alias("bids"), side(1, 2).alias("asks")))
    book = F.when(k < 3, F.lit('{"bids": [[')).when(k < 5, F.lit('{"bids": "none", "asks": [["1.5", "2"], 7, []]}')).otherwise(book)
    trades = F.to_json(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda j: F.struct(
        F.when((j != 2) | (k >= 10), F.col("event_id") * 10 + j).alias("id"), text(v + j).alias("price"), text(k).alias("qty"),
        (F.unix_millis(F.col("ts").cast("timestamp")) - j * 5 % 6 * 1000).alias("time"), (j % 2 == 0).alias("isBuyerMaker"))))
    return build_envelope(ev, name=F.upper("event_type"), symbol="event_type", ingested_at="ts", order_book=book,
                          recent_trades=F.when(k < 3, F.lit('[{"id": 1,')).otherwise(trades), source="events",
                          asset_class="events")


def tickers(ev: DataFrame) -> DataFrame:
    """Silver tickers from the event envelopes (the real extraction path)."""
    return extract_ticker(ticker_envelopes(ev))


def dirty_ticks(ev: DataFrame) -> DataFrame:
    """(event_id, symbol, ts, price_text) with fixed kinds of bad input."""
    k = props_k()
    text = (F.when(k < 3, F.lit("abc"))
             .when(k < 5, F.lit("NaN"))
             .when(k < 7, F.lit("-1"))
             .when(k < 8, F.lit("0"))
             .when(k < 9, F.lit(None).cast("string"))
             .otherwise(F.col("value").cast("string")))
    symbol = F.when(k == 99, F.lit(None).cast("string")).otherwise(F.col("event_type"))
    return ev.select("event_id", symbol.alias("symbol"), "ts", text.alias("price_text"))


def to_ntz(c):
    """TIMESTAMP -> TIMESTAMP_NTZ wall clock in the (UTC) session zone."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")
