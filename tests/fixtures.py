"""Small Bronze fixtures written the way the ingester lands them: one
pretty-printed JSON document per file under {name}/YYYY/MM/DD/HH/."""

from __future__ import annotations

import datetime as dt
import json
import os

H = 3_600_000  # one hour in ms


def candle(open_ms: int, close: str, volume: str = "1.0", high: str | None = None,
           low: str | None = None, open_: str | None = None, trades: int = 5) -> dict:
    return {"open_time": open_ms, "open": open_ or close, "high": high or close, "low": low or close,
            "close": close, "volume": volume, "close_time": open_ms + H - 1,
            "quote_asset_volume": "0", "num_trades": trades, "taker_buy_base_vol": "0",
            "taker_buy_quote_vol": "0", "ignore": "0"}


def ticker(last: str, open_: str | None = None, high: str | None = None, low: str | None = None,
           volume: str = "10", vwap: str | None = None, pct: str = "1.5", count: int = 7) -> dict:
    return {"lastPrice": last, "openPrice": open_ or last, "highPrice": high or last,
            "lowPrice": low or last, "volume": volume, "quoteVolume": "0", "priceChange": "0",
            "priceChangePercent": pct, "weightedAvgPrice": vwap or last, "count": count}


def envelope(name: str, symbol: str, at: dt.datetime, tick: dict | None = None,
             k1m=None, k5m=None, k1h=None) -> dict:
    return {
        "metadata": {"name": name, "symbol": symbol, "source": "exchange", "asset_class": "crypto",
                     "ingested_at": at.isoformat(), "pipeline_ver": "3.0.0"},
        "ticker": tick,
        "order_book": {"bids": [["1.0", "2.0"]], "asks": [["1.1", "3.0"]]},
        "recent_trades": [{"id": 1, "price": "1.0"}],
        "klines_1m": k1m, "klines_5m": k5m, "klines_1h": k1h,
    }


def land(root: str, doc: dict) -> str:
    at = dt.datetime.fromisoformat(doc["metadata"]["ingested_at"])
    name = doc["metadata"]["name"]
    folder = os.path.join(root, name, f"{at:%Y}", f"{at:%m}", f"{at:%d}", f"{at:%H}")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{name}_{at:%Y%m%d_%H%M%S_%f}.json")
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(doc, fh, indent=2)
    return path


def utc(*a) -> dt.datetime:
    return dt.datetime(*a, tzinfo=dt.timezone.utc)


def ms(t: dt.datetime) -> int:
    return int(t.timestamp() * 1000)
