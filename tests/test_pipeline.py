import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators.quality import QualityError, table_presence
from marketlake.paths import Paths
from marketlake.plans.pipeline import run_batch
from marketlake.schemas import GOLD_DAILY, SILVER_TICKERS
from marketlake.sources import read_layer
from marketlake.streaming import read_candles
from tests.fixtures import H, candle, envelope, land, ms, ticker, utc

NOW = dt.datetime(2024, 3, 5, 0, 0)


def make_lake(root):
    paths = Paths(root)
    for day in (1, 2):
        for i, h in enumerate((9, 15, 21)):
            at = utc(2024, 3, day, h, 0, 0)
            k = [candle(ms(at) - (j + 1) * H, str(100 + day * 10 + h - j)) for j in range(3)]
            for name, sym, px in (("Bitcoin", "BTCUSDT", 100), ("XRP", "XRPUSDT", 1)):
                land(paths.bronze, envelope(name, sym, at,
                                            ticker(str(px + day + i), open_=str(px + day)),
                                            k1m=k, k5m=k, k1h=k))
    return paths


def gold_rows(spark, paths):
    g = read_layer(spark, paths.gold_table("daily_summary"), GOLD_DAILY).drop("processed_at")
    return sorted(tuple(r) for r in g.select(sorted(g.columns)).collect())


def test_run_batch_end_to_end_and_idempotent(spark, tmp):
    paths = make_lake(os.path.join(tmp, "lake"))
    reports = run_batch(spark, paths, now=NOW)
    assert all(r.present for r in reports["presence"].collect())
    rules = reports["ticker_rules"].collect()[0]
    assert (rules.n_input, rules.n_valid, rules.n_unique, rules.n_output) == (12, 12, 12, 12)
    t = read_layer(spark, paths.silver_table("tickers"), SILVER_TICKERS)
    assert t.count() == 12
    k = read_candles(spark, paths.silver_table("klines_1h"))
    # 2 symbols x 2 days x 3 polls x 3 candles, each candle fetched once
    assert k.count() == 36
    assert set(k.columns) >= {"sma_7", "bb_std", "rsi_14", "vwap"}
    g = read_layer(spark, paths.gold_table("daily_summary"), GOLD_DAILY)
    btc = g.filter((F.col("symbol") == "BTCUSDT") & (F.col("date") == dt.date(2024, 3, 1))).collect()[0]
    assert (btc.open, btc.close, btc.snapshot_count) == (101.0, 103.0, 3)
    assert abs(btc.pct_return - (103 - 101) / 101 * 100) < 1e-12
    first = gold_rows(spark, paths)
    run_batch(spark, paths, now=NOW)
    assert gold_rows(spark, paths) == first
    # a full run rebuilds the candle tables: no row is kept twice
    assert read_candles(spark, paths.silver_table("klines_1h")).count() == 36


def test_run_batch_single_day_keeps_other_days(spark, tmp):
    paths = make_lake(os.path.join(tmp, "lake"))
    run_batch(spark, paths, now=NOW)
    before = gold_rows(spark, paths)
    run_batch(spark, paths, date="2024-03-02", now=NOW)
    assert gold_rows(spark, paths) == before


def test_strict_presence_missing_layer(spark, tmp):
    paths = make_lake(os.path.join(tmp, "lake"))
    run_batch(spark, paths, intervals=("klines_1m",), now=NOW)
    with pytest.raises(QualityError):
        table_presence(spark, {"klines_1h": paths.silver_table("klines_1h")}, strict=True)
    report = table_presence(spark, {"klines_1h": paths.silver_table("klines_1h")}).collect()
    assert [(r.table, r.present) for r in report] == [("klines_1h", False)]


def test_run_batch_single_day_merges_candles(spark, tmp):
    """A dated run merges its day into the candle tables: history before it
    stays, and every row equals indicators over the whole Bronze."""
    from marketlake.operators.indicators import add_indicators
    from marketlake.operators.silver import extract_klines
    from marketlake.sources import read_bronze
    paths = make_lake(os.path.join(tmp, "lake"))
    cols = ["symbol", "open_time", "close", "sma_21", "bb_std", "rsi_14", "vwap"]

    def rows(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                      for r in df.select(cols).collect())

    run_batch(spark, paths, intervals=("klines_1h",), now=NOW)
    before = rows(read_candles(spark, paths.silver_table("klines_1h")))
    run_batch(spark, paths, date="2024-03-02", intervals=("klines_1h",), now=NOW)
    after = read_candles(spark, paths.silver_table("klines_1h"))
    assert rows(after) == before
    expect = add_indicators(extract_klines(read_bronze(spark, paths.bronze), "klines_1h"))
    assert rows(after) == rows(expect)
    assert sorted(r._i for r in after.filter(F.col("symbol") == "BTCUSDT").collect()) == list(range(18))


def test_run_batch_without_tickers_reports_empty_layers(spark, tmp):
    """Every ticker fetch failed (ticker null): the run completes, the
    ticker and Gold layers are reported empty, and the candles are built."""
    paths = Paths(os.path.join(tmp, "lake"))
    for i, h in enumerate((9, 15)):
        at = utc(2024, 3, 1, h, 0, 0)
        land(paths.bronze, envelope("Bitcoin", "BTCUSDT", at, None,
                                    k1h=[candle(ms(at) - (j + 1) * H, str(100 + h - j)) for j in range(3)]))
    reports = run_batch(spark, paths, strict=False, intervals=("klines_1h",), now=NOW)
    present = {r.table: r.present for r in reports["presence"].collect()}
    assert present == {"tickers": False, "klines_1h": True, "daily_summary": False}
    assert read_candles(spark, paths.silver_table("klines_1h")).count() == 6
    rules = reports["ticker_rules"].collect()[0]
    assert (rules.n_input, rules.n_valid, rules.n_unique, rules.n_output) == (2, 0, 0, 0)
