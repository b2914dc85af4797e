import os

import pytest

from pyspark.sql import functions as F

from marketlake.operators import clean
from marketlake.operators.gold import build_gold_daily
from marketlake.operators.silver import extract_ticker, project_ticker
from marketlake.schemas import CANDLE_DAYS, SILVER_TICKERS
from marketlake.sources import read_bronze, read_layer
from marketlake.streaming import dedup_tickers, gold_daily_stream, read_candles, run_to_completion, stream_bronze
from tests.test_pipeline import make_lake


def test_stream_equals_batch(spark, tmp):
    paths = make_lake(os.path.join(tmp, "lake"))
    raw = stream_bronze(spark, paths.bronze, max_files_per_trigger=3)
    t = clean.drop_invalid(project_ticker(raw), ["symbol", "last_price"])
    # files landed within one clock tick may come in any order: wait for all of them
    t = clean.keep_positive(dedup_tickers(t, "3 days"), "last_price")
    run_to_completion(t, tmp + "/s/data", tmp + "/s/ck")
    streamed = spark.read.parquet(tmp + "/s/data")
    batch = extract_ticker(read_bronze(spark, paths.bronze))
    cols = ["symbol", "ingested_at", "last_price", "trade_count"]
    assert sorted(streamed.select(cols).collect()) == sorted(batch.select(cols).collect())


def test_stream_gold_closed_days_equal_batch(spark, tmp):
    paths = make_lake(os.path.join(tmp, "lake"))
    raw = stream_bronze(spark, paths.bronze)
    t = clean.drop_invalid(project_ticker(raw), ["symbol", "last_price"])
    g = gold_daily_stream(clean.keep_positive(t, "last_price"), watermark="1 hour")
    run_to_completion(g, tmp + "/g/data", tmp + "/g/ck")
    streamed = spark.read.parquet(tmp + "/g/data")
    # only 2024-03-01 is closed: the watermark (last event 03-02 21:00 - 1h) is before 03-03
    batch = build_gold_daily(extract_ticker(read_bronze(spark, paths.bronze)), with_processed_at=False)
    cols = ["symbol", "date", "open", "close", "high", "low", "snapshot_count", "total_trades"]
    assert sorted(streamed.select(cols).collect()) == sorted(
        batch.filter(F.col("date") == "2024-03-01").select(cols).collect())


def test_stream_restart_resumes(spark, tmp):
    paths = make_lake(os.path.join(tmp, "lake"))
    t = project_ticker(stream_bronze(spark, paths.bronze)).select("symbol", "ingested_at", "last_price")
    run_to_completion(t, tmp + "/r/data", tmp + "/r/ck")
    run_to_completion(t, tmp + "/r/data", tmp + "/r/ck")
    assert spark.read.parquet(tmp + "/r/data").count() == 12


def test_late_snapshot_dropped_after_watermark(spark, tmp):
    """STR-6: a snapshot older than the watermark when it arrives is not
    counted into an already-closed day."""
    import datetime as dt

    from tests.fixtures import envelope, land, ticker, utc
    root = os.path.join(tmp, "bronze")
    land(root, envelope("Bitcoin", "BTC", utc(2024, 3, 1, 10), ticker("10")))
    land(root, envelope("Bitcoin", "BTC", utc(2024, 3, 3, 10), ticker("30")))
    raw = stream_bronze(spark, root)
    t = clean.drop_invalid(project_ticker(raw), ["symbol", "last_price"])
    g = gold_daily_stream(t, watermark="1 hour")
    run_to_completion(g, tmp + "/g/data", tmp + "/g/ck")
    # late: a 2024-03-01 snapshot arrives after the watermark passed 03-03 09:00
    land(root, envelope("Bitcoin", "BTC", utc(2024, 3, 1, 12), ticker("99")))
    land(root, envelope("Bitcoin", "BTC", utc(2024, 3, 4, 10), ticker("40")))
    run_to_completion(g, tmp + "/g/data", tmp + "/g/ck")
    rows = {r.date: r for r in spark.read.parquet(tmp + "/g/data").collect()}
    assert rows[dt.date(2024, 3, 1)].snapshot_count == 1 and rows[dt.date(2024, 3, 1)].close == 10.0
    assert rows[dt.date(2024, 3, 3)].close == 30.0


@pytest.mark.parametrize("bucket_rows", [20, 16384])
def test_candle_upsert_replay_and_late_correction(spark, tmp, bucket_rows):
    import datetime as dt
    import json

    from marketlake.operators.indicators import INDICATORS, add_indicators
    from marketlake.operators.silver import extract_klines
    from marketlake.schemas import BRONZE
    from marketlake.streaming import upsert_candles
    from tests.fixtures import H, candle, envelope, ms, ticker, utc

    def docs_for(days, bump_day=None, late=0):
        out = []
        for d in days:
            at = utc(2024, 3, d, 23, 30) + dt.timedelta(minutes=late)
            ks = []
            for h in range(24):
                t0 = ms(utc(2024, 3, d, h))
                c = 100 + d + h * 0.5 + (7 if d == bump_day else 0)
                ks.append(candle(t0, str(c), volume=str(1 + h % 3)))
            out.append(envelope("Bitcoin", "BTC", at, ticker("1"), k1h=ks))
        return out

    def frame(docs):
        raw = spark.createDataFrame([(json.dumps(x),) for x in docs], "doc string")
        return raw.select(F.from_json("doc", BRONZE).alias("e")).select("e.*")

    path = tmp + "/klines_1h"
    kw = {"bucket_rows": bucket_rows}
    b1, b2 = frame(docs_for([1, 2, 3])), frame(docs_for([4, 5]))
    upsert_candles(spark, b1, path, **kw)
    upsert_candles(spark, b2, path, **kw)
    upsert_candles(spark, b2, path, **kw)  # replayed batch
    fix = frame(docs_for([2], bump_day=2, late=60))  # later copy of day 2 with new closes
    upsert_candles(spark, fix, path, **kw)

    allb = frame(docs_for([1, 2, 3, 4, 5]) + docs_for([2], bump_day=2, late=60))
    expect = add_indicators(extract_klines(allb, "klines_1h"), strategy="plain")
    got = read_candles(spark, path)
    cols = ["open_time", "close"] + list(INDICATORS)
    e = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in expect.select(cols).collect())
    g_ = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in got.select(cols).collect())
    assert len(g_) == 5 * 24 and e == g_
    assert sorted(r._i for r in got.select("_i").collect()) == list(range(120))


def test_start_streams_matches_batch(spark, tmp):
    from marketlake.operators.indicators import add_indicators
    from marketlake.operators.silver import extract_klines
    from marketlake.paths import Paths
    from marketlake.streaming import await_all, start_streams
    paths = make_lake(os.path.join(tmp, "lake"))
    await_all(start_streams(spark, paths, trigger=None, intervals=("klines_1h",)))
    batch_raw = read_bronze(spark, paths.bronze)
    t = read_layer(spark, paths.silver_table("tickers"), SILVER_TICKERS)
    assert t.count() == extract_ticker(batch_raw).count()
    k = read_candles(spark, paths.silver_table("klines_1h"))
    e = add_indicators(extract_klines(batch_raw, "klines_1h"), strategy="plain")
    cols = ["symbol", "open_time", "close", "sma_21", "rsi_14", "vwap"]
    rnd = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    assert rnd(k.select(cols).collect()) == rnd(e.select(cols).collect())
    assert isinstance(paths, Paths)


@pytest.mark.parametrize("bucket_rows", [20, 16384])
def test_candle_upsert_context_across_gap(spark, tmp, bucket_rows):
    import json

    from marketlake.operators.indicators import INDICATORS, add_indicators
    from marketlake.operators.silver import extract_klines
    from marketlake.schemas import BRONZE
    from marketlake.streaming import upsert_candles
    from tests.fixtures import candle, envelope, ms, ticker, utc

    def docs(days):
        return [envelope("Bitcoin", "BTC", utc(2024, 3, d, 23, 30), ticker("1"),
                         k1h=[candle(ms(utc(2024, 3, d, h)), str(50 + d + h * 0.25), volume=str(1 + h % 4))
                              for h in range(0, 24, 3)]) for d in days]

    def frame(ds):
        raw = spark.createDataFrame([(json.dumps(x),) for x in ds], "doc string")
        return raw.select(F.from_json("doc", BRONZE).alias("e")).select("e.*")

    path = tmp + "/klines_1h"
    kw = {"bucket_rows": bucket_rows}
    upsert_candles(spark, frame(docs([1, 2, 3])), path, **kw)
    upsert_candles(spark, frame(docs([20])), path, **kw)   # 17-day gap
    upsert_candles(spark, frame(docs([2])), path, **kw)    # replay inside history
    expect = add_indicators(extract_klines(frame(docs([1, 2, 3, 20])), "klines_1h"), strategy="plain")
    cols = ["open_time", "close"] + list(INDICATORS)
    rnd = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    got = read_candles(spark, path)
    assert rnd(got.select(cols).collect()) == rnd(expect.select(cols).collect())
    days = {str(r.date): r.n for r in read_layer(spark, path + "_days", CANDLE_DAYS).collect()}
    assert days == {f"2024-03-{d:02d}": 8 for d in (1, 2, 3, 20)}


def test_candle_upsert_empty_batch_is_noop(spark, tmp):
    import json

    from marketlake.schemas import BRONZE
    from marketlake.streaming import upsert_candles
    from tests.fixtures import candle, envelope, ms, ticker, utc

    def frame(docs):
        raw = spark.createDataFrame([(json.dumps(x),) for x in docs], "doc string")
        return raw.select(F.from_json("doc", BRONZE).alias("e")).select("e.*")

    path = tmp + "/klines_1h"
    empty = frame([envelope("Bitcoin", "BTC", utc(2024, 3, 1, 12), ticker("1"))])  # no candles
    upsert_candles(spark, empty, path)
    assert not os.path.exists(path)
    full = frame([envelope("Bitcoin", "BTC", utc(2024, 3, 1, 23), ticker("1"),
                           k1h=[candle(ms(utc(2024, 3, 1, h)), str(10 + h)) for h in range(24)])])
    upsert_candles(spark, full, path)
    before = sorted(read_candles(spark, path).select("open_time", "close", "vwap", "_i").collect())
    upsert_candles(spark, empty, path)
    assert sorted(read_candles(spark, path).select("open_time", "close", "vwap", "_i").collect()) == before


def test_candle_merge_after_empty_rebuild(spark, tmp):
    """A full rebuild from a batch without candles leaves a table with no
    data files; the next merge must start the series from scratch."""
    import json

    from marketlake.schemas import BRONZE
    from marketlake.streaming import upsert_candles
    from tests.fixtures import candle, envelope, ms, ticker, utc

    def frame(docs):
        raw = spark.createDataFrame([(json.dumps(x),) for x in docs], "doc string")
        return raw.select(F.from_json("doc", BRONZE).alias("e")).select("e.*")

    path = tmp + "/klines_5m"
    upsert_candles(spark, frame([envelope("Bitcoin", "BTC", utc(2024, 3, 1, 12), ticker("1"))]),
                   path, "klines_5m", replace=True)
    full = frame([envelope("Bitcoin", "BTC", utc(2024, 3, 1, 23), ticker("1"),
                           k5m=[candle(ms(utc(2024, 3, 1, h)), str(10 + h)) for h in range(6)])])
    upsert_candles(spark, full, path, "klines_5m")
    rows = sorted(read_candles(spark, path).select("_i", "close").collect())
    assert [(r._i, r.close) for r in rows] == [(h, 10.0 + h) for h in range(6)]
