import datetime as dt
import json

from pyspark.sql import functions as F

from marketlake.operators.bronze import positional_to_struct
from marketlake.operators.silver import extract_klines, extract_ticker
from marketlake.schemas import BRONZE
from tests.fixtures import candle, envelope, ms, ticker, utc

T0 = utc(2024, 3, 1, 10, 0, 0)


def bronze_df(spark, docs):
    rows = [(json.dumps(d, default=str),) for d in docs]
    raw = spark.createDataFrame(rows, "doc string")
    return raw.select(F.from_json("doc", BRONZE).alias("e")).select("e.*")


def test_null_ticker_gives_no_row(spark):
    df = bronze_df(spark, [envelope("Bitcoin", "BTC", T0, None)])
    assert extract_ticker(df).count() == 0


def test_bad_prices_dropped(spark):
    docs = [envelope("Bitcoin", "BTC", T0 + dt.timedelta(seconds=i), ticker(p))
            for i, p in enumerate(["abc", "0", "-1", "NaN", "5.5"])]
    rows = extract_ticker(bronze_df(spark, docs)).collect()
    assert [r.last_price for r in rows] == [5.5]
    r = rows[0]
    assert r.trade_count == 7 and r.hour == 10 and r.date == dt.date(2024, 3, 1)


def test_ticker_exact_duplicates_collapse(spark):
    docs = [envelope("Bitcoin", "BTC", T0, ticker("5"))] * 3
    assert extract_ticker(bronze_df(spark, docs)).count() == 1


def test_midnight_boundary_dates(spark):
    docs = [envelope("Bitcoin", "BTC", utc(2024, 3, 1, 23, 59, 59), ticker("5")),
            envelope("Bitcoin", "BTC", utc(2024, 3, 2, 0, 0, 0), ticker("6"))]
    dates = sorted(r.date for r in extract_ticker(bronze_df(spark, docs)).collect())
    assert dates == [dt.date(2024, 3, 1), dt.date(2024, 3, 2)]


def test_null_and_empty_klines(spark):
    docs = [envelope("Bitcoin", "BTC", T0, ticker("5"), k1m=None),
            envelope("Bitcoin", "BTC", T0 + dt.timedelta(minutes=1), ticker("5"), k1m=[])]
    assert extract_klines(bronze_df(spark, docs), "klines_1m").count() == 0


def test_latest_copy_of_candle_wins(spark):
    t = ms(utc(2024, 3, 1, 9, 0))
    docs = [envelope("Bitcoin", "BTC", T0, None, k1h=[candle(t, "10")]),
            envelope("Bitcoin", "BTC", T0 + dt.timedelta(minutes=5), None, k1h=[candle(t, "11")])]
    rows = extract_klines(bronze_df(spark, docs), "klines_1h").collect()
    assert [(r.close, r.interval) for r in rows] == [(11.0, "1h")]
    assert rows[0].open_time == dt.datetime(2024, 3, 1, 9, 0)


def test_latest_copy_zero_removes_key(spark):
    t = ms(utc(2024, 3, 1, 9, 0))
    docs = [envelope("Bitcoin", "BTC", T0, None, k1h=[candle(t, "10")]),
            envelope("Bitcoin", "BTC", T0 + dt.timedelta(minutes=5), None, k1h=[candle(t, "0")])]
    assert extract_klines(bronze_df(spark, docs), "klines_1h").count() == 0


def test_input_order_does_not_matter(spark):
    t = ms(utc(2024, 3, 1, 9, 0))
    docs = [envelope("Bitcoin", "BTC", T0 + dt.timedelta(minutes=i), None,
                     k1h=[candle(t, str(10 + i))]) for i in range(5)]
    a = extract_klines(bronze_df(spark, docs), "klines_1h").collect()
    b = extract_klines(bronze_df(spark, list(reversed(docs))), "klines_1h").collect()
    assert a == b and a[0].close == 14.0


def test_positional_candles_short_array(spark):
    raw = spark.createDataFrame(
        [([["1709280000000", "1", "2", "0.5", "1.5", "9", "1709283599999", "3", "4", "5", "6"]],)],
        "raw array<array<string>>")
    k = raw.select(F.explode(positional_to_struct("raw")).alias("k")).select("k.*").collect()[0]
    assert k.open_time == 1709280000000 and k.close == "1.5" and k.num_trades == 4
    assert k.ignore is None


def test_unknown_interval_rejected(spark):
    import pytest
    with pytest.raises(ValueError):
        extract_klines(bronze_df(spark, []), "klines_2m")
