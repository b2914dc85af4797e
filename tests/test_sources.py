import datetime as dt
import os

from pyspark.sql import functions as F

from marketlake.sources import read_bronze, read_ticks, split_corrupt
from tests.fixtures import envelope, land, ticker, utc

SAMPLE_TICKS = ('{"symbol": "BTCUSDT", "price": "71450.54000000"}\n'
                '{"symbol": "BTCUSDT", "price": "71450.53000000"}\n'
                '{"symbol": "BTCUSDT", "price": "71440.30000000"}')


def test_bronze_layout_partitions_and_quarantine(spark, tmp):
    root = os.path.join(tmp, "bronze")
    good_paths = [land(root, envelope("Bitcoin", "BTCUSDT", utc(2024, 3, 1, h, 0, 5), ticker("5")))
                  for h in (9, 10)]
    bad = land(root, envelope("XRP", "XRPUSDT", utc(2024, 3, 2, 1, 0, 0), ticker("1")))
    with open(bad, "r+", encoding="utf-8") as fh:
        text = fh.read()
        fh.seek(0)
        fh.write(text[: len(text) // 2])
        fh.truncate()
    df = read_bronze(spark, root)
    good, quarantine = split_corrupt(df)
    g = good.select("path_name", "year", "month", "day", "path_hour", "metadata.symbol").collect()
    assert sorted((r.path_name, r.year, r.month, r.day, r.path_hour) for r in g) == [
        ("Bitcoin", 2024, 3, 1, 9), ("Bitcoin", 2024, 3, 1, 10)]
    q = quarantine.collect()
    assert len(q) == 1 and q[0]._file.endswith(os.path.basename(bad))
    assert len(good_paths) == 2


def test_bronze_date_selection(spark, tmp):
    root = os.path.join(tmp, "bronze")
    land(root, envelope("Bitcoin", "BTCUSDT", utc(2024, 3, 1, 9), ticker("5")))
    land(root, envelope("Bitcoin", "BTCUSDT", utc(2024, 3, 2, 9), ticker("6")))
    df = read_bronze(spark, root, date="2024/03/02")
    assert [r.day for r in df.select("day").collect()] == [2]
    df2 = read_bronze(spark, root, date=dt.date(2024, 3, 1))
    assert df2.count() == 1


def test_ticks_ndjson(spark, tmp):
    p = os.path.join(tmp, "crypto_data.json")
    with open(p, "w") as fh:
        fh.write(SAMPLE_TICKS)
    rows = read_ticks(spark, p).collect()
    assert [r.price for r in rows] == [71450.54, 71450.53, 71440.3]
    # multiline would silently keep only the first document
    assert spark.read.option("multiline", True).schema("symbol string, price string").json(p).count() == 1


def test_order_book_kept_as_json_text(spark, tmp):
    root = os.path.join(tmp, "bronze")
    land(root, envelope("Bitcoin", "BTCUSDT", utc(2024, 3, 1, 9), ticker("5")))
    row = read_bronze(spark, root).select(
        F.get_json_object("order_book", "$.bids[0][0]").alias("b")).collect()[0]
    assert row.b == "1.0"
