"""Order books, recent trades, and gaps as intervals."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marketlake.operators.depth import order_book_levels, recent_trades
from marketlake.operators.quality import missing_intervals, missing_partitions
from marketlake.schemas import BRONZE
from tests.fixtures import envelope, ticker, utc


def frame(spark, parts):
    docs = []
    for i, part in enumerate(parts):
        doc = envelope("Bitcoin", f"S{i}", utc(2024, 3, 1, 1), ticker("1"))
        docs.append(({**doc, "order_book": None, "recent_trades": None}, part))
    rows = [(json.dumps(doc), *part) for doc, part in docs]
    raw = spark.createDataFrame(rows, "doc string, book string, trades string")
    return raw.select(F.from_json("doc", BRONZE).alias("e"), "book", "trades").select(
        "e.metadata", F.col("book").alias("order_book"), F.col("trades").alias("recent_trades"))


def test_order_book_levels(spark):
    book = {"bids": [["10", "1"], ["11.5", "2"], [9, 3], ["x", "1"], ["-1", "1"], ["8", None], ["11.5", "7"], 5, []], "asks": [["12", "4"]]}
    bad = ["", "{", "[]", "null", '{"bids": 1}', '{"bids": [[]], "asks": {}}', None]
    df = frame(spark, [(json.dumps(book), None)] + [(b, None) for b in bad])
    got = sorted(tuple(r) for r in order_book_levels(df, 3).select("symbol", "side", "level", "price", "quantity").collect())
    assert got == [("S0", "ask", 1, 12.0, 4.0), ("S0", "bid", 1, 11.5, 7.0), ("S0", "bid", 2, 11.5, 2.0), ("S0", "bid", 3, 10.0, 1.0)]


def test_recent_trades(spark):
    trades = [{"id": i, "price": str(i), "qty": "2", "time": 1_700_000_000_000 + i % 3, "isBuyerMaker": i % 2 == 0} for i in range(1, 7)]
    trades += [{"id": 99, "price": "1", "time": "soon"}, {"price": "1", "time": 1}, "x", {"id": 7, "price": "0", "time": 10 ** 15}]
    df = frame(spark, [(None, json.dumps(trades)), (None, "[{"), (None, None), (None, "{}")])
    got = [tuple(r) for r in recent_trades(df, 3).select("symbol", "trade_id", "price", "buyer_is_maker").collect()]
    assert sorted(got) == [("S0", 2, 2.0, True), ("S0", 4, 4.0, True), ("S0", 5, 5.0, False)]
    plan = recent_trades(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("kw", [{}, {"start": dt.datetime(2024, 1, 1, 5)}, {"end": dt.datetime(2024, 1, 9, 7)},
                                {"start": dt.datetime(2023, 12, 30), "end": dt.datetime(2024, 1, 2, 3)}])
def test_gaps_equal_the_expanded_grid(spark, tmp, kw):
    hours = {"A": [0, 1, 2, 5, 23, 24, 49, 50, 120], "B": [23, 24], "X": [200], None: [3]}
    rows = [(s, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h, minutes=m)) for s, hs in hours.items() for h in hs for m in (0, 30)]
    spark.createDataFrame([*rows, ("A", None)], "symbol string, at timestamp").write.parquet(tmp + "/t")
    df = spark.read.parquet(tmp + "/t")
    symbols = ["A", "B", "C"]
    want = {(r.symbol, r.slot) for r in missing_partitions(df, symbols, time="at", **kw).collect()}
    gaps = missing_intervals(df, symbols, time="at", **kw).collect()
    hour = dt.timedelta(hours=1)
    got = [(g.symbol, g.gap_from + i * hour) for g in gaps for i in range(g.n_slots)]
    assert len(got) == len(set(got)) and set(got) == want
    assert all(g.gap_from + (g.n_slots - 1) * hour == g.gap_to for g in gaps)
    assert not {(g.symbol, g.gap_to + hour) for g in gaps} & {(g.symbol, g.gap_from) for g in gaps}


def test_no_slots_no_gaps(spark):
    none = spark.createDataFrame([], "symbol string, at timestamp")
    assert missing_intervals(none, ["A"], time="at").count() == 0
    (gap,) = missing_intervals(none, ["A"], time="at", start=dt.datetime(2024, 1, 1), end=dt.datetime(2024, 1, 2)).collect()
    assert (gap.symbol, gap.n_slots) == ("A", 25)
