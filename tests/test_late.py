"""STR-6: late snapshots wait aside, once, and are merged by request."""

import datetime as dt

import pytest

from marketlake.operators.gold import build_gold_daily
from marketlake.operators.silver import extract_ticker
from marketlake.paths import Paths
from marketlake.schemas import SILVER_TICKERS
from marketlake.sources import read_layer
from marketlake.streaming import stream_bronze
from marketlake.streaming.late import (
    closed_before, closed_days_query, late_counts, merge_open_days, read_late, repair_late)
from tests.fixtures import envelope, land, ticker, utc
from tests.test_tables import GOLD, TICKS, frame, rounded, tables

HOUR = dt.timedelta(hours=1)


def snap(day, hour, price, symbol="BTC"):
    return envelope(symbol.lower(), symbol, utc(2024, 3, day, hour), ticker(price))


WAVES = [[snap(1, 8, "100"), snap(2, 9, "110"), snap(3, 2, "120")],
         [snap(1, 9, "101"), snap(1, 7, "-1"), snap(2, 9, "110"), snap(3, 1, "119"), snap(4, 12, "130"), snap(1, 5, "bad")],
         [snap(3, 5, "125"), snap(2, 1, "105", "ETH"), snap(4, 11, "129")]]
ON_TIME = [*WAVES[0], WAVES[1][3], WAVES[1][4], WAVES[2][2]]


def expected(spark, docs):
    t = extract_ticker(frame(spark, docs))
    return rounded(t, TICKS), rounded(build_gold_daily(t), GOLD)


def feed(spark, paths, waves, twice=False):
    records = paths.root + "/watermarks"
    for number, docs in enumerate(waves):
        for _ in range(1 + twice):
            good = frame(spark, docs)
            merge_open_days(spark, good, paths, closed_before(spark, good, paths, records, number, HOUR), f"q/{number}")


@pytest.mark.parametrize("twice", [False, True])
def test_closed_days_stay_and_late_rows_wait_once(spark, tmp_path, twice):
    paths = Paths(str(tmp_path))
    feed(spark, paths, WAVES, twice)
    assert tables(spark, paths) == expected(spark, ON_TIME)
    assert rounded(late_counts(spark, paths), ["symbol", "date", "n_late"]) == [
        ("BTC", dt.date(2024, 3, 1), 2), ("BTC", dt.date(2024, 3, 2), 1), ("BTC", dt.date(2024, 3, 3), 1),
        ("ETH", dt.date(2024, 3, 2), 1)]
    assert {r.batch for r in read_late(spark, paths).select("batch").collect()} == {"q/1", "q/2"}


def test_repair_merges_the_days_asked_for(spark, tmp_path):
    paths = Paths(str(tmp_path))
    feed(spark, paths, WAVES)
    assert repair_late(spark, paths, ["2024-03-02", "2024-03-09"]) == ["2024-03-02"]
    assert tables(spark, paths) == expected(spark, [*ON_TIME, WAVES[2][1]])
    assert {r.date.day for r in read_late(spark, paths).select("date").collect()} == {1, 3}
    assert repair_late(spark, paths) == ["2024-03-01", "2024-03-03"] and repair_late(spark, paths) == []
    assert tables(spark, paths) == expected(spark, [d for wave in WAVES for d in wave])
    assert late_counts(spark, paths).count() == 0


def test_snapshots_without_a_time_are_never_late_and_a_new_checkpoint_knows_the_tables(spark, tmp_path):
    paths = Paths(str(tmp_path))
    feed(spark, paths, WAVES[:1])
    timeless = snap(1, 1, "99")
    timeless["metadata"]["ingested_at"] = "some day"
    good = frame(spark, [timeless, snap(2, 3, "107")])
    open_from = closed_before(spark, good, paths, str(tmp_path / "other-watermarks"), 0, HOUR)
    assert open_from == "2024-03-03"                 # Silver holds the 3rd, 2 o'clock
    merge_open_days(spark, good, paths, open_from, "other/0")
    assert rounded(late_counts(spark, paths), ["date", "n_late"]) == [(dt.date(2024, 3, 2), 1)]
    assert read_layer(spark, paths.silver_table("tickers"), SILVER_TICKERS).count() == 4
    empty = frame(spark, [timeless]).limit(0)
    assert closed_before(spark, empty, Paths(str(tmp_path / "none")), str(tmp_path / "w"), 0, HOUR) is None
    merge_open_days(spark, empty, paths, open_from, "other/1")


def test_the_query_takes_up_where_it_stopped(spark, tmp_path):
    paths = Paths(str(tmp_path / "lake"))
    for wave in WAVES:
        for doc in wave:
            land(paths.bronze, doc)
        closed_days_query(spark, stream_bronze(spark, paths.bronze), paths, str(tmp_path / "checkpoint")).awaitTermination()
    assert tables(spark, paths) == expected(spark, ON_TIME)
    repair_late(spark, paths)
    assert tables(spark, paths) == expected(spark, [d for wave in WAVES for d in wave])
