"""Stored tables: nothing is lost by dated, partial, repeated or interrupted runs."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators.gold import build_gold_daily
from marketlake.operators.indicators import INDICATORS, add_indicators
from marketlake.operators.quality import QualityError, ingest_totals, missing_partitions
from marketlake.operators.silver import extract_klines, extract_ticker
from marketlake.paths import Paths
from marketlake.plans.pipeline import run_batch
from marketlake.schemas import BRONZE, GOLD_DAILY, INGEST_LOG, SILVER_TICKERS
from marketlake.sinks import lake
from marketlake.sources import read_bronze, read_layer
from marketlake.streaming import await_all, read_candles, start_streams, upsert_candles
from tests.fixtures import candle, envelope, land, ms, ticker, utc
from tests.test_pipeline import NOW, make_lake


def frame(spark, docs):
    raw = spark.createDataFrame([(json.dumps(x),) for x in docs], "doc string")
    return raw.select(F.from_json("doc", BRONZE).alias("e")).select("e.*")


def rounded(df, cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(cols).collect())


TICKS = ["symbol", "name", "ingested_at", "last_price", "date"]
GOLD = ["symbol", "name", "date", "open", "high", "low", "close", "total_trades", "snapshot_count", "pct_return"]
CANDLES = ["symbol", "open_time", "close", *INDICATORS, "_i"]


def tables(spark, paths):
    return (rounded(read_layer(spark, paths.silver_table("tickers"), SILVER_TICKERS), TICKS),
            rounded(read_layer(spark, paths.gold_table("daily_summary"), GOLD_DAILY), GOLD))


def from_bronze(spark, paths):
    t = extract_ticker(read_bronze(spark, paths.bronze))
    return rounded(t, TICKS), rounded(build_gold_daily(t), GOLD)


def land_at(paths, doc, landed):
    """Land a document in the folder of another time than its own, as a slow upload does."""
    path = land(paths.bronze, doc)
    folder = os.path.join(paths.bronze, doc["metadata"]["name"], f"{landed:%Y/%m/%d/%H}")
    os.makedirs(folder, exist_ok=True)
    with open(path, encoding="utf-8") as src, open(os.path.join(folder, os.path.basename(path)), "w", encoding="utf-8") as out:
        out.write(src.read())
    os.remove(path)


def test_dated_runs_keep_snapshots_that_land_after_midnight(spark, tmp):
    paths = make_lake(os.path.join(tmp, "lake"))
    late = envelope("Bitcoin", "BTCUSDT", utc(2024, 3, 1, 23, 59, 58), ticker("777"))
    land_at(paths, late, utc(2024, 3, 2, 0, 0, 1))
    for day in ("2024-03-01", "2024-03-02", "2024-03-02"):
        run_batch(spark, paths, date=day, intervals=(), now=NOW)
    assert tables(spark, paths) == from_bronze(spark, paths)
    assert [r[-2] for r in tables(spark, paths)[1] if r[0] == "BTCUSDT" and r[2] == dt.date(2024, 3, 1)] == [4]


def test_asset_runs_keep_the_other_assets(spark, tmp):
    paths = make_lake(os.path.join(tmp, "lake"))
    run_batch(spark, paths, intervals=("klines_1h",), now=NOW)
    before = tables(spark, paths), rounded(read_candles(spark, paths.silver_table("klines_1h")), CANDLES)
    run_batch(spark, paths, assets=["Bitcoin"], intervals=("klines_1h",), now=NOW)
    after = tables(spark, paths), rounded(read_candles(spark, paths.silver_table("klines_1h")), CANDLES)
    assert after == before


def test_full_run_leaves_no_stale_partition_and_no_staging(spark, tmp):
    import shutil
    paths = make_lake(os.path.join(tmp, "lake"))
    run_batch(spark, paths, intervals=("klines_1h",), now=NOW)
    shutil.rmtree(os.path.join(paths.bronze, "XRP"))
    scratch = spark.conf.get("spark.checkpoint.dir")
    held = set(os.listdir(scratch))
    run_batch(spark, paths, intervals=("klines_1h",), now=NOW)
    assert set(os.listdir(scratch)) <= held
    assert tables(spark, paths) == from_bronze(spark, paths)
    assert {r[0] for r in rounded(read_candles(spark, paths.silver_table("klines_1h")), CANDLES)} == {"BTCUSDT"}


def test_stream_and_batch_take_turns(spark, tmp):
    paths = make_lake(os.path.join(tmp, "lake"))
    await_all(start_streams(spark, paths, intervals=("klines_1h",), max_files_per_trigger=5))
    assert tables(spark, paths) == from_bronze(spark, paths)          # the open day included
    land(paths.bronze, envelope("XRP", "XRPUSDT", utc(2024, 3, 3, 1), ticker("9")))
    run_batch(spark, paths, date="2024-03-03", intervals=(), now=NOW)
    assert tables(spark, paths) == from_bronze(spark, paths)
    await_all(start_streams(spark, paths, intervals=("klines_1h",)))
    run_batch(spark, paths, intervals=("klines_1h",), now=NOW)
    assert tables(spark, paths) == from_bronze(spark, paths)


def test_survivor_does_not_depend_on_arrival(spark, tmp):
    docs = [envelope("Bitcoin", "BTC", utc(2024, 3, 1, 10), ticker(p)) for p in ("5", "-1", "7")]
    expect = rounded(extract_ticker(frame(spark, docs)), TICKS)
    from marketlake.plans.tickers import merge_tickers
    for n, order in enumerate(([0, 1, 2], [1, 2, 0])):
        paths = Paths(os.path.join(tmp, f"lake{n}"))
        for i in order:
            merge_tickers(spark, frame(spark, [docs[i]]), paths, now=NOW)
        assert tables(spark, paths)[0] == expect


def test_symbol_stays_text(spark, tmp):
    paths = Paths(os.path.join(tmp, "lake"))
    land(paths.bronze, envelope("Agent", "007", utc(2024, 3, 1, 10), ticker("5")))
    run_batch(spark, paths, intervals=(), now=NOW)
    assert {r[0] for part in tables(spark, paths) for r in part} == {"007"}


def test_bronze_gate(spark, tmp):
    paths = make_lake(os.path.join(tmp, "lake"))
    with pytest.raises(QualityError):
        run_batch(spark, paths, date="2024-03-01", expected=["BTCUSDT", "ETHUSDT"], intervals=(), now=NOW)
    assert not os.path.exists(paths.silver_table("tickers"))
    reports = run_batch(spark, paths, date="2024-03-01", expected=["BTCUSDT", "ETHUSDT"], strict=False, intervals=(), now=NOW)
    assert [r.symbol for r in reports["bronze_missing"].collect()] == ["ETHUSDT"]


def test_compacted_bronze_takes_new_files_only_and_prunes(spark, tmp):
    from marketlake.streaming import compact_bronze
    paths = make_lake(os.path.join(tmp, "lake"))

    def compact():
        compact_bronze(spark, paths.bronze, paths.bronze_compact, tmp + "/ck").awaitTermination()

    compact()
    run_batch(spark, paths, layout="compact", intervals=(), now=NOW)
    assert tables(spark, paths) == from_bronze(spark, paths)
    land(paths.bronze, envelope("XRP", "XRPUSDT", utc(2024, 3, 3, 1), ticker("9")))
    path = land(paths.bronze, envelope("XRP", "XRPUSDT", utc(2024, 3, 3, 2), ticker("9")))
    with open(path, "r+", encoding="utf-8") as f:
        f.truncate(40)
    compact()
    one = read_bronze(spark, paths.bronze_compact, date="2024-03-03", layout="compact", assets=["XRP"])
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan or "PartitionFilters: [isnotnull(name" in plan
    run_batch(spark, paths, date="2024-03-03", assets=["XRP"], layout="compact", intervals=(), now=NOW)
    whole = read_bronze(spark, paths.bronze_compact, layout="compact")
    assert whole.count() == 14 and whole.filter("_corrupt_record IS NOT NULL").count() == 1
    assert len(tables(spark, paths)[0]) == 13


# --- candle table

def day_docs(day, closes, late=0):
    at = utc(2024, 3, day, 23, 30) + dt.timedelta(minutes=late)
    ks = [candle(ms(utc(2024, 3, day, h)), str(c), volume=str(1 + h % 3)) for h, c in closes.items()]
    return envelope("Bitcoin", "BTC", at, ticker("1"), k1h=ks)


def normal(day):
    return {h: 100 + day + h * 0.5 for h in range(24)}


def expected_candles(spark, docs):
    # the batch's latest copy by envelope time, then the price rule
    out = add_indicators(extract_klines(frame(spark, docs), "klines_1h"), strategy="plain")
    return rounded(out, [c for c in CANDLES if c != "_i"])


def stored_candles(spark, path):
    df = read_candles(spark, path)
    rows = rounded(df, CANDLES)
    assert sorted(r[-1] for r in rows) == list(range(len(rows)))
    return [r[:-1] for r in rows]


def test_removed_candles_go_and_stay_away(spark, tmp):
    path = tmp + "/klines_1h"
    docs = [day_docs(1, normal(1)), day_docs(2, {5: 100}), day_docs(3, normal(3))]
    upsert_candles(spark, frame(spark, docs), path, bucket_rows=20)
    fix = day_docs(2, {5: 0}, late=60)                                # the day's only candle is taken back
    upsert_candles(spark, frame(spark, [fix]), path, bucket_rows=20)
    assert stored_candles(spark, path) == expected_candles(spark, [*docs, fix])
    assert set(lake.snapshot(spark, tmp).tables["klines_1h"]) == {"2024-03-01", "2024-03-03"}
    upsert_candles(spark, frame(spark, [docs[1]]), path, bucket_rows=20)   # an older copy arrives late
    assert stored_candles(spark, path) == expected_candles(spark, [*docs, fix])
    back = day_docs(2, {5: 55, 6: 56}, late=120)
    upsert_candles(spark, frame(spark, [back]), path, bucket_rows=20)
    assert stored_candles(spark, path) == expected_candles(spark, [*docs, fix, back])


def test_late_fix_rewrites_its_day_and_the_look_back(spark, tmp):
    path = tmp + "/klines_1h"
    docs = [day_docs(d, normal(d)) for d in range(1, 9)] + [day_docs(10, {1: 7, 2: 8}), day_docs(11, normal(11)), day_docs(12, normal(12))]
    upsert_candles(spark, frame(spark, docs), path, bucket_rows=20)
    for fixed, changed in ((3, {3, 4}), (8, {8, 10, 11}), (12, {12})):
        before = lake.snapshot(spark, tmp).tables["klines_1h"]
        docs.append(day_docs(fixed, {h: v + 3 for h, v in normal(fixed).items()}, late=60 + fixed))
        upsert_candles(spark, frame(spark, docs[-1:]), path, bucket_rows=20)
        after = lake.snapshot(spark, tmp).tables["klines_1h"]
        assert {int(d[-2:]) for d in after if before[d] != after[d]} == changed
        assert stored_candles(spark, path) == expected_candles(spark, docs)


def test_candles_of_other_symbols_are_carried_over(spark, tmp):
    path = tmp + "/klines_1h"
    other = [envelope("XRP", "XRP", utc(2024, 3, d, 23), ticker("1"),
                      k1h=[candle(ms(utc(2024, 3, d, h)), str(d + h / 8)) for h in range(0, 24, 2)]) for d in (1, 2, 3, 4)]
    docs = [*other, *[day_docs(d, normal(d)) for d in (1, 2, 3)]]
    upsert_candles(spark, frame(spark, docs), path, bucket_rows=20)
    docs.append(day_docs(1, {h: 50 + h for h in range(24)}, late=60))
    upsert_candles(spark, frame(spark, docs[-1:]), path, bucket_rows=20)
    assert rounded(read_candles(spark, path), CANDLES[:-1]) == expected_candles(spark, docs)


class Died(Exception):
    pass


def die(*_a, **_k):
    raise Died


@pytest.mark.parametrize("step", ["stage", "put_if_absent", "_state"])
def test_run_that_died_changes_nothing(spark, tmp, monkeypatch, step):
    """Die at a step of a commit, then repeat the batch together with the next one."""
    docs = [day_docs(1, normal(1)), day_docs(2, {5: 100}), day_docs(3, normal(3))]
    fix, more = day_docs(2, {5: 0}, late=60), day_docs(4, normal(4))
    path = tmp + "/klines_1h"
    monkeypatch.setattr(lake, "CHECKPOINT_EVERY", 2)
    upsert_candles(spark, frame(spark, docs), path, bucket_rows=20)
    with monkeypatch.context() as m:
        m.setattr(lake, step, die)
        with pytest.raises(Died):
            upsert_candles(spark, frame(spark, [fix]), path, bucket_rows=20)
    if step != "_state":                                              # that one dies when the commit is done
        assert stored_candles(spark, path) == expected_candles(spark, docs)
    upsert_candles(spark, frame(spark, [fix, more]), path, bucket_rows=20)
    assert stored_candles(spark, path) == expected_candles(spark, [*docs, fix, more])


def test_silver_and_gold_change_together(spark, tmp):
    """A reader sees both tables before or both after a commit, whenever it opens the lake."""
    from marketlake.plans.tickers import merge_tickers
    paths = Paths(os.path.join(tmp, "lake"))
    docs = [envelope("Bitcoin", "BTC", utc(2024, 3, 1, h), ticker(str(h))) for h in (10, 11)]
    merge_tickers(spark, frame(spark, docs[:1]), paths, now=NOW)
    seen = []
    merge_tickers(spark, frame(spark, docs[1:]), paths, now=NOW, on_staged=lambda _c: seen.append(tables(spark, paths)))
    assert [len(seen[0][0]), seen[0][1][0][-2]] == [1, 1]
    silver, gold = tables(spark, paths)
    assert [len(silver), gold[0][-2]] == [2, 2]
    with pytest.raises(Died):
        merge_tickers(spark, frame(spark, [envelope("Bitcoin", "BTC", utc(2024, 3, 1, 12), ticker("9"))]), paths, on_staged=die)
    assert tables(spark, paths) == (silver, gold)


@pytest.mark.parametrize("days, versions", [((1, 1), 3), ((1, 2), 2)])
def test_two_writers(spark, tmp, days, versions):
    """On the same day the slower writer stages anew; on other days its change stands."""
    from marketlake.plans.tickers import merge_tickers
    paths = Paths(os.path.join(tmp, "lake"))
    a, b = (envelope("Bitcoin", "BTC", utc(2024, 3, d, 10 + i), ticker(str(5 + i))) for i, d in enumerate(days))
    staged = []

    def meanwhile(change):
        staged.append(change)
        if len(staged) == 1:
            merge_tickers(spark, frame(spark, [b]), paths, now=NOW)

    merge_tickers(spark, frame(spark, [a]), paths, now=NOW, on_staged=meanwhile)
    assert len(staged) == versions - 1
    t = extract_ticker(frame(spark, [a, b]))
    assert tables(spark, paths) == (rounded(t, TICKS), rounded(build_gold_daily(t), GOLD))
    assert lake.snapshot(spark, paths.root).version == 2


def test_one_record_per_version(spark, tmp):
    """Of writers that put the same version at once exactly one succeeds."""
    from concurrent.futures import ThreadPoolExecutor
    os.makedirs(tmp + "/_log")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: lake.put_if_absent(spark, tmp + "/_log/1.json", f"writer {i}" * 1000), range(24)))
    assert sum(won) == 1
    with open(tmp + "/_log/1.json") as f:
        assert f.read() == f"writer {won.index(True)}" * 1000
    assert os.listdir(tmp + "/_log").count("1.json") == 1 and not [x for x in os.listdir(tmp + "/_log") if "draft-" in x and ".crc" not in x]


def test_versions_states_and_vacuum(spark, tmp, monkeypatch):
    monkeypatch.setattr(lake, "CHECKPOINT_EVERY", 3)
    rows = spark.createDataFrame([(dt.date(2024, 3, 1), "A", 1.0), (None, "B", 2.0)], "date date, symbol string, x double")

    def put(k):
        def staged(_at):
            found = lake.stage(rows.withColumn("x", rows.x * k), tmp, "t", ("symbol",))
            return lake.Change({"t": {d: f for (d,), f in found.items()}})
        return lake.update(spark, tmp, staged)

    def xs(at):
        return sorted(r.x for r in lake.read(spark, at, "t", rows.schema).collect())

    for k in range(1, 9):
        assert put(k).version == k
    assert [xs(lake.snapshot(spark, tmp, v)) for v in (1, 3, 5, 8)] == [[v, 2 * v] for v in (1, 3, 5, 8)]
    with pytest.raises(ValueError):
        lake.snapshot(spark, tmp, 9)
    read = []
    real = lake._read_text
    monkeypatch.setattr(lake, "_read_text", lambda s, p: read.append(p) or real(s, p))
    assert xs(lake.snapshot(spark, tmp)) == [8, 16]
    assert len(read) <= 6                                             # a hint, a state, and the records behind it
    orphan = lake.stage(rows, tmp, "t")                               # what a running writer has staged
    assert len(lake.vacuum(spark, tmp, keep_versions=2)) == 12
    assert xs(lake.snapshot(spark, tmp, 7)) == [7, 14] and lake.vacuum(spark, tmp, keep_versions=2) == []
    put(9)
    assert len(lake.vacuum(spark, tmp, keep_versions=2)) == 2
    assert all(os.path.exists(f"{tmp}/{f}") for f in orphan.values())
    assert lake.read(spark, lake.snapshot(spark, tmp), "t", rows.schema, days=[lake.NULL_DAY]).count() == 1


# --- checks

def test_missing_partitions_reads_its_window_once(spark, tmp):
    rows = [("A", dt.datetime(2024, 1, 1, h)) for h in range(24) if h != 5] + [("B", dt.datetime(2024, 1, 2))]
    spark.createDataFrame(rows, "symbol string, at timestamp").write.parquet(tmp + "/t")
    df = spark.read.parquet(tmp + "/t")
    got = missing_partitions(df, ["A"], time="at", start=dt.datetime(2024, 1, 1, 4), end=dt.datetime(2024, 1, 1, 6))
    assert [(r.symbol, r.slot.hour) for r in got.collect()] == [("A", 5)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") - plan.count("== Initial Plan ==") * plan.count("FileScan") // 2 == 1
    assert "GreaterThanOrEqual(at" in plan and "LessThan(at" in plan
    days = missing_partitions(df, ["A", "B"], time="at", unit="day")
    assert sorted((r.symbol, r.slot.day) for r in days.collect()) == [("A", 2), ("B", 1)]


def test_ingest_totals_takes_its_own_schema(spark):
    log = spark.createDataFrame([(i, "x", i % 3 > 0, 1.0) for i in range(9000)], INGEST_LOG)
    last = ingest_totals(log).orderBy(F.desc("cycle")).first()
    assert (last.cum_ok, last.cum_fail) == (6000, 3000)


def test_scratch_needs_a_shared_folder_off_local():
    from types import SimpleNamespace

    from marketlake.session import checkpoint_root
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(ValueError):
        checkpoint_root(spark)


