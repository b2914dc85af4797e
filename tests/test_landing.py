"""Landed files by folder, and the quarantine: nothing twice, nothing lost, no listing of the history."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from marketlake.paths import Paths
from marketlake.plans.pipeline import run_batch
from marketlake.plans.tickers import merge_tickers
from marketlake.schemas import SILVER_TICKERS
from marketlake.sinks import quarantine
from marketlake.sources import read_layer
from marketlake.sources.landing import Landing, drain
from marketlake.streaming import await_all, drain_landing, start_streams
from tests.fixtures import envelope, land, ticker, utc
from tests.test_pipeline import NOW, make_lake


def snap(paths, day, hour, minute=0, name="Bitcoin"):
    return land(paths.bronze, envelope(name, name[:3].upper(), utc(2024, 3, day, hour, minute), ticker(str(day * 100 + hour))))


def names(batch):
    return [os.path.basename(f) for f in batch.files]


def test_listings_do_not_grow_with_history(spark, tmp):
    paths = Paths(tmp + "/lake")
    listed = []
    landing = Landing(spark, paths.bronze, tmp + "/state")
    for day in range(1, 29):
        path = snap(paths, day, 9)
        batch = landing.plan()
        assert [f.removeprefix("file:") for f in batch.files] == [path]
        listed.append(landing.listed)
        landing.done(batch)
        assert landing.plan() is None
    assert max(listed[2:]) == min(listed[2:]) <= 10
    assert Landing(spark, paths.bronze, tmp + "/state").plan() is None       # restarted: nothing is new


def test_every_file_once_in_any_order_of_landing(spark, tmp):
    paths = Paths(tmp + "/lake")
    landing = Landing(spark, paths.bronze, tmp + "/state", max_files=3)
    seen, landed = [], []

    def take():
        while (batch := landing.plan()) is not None:
            assert len(batch.files) <= 3 and names(landing.plan()) == names(batch)   # not done: the same again
            seen.extend(names(batch))
            landing.done(batch)

    for wave in ([(1, 9, 1), (1, 9, 2), (1, 10, 0), (1, 10, 3), (2, 1, 0)], [(2, 1, 1), (1, 10, 7), (2, 1, 2)],
                 [(d, h, 0) for d in (3, 4) for h in (1, 2, 13)]):
        for day, hour, minute in wave:
            landed += [os.path.basename(snap(paths, day, hour, minute, n)) for n in ("Bitcoin", "XRP")]
        take()
    assert sorted(seen) == sorted(landed)
    late = snap(paths, 1, 9, 30)                                      # its folder is closed: for a dated run
    assert landing.plan() is None and os.path.exists(late)


def test_a_batch_that_died_is_repeated_with_its_files(spark, tmp):
    paths = Paths(tmp + "/lake")
    snap(paths, 1, 9)
    landing = Landing(spark, paths.bronze, tmp + "/state")

    def dies(df, _n):
        assert df.count() == 1
        raise KeyError

    with pytest.raises(KeyError):
        drain(landing, dies)
    snap(paths, 1, 9, 5)
    counts = []
    assert drain(Landing(spark, paths.bronze, tmp + "/state"), lambda df, n: counts.append((n, df.count()))) == 2
    assert counts == [(1, 1), (2, 1)]


def test_drained_landing_equals_a_full_batch(spark, tmp):
    paths = make_lake(tmp + "/lake")
    columns = ["symbol", "ingested_at", "last_price"]
    run_batch(spark, paths, intervals=(), now=NOW)
    want = read_layer(spark, paths.silver_table("tickers"), SILVER_TICKERS).select(columns).collect()
    other = make_lake(tmp + "/other")
    assert drain_landing(spark, other, intervals=(), max_files=5) == 3
    assert drain_landing(spark, other, intervals=()) == 0
    got = read_layer(spark, other.silver_table("tickers"), SILVER_TICKERS).select(columns).collect()
    assert sorted(got) == sorted(want)


def damage(path, cut):
    with open(path, encoding="utf-8") as f:
        text = f.read()
    with open(path, "w", encoding="utf-8") as f:
        f.write(text[:-cut])
    return text[-cut:]


def test_damaged_documents_lie_in_quarantine_once(spark, tmp):
    paths = make_lake(tmp + "/lake")
    end = damage(snap(paths, 5, 9), 4)
    for _ in range(2):
        run_batch(spark, paths, date="2024-03-05", intervals=(), strict=False, now=NOW)
    await_all(start_streams(spark, paths, intervals=()))             # another reader, its epoch 0
    held = quarantine.read(spark, paths).collect()
    assert [(os.path.basename(r.file), r.date) for r in held] == [("Bitcoin_20240305_090000_000000.json", dt.date(2024, 3, 5))]
    quarantine.replay(spark, paths, lambda t: F.concat(t, F.lit("x")), lambda good: pytest.fail("still damaged"))
    assert quarantine.read(spark, paths).count() == 1
    quarantine.replay(spark, paths, lambda t: F.concat(t, F.lit(end)), lambda good: merge_tickers(spark, good, paths, now=NOW))
    assert quarantine.read(spark, paths).count() == 0
    days = read_layer(spark, paths.silver_table("tickers"), SILVER_TICKERS).groupBy("date").count().collect()
    assert {r.date.day: r["count"] for r in days} == {1: 6, 2: 6, 5: 1}


def test_closed_days_are_compacted_once(spark, tmp, monkeypatch):
    from marketlake.schemas import COMPACT_BRONZE
    from marketlake.sinks import lake
    from marketlake.sources import read_bronze
    from marketlake.streaming import compact_landing
    paths = make_lake(tmp + "/lake")

    def files():
        return sorted(os.path.basename(r[0]) for r in read_bronze(spark, paths.bronze_compact, layout="compact").select("_file").collect())

    def folders():
        return {d: len(f) for d, f in lake.snapshot(spark, paths.root).tables["bronze_compact"].items()}

    def die(*_a, **_k):
        raise KeyError

    assert compact_landing(spark, paths, "2024-03-01", max_files=4) == []
    landed = files()
    assert len(landed) == len(set(landed)) == 12 and folders() == {"2024-03-01": 2, "2024-03-02": 2}
    with monkeypatch.context() as m:                                  # dies when all is staged
        m.setattr(lake, "commit", die)
        with pytest.raises(KeyError):
            compact_landing(spark, paths, "2024-03-02")
    assert files() == landed and folders()["2024-03-01"] == 2
    assert compact_landing(spark, paths, "2024-03-02") == ["2024-03-01"]
    assert files() == landed and folders() == {"2024-03-01": 1, "2024-03-02": 2}
    (only,) = lake.snapshot(spark, paths.root).tables["bronze_compact"]["2024-03-01"]
    assert len([f for f in os.listdir(f"{paths.root}/{only}") if f.endswith(".parquet")]) == 1
    version = lake.snapshot(spark, paths.root).version
    assert compact_landing(spark, paths, "2024-03-02") == [] and lake.snapshot(spark, paths.root).version == version
    one = read_bronze(spark, paths.bronze_compact, layout="compact", date="2024-03-01", assets=["XRP"])
    assert one.count() == 3 and one.columns == COMPACT_BRONZE.names


def test_quality_counts_are_kept_once_per_batch(spark, tmp):
    from marketlake.sinks.quality_log import log_counts, read_counts
    paths = make_lake(tmp + "/lake")
    await_all(start_streams(spark, paths, intervals=(), max_files_per_trigger=5))
    await_all(start_streams(spark, paths, intervals=()))              # nothing new
    run_batch(spark, paths, intervals=(), now=NOW)
    counts = {"n_input": 5, "n_valid": 5, "n_unique": 5, "n_output": 5}
    for _ in range(2):
        log_counts(spark, paths, "landing", 7, counts, NOW)
    kept = read_counts(spark, paths).groupBy(F.substring_index("source", " ", 1).alias("k")).agg(
        F.sum("n_input").alias("n"), F.count("batch").alias("batches")).collect()
    assert {r.k: (r.n, r.batches) for r in kept} == {"stream": (12, 3), "run": (12, 1), "landing": (5, 1)}
