import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlake.operators import gold, quality, serving
from marketlake.plans import standins as si
from tests.conftest import SF_SMALL

TICK_SCHEMA = ("symbol string, name string, ingested_at timestamp, open_price double, "
               "high_price double, low_price double, last_price double, volume double, vwap double, "
               "trade_count long, price_change_pct double, date date")


def ticks(spark, rows):
    full = [(s, s.upper(), t, o, h, lo, c, 1.0, c, 1, 0.5, t.date() if t else None)
            for s, t, o, h, lo, c in rows]
    return spark.createDataFrame(full, TICK_SCHEMA)


def test_gold_open_close_by_time_any_order(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [("A", t + dt.timedelta(hours=i), 10.0 + i, 20.0, 5.0, 11.0 + i) for i in range(4)]
    for order in (rows, list(reversed(rows))):
        g = gold.build_gold_daily(ticks(spark, order), with_processed_at=False).collect()[0]
        assert (g.open, g.close, g.snapshot_count) == (10.0, 14.0, 4)
        assert abs(g.pct_return - 40.0) < 1e-12


def test_gold_open_zero_return_null(spark):
    t = dt.datetime(2024, 1, 1, 10)
    g = gold.build_gold_daily(ticks(spark, [("A", t, 0.0, 1.0, 0.0, 1.0)]), with_processed_at=False)
    assert g.collect()[0].pct_return is None


def test_gold_fixed_processed_at(spark):
    t = dt.datetime(2024, 1, 1, 10)
    now = dt.datetime(2024, 1, 2, 0, 0)
    g = gold.build_gold_daily(ticks(spark, [("A", t, 1.0, 1.0, 1.0, 1.0)]), now=now).collect()[0]
    assert g.processed_at == now


def test_missing_partitions_brute_force(spark):
    ev = si.events(spark, SF_SMALL)
    got = quality.missing_partitions(ev, ["click", "view", "nope"], time="ts", symbol_col="event_type")
    pdf = ev.select("event_type", "ts").toPandas()
    pdf["slot"] = pdf.ts.dt.floor("h")
    seen = set(zip(pdf.event_type, pdf.slot))
    hours = pd.date_range(pdf.slot.min(), pdf.slot.max(), freq="h")
    expect = {(s, h.to_pydatetime()) for s in ["click", "view", "nope"] for h in hours
              if (s, h) not in seen}
    assert {(r.symbol, r.slot) for r in got.collect()} == expect


def test_rule_counts(spark):
    rows = [("A", dt.datetime(2024, 1, 1, 1), 1.0), ("A", dt.datetime(2024, 1, 1, 1), 2.0),
            (None, dt.datetime(2024, 1, 1, 1), 1.0), ("B", dt.datetime(2024, 1, 1, 2), float("nan")),
            ("C", dt.datetime(2024, 1, 1, 3), 0.0), ("D", dt.datetime(2024, 1, 1, 3), None)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, price double")
    r = quality.rule_counts(df, ["symbol", "ts"], "price").collect()[0]
    assert (r.n_input, r.n_invalid, r.n_duplicate, r.n_nonpositive, r.n_output) == (6, 3, 1, 1, 1)


def test_ingest_totals_and_slow(spark):
    log = spark.createDataFrame(
        [(1, "Bitcoin", True, 1.0), (1, "XRP", False, 9.0), (2, "Bitcoin", True, 2.0),
         (2, "XRP", True, 6.0)], "cycle long, name string, ok boolean, elapsed_s double")
    t = quality.ingest_totals(log, granule=1).orderBy("cycle").collect()
    assert [(r.passed, r.total, r.cum_ok, r.cum_fail) for r in t] == [(1, 2, 1, 1), (2, 2, 3, 1)]
    assert [r.success_pct for r in t] == [50.0, 75.0]
    slow = quality.slow_cycles(log, 5.0).filter("slow").count()
    assert slow == 2


def test_serving_views(spark):
    t = dt.datetime(2024, 1, 1, 10)
    df = ticks(spark, [("A", t, 1.0, 2.0, 0.5, 1.5), ("A", t + dt.timedelta(hours=1), 1.0, 3.0, 0.5, 2.5),
                       ("B", t, 5.0, 6.0, 4.0, 5.5)])
    k = {r.symbol: r for r in serving.kpi_latest(df).collect()}
    assert k["A"].latest_price == 2.5 and k["A"].total_volume == 2.0
    g = gold.build_gold_daily(df, with_processed_at=False)
    assert serving.high_low_range(g, ["A"]).collect()[0].range == 2.5
    assert [r.symbol for r in serving.volume_by_symbol(g, ["B"]).collect()] == ["B"]
    assert [r.price for r in serving.price_trend(df, ["A"]).collect()] == [1.5, 2.5]


def test_slicer_prunes_partitions(spark, tmp):
    t = dt.datetime(2024, 1, 1, 10)
    ticks(spark, [("A", t, 1.0, 1.0, 1.0, 1.0), ("B", t, 1.0, 1.0, 1.0, 1.0)]) \
        .write.partitionBy("symbol").parquet(tmp + "/t")
    from marketlake.sources import read_layer
    df = read_layer(spark, tmp + "/t", spark.read.parquet(tmp + "/t").schema, ["A"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and df.count() == 1


def test_dedup_plans_group_limit_before_shuffle(spark):
    from marketlake.operators.clean import dedup_latest
    ev = si.events(spark, SF_SMALL)
    plan = dedup_latest(ev, ["event_type"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_candle_day_volume(spark):
    c = si.candles(si.events(spark, SF_SMALL))
    v = gold.candle_day_volume(c)
    assert abs(v.agg(F.sum("day_volume")).collect()[0][0] - c.agg(F.sum("volume")).collect()[0][0]) < 1e-6


def test_publish_table_catalog_and_blank_url(spark, tmp):
    from marketlake.sinks import publish_table
    t = dt.datetime(2024, 1, 1, 10)
    g = gold.build_gold_daily(ticks(spark, [("A", t, 1.0, 1.0, 1.0, 2.0)]), with_processed_at=False)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS market LOCATION '{tmp}/market.db'")
    where = publish_table(g, "market.crypto_daily", url="none")
    assert where == "catalog"
    assert spark.table("market.crypto_daily").collect()[0].pct_return == 100.0
    spark.sql("DROP TABLE market.crypto_daily")


def test_table_presence_empty_partitioned_table(spark, tmp):
    """A table written from no rows (only a _SUCCESS marker) is reported
    absent, and a strict check fails with QualityError."""
    import pytest

    from marketlake.operators.quality import QualityError, table_presence
    path = tmp + "/klines_5m"
    spark.createDataFrame([], "symbol string, date date, close double") \
        .write.partitionBy("symbol", "date").parquet(path)
    report = table_presence(spark, {"klines_5m": path}).collect()
    assert [(r.table, r.n_rows, r.present) for r in report] == [("klines_5m", 0, False)]
    with pytest.raises(QualityError):
        table_presence(spark, {"klines_5m": path}, strict=True)


def test_publish_keeps_the_old_table_until_the_new_one_is_written(spark):
    from marketlake.sinks import publish_table
    name = "market.swapped"
    spark.sql("CREATE DATABASE IF NOT EXISTS market")
    spark.sql(f"DROP TABLE IF EXISTS {name}")

    def rows():
        return sorted(r[0] for r in spark.read.table(name).collect())

    publish_table(spark.range(3), name)
    with pytest.raises(Exception):
        publish_table(spark.range(9).select((F.col("id") + F.raise_error(F.lit("lost"))).alias("id")), name)
    assert rows() == [0, 1, 2]
    publish_table(spark.range(5).withColumnRenamed("id", "other"), name)
    assert rows() == [0, 1, 2, 3, 4]
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")             # a run that died between its renames
    with pytest.raises(Exception):
        publish_table(spark.range(9).select((F.col("id") + F.raise_error(F.lit("lost"))).alias("id")), name)
    assert rows() == [0, 1, 2, 3, 4]
    publish_table(spark.range(2), name)
    assert rows() == [0, 1] and not spark.catalog.tableExists(f"{name}__old")
    assert [t.name for t in spark.catalog.listTables("market") if t.name.startswith("swapped")] == ["swapped"]


@pytest.mark.parametrize("kind", ["bigint", "int", "date", "timestamp", "timestamp_ntz"])
def test_running_sums_span_no_table(spark, kind):
    from marketlake.operators.scan import running_sums
    n = [-(2 ** 61), -70_000, -65_537, -65_536, -1, 0, 1, 5, 65_535, 65_536, 2 ** 30, 2 ** 40, 2 ** 62]
    n = [x for x in n if abs(x) < {"bigint": 2 ** 63, "int": 2 ** 31, "date": 700_000}.get(kind, 2 ** 50)]
    rows = spark.createDataFrame([(x, i + 1) for i, x in enumerate(n)] + [(None, 100)], "n long, v int")
    of = {"date": F.date_from_unix_date(F.col("n").cast("int")), "timestamp": F.timestamp_micros("n"),
          "timestamp_ntz": F.timestamp_micros("n").cast("timestamp_ntz")}.get(kind, F.col("n").cast(kind))
    rows = rows.withColumn("o", of)
    for fan in (1024, 1 << 16):
        out = running_sums(rows, "o", {"s": F.col("v"), "none": F.lit(None).cast("int")}, fan)
        got = {r["n"]: (r["s"], r["none"]) for r in out.collect()}
        assert got == {None: (100, 0), **{x: (100 + (i + 1) * (i + 2) // 2, 0) for i, x in enumerate(n)}}
    assert out.columns == ["n", "v", "o", "s", "none"]


def test_ingest_totals_has_no_single_partition(spark):
    log = spark.range(5000).select((F.col("id") * 7).alias("cycle"), (F.col("id") % 3 > 0).alias("ok"))
    t = quality.ingest_totals(log)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert t.agg(F.max("cum_ok"), F.max("cum_fail")).first() == (3333, 1667)
