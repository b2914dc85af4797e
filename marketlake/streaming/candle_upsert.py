"""Candle tables with indicators, kept up to date batch by batch (STR-5).

Row-frame windows are not allowed on a stream, and a late or corrected candle
changes every later cumulative VWAP of its series.  So stored rows hold only
what depends on their own day and the ``LOOKBACK`` candles before it: SMA,
Bollinger, RSI, the position in the day and the VWAP sums since the day began.
A small day table has each day's row count and VWAP sums; ``read_candles`` adds
the sums of all earlier days, so a fix never rewrites the days behind it.

One (micro-)batch, all intervals in one plan:

1. its candles are cleaned, reduced to the latest copy per (symbol, interval,
   open_time) and staged; their (symbol, interval, day)s are the touched days;
2. new, stored and formerly removed rows of the touched days are merged: the
   latest copy wins, then the positive-close rule;
3. from the day table, with the touched days' new counts, follow each series'
   positions.  Later days that begin less than ``LOOKBACK`` rows behind a
   touched one are re-done, and days that end less than that before a re-done
   one are read as context;
4. positions continue from the day table; the indicators run over buckets of
   positions, so no task holds a series;
5. rows, day tables and removed candles of all intervals change in one commit
   of the lake (``sinks.lake``).  Another writer's commit to these tables makes
   the change be staged anew; a run that dies changes nothing, and re-running
   a batch gives the same tables.

Beside each table: ``_days`` (by month), and ``_removed``, the latest copies
that the price rule took out, so that an older copy arriving later does not
bring a candle back.  Candles with a NULL ``open_time`` have no day and are not
stored.  A day folder holds all symbols: re-doing one symbol's day copies the
others' rows of that day.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from marketlake.functions.scalar import safe_div, typical_price
from marketlake.operators.clean import dedup_latest, drop_invalid
from marketlake.operators.indicators import (DEFAULT_BUCKET_ROWS, INDICATORS, LOOKBACK,
                                             _frame_indicators, _rsi_columns, bucket_frame)
from marketlake.operators.scan import add_lookback_buckets, add_nullable
from marketlake.operators.silver import CANDLE_VALUE_COLUMNS, project_klines
from marketlake.schemas import CANDLE_DAYS, CANDLE_ROWS, CANDLE_TABLE, KLINE_ARRAYS
from marketlake.session import delete_path, scratch_path
from marketlake.sinks import lake

KEYS = ["symbol", "interval"]
DAY = [*KEYS, "date"]
BASE = ["symbol", "interval", "open_time", "ingested_at", "open", "high", "low", "close",
        "volume", "num_trades"]
ROWS = [f.name for f in CANDLE_ROWS]
REMOVED = StructType([CANDLE_TABLE[c] for c in (*BASE, "date")])


def _latest(df: DataFrame) -> DataFrame:
    return dedup_latest(df, KEYS + ["open_time"], "ingested_at",
                        tiebreak=list(CANDLE_VALUE_COLUMNS))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _folders(df: DataFrame, flag: Column) -> tuple[dict[str, set[str]], dict[str, set[str]]]:
    """The days of ``df`` by interval, and those that have a row with the flag: bounded by the calendar, not by rows."""
    every: dict[str, set[str]] = {}
    flagged: dict[str, set[str]] = {}
    for r in df.groupBy("interval", F.col("date").cast("string").alias("d")).agg(F.bool_or(flag).alias("f")).collect():
        every.setdefault(r["interval"], set()).add(r["d"])
        if r["f"]:
            flagged.setdefault(r["interval"], set()).add(r["d"])
    return every, flagged


def _plan(days: DataFrame) -> DataFrame:
    """Which days to read: DAY, before (rows of the series before it), redo (else only context).

    ``days``: DAY, n and touched, all days of the series concerned.
    """
    order = Window.partitionBy(*KEYS).orderBy("date")
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    at = days.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    at = at.withColumn("touched_end", F.max(F.when(F.col("touched"), F.col("before") + F.col("n"))).over(earlier))
    behind = F.coalesce(F.col("before") - F.col("touched_end") < LOOKBACK, F.lit(False))
    at = at.withColumn("redo", F.col("touched") | behind)
    at = at.withColumn("next_redo", F.min(F.when(F.col("redo"), F.col("before"))).over(later))
    context = F.coalesce(F.col("next_redo") - F.col("before") - F.col("n") < LOOKBACK, F.lit(False))
    return at.filter("redo").unionByName(at.filter(~F.col("redo") & context)).select(*DAY, "before", "redo")


def _with_indicators(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """Stored columns of ``rows`` (BASE, date, before, redo) for the days to re-do."""
    day = Window.partitionBy(*DAY).orderBy("open_time")
    rows = rows.withColumns({
        "_j": (F.row_number().over(day) - 1).cast("long"),
        "_day_pv": F.sum(typical_price("high", "low", "close") * F.col("volume")).over(day),
        "_day_v": F.sum(F.col("volume").cast("double")).over(day)})
    rows = rows.withColumn("_i", F.col("before") + F.col("_j"))
    bucketed, w = bucket_frame(add_lookback_buckets(rows, "_i", bucket_rows, LOOKBACK), KEYS)
    out = _rsi_columns(bucketed.withColumns(dict(_frame_indicators(w, "close"))), w, "close")
    return out.filter(F.col("_own") & F.col("redo")).select(*ROWS)


def _stage(spark: SparkSession, new: DataFrame, tables: Mapping[str, str], at: lake.Snapshot, bucket_rows: int,
           replace: bool, scratch: str) -> lake.Change:
    """Stage the merge of a batch's candles into ``tables`` (by interval) as of ``at``."""
    base = lake.Snapshot(at.root, at.version) if replace else at

    def stored(suffix: str, schema: StructType, folders: Mapping[str, set[str]] | None = None) -> DataFrame:
        return _union([lake.read(spark, base, t + suffix, schema, None if folders is None else folders.get(i, set()))
                       for i, t in tables.items()])

    touched = new.select(*DAY).distinct()
    new_days, _ = _folders(new, F.lit(False))
    months = {i: {f"{d[:7]}-01" for d in days} for i, days in new_days.items()}
    held, taken = stored("", CANDLE_ROWS, new_days), stored("_removed", REMOVED, new_days)
    parts = [new, *[t.join(touched, DAY, "left_semi").select(*BASE, "date") for t in (held, taken)]]
    merged = _latest(_union(parts)).withColumn("_kept", F.coalesce(F.col("close") > 0, F.lit(False)))
    merged = _written(merged, f"{scratch}/merged")
    kept = merged.filter("_kept").select(*BASE, "date")

    per_day = kept.groupBy(*DAY).agg(
        F.count(F.lit(1)).alias("n"), F.sum(typical_price("high", "low", "close") * F.col("volume")).alias("pv"),
        F.sum(F.col("volume").cast("double")).alias("v"))
    per_day = touched.join(per_day, DAY, "left").select(*DAY, F.coalesce("n", F.lit(0)).alias("n"), "pv", "v")
    other_days = stored("_days", CANDLE_DAYS).join(new.select(*KEYS).distinct(), KEYS, "left_semi")
    other_days = other_days.join(touched, DAY, "left_anti")
    plan = _written(_plan(per_day.select(*DAY, "n", F.lit(True).alias("touched")).unionByName(
        other_days.select(*DAY, "n", F.lit(False).alias("touched")))), f"{scratch}/plan")

    all_days, redo_days = _folders(plan, F.col("redo"))
    around = stored("", CANDLE_ROWS, all_days).join(touched, DAY, "left_anti").select(*BASE, "date")
    done = _with_indicators(kept.unionByName(around).join(plan, DAY), bucket_rows)
    carried = stored("", CANDLE_ROWS, redo_days).join(plan.filter("redo"), DAY, "left_anti")
    out = {
        "": (done.unionByName(carried), ("interval", "date"), ("symbol", "open_time"), redo_days),
        "_removed": (merged.filter(~F.col("_kept")).select(*BASE, "date").unionByName(
            taken.join(touched, DAY, "left_anti").select(*BASE, "date")), ("interval", "date"), ("symbol", "open_time"), new_days),
    }
    day_rows = per_day.filter("n > 0").unionByName(
        stored("_days", CANDLE_DAYS, months).join(touched, DAY, "left_anti").select(*DAY, "n", "pv", "v"))
    out["_days"] = (day_rows.withColumn("month", F.trunc("date", "MM")), ("interval", "month"), ("symbol", "date"), months)

    change, layer = lake.Change(), next(iter(tables.values())).rpartition("/")[0]
    with ThreadPoolExecutor(len(out)) as pool:                       # three writes that do not need each other
        writes = {suffix: pool.submit(lake.stage, df, at.root, f"{layer}/klines{suffix}".lstrip("/"), cluster, partition_by)
                  for suffix, (df, partition_by, cluster, _) in out.items()}
    for suffix, (_, _, _, folders) in out.items():
        written = writes[suffix].result()
        for interval, table in tables.items():
            name = table + suffix
            change.days[name] = {d: f for (i, d), f in written.items() if i == interval}
            if replace:
                change.whole.add(name)
            else:
                change.days[name] = {**dict.fromkeys(folders.get(interval, ())), **change.days[name]}
            change.reads[name] = None
    return change


def upsert_all(spark: SparkSession, batch: DataFrame, root: str, intervals: Sequence[str],
               bucket_rows: int = DEFAULT_BUCKET_ROWS, replace: bool = False,
               paths: Mapping[str, str] | None = None,
               on_staged: Callable[[lake.Change], None] | None = None) -> None:
    """Merge a batch of Bronze envelopes into the candle tables ``{root}/klines_{1m,5m,1h}`` (or ``paths`` by array).

    ``replace=True`` builds the tables from ``batch`` alone and replaces all of
    them (a full rebuild); the default merges into what is stored.
    """
    if not intervals:
        return
    paths = paths or {a: f"{root.rstrip('/')}/klines_{KLINE_ARRAYS[a]}" for a in intervals}
    lake_root = lake.locate(next(iter(paths.values())))[0]
    tables = {KLINE_ARRAYS[a]: lake.locate(paths[a])[1] for a in intervals}
    scratch = scratch_path(spark, "candle-upsert")
    new = _union([project_klines(batch, a) for a in intervals]).filter(F.col("open_time").isNotNull())
    new = _latest(drop_invalid(new, ["symbol", "close"])).select(*BASE, F.to_date("open_time").alias("date"))
    new = _written(new, f"{scratch}/new")
    tries = iter(range(1000))
    if replace or not new.isEmpty():
        lake.update(spark, lake_root, lambda at: _stage(
            spark, new, tables, at, bucket_rows, replace, f"{scratch}/{next(tries)}"), on_staged=on_staged)
    delete_path(spark, scratch)


def upsert_candles(spark: SparkSession, batch: DataFrame, path: str,
                   array_name: str = "klines_1h", bucket_rows: int = DEFAULT_BUCKET_ROWS,
                   replace: bool = False, on_staged: Callable[[lake.Change], None] | None = None) -> None:
    """``upsert_all`` for the one table at ``path``."""
    upsert_all(spark, batch, "", (array_name,), bucket_rows, replace, {array_name: path}, on_staged)


def read_candles(spark: SparkSession, path: str, at: lake.Snapshot | None = None) -> DataFrame:
    """The candle table at ``path`` with all indicators and each candle's position ``_i`` in its series.

    The sums of the days before come from the day table (one row per series and
    day); Spark broadcasts it if it is measured small and joins by day if not.
    """
    root, table = lake.locate(path)
    at = at or lake.snapshot(spark, root)
    before = Window.partitionBy(*KEYS).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    days = lake.read(spark, at, f"{table}_days", CANDLE_DAYS).select(
        *DAY, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_i0"),
        F.sum("pv").over(before).alias("_pv0"), F.sum("v").over(before).alias("_v0"))
    rows = lake.read(spark, at, table, CANDLE_ROWS).join(days, DAY)
    return rows.withColumns({
        "_i": F.col("_i0") + F.col("_j"), "_cum_pv": add_nullable("_pv0", "_day_pv"),
        "_cum_v": add_nullable("_v0", "_day_v"),
    }).withColumn("vwap", safe_div(F.col("_cum_pv"), F.col("_cum_v"))).select([f.name for f in CANDLE_TABLE])


def candle_upsert_query(spark: SparkSession, envelopes: DataFrame, root: str, checkpoint: str,
                        intervals: Sequence[str] = tuple(KLINE_ARRAYS), trigger: str | None = None,
                        bucket_rows: int = DEFAULT_BUCKET_ROWS) -> StreamingQuery:
    """STR-5: keep ``{root}/klines_{1m,5m,1h}`` up to date from a Bronze stream."""
    from marketlake.streaming.pipeline import each_batch
    return each_batch(envelopes, lambda batch, _epoch: upsert_all(spark, batch, root, intervals, bucket_rows),
                      checkpoint, trigger)
