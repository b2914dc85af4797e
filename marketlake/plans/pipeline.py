"""The batch ETL: Bronze -> Silver (tickers, candles + indicators) -> Gold.

Flow (one JSON parse in total):

1. Bronze JSON of the chosen day and assets is read once with the fixed
   schema; damaged documents go to the quarantine with their file path, and
   the columns that Silver needs are staged as Parquet under the checkpoint
   root.  The lineage back to the JSON files is cut there.
2. The Bronze gate: every expected symbol must have landed.
3. Silver ``tickers``, Gold and one candle table per interval (1m, 5m, 1h) are
   rebuilt by a full run.  A run for a day or for some assets merges its rows
   into the days they belong to -- by event time: a snapshot taken just before
   midnight lands in the next day's folder -- and touches nothing else.
4. The tables are checked for presence, and the staging copy is deleted.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.bronze import select_assets
from marketlake.operators.indicators import DEFAULT_BUCKET_ROWS
from marketlake.operators.quality import missing_partitions, table_presence
from marketlake.paths import Paths
from marketlake.plans.tickers import GOLD_TABLE, merge_tickers
from marketlake.schemas import CORRUPT, GOLD_DAILY, KLINE_ARRAYS
from marketlake.session import delete_path, ensure_utc, scratch_path
from marketlake.sinks import publish_table, quarantine
from marketlake.sinks.quality_log import log_counts
from marketlake.sources import read_bronze, read_layer, split_corrupt
from marketlake.streaming.candle_upsert import upsert_all


def stage_bronze(spark: SparkSession, paths: Paths, date=None, assets: Iterable[str] | None = None,
                 layout: str = "exchange", intervals: Sequence[str] = tuple(KLINE_ARRAYS)) -> tuple[DataFrame, str]:
    """Parse Bronze once: quarantine the damaged documents, stage the rest as
    Parquet.  Returns (staged DataFrame, staging path)."""
    assets = None if assets is None else list(assets)
    raw = read_bronze(spark, paths.bronze_compact if layout == "compact" else paths.bronze, date=date, layout=layout,
                      multiline=(layout == "exchange"), assets=None if layout == "hive" else assets)
    staged_path = scratch_path(spark, "bronze-staged")
    raw = raw.select("_file", "metadata", "ticker", *intervals, CORRUPT)
    raw.write.parquet(staged_path)
    good, bad = split_corrupt(spark.read.schema(raw.schema).parquet(staged_path))
    quarantine.add(spark, bad, paths)
    return select_assets(good, assets), staged_path


def bronze_gate(good: DataFrame, expected: Iterable[str], date=None, strict: bool = True) -> DataFrame:
    """DQ-1 before the ETL: (symbol, slot) of expected symbols without a document that day."""
    at = F.try_to_timestamp("metadata.ingested_at")
    present = good.select(F.col("metadata.symbol").alias("symbol"), at.alias("ingested_at"))
    if date is not None:
        date = date if isinstance(date, _dt.date) else _dt.date.fromisoformat(str(date).replace("/", "-"))
        date = _dt.datetime(date.year, date.month, date.day)
    return missing_partitions(present, expected, unit="day", start=date, end=date, strict=strict)


def run_batch(spark: SparkSession, paths: Paths, date: str | _dt.date | None = None,
              strict: bool = True, intervals: Sequence[str] = tuple(KLINE_ARRAYS),
              assets: Iterable[str] | None = None, bucket_rows: int = DEFAULT_BUCKET_ROWS,
              layout: str = "exchange", now: _dt.datetime | None = None,
              expected: Iterable[str] | None = None, publish: dict | None = None) -> dict[str, DataFrame]:
    """Run the whole batch ETL; returns the quality reports.

    Without ``date`` and ``assets`` every table is rebuilt, and partitions that
    Bronze no longer holds go.  ``date`` limits the Bronze read to that day's
    landing folders, ``assets`` to these assets' folders; the rows found are
    merged, so other days and assets stay as they are.  Candles with a NULL
    ``open_time`` have no day and are not stored.

    ``expected`` symbols are checked first (DQ-1; a missing one fails a strict
    run before anything is written); ``publish`` holds ``publish_table``
    options for Gold.
    """
    ensure_utc(spark)
    rebuild = date is None and assets is None
    good, staged_path = stage_bronze(spark, paths, date, assets, layout, intervals)
    reports = {}
    if expected is not None:
        missing = bronze_gate(good, expected, date, strict)
        kept = scratch_path(spark, "bronze-missing")                 # the staged documents go, the report stays
        missing.write.parquet(kept)
        reports["bronze_missing"] = spark.read.schema(missing.schema).parquet(kept)
    counts = merge_tickers(spark, good, paths, replace=rebuild, now=now)
    log_counts(spark, paths, f"run {uuid.uuid4().hex}", 0, counts, now)
    tables = {"tickers": paths.silver_table("tickers")}
    upsert_all(spark, good, paths.silver, intervals, bucket_rows, replace=rebuild)
    for array_name in intervals:
        label = KLINE_ARRAYS[array_name]
        tables[f"klines_{label}"] = paths.silver_table(f"klines_{label}")
    tables[GOLD_TABLE] = paths.gold_table(GOLD_TABLE)
    delete_path(spark, staged_path)

    if publish is not None:
        publish_table(read_layer(spark, tables[GOLD_TABLE], GOLD_DAILY), **publish)
    presence = table_presence(spark, tables, strict=strict)
    return {**reports, "presence": presence, "ticker_rules": spark.createDataFrame([counts])}
