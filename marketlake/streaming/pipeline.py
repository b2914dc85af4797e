"""The continuous form of the ETL: one Bronze file stream feeding Silver
tickers, the daily Gold, the candle tables and the quarantine.

This replaces the reference's poll-and-rerun loop: new landed files are parsed
once per micro-batch, staged as Parquet, and merged with the same writers as a
batch run, so batch and stream can take turns on the same tables and the open
day is in Gold.  The checkpoint is ``{root}/_checkpoints/lake``; a repeated
micro-batch gives the same tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.operators.indicators import DEFAULT_BUCKET_ROWS
from marketlake.paths import Paths
from marketlake.plans.tickers import merge_tickers
from marketlake.schemas import COMPACT_BRONZE, CORRUPT, KLINE_ARRAYS
from marketlake.session import delete_path, ensure_utc, scratch_path
from marketlake.sinks import lake, quarantine
from marketlake.sinks.quality_log import log_counts
from marketlake.sources.bronze import split_corrupt
from marketlake.sources.landing import EXCHANGE_LEVELS, Landing, drain
from marketlake.streaming.bronze_stream import stream_bronze
from marketlake.streaming.candle_upsert import upsert_all


def each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
               trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Run ``handle`` on every micro-batch, staged as Parquet first (one parse, no cache).

    ``trigger``: see ``bronze_stream.start``.
    """
    spark = stream.sparkSession

    def staged(batch: DataFrame, epoch: int) -> None:
        path = scratch_path(spark, "micro-batch")
        batch.write.parquet(path)
        try:
            handle(spark.read.schema(batch.schema).parquet(path), epoch)
        finally:
            delete_path(spark, path)

    w = stream.writeStream.foreachBatch(staged).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if trigger in (None, "once", "available_now") \
        else w.trigger(processingTime=trigger)
    return w.start()


def ticker_query(spark: SparkSession, envelopes: DataFrame, paths: Paths, checkpoint: str,
                 trigger: str | None = None) -> StreamingQuery:
    """STR-3/4: keep Silver tickers and the daily Gold up to date from a Bronze stream."""
    return each_batch(envelopes, lambda batch, _epoch: merge_tickers(spark, batch, paths), checkpoint, trigger)


def handle_batch(spark: SparkSession, batch: DataFrame, paths: Paths, intervals: Sequence[str],
                 bucket_rows: int = DEFAULT_BUCKET_ROWS, source: str | None = None, number: int = 0) -> None:
    """Merge one staged batch of Bronze documents into all tables; seeing a batch again changes nothing.

    With a ``source`` its quality counts are logged as batch ``number``.
    """
    good, bad = split_corrupt(batch)
    quarantine.add(spark, bad, paths)
    counts = merge_tickers(spark, good, paths)
    if source is not None:
        log_counts(spark, paths, source, number, counts)
    upsert_all(spark, good, paths.silver, intervals, bucket_rows)


def drain_landing(spark: SparkSession, paths: Paths, intervals: Sequence[str] = tuple(KLINE_ARRAYS),
                  max_files: int | None = None, levels: int = EXCHANGE_LEVELS, multiline: bool = True,
                  bucket_rows: int = DEFAULT_BUCKET_ROWS) -> int:
    """Merge what has landed since the last call, listing only open folders; returns the number of batches.

    The state is ``{root}/_checkpoints/landing``; call it on a timer for a continuous form.
    """
    ensure_utc(spark)
    landing = Landing(spark, paths.bronze, f"{paths.root.rstrip('/')}/_checkpoints/landing", levels, max_files=max_files)
    columns = ["_file", "metadata", "ticker", *intervals, CORRUPT]

    def handle(batch: DataFrame, number: int) -> None:
        staged = scratch_path(spark, "landed-batch")                 # one parse
        batch.write.parquet(staged)
        try:
            handle_batch(spark, spark.read.schema(batch.schema).parquet(staged), paths, intervals, bucket_rows,
                         "landing", number)
        finally:
            delete_path(spark, staged)

    return drain(landing, handle, multiline, columns)


def compact_landing(spark: SparkSession, paths: Paths, today: str, max_files: int | None = None,
                    levels: int = EXCHANGE_LEVELS, multiline: bool = True) -> list[str]:
    """SNK-1: append what has landed to the Parquet table ``bronze_compact`` of the lake, then compact the closed days.

    Every batch adds a folder to its event days; days before ``today`` end in
    one folder with files of the target size.  Read it with
    ``read_bronze(layout="compact")``, whose ``date`` opens that day's folder
    only.  A repeated batch is appended once: a file that the day has is left out.
    """
    ensure_utc(spark)
    root, table = lake.locate(paths.bronze_compact)
    landing = Landing(spark, paths.bronze, f"{paths.root.rstrip('/')}/_checkpoints/compact", levels, max_files=max_files)
    day = F.to_date(F.try_to_timestamp("metadata.ingested_at"))

    def handle(batch: DataFrame, _number: int) -> None:
        rows = batch.withColumns({"name": F.col("metadata.name"), "date": day}).select([f.name for f in COMPACT_BRONZE])
        staged = scratch_path(spark, "landed-batch")                 # one parse
        rows.write.parquet(staged)
        rows = spark.read.schema(COMPACT_BRONZE).parquet(staged)
        held = lake.read(spark, lake.snapshot(spark, root), table, COMPACT_BRONZE, lake.days_of(rows))
        rows = rows.join(held.select("_file").distinct(), "_file", "left_anti").select([f.name for f in COMPACT_BRONZE])
        lake.append(spark, root, table, rows, ("name",))
        delete_path(spark, staged)

    drain(landing, handle, multiline)
    return lake.compact(spark, root, table, COMPACT_BRONZE, today, ("name",))


def start_streams(spark: SparkSession, paths: Paths, trigger: str | None = None,
                  intervals: Sequence[str] = tuple(KLINE_ARRAYS),
                  max_files_per_trigger: int | None = None, layout: str = "exchange",
                  bucket_rows: int = DEFAULT_BUCKET_ROWS) -> dict[str, StreamingQuery]:
    """Start the stream; returns its query by name.

    ``trigger=None`` processes what has landed and stops (``availableNow``);
    a string such as ``"30 seconds"`` runs continuously at that interval.
    """
    ensure_utc(spark)
    raw = stream_bronze(spark, paths.bronze, max_files_per_trigger=max_files_per_trigger,
                        multiline=(layout == "exchange"), layout=layout)
    raw = raw.select("_file", "metadata", "ticker", *intervals, CORRUPT)

    checkpoint = f"{paths.root.rstrip('/')}/_checkpoints/lake"

    def handle(batch: DataFrame, epoch: int) -> None:
        query = json.loads(lake._read_text(spark, f"{checkpoint}/metadata"))["id"]      # a new checkpoint has another
        handle_batch(spark, batch, paths, intervals, bucket_rows, f"stream {query}", epoch)

    return {"lake": each_batch(raw, handle, checkpoint, trigger, "lake")}


def await_all(queries: dict[str, StreamingQuery]) -> None:
    for q in queries.values():
        q.awaitTermination()
