"""STR-6: snapshots that arrive behind the watermark, kept aside and merged on request.

The daily summary of a day is final once the watermark (the largest event time
of earlier micro-batches, less a delay) has passed the day's end.  A snapshot
of such a day that comes later is late: it goes to the lake table
``tickers_late`` instead of Silver, so a closed day keeps the values that were
read from it, and nothing is lost.  ``late_counts`` counts what waits;
``repair_late`` merges it into Silver and Gold, in one commit that also takes
it off the late table.

The watermark before each micro-batch is a record in the query's checkpoint,
put before the batch is merged: a batch that is seen again is split in the same
way, and appended once.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from marketlake.operators.clean import drop_invalid
from marketlake.operators.silver import project_ticker
from marketlake.paths import Paths
from marketlake.plans.tickers import _positive, _survivors, merge_tickers, stage_tickers
from marketlake.schemas import SILVER_TICKERS
from marketlake.session import delete_path, ensure_utc, scratch_path
from marketlake.sinks import lake
from marketlake.sources.bronze import split_corrupt
from marketlake.streaming.pipeline import each_batch

LATE = StructType([*SILVER_TICKERS, StructField("batch", StringType())])


def _table(paths: Paths) -> tuple[str, str]:
    return lake.locate(paths.silver_table("tickers_late"))


def _event_time():
    return F.try_to_timestamp("metadata.ingested_at")


def _stored_high(spark: SparkSession, paths: Paths) -> float | None:
    """The largest event time in Silver: only its newest day is read."""
    root, silver = lake.locate(paths.silver_table("tickers"))
    at = lake.snapshot(spark, root)
    days = [d for d in at.tables.get(silver, {}) if d != lake.NULL_DAY]
    if not days:
        return None
    return lake.read(spark, at, silver, SILVER_TICKERS, [max(days)]).agg(
        F.max(F.unix_micros("ingested_at")) / 1e6).first()[0]


def closed_before(spark: SparkSession, good: DataFrame, paths: Paths, records: str, number: int,
                  delay: _dt.timedelta) -> str | None:
    """The first day that is open for batch ``number`` (earlier ones are closed); None if all are.

    Batches are numbered from 0 without gaps; ``records`` holds, for each, the
    largest event time before it and with it.
    """
    path = f"{records}/{number:020d}.json"
    text = lake._read_text(spark, path)
    if text is None:
        earlier = lake._read_text(spark, f"{records}/{number - 1:020d}.json") if number else None
        before = json.loads(earlier)["with"] if earlier else _stored_high(spark, paths)
        own = good.agg(F.max(F.unix_micros(_event_time())) / 1e6).first()[0]
        lake.put_if_absent(spark, path, json.dumps(
            {"before": before, "with": max((x for x in (before, own) if x is not None), default=None)}))
        text = lake._read_text(spark, path)
    before = json.loads(text)["before"]
    if before is None:
        return None
    return (_dt.datetime.fromtimestamp(before, _dt.timezone.utc) - delay).date().isoformat()


def merge_open_days(spark: SparkSession, good: DataFrame, paths: Paths, open_from: str | None, batch: str) -> None:
    """Merge the envelopes of open days into Silver and Gold, and keep the others as late rows of ``batch``.

    Snapshots without an event time are never late.  Doing the same batch
    again changes nothing.
    """
    if open_from is None:
        merge_tickers(spark, good, paths)
        return
    is_late = F.coalesce(F.to_date(_event_time()) < F.lit(open_from).cast("date"), F.lit(False))
    root, table = _table(paths)
    late = _survivors(drop_invalid(project_ticker(good.filter(is_late)), ["symbol", "last_price"]))
    staged = scratch_path(spark, "late")
    late.select([f.name for f in SILVER_TICKERS]).withColumn("batch", F.lit(batch)).write.parquet(staged)
    late = spark.read.schema(LATE).parquet(staged)
    days = lake.days_of(late)
    if days:
        done = lake.read(spark, lake.snapshot(spark, root), table, LATE, days).select("batch").distinct()
        lake.append(spark, root, table, late.join(done, "batch", "left_anti").select([f.name for f in LATE]),
                    ("symbol", "ingested_at"))
    merge_tickers(spark, good.filter(~is_late), paths)
    delete_path(spark, staged)


def closed_days_query(spark: SparkSession, envelopes: DataFrame, paths: Paths, checkpoint: str,
                      delay: _dt.timedelta = _dt.timedelta(hours=1), trigger: str | None = None) -> StreamingQuery:
    """Like ``ticker_query``, but days that the watermark has passed stay as they are; late rows wait aside."""
    ensure_utc(spark)
    records = f"{checkpoint.rstrip('/')}/watermarks"

    def handle(batch: DataFrame, epoch: int) -> None:
        good = split_corrupt(batch)[0] if "_corrupt_record" in batch.columns else batch
        query = json.loads(lake._read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        open_from = closed_before(spark, good, paths, records, epoch, delay)
        merge_open_days(spark, good, paths, open_from, f"{query}/{epoch}")

    return each_batch(envelopes, handle, checkpoint, trigger)


def read_late(spark: SparkSession, paths: Paths, at: lake.Snapshot | None = None) -> DataFrame:
    """The snapshots that wait, as Silver rows with their micro-batch."""
    root, table = _table(paths)
    return lake.read(spark, at or lake.snapshot(spark, root), table, LATE)


def late_counts(spark: SparkSession, paths: Paths, at: lake.Snapshot | None = None) -> DataFrame:
    """How many snapshots wait per symbol and day."""
    return read_late(spark, paths, at).groupBy("symbol", "name", "date").agg(F.count(F.lit(1)).alias("n_late"))


def repair_late(spark: SparkSession, paths: Paths, days: Iterable[str] | None = None) -> list[str]:
    """Merge the late rows (of ``days``; default: all) into Silver and Gold; returns the days that changed.

    One commit changes the days and empties their late rows; rows that turn up
    late meanwhile make it start anew, so they are either merged or still wait.
    """
    root, table = _table(paths)
    wanted, touched = None if days is None else set(days), []

    def stage(at: lake.Snapshot) -> lake.Change | None:
        touched[:] = sorted(d for d in at.tables.get(table, {}) if wanted is None or d in wanted)
        if not touched:
            return None
        scratch = scratch_path(spark, "late-repair")
        late = _survivors(lake.read(spark, at, table, LATE, touched).drop("batch")).withColumn("_kept", _positive())
        late.write.parquet(scratch)
        change = stage_tickers(spark, spark.read.schema(late.schema).parquet(scratch), paths, at)
        change.days[table] = dict.fromkeys(touched)
        delete_path(spark, scratch)
        return change

    lake.update(spark, root, stage)
    return list(touched)
