"""Quality counts of every run and micro-batch, kept (DQ-4).

One row per (source, batch) in the lake's table ``silver/quality_log``.  A batch
that is handled again after a crash is not counted again.  Each row lies in a
folder of its own until ``lake.compact`` joins the closed days.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.paths import Paths
from marketlake.schemas import QUALITY_LOG
from marketlake.sinks import lake


def _table(paths: Paths) -> tuple[str, str]:
    return lake.locate(paths.silver_table("quality_log"))


def log_counts(spark: SparkSession, paths: Paths, source: str, batch: int, counts: Mapping[str, int],
               now: _dt.datetime | None = None) -> None:
    """Keep the counts of ``merge_tickers`` for a batch of a source (a run, a checkpoint), once."""
    root, name = _table(paths)
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(source, batch, *(counts[f"n_{s}"] for s in ("input", "valid", "unique", "output")),
                                  now, now.date())], QUALITY_LOG)

    def stage(at: lake.Snapshot) -> lake.Change | None:
        held = at.tables.get(name, {})
        seen = lake.read(spark, at, name, QUALITY_LOG).filter((F.col("source") == source) & (F.col("batch") == batch))
        if not seen.isEmpty():
            return None
        return lake.Change({name: {d: [*held.get(d, ()), f] for (d,), f in lake.stage(row, root, name).items()}})

    lake.update(spark, root, stage)


def read_counts(spark: SparkSession, paths: Paths) -> DataFrame:
    """source, batch, n_input, n_valid, n_unique, n_output, logged_at, date."""
    root, name = _table(paths)
    return lake.read(spark, lake.snapshot(spark, root), name, QUALITY_LOG)
