"""Damaged documents, kept once each, and their way back (SRC-2).

A row is keyed by (file, SHA-256 of its text): re-running a batch, a repeated
micro-batch or a stream with a new checkpoint adds nothing twice and takes
nothing away.  The table is part of the lake (``quarantine/documents``), by the
day in the file's path.  ``replay`` repairs texts by an expression; what parses
then is handed on, and leaves the quarantine when that is done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.paths import Paths
from marketlake.schemas import BRONZE, CORRUPT, QUARANTINE
from marketlake.session import delete_path, scratch_path
from marketlake.sinks import lake

KEY = ["file", "digest"]


def _table(paths: Paths) -> tuple[str, str]:
    return lake.locate(f"{paths.quarantine}/documents")


def _rows(bad: DataFrame) -> DataFrame:
    """``bad``: the second part of ``split_corrupt``."""
    path_day = F.regexp_extract(F.col("_file"), r"[/=](\d{4}[/-]\d{2}[/-]\d{2})(?=/)", 1)
    day = F.try_to_timestamp(F.translate(path_day, "/", "-"), F.lit("yyyy-MM-dd")).cast("date")
    return bad.select(F.col("_file").alias("file"), F.sha2(F.encode(CORRUPT, "UTF-8"), 256).alias("digest"),
                      F.col(CORRUPT).alias("text"), day.alias("date"))


def _replace(spark: SparkSession, paths: Paths, keys: DataFrame, added: DataFrame | None) -> None:
    """Take the rows of ``keys`` (KEY, date) out and put ``added`` in, in one commit; both are written tables."""
    root, name = _table(paths)
    days = lake.days_of(keys)

    def stage(at: lake.Snapshot) -> lake.Change:
        rows = lake.read(spark, at, name, QUARANTINE, days).join(keys.select(*KEY), KEY, "left_anti")
        rows = rows.select(*KEY, "text", "date")
        rows = rows if added is None else rows.unionByName(added)
        written = {d: f for (d,), f in lake.stage(rows, root, name, ("file",)).items()}
        return lake.Change({name: {**dict.fromkeys(days), **written}})

    if days:
        lake.update(spark, root, stage)


def add(spark: SparkSession, bad: DataFrame, paths: Paths) -> None:
    """Put damaged documents in; those that are there already stay once."""
    scratch = scratch_path(spark, "quarantine")
    _rows(bad).dropDuplicates(KEY).write.parquet(scratch)
    new = spark.read.schema(QUARANTINE).parquet(scratch)
    _replace(spark, paths, new, new)
    delete_path(spark, scratch)


def read(spark: SparkSession, paths: Paths, at: lake.Snapshot | None = None) -> DataFrame:
    """file, digest, text, date of all damaged documents."""
    root, name = _table(paths)
    return lake.read(spark, at or lake.snapshot(spark, root), name, QUARANTINE)


def replay(spark: SparkSession, paths: Paths, repair: Callable[[Column], Column],
           handle: Callable[[DataFrame], None]) -> None:
    """Repair texts; ``handle`` gets the envelopes that parse then, and may see them again if a run dies before its end."""
    parsed = read(spark, paths).withColumn("e", F.from_json(repair(F.col("text")), BRONZE, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    scratch = scratch_path(spark, "replay")
    parsed.filter(F.col(f"e.{CORRUPT}").isNull() & F.col("e.metadata").isNotNull()).write.parquet(scratch)
    good = spark.read.schema(parsed.schema).parquet(scratch)
    if not good.isEmpty():
        handle(good.select(F.col("file").alias("_file"), "e.*").drop(CORRUPT))
        _replace(spark, paths, good.select(*KEY, "date"), None)
    delete_path(spark, scratch)
