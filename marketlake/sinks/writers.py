"""Layer writers.

Silver and Gold are Parquet partitioned by ``symbol``.  Instead of a hard
``repartition("symbol")`` (one task per symbol: 3 symbols = 3 busy tasks at
any size) the writers use a ``rebalance`` hint: rows are clustered by symbol
so each symbol folder gets few files, and AQE splits a skewed symbol into
several tasks and merges small ones.

Overwrites are dynamic by default (only partitions present in the new data
are replaced), so an incremental run never deletes other days or symbols.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_bronze(envelopes: DataFrame, path: str,
                 partition_by: Sequence[str] = ("name", "date", "hour")) -> None:
    """SNK-1: append envelopes as NDJSON under ``name=/date=/hour=`` folders
    (``key=value`` so a later read prunes by day and hour).  ``hour`` stays a
    column when it is not a folder level."""
    ts = F.try_to_timestamp(F.col("metadata.ingested_at"))
    out = envelopes.withColumns({
        "name": F.col("metadata.name"),
        "date": F.to_date(ts),
        "hour": F.hour(ts),
    })
    (out.hint("rebalance", *partition_by)
        .write.mode("append").partitionBy(*partition_by).json(path))


def _write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str,
                       dynamic: bool) -> None:
    writer = df.hint("rebalance", *partition_by).write.mode(mode)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.partitionBy(*partition_by).parquet(path)


def write_silver(df: DataFrame, path: str, mode: str = "overwrite",
                 partition_by: Sequence[str] = ("symbol",), dynamic: bool = True) -> None:
    """SNK-2: a Silver table."""
    _write_partitioned(df, path, partition_by, mode, dynamic)


def write_gold(df: DataFrame, path: str, mode: str = "overwrite",
               partition_by: Sequence[str] = ("symbol",), dynamic: bool = True) -> None:
    """SNK-3: the Gold table."""
    _write_partitioned(df, path, partition_by, mode, dynamic)


def _blank(v) -> bool:
    return v is None or str(v).strip().lower() in ("", "none", "null", "n/a")


def publish_table(df: DataFrame, table: str = "market.crypto_daily", url: str | None = None,
                  user: str | None = None, password: str | None = None,
                  mode: str = "overwrite") -> str:
    """SNK-4: make Gold available as a SQL table.

    With a JDBC ``url`` the rows go to that database table; a blank or
    none/null/n-a URL means no external warehouse, and the table is saved in
    the session catalog instead; a write that fails leaves the old table as it
    is, and two renames put the new one in its place.  A run that dies between
    them leaves the old rows as ``{table}__old``; the next publish puts them
    back first.  Returns where it went.
    """
    if not _blank(url):
        opts = {"url": url, "dbtable": table}
        if not _blank(user):
            opts["user"] = user
        if not _blank(password):
            opts["password"] = password
        # keep the target's definition and grants: empty it, do not drop it
        df.write.format("jdbc").options(**opts, truncate="true", batchsize="10000").mode(mode).save()
        return "jdbc"
    spark = df.sparkSession
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    if mode != "overwrite":
        df.write.mode(mode).saveAsTable(table)
        return "catalog"
    # the new table is written beside the old one, which stays until then and goes only when the new has its name
    new, old = f"{table}__new_{uuid.uuid4().hex[:12]}", f"{table}__old"      # a failed write leaves a folder of that name
    if spark.catalog.tableExists(old):               # a run died here
        there = spark.catalog.tableExists(table)
        spark.sql(f"DROP TABLE {old}" if there else f"ALTER TABLE {old} RENAME TO {table}")
    df.write.saveAsTable(new)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    return "catalog"
