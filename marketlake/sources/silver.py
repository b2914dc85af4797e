"""Silver / Gold Parquet readers (SRC-6)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from marketlake.operators.clean import select_symbols
from marketlake.session import path_exists
from marketlake.sinks import lake


def read_stored(spark: SparkSession, path: str, schema: StructType, at: lake.Snapshot | None = None,
                days: Iterable[str] | None = None) -> DataFrame | None:
    """A stored table, or None when there is none.

    A table of a lake is read as of the snapshot ``at`` (default: now), so two
    tables read with one snapshot belong together; ``days`` opens only the
    folders of these days.  Any other path is plain Parquet.
    """
    root, table = lake.locate(path)
    at = at or lake.snapshot(spark, root)
    if table in at.tables:
        return lake.read(spark, at, table, schema, days)
    return spark.read.schema(schema).parquet(path) if not lake.is_lake(spark, root) and path_exists(spark, path) else None


def read_layer(spark: SparkSession, path: str, schema: StructType, symbols: Iterable[str] | None = None,
               at: lake.Snapshot | None = None, days: Iterable[str] | None = None) -> DataFrame:
    """A Silver or Gold table with its fixed schema; a filter on ``symbols`` skips row groups (or ``symbol=`` folders).

    The schema also types the partition columns (symbol ``"007"`` stays text),
    and a table without rows reads as an empty one.
    """
    df = read_stored(spark, path, schema, at, days)
    return select_symbols(spark.read.schema(schema).parquet(path) if df is None else df, symbols)
