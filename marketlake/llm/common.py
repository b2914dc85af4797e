"""Helpers shared by the training-data operators.

Where an operator must find a row again after a shuffle it uses
``with_row_key``: a 64-bit key of the row's place in its file, equal in every
evaluation of the plan, whatever columns the table has and however often a row
is repeated.  What is no Parquet scan (a union, an in-memory frame) has no such
places: whoever keys it twice has to key the same ``as_table``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import scratch_path

#: words of every contract: runs without ASCII white space (bytes.split() in Python)
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh folder under ``spark.checkpoint.dir`` and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_table(df: DataFrame) -> bool:
    """Whether ``df`` is one Parquet scan, perhaps with columns or rows left out: each row has one place in a file."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias") and node.deterministic():
        node = node.children().apply(0)
    return node.nodeName() == "LogicalRelation" and node.simpleString(100).rstrip().endswith("parquet")


def as_table(df: DataFrame) -> DataFrame:
    """``df`` itself if it is a Parquet scan, else a written copy."""
    return df if is_table(df) else save(df, "rows")


def with_row_key(df: DataFrame, name: str = "_row_key", columns: dict | None = None) -> DataFrame:
    """Add a stable 64-bit key of (file, row number) to ``df``, or to the columns asked for.

    A frame that is no file scan is written first (see ``as_table``), so its keys hold for this call only.
    """
    df = as_table(df)
    meta = df.metadataColumn("_metadata")
    key = F.xxhash64(meta["file_path"], meta["row_index"])
    return (df.withColumn(name, key) if columns is None
            else df.select(*[c.alias(n) for n, c in columns.items()], key.alias(name)))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs``, a table, without the rows whose keys (column row_key) are in ``dropped``; same columns."""
    key = fresh(docs, "_row_key")
    gone = dropped.select(F.col("row_key").alias(key))
    return with_row_key(docs, key).join(gone, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def crc_mod(doc_id: str, n: int):
    """crc32 of the id as text modulo n; -1 for a null id (so it never equals a remainder)."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")), F.lit(n)),
                      F.lit(-1))


def text_or_empty(text: str):
    return F.coalesce(F.col(text), F.lit(""))
