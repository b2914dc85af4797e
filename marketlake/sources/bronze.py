"""Bronze JSON readers (SRC-1..5).

Bronze documents are read with a fixed schema (no inference pass), in
PERMISSIVE mode with the raw text of unparseable documents kept in
``_corrupt_record``, so one damaged file never fails or silently empties a run.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.schemas import BRONZE, COMPACT_BRONZE, CORRUPT, TICK
from marketlake.sources.silver import read_stored

# Fixed value: the exchange landing layout {prefix}/{name}/YYYY/MM/DD/HH/{file}.json
PATH_PATTERN = r"/([^/]+)/(\d{4})/(\d{2})/(\d{2})/(\d{2})/[^/]+$"


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _roots(root: str, date, assets) -> list[str]:
    names = sorted(assets) if assets is not None else ["*"]
    return [_date_glob(root, date, n) if date is not None else f"{root.rstrip('/')}/{n}" for n in names]


def _date_glob(root: str, date, name: str) -> str:
    if isinstance(date, str):
        date = _dt.date.fromisoformat(date.replace("/", "-"))
    # down to the hour folders: #assets x 24 root paths, which is above
    # Spark's parallel-listing threshold, so the listing runs on executors
    return f"{root.rstrip('/')}/{name}/{date:%Y}/{date:%m}/{date:%d}/*"


def read_bronze(spark: SparkSession, paths: str | Sequence[str], date=None,
                multiline: bool = True, layout: str = "exchange",
                assets: Sequence[str] | None = None) -> DataFrame:
    """SRC-1/3/5: Bronze envelopes, one row per document, plus ``_file``.

    * ``layout="exchange"``: ``{name}/YYYY/MM/DD/HH/`` folders, one
      pretty-printed document per file (``multiline``), read recursively;
      ``date`` (date or ``YYYY-MM-DD``/``YYYY/MM/DD``) narrows the listing to
      that day's folders; ``path_name, year, month, day, path_hour`` are parsed
      from the path (the landing time, not the event time).  ``assets`` narrows
      the listing to these names' folders.
    * ``layout="hive"``: the ``name=/date=/hour=`` layout of ``write_bronze``
      (NDJSON); ``date`` becomes a partition filter.
    * ``layout="compact"``: the Parquet table of ``streaming.compact_bronze`` or
      ``streaming.compact_landing``, by (asset and) event day; ``date`` and ``assets`` become partition filters.
    """
    reader = (spark.read.schema(BRONZE)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT))
    roots = _as_list(paths)
    if layout == "exchange":
        if date is not None or assets is not None:
            roots = [g for r in roots for g in _roots(r, date, assets)]
        df = (reader.option("multiline", multiline).option("recursiveFileLookup", True)
              .json(roots))
        df = df.withColumn("_file", F.col("_metadata.file_path"))
        return with_path_partitions(df, "_file")
    if layout == "hive":
        df = reader.option("multiline", multiline).json(roots).withColumn(
            "_file", F.col("_metadata.file_path"))
        if date is not None:
            d = date if isinstance(date, _dt.date) else _dt.date.fromisoformat(str(date).replace("/", "-"))
            df = df.filter(F.col("date") == F.lit(d))
        return df
    if layout == "compact":
        table = None if not isinstance(paths, str) else read_stored(spark, paths, COMPACT_BRONZE)
        df = spark.read.schema(COMPACT_BRONZE).parquet(*_as_list(paths)) if table is None else table
        if date is not None:
            d = date if isinstance(date, _dt.date) else _dt.date.fromisoformat(str(date).replace("/", "-"))
            df = df.filter(F.col("date") == F.lit(d))
        return df if assets is None else df.filter(F.col("name").isin(list(assets)))
    raise ValueError(f"unknown layout {layout!r}")


def with_path_partitions(df: DataFrame, file_col: str = "_file") -> DataFrame:
    """SRC-5: asset name and Y/M/D/H parsed from the landing path.

    The exchange layout is not ``key=value``, so Spark's partition discovery
    cannot see it; a path that does not match gives NULLs.
    """
    f = F.col(file_col)

    def part(i: int):
        v = F.regexp_extract(f, PATH_PATTERN, i)
        return F.when(v != "", v)

    return df.withColumns({
        "path_name": part(1),
        "year": part(2).try_cast("int"),
        "month": part(3).try_cast("int"),
        "day": part(4).try_cast("int"),
        "path_hour": part(5).try_cast("int"),
    })


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC-2: (good documents, quarantine rows ``(_file, metadata, _corrupt_record)``).

    The quarantine keeps the file path and raw text so a damaged file can be
    found and re-landed, plus whatever metadata could be parsed (also needed
    because Spark refuses a raw-JSON query that references only the corrupt
    record column); all other files are unaffected.
    """
    bad_flag = F.col(CORRUPT).isNotNull()
    good = df.filter(~bad_flag).drop(CORRUPT)
    bad = df.filter(bad_flag).select("_file", "metadata", CORRUPT)
    return good, bad


def read_ticks(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """SRC-4: newline-delimited ``{symbol, price}`` ticks; ``price`` parsed to
    double (bad text -> NULL).  Never ``multiline``: that would read only the
    first document of each file."""
    df = spark.read.schema(TICK).option("mode", "PERMISSIVE").json(_as_list(paths))
    return df.select("symbol", F.col("price").try_cast("double").alias("price"))
