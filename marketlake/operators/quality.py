"""Data-quality and ingest-outcome operators (DQ-1..6).

Each check returns a DataFrame report; ``strict=True`` additionally raises
when the report shows a failure.  Reports are aggregates: nothing is
collected to the driver except the one-row emptiness probe of a strict check.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.functions.scalar import is_valid_number, safe_div
from marketlake.operators.scan import running_sums
from marketlake.session import scratch_path


class QualityError(ValueError):
    """A strict data-quality check failed."""


def _slot(df: DataFrame, time: str, unit: str):
    slot = F.date_trunc(unit, F.col(time))
    if dict(df.dtypes)[time] == "timestamp_ntz":
        slot = slot.cast("timestamp_ntz")
    return slot


# Chunk used to spread grid generation over tasks, per slot unit.
_GRID_CHUNK = {"second": "HOUR", "minute": "DAY", "hour": "DAY", "day": "YEAR", "month": "YEAR"}


def _slot_grid(spark, bounds: DataFrame, symbols: list[str], unit: str) -> DataFrame:
    """(symbol, slot) for every listed symbol and every slot in [lo, hi].

    Generated from the one-row bounds: first one row per (symbol, chunk) --
    #symbols x #days for hourly slots -- spread over the cluster with an
    explicit-width repartition (not coalesced away by AQE), then each chunk
    expands to its slots in its own task.  No cross join, no single task
    producing the whole grid.
    """
    unit = unit.lower()
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    syms = bounds.select(F.explode(F.array(*[F.lit(s) for s in symbols])).alias("symbol"), "lo", "hi")
    chunk = _GRID_CHUNK.get(unit)
    if chunk is None:
        return syms.select("symbol", F.explode(F.sequence("lo", "hi", step)).alias("slot"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    cstep = F.expr(f"INTERVAL 1 {chunk}")
    chunks = syms.select("symbol", "lo", "hi",
                         F.explode(F.sequence(F.date_trunc(chunk, "lo"), "hi", cstep)).alias("_c"))
    if dict(bounds.dtypes)["lo"] == "timestamp_ntz":
        chunks = chunks.withColumn("_c", F.col("_c").cast("timestamp_ntz"))
    chunks = chunks.repartition(width, "symbol", "_c")
    first = F.greatest(F.col("_c"), F.col("lo"))
    last = F.least(F.col("_c") + cstep - step, F.col("hi"))
    return chunks.select("symbol", F.explode(F.sequence(first, last, step)).alias("slot"))


def missing_partitions(present: DataFrame, symbols: Iterable[str], time: str = "ingested_at",
                       symbol_col: str = "symbol", unit: str = "hour", start=None, end=None,
                       strict: bool = False) -> DataFrame:
    """DQ-1: (symbol, slot) pairs expected but absent.

    Expected = every listed symbol for every ``unit`` slot from ``start`` to
    ``end`` (both default to the first / last slot present).  The listed
    symbols and the given bounds filter the input, so a check of one hour
    reads one hour; the input is read once.  The grid is
    generated from the parameters (``explode`` of a list and a ``sequence``),
    so its size is #symbols x #slots and independent of the row count; the
    present side is reduced to distinct (symbol, slot) with a map-side
    partial aggregate before it is shuffled.  Missing = grid LEFT ANTI present.
    """
    symbols = list(symbols)
    if not symbols:
        raise ValueError("symbols must not be empty")
    kind, spark = dict(present.dtypes)[time], present.sparkSession
    t = F.col(time)
    if start is not None:
        present = present.filter(t >= F.date_trunc(unit, F.lit(start)).cast(kind))
    if end is not None:
        present = present.filter(t < (F.date_trunc(unit, F.lit(end)) + F.expr(f"INTERVAL 1 {unit.upper()}")).cast(kind))
    # the bounds take every symbol's slots, the comparison only the listed ones'
    seen = present.select(F.col(symbol_col).alias("symbol"), _slot(present, time, unit).alias("slot")).distinct()
    if start is not None and end is not None:
        bounds = spark.range(1).select(*[F.date_trunc(unit, F.lit(x)).cast(dict(seen.dtypes)["slot"]).alias(n)
                                         for x, n in ((start, "lo"), (end, "hi"))])
    else:
        path = scratch_path(spark, "seen-slots")
        seen.write.parquet(path)
        seen = spark.read.parquet(path)
        lo = F.date_trunc(unit, F.lit(start)).cast(dict(seen.dtypes)["slot"]) if start is not None else F.min("slot")
        hi = F.date_trunc(unit, F.lit(end)).cast(dict(seen.dtypes)["slot"]) if end is not None else F.max("slot")
        bounds = seen.agg(lo.alias("lo"), hi.alias("hi"))
    grid = _slot_grid(spark, bounds, symbols, unit)
    missing = grid.join(seen.filter(F.col("symbol").isin(symbols)), on=["symbol", "slot"], how="left_anti")
    if strict and not missing.isEmpty():
        raise QualityError("missing partitions found")
    return missing


def missing_intervals(present: DataFrame, symbols: Iterable[str], time: str = "ingested_at",
                      symbol_col: str = "symbol", unit: str = "hour", granule: str = "day",
                      start=None, end=None) -> DataFrame:
    """DQ-1 as intervals: symbol, gap_from, gap_to (first and last missing slot), n_slots.

    The same slots as ``missing_partitions``, without its grid: the work
    follows the slots that are present.  Within a (symbol, ``granule``) each
    slot looks at the next one; between granules the last slot of one meets the
    first of the next, on a table of one row per symbol and granule.  The
    bounds enter that table as two rows per listed symbol, so gaps at the ends
    and symbols that are absent come out the same way.
    """
    symbols = sorted(set(symbols))
    if not symbols:
        raise ValueError("symbols must not be empty")
    kind, spark = dict(present.dtypes)[time], present.sparkSession
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    if start is not None:
        present = present.filter(F.col(time) >= F.date_trunc(unit, F.lit(start)).cast(kind))
    if end is not None:
        present = present.filter(F.col(time) < (F.date_trunc(unit, F.lit(end)) + step).cast(kind))
    path = scratch_path(spark, "seen-slots")
    present.select(F.col(symbol_col).alias("symbol"), _slot(present, time, unit).alias("slot")).distinct().write.parquet(path)
    seen = spark.read.parquet(path)
    slot = dict(seen.dtypes)["slot"]
    lo, hi = (F.date_trunc(unit, F.lit(x)).cast(slot) if x is not None else whole
              for x, whole in ((start, F.min("slot")), (end, F.max("slot"))))
    ends = (seen.agg(lo.alias("lo"), hi.alias("hi")).filter("lo IS NOT NULL AND hi IS NOT NULL")
            .withColumn("symbol", F.explode(F.array(*[F.lit(s) for s in symbols]))))
    own = seen.filter(F.col("symbol").isin(symbols) & F.col("slot").isNotNull()).withColumn("g", F.date_trunc(granule, "slot").cast(slot))

    def gap(after: Column, before: Column) -> list[Column]:
        return [(after + step).cast(slot).alias("gap_from"), (before - step).cast(slot).alias("gap_to")]

    following = F.lead("slot").over(Window.partitionBy("symbol", "g").orderBy("slot"))
    inner = own.withColumn("next", following).select("symbol", *gap(F.col("slot"), F.col("next")))
    edge = F.lit(None).cast(slot)
    parts = (own.groupBy("symbol", "g").agg(F.min("slot").alias("first"), F.max("slot").alias("last"))
             .select("symbol", F.lit(1).alias("at"), "g", "first", "last")
             .unionByName(ends.select("symbol", F.lit(0).alias("at"), edge.alias("g"), edge.alias("first"),
                                      (F.col("lo") - step).cast(slot).alias("last")))
             .unionByName(ends.select("symbol", F.lit(2).alias("at"), edge.alias("g"), (F.col("hi") + step).cast(slot).alias("first"),
                                      edge.alias("last"))))
    previous = F.lag("last").over(Window.partitionBy("symbol").orderBy("at", "g"))
    seams = parts.withColumn("previous", previous).select("symbol", *gap(F.col("previous"), F.col("first")))
    n = F.timestamp_diff(unit.upper(), "gap_from", "gap_to") + 1
    return inner.unionByName(seams).filter(F.col("gap_from") <= F.col("gap_to")).withColumn("n_slots", n)


def layer_presence(tables: Mapping[str, DataFrame], strict: bool = False,
                   count_rows: bool = True) -> DataFrame:
    """DQ-2/DQ-3: one row per table: (table, n_rows, present).

    ``count_rows=False`` only probes for one row (``limit(1)``), which reads a
    single split instead of the whole table.
    """
    parts = []
    for name, df in tables.items():
        src = df if count_rows else df.limit(1)
        parts.append(src.agg(F.count(F.lit(1)).alias("n_rows"))
                     .select(F.lit(name).alias("table"), "n_rows",
                             (F.col("n_rows") > 0).alias("present")))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    if strict:                                       # one probe per table: the report keeps the result
        rows = report.collect()
        report = report.sparkSession.createDataFrame(rows, report.schema)
        empty = [r["table"] for r in rows if not r["present"]]
        if empty:
            raise QualityError(f"layer missing or empty: {empty[0]}")
    return report


def table_presence(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet",
                   strict: bool = False) -> DataFrame:
    """DQ-2/DQ-3 over stored tables: a path that does not exist is reported absent."""
    from pyspark.errors import AnalysisException

    from marketlake.session import path_exists
    from marketlake.sinks import lake
    tables = {}
    for name, path in paths.items():
        table = None
        root, key = lake.locate(path)
        held = lake.snapshot(spark, root).tables
        if key in held:
            folders = sorted(f for day in held[key].values() for f in day)
            table = spark.read.format(fmt).load([f"{root}/{f}" for f in folders]) if folders else None
        elif not lake.is_lake(spark, root) and path_exists(spark, path):
            try:
                table = spark.read.format(fmt).load(path)
            except AnalysisException as e:
                # a table written from no rows has no data file to read a
                # schema from: it is there, but empty
                if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                    raise
        elif strict:
            raise QualityError(f"layer missing: {name} ({path})")
        tables[name] = table if table is not None else spark.range(0).select(F.lit(1).alias("x"))
    return layer_presence(tables, strict=strict, count_rows=False)


def rule_counts(df: DataFrame, keys: Iterable[str], price: str, latest: str | None = None) -> DataFrame:
    """DQ-4: how many rows each Silver rule removes, in rule order.

    Columns: n_input, n_invalid (NULL key / NULL or NaN price), n_duplicate,
    n_nonpositive (the surviving copy has price <= 0), n_output.

    Planned as two hash aggregates: per (valid, key) -- partial on the map
    side, so a hot key or the pile of invalid rows is pre-reduced -- then one
    global row.  The survivor of a key is its latest copy (``max_by``).
    """
    keys = list(keys)
    valid = F.col(keys[0]).isNotNull() & is_valid_number(price)
    survivor = F.max_by(price, F.col(latest)) if latest else F.min(price)
    per_key = df.groupBy(valid.alias("_valid"), *keys).agg(
        F.count(F.lit(1)).alias("_n"), survivor.alias("_p"))
    v, p = F.col("_valid"), F.col("_p")
    return per_key.agg(
        F.sum("_n").alias("n_input"),
        F.coalesce(F.sum(F.when(~v, F.col("_n"))), F.lit(0)).alias("n_invalid"),
        F.coalesce(F.sum(F.when(v, F.col("_n") - 1)), F.lit(0)).alias("n_duplicate"),
        F.count_if(v & ~(p > 0)).alias("n_nonpositive"),
        F.count_if(v & (p > 0)).alias("n_output"),
    )


def ingest_totals(log: DataFrame, cycle: str = "cycle", ok: str = "ok",
                  granule: str | int | None = None) -> DataFrame:
    """DQ-5: per cycle passed/total, and running ok / fail / success %.

    The running totals come from ``running_sums`` over the per-cycle rows, in
    blocks of 65,536 cycle numbers: no window has more rows, and none spans the
    table.  Cycles are whole numbers, dates or timestamps.  A number as
    ``granule`` sets the size of the blocks (the next power of two, from 1024
    on); a time unit, which the blocks do not need, changes nothing.
    """
    fan = 1 << 16 if not isinstance(granule, int) else max(1024, 1 << (granule - 1).bit_length())
    per = log.groupBy(cycle).agg(
        F.count_if(F.col(ok)).alias("passed"),
        F.count(F.lit(1)).alias("total"),
    )
    spark = log.sparkSession                         # one row a cycle, written: each level reads it, none the log
    staged = scratch_path(spark, "cycles")
    per.write.parquet(staged)
    per = spark.read.schema(per.schema).parquet(staged)
    run = running_sums(per, cycle, {"cum_ok": F.col("passed"), "cum_fail": F.col("total") - F.col("passed")}, fan)
    return run.withColumn(
        "success_pct",
        safe_div(F.col("cum_ok") * F.lit(100.0), F.col("cum_ok") + F.col("cum_fail")))


def slow_cycles(log: DataFrame, interval_seconds: float, elapsed: str = "elapsed_s") -> DataFrame:
    """DQ-6: flag cycles that took longer than the poll interval."""
    return log.withColumn("slow", F.col(elapsed) > F.lit(float(interval_seconds)))
