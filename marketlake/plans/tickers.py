"""Silver tickers and the daily Gold, merged by (symbol, day) or rebuilt.

Batch runs and the stream write these tables through ``merge_tickers`` only.
A merge reads the stored days that the new snapshots fall on, lets the fixed
survivor win among copies of a snapshot, and replaces just those days; other
symbols' rows of such a day are carried over as they are.  Snapshots that the
price rule takes out are remembered (table ``tickers_removed``), so the result
does not depend on how the input was cut into runs.  Silver, Gold and the
removed snapshots change in one commit of the lake (``sinks.lake``): a run that
dies leaves all of them as they were, and two writers lose nothing.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.clean import dedup_latest, drop_invalid
from marketlake.operators.gold import build_gold_daily
from marketlake.operators.silver import TICKER_VALUE_COLUMNS, project_ticker
from marketlake.paths import Paths
from marketlake.schemas import GOLD_DAILY, SILVER_TICKERS
from marketlake.session import delete_path, scratch_path
from marketlake.sinks import lake

GOLD_TABLE = "daily_summary"
PARTITION = ("symbol", "date")
# Row counts observed after each ticker rule (DQ-4), in rule order.
TICKER_STEPS = ("input", "valid", "unique", "output")


def _survivors(df: DataFrame) -> DataFrame:
    return dedup_latest(df, ["symbol", "ingested_at"], None,
                        tiebreak=["name", "asset_class", *TICKER_VALUE_COLUMNS])


def _positive(price: str = "last_price"):
    return F.coalesce(F.col(price) > 0, F.lit(False))


def _on_days(df: DataFrame, days: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on (symbol, day); snapshots without an event time share the null day."""
    d = days.select(F.col("symbol").alias("_s"), F.col("date").alias("_d"))
    return df.join(d, (F.col("symbol") == F.col("_s")) & F.col("date").eqNullSafe(F.col("_d")), how)


def observed_tickers(good: DataFrame) -> tuple[DataFrame, list[Observation]]:
    """Unique tickers with a flag ``_kept`` (positive price), and the DQ-4 row
    counts gathered in the same pass (filled when a write runs; no extra job)."""
    obs = [Observation(f"ticker_{n}") for n in TICKER_STEPS[:3]]
    df = project_ticker(good).observe(obs[0], F.count(F.lit(1)).alias("n_input"))
    df = drop_invalid(df, ["symbol", "last_price"]).observe(obs[1], F.count(F.lit(1)).alias("n_valid"))
    df = _survivors(df).withColumn("_kept", _positive())
    return df.observe(obs[2], F.count(F.lit(1)).alias("n_unique"),
                      F.count_if("_kept").alias("n_output")), obs


def _counts(observations: list[Observation], good: DataFrame) -> dict[str, int]:
    """The DQ-4 counts.  When a stage produces no rows, AQE replaces the plan
    above it with an empty relation and every ``observe`` in it reports
    nothing; only then are those steps counted with separate jobs."""
    from py4j.protocol import Py4JJavaError
    counts: dict[str, int] = {}
    for i, o in enumerate(observations):
        try:
            counts.update(o.get)
        except Py4JJavaError:
            frame = project_ticker(good)
            frame = drop_invalid(frame, ["symbol", "last_price"]) if i else frame
            counts[f"n_{TICKER_STEPS[i]}"] = (_survivors(frame) if i == 2 else frame).count()
    return {f"n_{s}": counts.get(f"n_{s}", 0) for s in TICKER_STEPS}


def _names(paths: Paths) -> tuple[str, str, str, str]:
    root, silver = lake.locate(paths.silver_table("tickers"))
    return root, silver, f"{silver}_removed", lake.locate(paths.gold_table(GOLD_TABLE))[1]


def stage_tickers(spark: SparkSession, new: DataFrame, paths: Paths, at: lake.Snapshot, replace: bool = False,
                  now: _dt.datetime | None = None) -> lake.Change:
    """Stage the merge of unique tickers with a flag ``_kept`` (a written table) into the lake as of ``at``."""
    root, silver, removed, gold = _names(paths)
    columns = [f.name for f in SILVER_TICKERS]
    days = lake.days_of(new)
    keys = new.select(*PARTITION).distinct()
    if replace:
        rows, gone = new.filter("_kept").select(*columns), new.filter(~F.col("_kept")).select(*columns)
        summary = build_gold_daily(rows, now=now).select([f.name for f in GOLD_DAILY])
    else:
        stored = lake.read(spark, at, silver, SILVER_TICKERS, days)
        taken = lake.read(spark, at, removed, SILVER_TICKERS, days)
        parts = new.select(*columns)
        for held in (stored, taken):
            parts = parts.unionByName(_on_days(held, keys, "left_semi"))
        scratch = scratch_path(spark, "tickers-merged")
        merged = _survivors(parts).withColumn("_kept", _positive())
        merged.write.parquet(scratch)
        merged = spark.read.schema(merged.schema).parquet(scratch)
        rows = merged.filter("_kept").select(*columns)
        # the touched (symbol, day)s are whole in ``rows``; what the days hold besides is carried over
        summary = build_gold_daily(rows, now=now).select([f.name for f in GOLD_DAILY]).unionByName(
            _on_days(lake.read(spark, at, gold, GOLD_DAILY, days), keys, "left_anti"))
        rows = rows.unionByName(_on_days(stored, keys, "left_anti"))
        gone = merged.filter(~F.col("_kept")).select(*columns).unionByName(_on_days(taken, keys, "left_anti"))
    change = lake.Change()
    out = {silver: (rows, ("symbol", "ingested_at")), removed: (gone, ("symbol", "ingested_at")), gold: (summary, ("symbol",))}
    with ThreadPoolExecutor(len(out)) as pool:                       # three writes that do not need each other
        writes = {name: pool.submit(lake.stage, df, root, name, cluster) for name, (df, cluster) in out.items()}
    for name, write in writes.items():
        written = {d: f for (d,), f in write.result().items()}
        change.days[name] = {**dict.fromkeys(days), **written}
        if replace:
            change.whole.add(name)
            change.days[name] = written
    if not replace:
        delete_path(spark, scratch)
    return change


def merge_tickers(spark: SparkSession, good: DataFrame, paths: Paths, replace: bool = False,
                  now: _dt.datetime | None = None,
                  on_staged: Callable[[lake.Change], None] | None = None) -> dict[str, int]:
    """Merge the tickers of Bronze envelopes into Silver and refresh Gold for
    the days they touch; ``replace=True`` rebuilds both tables from ``good``
    alone.  Returns the DQ-4 counts of ``good``.

    The day of a snapshot is its own event time, whatever folder it landed in.
    ``on_staged``: see ``lake.update``.
    """
    scratch = scratch_path(spark, "tickers")
    tickers, observations = observed_tickers(good)
    tickers.write.parquet(scratch)
    counts = _counts(observations, good)
    new = spark.read.schema(tickers.schema).parquet(scratch)
    if replace or not new.isEmpty():
        lake.update(spark, _names(paths)[0], lambda at: stage_tickers(spark, new, paths, at, replace, now),
                    on_staged=on_staged)
    delete_path(spark, scratch)
    return counts
