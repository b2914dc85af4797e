"""Ordered running computations without a whole-series window.

A window ``partitionBy(series).orderBy(t)`` puts every row of a series in one
task.  Market data has few series and long histories, so that caps the work at
one task per symbol.  ``index_series`` computes the global position of every
row and running sums with two levels instead:

1. per (series, granule) -- granule = ``date_trunc(unit, t)`` -- a row number
   and running sums inside the granule (parallel across granules);
2. per (series, granule) counts and totals, a hash aggregate with a partial
   (map-side) step -- its shuffle is one row per (series, granule) per map
   task -- turned into exclusive prefix sums over the granules of a series
   (a table of #series x #granules rows, not of data rows);
3. the two are joined on (series, granule).  The big side is already hash
   partitioned on that key by step 1, so only the small side moves; AQE turns
   the join into a broadcast when the prefix table is measured small enough at
   run time (``spark.sql.adaptive.autoBroadcastJoinThreshold``), and keeps a
   shuffle join otherwise.  Nothing is broadcast on an unchecked guess.

Rows with a NULL order value form their own granule that sorts first, the
same place ``ORDER BY t ASC`` (NULLS FIRST) puts them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Granule assigned to rows whose order value is NULL: earlier than any real one.
NULL_GRANULE = "0001-01-01 00:00:00"


# Same for a numeric order column.
NULL_NUMERIC_GRANULE = -(2 ** 62)


def add_nullable(a: str, b: str) -> Column:
    """a + b where NULL counts as "no rows yet" (as in sum()): NULL + x = x,
    and NULL + NULL stays NULL."""
    x, y = F.col(a), F.col(b)
    return F.when(x.isNull(), y).when(y.isNull(), x).otherwise(x + y)


def granule_of(order: Column, unit: str | int) -> Column:
    """``date_trunc(unit, order)`` for time orders; ``floor(order / unit)`` when
    ``unit`` is a number (numeric orders).  NULL orders get the sentinel granule."""
    if isinstance(unit, int):
        return F.coalesce(F.floor(order / F.lit(unit)).cast("long"), F.lit(NULL_NUMERIC_GRANULE))
    g = F.date_trunc(unit, order)
    return F.coalesce(g, F.to_timestamp(F.lit(NULL_GRANULE)))


def index_series(df: DataFrame, keys: Sequence[str], order: str,
                 sums: Mapping[str, Column] | None = None, unit: str | int = "day",
                 tiebreak: Sequence[str] = (), index_col: str = "_i",
                 start: DataFrame | None = None) -> DataFrame:
    """Add a 0-based position ``index_col`` within each series and running sums.

    ``sums`` maps an output name to an expression; the output column holds the
    sum of that expression over all rows of the series up to and including the
    current one, with ``RANGE`` semantics on ``order`` (rows with an equal
    order value share the value), i.e. exactly ``sum(e).over(partitionBy(keys)
    .orderBy(order))``.

    ``start`` continues series that already have earlier rows elsewhere (a
    stored table): one row per series with ``keys``, ``_i0`` (the position of
    the series' first row here) and, per sum, ``_s0_{name}`` (the running sum
    before it; NULL = nothing yet).  Series absent from ``start`` begin at 0.
    It is joined to the per-granule offsets table, never to the data rows.
    """
    sums = dict(sums or {})
    keys = list(keys)
    g = "_g"
    base = df.withColumn(g, granule_of(F.col(order), unit))
    for name, expr in sums.items():
        base = base.withColumn(f"_e_{name}", expr)

    in_g = Window.partitionBy(*keys, g).orderBy(F.col(order).asc_nulls_first(),
                                                 *[F.col(c).asc_nulls_last() for c in tiebreak])
    in_g_range = Window.partitionBy(*keys, g).orderBy(F.col(order).asc_nulls_first())
    local = base.withColumn("_j", F.row_number().over(in_g) - 1)
    for name in sums:
        local = local.withColumn(f"_r_{name}", F.sum(f"_e_{name}").over(in_g_range))

    # Per-granule counts and totals straight from the input, as a hash
    # aggregate with a map-side partial step: its shuffle carries one row per
    # (series, granule) per map task.  (Taking them from the window output
    # instead does not share the window's exchange -- column pruning gives the
    # two branches different projections -- and re-shuffles every row.)
    stats = base.groupBy(*keys, g).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(f"_e_{name}").alias(f"_t_{name}") for name in sums],
    )
    before = Window.partitionBy(*keys).orderBy(g).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(
        *keys, g,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off_n"),
        # NULL (not 0) when no earlier granule has a non-NULL value, as sum() does.
        *[F.sum(f"_t_{name}").over(before).alias(f"_off_{name}") for name in sums],
    )

    if start is not None:
        offsets = offsets.join(start, on=keys, how="left").select(
            *keys, g,
            (F.coalesce(F.col("_i0"), F.lit(0)) + F.col("_off_n")).alias("_off_n"),
            *[add_nullable(f"_s0_{name}", f"_off_{name}").alias(f"_off_{name}") for name in sums])

    joined = local.join(offsets, on=[*keys, g], how="inner")
    out = joined.withColumn(index_col, F.col("_off_n") + F.col("_j"))
    for name in sums:
        out = out.withColumn(name, add_nullable(f"_off_{name}", f"_r_{name}"))
    drop = [g, "_j", "_off_n"] + [f"_e_{n}" for n in sums] + [f"_r_{n}" for n in sums] \
        + [f"_off_{n}" for n in sums]
    return out.drop(*drop)


def running_sums(df: DataFrame, order: str, sums: Mapping[str, Column], fan: int = 1 << 16) -> DataFrame:
    """Running sums over a whole table by one ordered column of distinct values, no task with all rows.

    ``index_series`` without keys ends in one window over all granules.  Here
    the values are numbers and fall into blocks of ``fan`` (a power of two), so
    no window has more rows; the sums before each block are the same problem
    over the table of blocks, with as many levels as numbers of the column's
    type need.  At the top only the blocks of negative and of other numbers
    are left.  Dates count as days,
    timestamps as microseconds, and a NULL comes before all others.  The sums
    must be integers.
    """
    kind = df.schema[order].dataType
    number = {"date": F.unix_date, "timestamp": F.unix_micros,
              "timestamp_ntz": lambda c: F.unix_micros(F.col(c).cast("timestamp"))}.get(kind.simpleString(), F.col)(order)
    bits = {"date": 23, "tinyint": 7, "smallint": 15, "int": 31}.get(kind.simpleString(), 63)
    rows = df.withColumns({"_n": F.coalesce(number.cast("bigint"), F.lit(NULL_NUMERIC_GRANULE if bits == 63 else -(2 ** bits))),
                           **{f"_x_{name}": e.cast("bigint") for name, e in sums.items()}})
    before = _before(rows.groupBy("_n").agg(*[F.sum(f"_x_{name}").alias(f"_x_{name}") for name in sums]), list(sums), bits, fan)
    out = rows.join(before, "_n").withColumns({name: F.col(f"_b_{name}") + F.coalesce(F.col(f"_x_{name}"), F.lit(0))
                                               for name in sums})
    return out.drop("_n", *[f"_x_{name}" for name in sums], *[f"_b_{name}" for name in sums])


def _before(values: DataFrame, names: Sequence[str], bits: int, fan: int) -> DataFrame:
    """(_n, _b_{name}): the sums of _x_{name} over the rows with a smaller _n; |_n| is at most 2**bits."""
    if bits <= 0:                                    # -1 and 0 are left
        low = values.filter(F.col("_n") < 0).select((F.col("_n") + 1).alias("_n"), *[F.col(f"_x_{n}").alias(f"_b_{n}") for n in names])
        return values.select("_n").join(low, "_n", "left").select(
            "_n", *[F.coalesce(F.col(f"_b_{n}"), F.lit(0)).alias(f"_b_{n}") for n in names])
    inside = Window.partitionBy("_block").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    blocks = values.withColumn("_block", F.expr(f"(_n - pmod(_n, {int(fan)}L)) div {int(fan)}L"))
    above = _before(blocks.groupBy(F.col("_block").alias("_n")).agg(*[F.sum(f"_x_{n}").alias(f"_x_{n}") for n in names]),
                    names, bits - (fan.bit_length() - 1), fan)
    above = above.select(F.col("_n").alias("_block"), *[F.col(f"_b_{n}").alias(f"_a_{n}") for n in names])
    local = blocks.select("_n", "_block", *[F.coalesce(F.sum(f"_x_{n}").over(inside), F.lit(0)).alias(f"_b_{n}") for n in names])
    return local.join(above, "_block").select("_n", *[(F.col(f"_a_{n}") + F.col(f"_b_{n}")).alias(f"_b_{n}") for n in names])


def add_lookback_buckets(df: DataFrame, index_col: str, bucket_rows: int, lookback: int,
                         bucket_col: str = "_b", own_col: str = "_own") -> DataFrame:
    """Assign rows to buckets of ``bucket_rows`` consecutive positions and copy the
    last ``lookback`` rows of every bucket into the next one.

    A row-frame window over ``partitionBy(series, bucket)`` then sees, for every
    row it owns, the same ``lookback`` preceding rows a whole-series window
    sees.  Extra data moved: ``lookback / bucket_rows`` of the input.
    """
    if bucket_rows < lookback or bucket_rows < 1:
        raise ValueError(f"bucket_rows must be >= lookback ({lookback}); got {bucket_rows}")
    i = F.col(index_col)
    own = F.expr(f"`{index_col}` div {int(bucket_rows)}")
    tail = (i % F.lit(bucket_rows)) >= F.lit(bucket_rows - lookback)
    targets = F.when(tail & F.lit(lookback > 0), F.array(own, own + 1)).otherwise(F.array(own))
    return (df.withColumn("_own_b", own)
              .withColumn(bucket_col, F.explode(targets))
              .withColumn(own_col, F.col(bucket_col) == F.col("_own_b"))
              .drop("_own_b"))
