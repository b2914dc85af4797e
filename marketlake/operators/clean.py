"""Row rules of the Silver layer (FLT-1..5).

The order of application is part of the semantics: drop invalid keys, then
deduplicate, then drop non-positive prices.  A non-key filter is never moved
below the dedup, since that changes which duplicate survives.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.scalar import as_col, is_valid_number


def drop_invalid(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """FLT-1: drop rows where any required column is NULL (or NaN for numbers).

    Same rows as ``DataFrame.dropna(subset=required)``.
    """
    return df.dropna(subset=list(required))


def keep_positive(df: DataFrame, col: str) -> DataFrame:
    """FLT-2: keep rows whose price is strictly positive."""
    return df.filter(F.col(col) > 0)


def _sort_exprs(cols: Iterable[str | Column], descending: bool) -> list[Column]:
    out = []
    for c in cols:
        c = as_col(c)
        out.append(c.desc_nulls_last() if descending else c.asc_nulls_last())
    return out


def dedup_latest(df: DataFrame, keys: Sequence[str], latest: str | Column | None = None,
                 tiebreak: Sequence[str | Column] = ()) -> DataFrame:
    """FLT-3/FLT-4: one row per key with a fixed survivor.

    The survivor has the greatest ``latest`` value (NULLs lose); remaining ties
    are broken by ``tiebreak`` ascending (NULLs last).  Planned as a
    ``row_number() = 1`` filter, which Catalyst turns into a
    ``WindowGroupLimit`` on both sides of the shuffle: each map task keeps one
    row per key before anything is shuffled, so a hot group of copies is
    reduced locally instead of being sent to one reducer.
    """
    order = _sort_exprs([latest], True) if latest is not None else []
    order += _sort_exprs(tiebreak, False)
    if not order:
        order = [F.lit(1)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def latest_n(df: DataFrame, n: int, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """BRZ-4: the ``n`` most recent rows per key (by ``order`` descending)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    w = Window.partitionBy(*keys).orderBy(*_sort_exprs(order, True))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") <= n)
              .drop("_rn"))


def select_symbols(df: DataFrame, symbols: Iterable[str] | None, col: str = "symbol") -> DataFrame:
    """FLT-5 / BRZ-3: keep the listed keys; ``None`` keeps everything.

    On a table partitioned by ``col`` this lands in ``PartitionFilters``.
    """
    if symbols is None:
        return df
    symbols = list(symbols)
    return df.filter(F.col(col).isin(symbols))


__all__ = ["drop_invalid", "keep_positive", "dedup_latest", "latest_n", "select_symbols",
           "is_valid_number"]
