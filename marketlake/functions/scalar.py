"""Scalar column expressions (PRJ-2..8).

All of these stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.schemas import KLINE_ARRAYS


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_double(c: str | Column) -> Column:
    """Decimal text -> double; unparseable text -> NULL (``try_cast``, ANSI-safe)."""
    return as_col(c).try_cast("double")


def parse_ts(c: str | Column) -> Column:
    """ISO-8601 text (with or without offset) -> TIMESTAMP; bad text -> NULL."""
    return F.try_to_timestamp(as_col(c))


def epoch_ms_to_ts(c: str | Column) -> Column:
    """Epoch milliseconds (long) -> TIMESTAMP, exact to the millisecond."""
    return F.timestamp_millis(as_col(c))


def interval_label(array_name: str) -> Column:
    """``klines_1m`` -> literal ``1m``; only the three landed arrays are accepted."""
    if array_name not in KLINE_ARRAYS:
        raise ValueError(f"unknown candle array {array_name!r}; expected one of {sorted(KLINE_ARRAYS)}")
    return F.lit(KLINE_ARRAYS[array_name])


def safe_div(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(as_col(num), as_col(den))


def is_valid_number(c: str | Column) -> Column:
    """Not NULL and not NaN -- what ``DataFrame.dropna`` keeps for a double."""
    x = as_col(c)
    return x.isNotNull() & ~F.isnan(x)


def typical_price(high: str | Column, low: str | Column, close: str | Column) -> Column:
    return (as_col(high) + as_col(low) + as_col(close)) / F.lit(3)
