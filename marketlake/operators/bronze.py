"""Bronze shaping (BRZ-1..3): positional candles, the envelope, asset selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.clean import select_symbols
from pyspark.sql import types as T

from marketlake.schemas import KLINE, KLINE_FIELDS, KLINE_LONG_FIELDS, TICKER, TICKER_STRING_FIELDS

PIPELINE_VERSION = "3.0.0"


def positional_to_struct(raw: str | Column) -> Column:
    """BRZ-1: ``array<array<string>>`` of 12 positional values per candle ->
    ``array<struct<open_time, open, ..., ignore>>``.

    ``get`` gives NULL past the end of a short candle (like ``zip`` truncation
    leaving the field out); long fields are ``try_cast`` so bad text is NULL.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw

    def one(c: Column) -> Column:
        fields = []
        for i, name in enumerate(KLINE_FIELDS):
            v = F.get(c, i)
            if name in KLINE_LONG_FIELDS:
                v = v.try_cast("long")
            fields.append(v.alias(name))
        return F.struct(*fields)

    return F.transform(raw, one)


def struct_to_positional(klines: str | Column) -> Column:
    """Inverse of ``positional_to_struct``: candles back to positional text arrays."""
    klines = F.col(klines) if isinstance(klines, str) else klines
    return F.transform(klines, lambda k: F.array(*[k[f].cast("string") for f in KLINE_FIELDS]))


def iso_utc(ts: str | Column) -> Column:
    """Timestamp -> ISO-8601 text with offset, microseconds kept (``...+00:00``)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def build_envelope(df: DataFrame, name: str | Column, symbol: str | Column,
                   ingested_at: str | Column, ticker: Column | None = None,
                   klines: dict[str, Column] | None = None, source: str = "exchange",
                   asset_class: str = "crypto", order_book: Column | None = None,
                   recent_trades: Column | None = None) -> DataFrame:
    """BRZ-2: one envelope row per input row: ``metadata`` + the six parts.

    Parts not given are NULL, as when a fetch failed.  ``to_json`` of the
    result is the file form of one document.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    klines = klines or {}
    meta = F.struct(
        col(name).alias("name"), col(symbol).alias("symbol"), F.lit(source).alias("source"),
        F.lit(asset_class).alias("asset_class"), iso_utc(col(ingested_at)).alias("ingested_at"),
        F.lit(PIPELINE_VERSION).alias("pipeline_ver"))
    null = F.lit(None)
    return df.select(
        meta.alias("metadata"),
        (ticker if ticker is not None else null.cast(TICKER)).alias("ticker"),
        (order_book if order_book is not None else null.cast("string")).alias("order_book"),
        (recent_trades if recent_trades is not None else null.cast("string")).alias("recent_trades"),
        *[(klines[a] if a in klines else null.cast(T.ArrayType(KLINE))).alias(a)
          for a in ("klines_1m", "klines_5m", "klines_1h")],
    )


def ticker_struct(**cols: Column) -> Column:
    """A payload ticker struct from columns (numbers rendered as text)."""
    fields = [cols[f].cast("string").alias(f) if f in cols else F.lit(None).cast("string").alias(f)
              for f in TICKER_STRING_FIELDS]
    count = cols.get("count")
    fields.append((count.cast("long") if count is not None else F.lit(None).cast("long")).alias("count"))
    return F.struct(*fields)


def select_assets(df: DataFrame, names: Iterable[str] | None, col: str = "metadata.name") -> DataFrame:
    """BRZ-3: keep the listed assets; ``None`` keeps all."""
    if names is None:
        return df
    return df.filter(F.col(col).isin(list(names)))


__all__ = ["positional_to_struct", "struct_to_positional", "build_envelope", "ticker_struct",
           "select_assets", "select_symbols", "iso_utc"]
