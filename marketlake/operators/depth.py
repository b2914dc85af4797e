"""Order books and recent trades of an envelope as typed rows (BRZ-4 for depth and trades).

Both parts are landed as JSON text.  They are parsed as VARIANT: a part that is
no JSON, has another shape, or whose numbers are no numbers gives NULL at that
place and never fails or drops its document's other parts.  Everything happens
within a row (sort, cut, explode), so there is no shuffle, whatever the symbol.

Fixed values: ``{"bids": [[price, quantity], ...], "asks": [...]}`` and
``[{"id", "price", "qty", "time", "isBuyerMaker"}, ...]``, the exchange's
public payloads, numbers as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.scalar import parse_ts

DEPTH = 10
TRADES = 50


def _items(text: Column, path: str) -> Column:
    """The array at ``path`` of a JSON text as an array of VARIANT; NULL if there is none."""
    return F.try_variant_get(F.try_parse_json(text), path, "array<variant>")


def _number(v: Column, path: str) -> Column:
    """A number, or a text that is one; else NULL."""
    return F.try_variant_get(v, path, "string").try_cast("double")


def order_book_levels(envelopes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The ``depth`` best levels of each side: symbol, name, ingested_at, side, level (from 1), price, quantity.

    Best is the highest bid and the lowest ask, whatever the order in the
    payload; of equal prices the larger quantity comes first.  Levels without a
    positive price or with a null quantity do not count.
    """
    def side(path: str, sign: int) -> Column:
        levels = F.transform(_items(F.col("order_book"), path), lambda v: F.struct(
            (_number(v, "$[0]") * sign).alias("key"), (-_number(v, "$[1]")).alias("less")))
        good = F.filter(levels, lambda x: (x["key"] * sign > 0) & x["less"].isNotNull())
        return F.transform(F.slice(F.array_sort(good), 1, depth), lambda x, i: F.struct(
            (i + 1).alias("level"), (x["key"] * sign).alias("price"), (-x["less"]).alias("quantity")))

    sides = F.create_map(F.lit("bid"), F.coalesce(side("$.bids", -1), F.array()),
                         F.lit("ask"), F.coalesce(side("$.asks", 1), F.array()))
    rows = envelopes.select(F.col("metadata.symbol").alias("symbol"), F.col("metadata.name").alias("name"),
                            parse_ts("metadata.ingested_at").alias("ingested_at"),
                            F.explode(sides).alias("side", "levels"))
    return rows.select("symbol", "name", "ingested_at", "side", F.inline("levels"))


def recent_trades(envelopes: DataFrame, newest: int = TRADES) -> DataFrame:
    """The ``newest`` trades of each snapshot: symbol, name, ingested_at, trade_id, price, quantity, traded_at, buyer_is_maker.

    Newest by time, then id; trades without an id, a time or a positive price
    do not count.  ``buyer_is_maker`` is NULL if it is no boolean.
    """
    def trade(v: Column) -> Column:
        return F.struct(F.try_variant_get(v, "$.time", "bigint").alias("time"), F.try_variant_get(v, "$.id", "bigint").alias("id"),
                        _number(v, "$.price").alias("price"), _number(v, "$.qty").alias("quantity"),
                        F.try_variant_get(v, "$.isBuyerMaker", "boolean").alias("maker"))

    trades = F.transform(_items(F.col("recent_trades"), "$"), trade)
    good = F.filter(trades, lambda t: t["id"].isNotNull() & t["time"].isNotNull() & (t["price"] > 0))
    rows = envelopes.select(F.col("metadata.symbol").alias("symbol"), F.col("metadata.name").alias("name"),
                            parse_ts("metadata.ingested_at").alias("ingested_at"),
                            F.explode(F.slice(F.reverse(F.array_sort(good)), 1, newest)).alias("t"))
    return rows.select("symbol", "name", "ingested_at", F.col("t.id").alias("trade_id"), "t.price", "t.quantity",
                       F.timestamp_millis("t.time").alias("traded_at"), F.col("t.maker").alias("buyer_is_maker"))
