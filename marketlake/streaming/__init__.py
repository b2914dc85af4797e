"""Structured Streaming forms of the Bronze read, dedup, Gold and candles (STR-1..6)."""

from marketlake.streaming.bronze_stream import (  # noqa: F401
    compact_bronze,
    dedup_tickers,
    gold_daily_stream,
    run_to_completion,
    start,
    stream_bronze,
)
from marketlake.streaming.candle_upsert import candle_upsert_query, read_candles, upsert_all, upsert_candles  # noqa: F401,E402
from marketlake.streaming.pipeline import await_all, compact_landing, drain_landing, each_batch, start_streams, ticker_query  # noqa: F401,E402
from marketlake.streaming.late import closed_days_query, late_counts, read_late, repair_late  # noqa: F401,E402
