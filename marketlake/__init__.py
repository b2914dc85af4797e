"""marketlake: a Spark-native market-data lake.

Bronze JSON envelopes -> Silver tickers and candles with technical
indicators -> Gold daily summaries, as batch DataFrame functions and as
Structured Streaming queries, plus serving views and data-quality checks.
"""

__version__ = "0.1.0"
