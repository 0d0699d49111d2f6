"""tickforge — market-bar (OHLCV) analytics and forecasting on Spark.

Batch and streaming operators over bar tables: cleaning, EMA, min-max
features, sliding windows, per-symbol models (linear, tree, nearest
neighbours, recurrent network), evaluation metrics and upsert/append sinks.  All data
work is expressed with DataFrame / Window / pandas-function / Structured
Streaming APIs.
"""

from tickforge.session import get_spark  # noqa: F401

__all__ = ["get_spark"]
