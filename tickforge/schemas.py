"""Fixed schemas of the bar data model."""

from __future__ import annotations

from pyspark.sql import types as T

# The OHLCV column names and the two feature layouts.
BAR_VALUE_COLS = ["open", "high", "low", "close", "volume"]
FEATURES_G1 = ["open", "high", "low", "close", "volume", "EMA5"]
FEATURES_G2 = ["open", "high", "low", "close", "volume", "timestamp", "EMA5"]
TARGET_COL = "close"
DEFAULT_SEQ_LEN = 3

# Model labels of the long prediction table, by wide column.
MODEL_LABELS = [
    ("LinearRegression", "pred_linear"),
    ("DecisionTree", "pred_dt"),
    ("KNN", "pred_knn"),
    ("Recurrent", "pred_recurrent"),
]

RAW_BAR_CSV = T.StructType([
    T.StructField("datetime", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

# Keyed stream message (value JSON); the key is the symbol.
STREAM_BAR = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("datetime", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

# Single-symbol stream message (no symbol, key column ``date``).
STREAM_BAR_SINGLE = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

MODEL_CONFIG = T.StructType([
    T.StructField("seq_len", T.IntegerType()),
    T.StructField("input_size", T.IntegerType()),
    T.StructField("hidden_size", T.IntegerType()),
    T.StructField("features_cols", T.ArrayType(T.StringType())),
    T.StructField("target_col", T.StringType()),
    T.StructField("target_col_idx", T.IntegerType()),
])
