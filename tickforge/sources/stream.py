"""Keyed bar messages: decode (batch or stream) and the streaming sources.

A message is ``key`` = symbol and ``value`` = JSON bar.  Decoding is
PERMISSIVE: a value that is not valid JSON, or not a bar, yields nulls and
is left out by the ``close IS NOT NULL`` filter instead of failing the batch;
``rejected_messages`` gives these messages with the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators.clean import parse_datetime
from tickforge.schemas import STREAM_BAR, STREAM_BAR_SINGLE

MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])


def decode_bars(messages: DataFrame, schema: T.StructType = STREAM_BAR,
                value_col: str = "value") -> DataFrame:
    """``CAST(value AS STRING)`` -> struct by schema -> flat columns -> keep
    rows whose ``close`` parsed."""
    parsed = messages.select(
        F.from_json(F.col(value_col).cast("string"), schema,
                    {"mode": "PERMISSIVE"}).alias("d"))
    return parsed.select("d.*").where(F.col("close").isNotNull())


def timed_bars(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Decoded bars that have a symbol and a time, ``datetime`` as TIMESTAMP."""
    bars = decode_bars(messages, STREAM_BAR, value_col).withColumn("datetime", parse_datetime("datetime"))
    return bars.where("symbol IS NOT NULL AND datetime IS NOT NULL")


def rejected_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """(key, value, reason) of every message that ``timed_bars`` leaves out:
    ``not a bar`` (no close), ``no symbol`` or ``no time`` (none that parses),
    the first that holds.  Batch or stream; no shuffle."""
    text = F.col(value_col).cast("string")
    read = messages.select(F.col("key").cast("string").alias("key"), text.alias("value"),
                           F.from_json(text, STREAM_BAR, {"mode": "PERMISSIVE"}).alias("d"))
    reason = (F.when(F.col("d.close").isNull(), "not a bar")
              .when(F.col("d.symbol").isNull(), "no symbol")
              .when(parse_datetime(F.col("d.datetime")).isNull(), "no time"))
    return read.select("key", "value", reason.alias("reason")).where("reason IS NOT NULL")


def decode_single_symbol(messages: DataFrame, symbol: str,
                         value_col: str = "value") -> DataFrame:
    """Single-symbol messages (``date`` + OHLCV, no symbol): decode, then
    name the key ``datetime`` and add the symbol as a literal."""
    bars = decode_bars(messages, STREAM_BAR_SINGLE, value_col)
    return bars.select(F.lit(symbol).alias("symbol"), F.col("date").alias("datetime"),
                       "open", "high", "low", "close", "volume")


def read_message_stream(spark: SparkSession, path: str, fmt: str = "json",
                        max_files_per_trigger: int | None = None,
                        kafka_options: dict[str, str] | None = None) -> DataFrame:
    """Streaming messages with ``key``/``value`` columns.

    With ``kafka_options`` (``kafka.bootstrap.servers``, ``subscribe``…) the
    Kafka source is used (``startingOffsets=latest``, ``failOnDataLoss=false``
    unless given); otherwise a file source over ``path`` replays message
    files — the offline form used by tests and history replay.
    """
    if kafka_options is not None:
        opts = {"startingOffsets": "latest", "failOnDataLoss": "false", **kafka_options}
        return spark.readStream.format("kafka").options(**opts).load()
    reader = spark.readStream.schema(MESSAGE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """Model configuration JSON (one object per file or line) as rows."""
    from tickforge.schemas import MODEL_CONFIG
    return spark.read.schema(MODEL_CONFIG).option("multiLine", True).json(path)
