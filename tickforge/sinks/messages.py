"""Keyed message encoding (the producer side of the bar stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.schemas import STREAM_BAR

DATETIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def encode_bars(bars: DataFrame, key: str = "symbol") -> DataFrame:
    """``key`` = symbol (one symbol -> one Kafka partition, in order) and
    ``value`` = JSON bar with ``datetime`` as text."""
    fields = []
    for f in STREAM_BAR.fields:
        c = F.col(f.name)
        if f.name == "datetime" and dict(bars.dtypes).get("datetime") != "string":
            c = F.date_format(c, DATETIME_TEXT)
        fields.append(c.alias(f.name))
    return bars.select(F.col(key).cast("string").alias("key"),
                       F.to_json(F.struct(*fields)).alias("value"))


def write_messages(messages: DataFrame, path: str | None = None,
                   kafka_options: dict[str, str] | None = None) -> None:
    """Publish to Kafka when configured, else append JSON-lines message files."""
    if kafka_options is not None:
        messages.write.format("kafka").options(**kafka_options).save()
    else:
        messages.write.mode("append").json(path)
