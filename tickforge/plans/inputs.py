"""Bar inputs derived from the driver tables (shared by catalog and bench)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.operators.clean import clean_bars
from tickforge.sources.bars import event_ticks, events_bars, lineitem_bars, table


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean hourly bars of the five event types."""
    return clean_bars(events_bars(table(spark, sf_dir, "events")), unique=True)


def daily_brand_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean daily bars of the part brands."""
    return clean_bars(lineitem_bars(table(spark, sf_dir, "lineitem"),
                                    table(spark, sf_dir, "part")), unique=True)


def minute_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw minute bars with repeated keys and an ingest order."""
    return event_ticks(table(spark, sf_dir, "events"))


def daily_returnflag_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean daily bars per return flag: three keys, each about a third of
    all lineitem rows."""
    return clean_bars(lineitem_bars(table(spark, sf_dir, "lineitem"), key="l_returnflag"), unique=True)
