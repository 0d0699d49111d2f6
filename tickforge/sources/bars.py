"""Bar scans (CSV, Parquet history) and adapters from the driver tables.

The adapters turn the synthetic tables into OHLCV bars with the same schema a
vendor feed would give: ``symbol STRING, datetime TIMESTAMP, open, high, low,
close, volume DOUBLE``.  They are grouped aggregations, so Spark combines
partial results map-side and a hot symbol never lands whole in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.schemas import RAW_BAR_CSV

BAR_COLUMNS = ["symbol", "datetime", "open", "high", "low", "close", "volume"]


def read_bars_csv(spark: SparkSession, path: str | list[str],
                  symbol_from_file: bool = False) -> DataFrame:
    """Header CSV bars with an explicit schema (never inferred: ``000001``).

    With ``symbol_from_file`` the files carry no symbol column and the symbol
    is the file name without extension (one file per symbol), so a glob over
    many files is one scan instead of a union of per-file reads.
    """
    if symbol_from_file:
        schema = RAW_BAR_CSV[:1]
        for f in RAW_BAR_CSV.fields[2:]:
            schema = schema.add(f)
    else:
        schema = RAW_BAR_CSV
    df = (spark.read.schema(schema).option("header", True)
          .option("mode", "PERMISSIVE").csv(path))
    if symbol_from_file:
        df = df.withColumn(
            "symbol",
            F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.[^./]*)?$", 1))
    return df.select(*BAR_COLUMNS)


def read_bars_parquet(spark: SparkSession, path: str, symbol: str | None = None,
                      merge_schema: bool = True) -> DataFrame:
    """Parquet bar history; files written at different times may differ in
    columns (captures lack ``timestamp``), so schemas are merged.  A symbol
    filter prunes ``symbol=`` partitions when the table is partitioned."""
    df = spark.read.option("mergeSchema", merge_schema).parquet(path)
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    return df


def load_symbol_history(spark: SparkSession, path: str, symbol: str) -> DataFrame:
    """All history of one symbol; an error when there is none."""
    df = read_bars_parquet(spark, path, symbol)
    if df.isEmpty():
        raise ValueError(f"no history for symbol {symbol!r} under {path}")
    return df


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Union-all by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def normalise_symbol(col: str | Column = "symbol") -> Column:
    """``SSE:000001`` -> ``000001`` (exchange prefix dropped)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, r"^.*:", "")


def _ohlcv(price: Column, order: Column, volume: Column) -> list[Column]:
    return [
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        volume.alias("volume"),
    ]


def events_bars(events: DataFrame, unit: str = "hour") -> DataFrame:
    """Bars from ``events``: symbol = event_type, bar = ``date_trunc(unit, ts)``,
    open/close = first/last ``value`` by ``(ts, event_id)``, volume = count."""
    return (events
            .groupBy(F.col("event_type").alias("symbol"),
                     F.date_trunc(unit, "ts").alias("datetime"))
            .agg(*_ohlcv(F.col("value"), F.struct("ts", "event_id"),
                         F.count(F.lit(1)).cast("double"))))


def event_ticks(events: DataFrame, unit: str = "minute") -> DataFrame:
    """One raw bar per event, stamped to its ``unit`` (a raw feed in which a
    key ``(symbol, datetime)`` can repeat).  ``ingest_order`` is ``(ts,
    event_id)``; cleaning keeps the first bar of a key in that order."""
    v = F.col("value")
    return events.select(
        F.col("event_type").alias("symbol"),
        F.date_trunc(unit, "ts").alias("datetime"),
        v.alias("open"), v.alias("high"), v.alias("low"), v.alias("close"),
        F.lit(1.0).alias("volume"),
        F.struct("ts", "event_id").alias("ingest_order"))


def lineitem_bars(lineitem: DataFrame, part: DataFrame | None = None,
                  key: str = "p_brand") -> DataFrame:
    """Daily bars per ``key`` from ``lineitem`` (``⋈ part`` when the key is a
    part column, e.g. the brand; ``l_returnflag`` needs no join).

    price = net unit price ``l_extendedprice * (1 - l_discount) / l_quantity``,
    open/close by ``(l_orderkey, l_linenumber)``, volume = ``sum(l_quantity)``.
    The join is left to the planner (AQE broadcasts ``part`` only after it
    measured it under the threshold); only the four needed columns of
    ``lineitem`` are read.
    """
    own = [key] if key in lineitem.columns else []
    li = lineitem.select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", *own,
        (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
         / F.col("l_quantity")).alias("price"))
    if not own:
        p = part.select(F.col("p_partkey").alias("l_partkey"), key)
        li = li.join(p, "l_partkey")
    return (li
            .groupBy(F.col(key).alias("symbol"),
                     F.date_trunc("day", "l_shipdate").alias("datetime"))
            .agg(*_ohlcv(F.col("price"), F.struct("l_orderkey", "l_linenumber"),
                         F.sum("l_quantity"))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
