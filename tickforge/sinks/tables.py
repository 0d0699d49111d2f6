"""Table writers: captures, batch CSVs, history, models, prediction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.operators.clean import latest_per_key
from tickforge.schemas import MODEL_LABELS


def write_history(bars: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Clean history, partitioned by symbol and time-sorted inside each file
    (symbol filters prune folders; row-group statistics on ``datetime`` act
    as the (symbol, time) index)."""
    # a symbol's history is split by month, so no task writes all of it
    (bars.repartition("symbol", F.date_trunc("month", F.col("datetime").cast("timestamp")))
     .sortWithinPartitions("symbol", "datetime")
     .write.mode(mode).partitionBy("symbol").parquet(path))


def append_capture(bars: DataFrame, path: str, batch_id: int) -> None:
    """Bars + EMA5 of one micro-batch, idempotent per batch: a replayed batch
    overwrites its own ``batch_id`` partitions only."""
    (bars.withColumn("batch_id", F.lit(int(batch_id)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("symbol", "batch_id").parquet(path))


def write_batch_csv(df: DataFrame, base: str, batch_id: int) -> str:
    """One header CSV folder per micro-batch (replay-safe: overwrite)."""
    out = f"{base.rstrip('/')}/batch_id={int(batch_id)}"
    df.write.mode("overwrite").option("header", True).csv(out)
    return out


def append_new_bars_csv(snapshot: DataFrame, path: str, keys: str = "symbol") -> None:
    """Append the newest bar per symbol of a polled snapshot to CSV history."""
    latest_per_key(snapshot, keys).write.mode("append").option("header", True).csv(path)


def write_models(models: DataFrame, path: str) -> None:
    """Model / scaler / config rows per symbol; re-training a symbol replaces
    only that symbol's partition."""
    (models.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("symbol").parquet(path))


def to_long(wide: DataFrame, labels: list[tuple[str, str]] = MODEL_LABELS,
            actual: str = "actual_price", time_col: str = "datetime",
            decimals: int = 6) -> DataFrame:
    """Wide prediction rows -> one row per model.

    ``id`` = ``xxhash64(symbol, time, model_type)`` (stable across retries),
    ``timestamp`` = the bar's event time, prices rounded to ``decimals``.
    """
    stacked = F.explode(F.array(*[
        F.struct(F.lit(label).alias("model_type"), F.col(col).alias("predicted_price"))
        for label, col in labels]))
    df = wide.select("symbol", F.col(time_col).alias("timestamp"),
                     F.col(actual).alias("actual_price"), stacked.alias("_m"))
    return df.select(
        F.xxhash64("symbol", "timestamp", "_m.model_type").alias("id"),
        "symbol",
        F.round("_m.predicted_price", decimals).alias("predicted_price"),
        F.round("actual_price", decimals).alias("actual_price"),
        F.col("_m.model_type").alias("model_type"),
        F.col("timestamp").cast("timestamp").alias("timestamp"))


def show_batch(df: DataFrame, n: int = 20) -> None:
    """Console sink for a batch."""
    df.show(n, truncate=False)
