"""Forecast evaluation and prediction-table reads.

All metrics are grouped aggregations (``avg`` of squared / absolute /
percentage error) that Spark combines per map task, so they cost one small
shuffle regardless of how rows spread over symbols.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.operators.sequence import DEFAULT_BLOCK_ROWS, ordered_frame


def squared_error(pred: Column, actual: Column) -> Column:
    return (pred - actual) * (pred - actual)


def absolute_error(pred: Column, actual: Column) -> Column:
    return F.abs(pred - actual)


def percentage_error(pred: Column, actual: Column) -> Column:
    """|(p - a) / a|; null when a = 0 (left out of averages)."""
    return F.abs(F.try_divide(pred - actual, actual))


def error_metrics(pred_long: DataFrame, keys: list[str], pred: str = "predicted_price",
                  actual: str = "actual_price", decimals: int | None = None) -> DataFrame:
    """n, MSE, RMSE, MAE and MAPE (percent) per ``keys``."""
    p, a = F.col(pred), F.col(actual)
    out = (pred_long.groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("n"),
                F.avg(squared_error(p, a)).alias("mse"),
                F.avg(absolute_error(p, a)).alias("mae"),
                (F.avg(percentage_error(p, a)) * F.lit(100.0)).alias("mape"))
           .withColumn("rmse", F.sqrt("mse")))
    if decimals is not None:
        out = out.withColumns({c: F.round(c, decimals) for c in ("mse", "rmse", "mae", "mape")})
    return out


def dashboard_metrics(pred_long: DataFrame, models: list[str], keys: str = "symbol",
                      model_col: str = "model_type") -> DataFrame:
    """Per symbol × model: MSE and RMSE to 4 decimals, MAPE to 2; a model
    without records gets zeros.  Models are pivoted with a fixed value list
    (no join against a symbol × model grid) and unpivoted back."""
    p, a = F.col("predicted_price"), F.col("actual_price")
    wide = (pred_long.groupBy(keys).pivot(model_col, models)
            .agg(F.avg(squared_error(p, a)).alias("mse"),
                 (F.avg(percentage_error(p, a)) * F.lit(100.0)).alias("mape")))
    parts = []
    for m in models:
        mse = F.coalesce(F.col(f"{m}_mse"), F.lit(0.0))
        parts.append(F.struct(F.lit(m).alias(model_col),
                              F.round(mse, 4).alias("mse"),
                              F.round(F.sqrt(mse), 4).alias("rmse"),
                              F.round(F.coalesce(F.col(f"{m}_mape"), F.lit(0.0)), 2).alias("mape")))
    return (wide.select(keys, F.explode(F.array(*parts)).alias("_m"))
            .select(keys, "_m.*"))


def next_bar_forecasts(feat: DataFrame, models: dict[str, str], keys: str = "symbol",
                       order: str = "datetime",
                       block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Match each forecast made at bar t-1 with the bar t it forecasts.

    ``models`` maps a model label to the column holding, at bar t-1, its
    forecast of the next close.  Output (long): key, ``datetime`` of the
    forecast bar, ``model_type``, ``predicted_price``, ``actual_price`` and
    the carried ``pos``/``n`` when present.  The pairing is a lag of one row
    over the blocked frame (no self-join).
    """
    sf = ordered_frame(feat, keys, order, lookback=1, block_rows=block_rows)
    df = sf.df.withColumns({f"_prev_{m}": F.lag(c, 1).over(sf.window) for m, c in models.items()})
    df = sf.finish(df)
    carry = [c for c in ("pos", "n") if c in feat.columns]
    stacked = F.explode(F.array(*[
        F.struct(F.lit(m).alias("model_type"), F.col(f"_prev_{m}").alias("predicted_price"))
        for m in models]))
    return (df.select(keys, order, *carry, F.col("close").alias("actual_price"),
                      stacked.alias("_p"))
            .select(keys, order, *carry, "_p.model_type", "_p.predicted_price", "actual_price")
            .where(F.col("predicted_price").isNotNull()))


def read_predictions(preds: DataFrame, symbol: str | None = None,
                     model_type: str | None = None, limit: int = 50,
                     per_group: list[str] | None = None, time_col: str = "datetime") -> DataFrame:
    """Newest-first predictions with optional equality filters.

    ``per_group=None`` is a global top-``limit`` (planned as a
    TakeOrderedAndProject); ``per_group=[...]`` keeps ``limit`` rows per
    group (a window group limit, evaluated partially before the shuffle).
    """
    df = preds
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    if model_type is not None:
        df = df.where(F.col("model_type") == model_type)
    if not per_group:
        return df.orderBy(F.col(time_col).desc()).limit(limit)
    w = Window.partitionBy(*per_group).orderBy(F.col(time_col).desc())
    return df.withColumn("rn", F.row_number().over(w).cast("long")).where(F.col("rn") <= limit)


def series_by_model(topk: DataFrame, keys: list[str], time_col: str = "datetime") -> DataFrame:
    """One time-ordered series per group.  Apply to a top-k result: the
    array holds at most k points per group."""
    pt = F.struct(F.col(time_col).alias("t"), F.col("predicted_price").alias("p"),
                  F.col("actual_price").alias("a"))
    return topk.groupBy(*keys).agg(F.array_sort(F.collect_list(pt)).alias("series"))


def display_points(df: DataFrame, time_col: str = "datetime") -> DataFrame:
    """Chart projection: prices to 2 decimals, time label HH:mm:ss."""
    return df.withColumns({
        "label": F.date_format(time_col, "HH:mm:ss"),
        "predicted_price": F.round("predicted_price", 2),
        "actual_price": F.round("actual_price", 2)})
