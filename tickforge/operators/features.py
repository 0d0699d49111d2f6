"""Model features: positions, min-max scaling, sliding windows, splits.

The min-max arithmetic reproduces scikit-learn's ``MinMaxScaler`` to the
bit: ``scale = 1 / range`` (a range below ``10·eps`` counts as 1, so a
constant column maps to ``x - min``), ``offset = 0 - min·scale`` and
``x·scale + offset``; values outside the fitted range are not clipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.functions.ema import EMA_SPAN, ema_frame_rows
from tickforge.operators.indicators import blocked_ema
from tickforge.operators.joins import join_small
from tickforge.operators.sequence import DEFAULT_BLOCK_ROWS, ordered_frame, sequence_frame
from tickforge.schemas import DEFAULT_SEQ_LEN, FEATURES_G2

FIT_FRACTION = 0.8
_TINY_RANGE = 10 * 2.220446049250313e-16


def with_positions(bars: DataFrame, keys: list[str] | str = "symbol",
                   order: str = "datetime", ema_span: int | None = EMA_SPAN,
                   block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Add ``EMA5`` (unless ``ema_span`` is None), ``pos`` (0-based row index
    in time order) and ``n`` (rows of the key) in one blocked window pass."""
    lookback = ema_frame_rows(ema_span) - 1 if ema_span else 0
    sf = sequence_frame(bars, keys, order, lookback=lookback,
                        block_rows=max(block_rows, lookback))
    if not ema_span:
        df = sf.df.withColumn("pos", sf.position()).withColumn("n", sf.count())
        return sf.finish(df)
    return blocked_ema(sf, "close", ema_span, "EMA5", with_position="pos", with_count="n")


def fit_rows(pos: str = "pos", n: str = "n", fraction: float = FIT_FRACTION) -> Column:
    """Rows ``pos < int(fraction·n)`` — the chronological training part."""
    return F.col(pos) < F.floor(F.lit(fraction) * F.col(n))


def fit_minmax(feat: DataFrame, features: list[str] = FEATURES_G2,
               keys: list[str] | str = "symbol", fraction: float = FIT_FRACTION) -> DataFrame:
    """Per-key min and max of each feature over the first ``fraction`` of rows.

    A grouped aggregation (partial per map task), one small row per key:
    ``{f}_min``, ``{f}_max``.
    """
    keys = [keys] if isinstance(keys, str) else keys
    aggs = []
    for f in features:
        aggs += [F.min(f).alias(f"{f}_min"), F.max(f).alias(f"{f}_max")]
    return feat.where(fit_rows(fraction=fraction)).groupBy(*keys).agg(*aggs)


def minmax_scale_factor(fmin: Column, fmax: Column) -> Column:
    rng = fmax - fmin
    return F.lit(1.0) / F.when(rng < F.lit(_TINY_RANGE), F.lit(1.0)).otherwise(rng)


def minmax_transform(x: Column, fmin: Column, fmax: Column) -> Column:
    scale = minmax_scale_factor(fmin, fmax)
    return x * scale + (F.lit(0.0) - fmin * scale)


def minmax_inverse(v: Column, fmin: Column, fmax: Column) -> Column:
    scale = minmax_scale_factor(fmin, fmax)
    return (v - (F.lit(0.0) - fmin * scale)) / scale


def apply_minmax(feat: DataFrame, scaler: DataFrame, features: list[str] = FEATURES_G2,
                 keys: list[str] | str = "symbol", suffix: str = "_s",
                 keep_bounds: list[str] | None = None) -> DataFrame:
    """Join the per-key scaler and add ``{f}{suffix}`` scaled columns.

    The scaler has one row per key: broadcast once counted, else a salted join.
    ``keep_bounds`` keeps ``{f}_min/{f}_max`` of those features (for inverse).
    """
    keys = [keys] if isinstance(keys, str) else keys
    j = join_small(feat, scaler, keys)
    j = j.withColumns({f"{f}{suffix}": minmax_transform(F.col(f), F.col(f"{f}_min"),
                                                        F.col(f"{f}_max")) for f in features})
    keep = set(keep_bounds or [])
    drop = [f"{f}_{b}" for f in features if f not in keep for b in ("min", "max")]
    return j.drop(*drop)


def sliding_windows(scaled: DataFrame, features: list[str], seq_len: int = DEFAULT_SEQ_LEN,
                    target: str | None = "close_s", keys: list[str] | str = "symbol",
                    order: str = "datetime", include_current: bool = False,
                    block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """One row per window, at the row the window forecasts.

    ``include_current=False`` (training, single-symbol stream): ``xs`` = the
    ``seq_len`` rows before the row, ``y`` = its ``target`` — ``n - seq_len``
    windows per key.  ``include_current=True`` (keyed stream): ``xs`` ends
    with the row itself.  Adds ``xs`` (``seq_len × F`` array), ``x`` (its
    time-major flattening) and ``widx`` (0-based window index).
    """
    sf = ordered_frame(scaled, keys, order, lookback=seq_len, block_rows=block_rows)
    frame = sf.rows(-(seq_len - 1), 0) if include_current else sf.rows(-seq_len, -1)
    vec = F.array(*[F.col(f).cast("double") for f in features])
    df = (sf.df.withColumn("xs", F.collect_list(vec).over(frame))
          .withColumn("_wpos", sf.position()))
    first = seq_len - 1 if include_current else seq_len
    df = df.withColumn("widx", F.col("_wpos") - F.lit(first))
    out = sf.finish(df).where(F.size("xs") == seq_len).drop("_wpos")
    out = out.withColumn("x", F.flatten("xs"))
    if target is not None:
        out = out.withColumn("y", F.col(target))
    return out


def window_split(widx: str | Column = "widx", n: str = "n", seq_len: int = DEFAULT_SEQ_LEN,
                 fraction: float = FIT_FRACTION) -> Column:
    """Training windows: ``widx < int(fraction · (n - seq_len))``."""
    w = F.col(widx) if isinstance(widx, str) else widx
    return w < F.floor(F.lit(fraction) * (F.col(n) - F.lit(seq_len)))


def flag_new_bars(polls: DataFrame, keys: list[str] | str, poll_order: list[str] | str,
                  bar_time: str = "bar_datetime", block_rows: int = DEFAULT_BLOCK_ROWS,
                  bucket_seconds: int = 60) -> DataFrame:
    """A poll is new when the newest bar it saw differs from the previous
    poll's (the first poll of a key is new).  Polls are dense, so blocks are
    planned on minute buckets."""
    sf = ordered_frame(polls, keys, poll_order, lookback=1, block_rows=block_rows,
                       bucket_seconds=bucket_seconds)
    prev = F.lag(bar_time, 1).over(sf.window)
    df = sf.df.withColumn("is_new", prev.isNull() | (prev != F.col(bar_time)))
    return sf.finish(df)


def warmup_gate(df: DataFrame, seq_len: int = DEFAULT_SEQ_LEN, pos: str = "pos",
                cols: list[str] | None = None, drop: bool = False) -> DataFrame:
    """No forecast before ``seq_len`` rows are buffered: null out ``cols``
    (single-symbol job) or drop the row (keyed job)."""
    ready = F.col(pos) >= F.lit(seq_len)
    if drop:
        return df.where(ready)
    return df.withColumns({c: F.when(ready, F.col(c)) for c in (cols or [])})
