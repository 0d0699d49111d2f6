"""Technical indicators over bar series."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.functions.ema import EMA_SPAN, ema_alpha, ema_fold, ema_frame_rows
from tickforge.operators.joins import join_small
from tickforge.operators.sequence import (BLK, DEFAULT_BLOCK_ROWS, HALO, NTOTAL, START, SeqFrame,
                                          map_blocks, sequence_frame)
from tickforge.session import materialize


def ema_recursive(values: pd.Series, span: int = EMA_SPAN) -> pd.Series:
    """Non-adjusted recursive EMA of an ordered series (pandas ``ewm``)."""
    return values.ewm(span=span, adjust=False).mean()


#: Blocks whose recursions one fold composes.
CHUNK_BLOCKS = 256
_RECORD = "lead long, x1 double, mul double, add double, trail long"


def ema_segment(values: np.ndarray, span: int = EMA_SPAN) -> tuple:
    """The recursion over ``values`` as an affine map: with ``e1`` the average
    at the first value that is not NaN, the last one is ``mul * e1 + add``.

    Returns (NaNs before that value, the value, mul, add, NaNs at the end);
    the middle three are None where all values are NaN.
    """
    seen = np.flatnonzero(~np.isnan(values))
    if not len(seen):
        return len(values), None, None, None, 0
    first, last = seen[0], seen[-1]
    part = values[first:last + 1]
    rest, unit = part.copy(), np.where(np.isnan(part), np.nan, 0.0)
    rest[0], unit[0] = 0.0, 1.0
    add, mul = (float(ema_recursive(pd.Series(v), span).iloc[-1]) for v in (rest, unit))
    return int(first), float(part[0]), mul, add, int(len(values) - 1 - last)


def _then(r: Column, s: Column, span: int) -> Column:
    """Record of segment ``r`` followed by segment ``s``."""
    a = ema_alpha(span)
    old = F.pow(F.lit(1.0 - a), r["trail"] + s["lead"] + F.lit(1))
    keep, new = old / (old + F.lit(a)), s["x1"] * F.lit(a) / (old + F.lit(a))
    none_r, none_s = r["x1"].isNull(), s["x1"].isNull()
    return F.struct(
        F.when(none_r, r["lead"] + s["lead"]).otherwise(r["lead"]).alias("lead"),
        F.when(none_r, s["x1"]).otherwise(r["x1"]).alias("x1"),
        F.when(none_r, s["mul"]).when(none_s, r["mul"]).otherwise(s["mul"] * keep * r["mul"]).alias("mul"),
        F.when(none_r, s["add"]).when(none_s, r["add"])
        .otherwise(s["mul"] * (keep * r["add"] + new) + s["add"]).alias("add"),
        F.when(none_s, r["trail"] + F.when(none_r, F.lit(0)).otherwise(s["lead"]))
        .otherwise(s["trail"]).cast("long").alias("trail"))


def scan_segments(records: DataFrame, keys: list[str], span: int = EMA_SPAN,
                  chunk_blocks: int | None = None) -> DataFrame:
    """Exclusive prefix scan: for each block the average ``_ema`` and the NaNs
    since (``_gap``) after all segments of its key before it (null at first).

    Maps compose in order, first within chunks of blocks, then over the
    chunks of a key; no fold takes more than the chunks of a key.
    """
    none = F.struct(F.lit(0).cast("long").alias("lead"), *[
        F.lit(None).cast("double").alias(c) for c in ("x1", "mul", "add")],
        F.lit(0).cast("long").alias("trail"))

    def fold(rs: Column, zero: Column) -> Column:
        return F.aggregate(rs, zero, lambda acc, s: _then(acc, s["r"], span))
    chunks = (records.withColumn("_chunk", F.floor(F.col(BLK) / F.lit(chunk_blocks or CHUNK_BLOCKS)))
              .groupBy(*keys, "_chunk")
              .agg(F.sort_array(F.collect_list(F.struct(BLK, "r"))).alias("rs"))
              .withColumn("r", fold(F.col("rs"), none)))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("_before", fold(F.collect_list(F.struct("r")).over(earlier), none))
    at = F.transform("rs", lambda s, i: F.struct(
        s[BLK].alias(BLK), fold(F.slice("rs", F.lit(1), i), F.col("_before")).alias("p")))
    return (chunks.select(*keys, F.explode(at).alias("at"))
            .select(*keys, F.col(f"at.{BLK}").alias(BLK),
                    (F.col("at.p.mul") * F.col("at.p.x1") + F.col("at.p.add")).alias("_ema"),
                    F.col("at.p.trail").alias("_gap")))


def blocked_ema(sf: SeqFrame, col: str = "close", span: int = EMA_SPAN, out: str = "EMA5",
                **positions) -> DataFrame:
    """The recursive EMA of ``col`` over a frame whose halo has
    ``ema_frame_rows - 1`` rows.

    Where keys have several blocks, each block starts, that many rows early,
    from the average that the segments before it leave (``scan_segments``), so
    its rows equal the recursion over the whole series whatever the values;
    the halo brings the rounding of the carried average below a double's.
    """
    added = [T.StructField(out, T.DoubleType())]
    if not sf.split:
        def whole(pdf):
            pdf[out] = ema_recursive(pdf[col].astype(float), span).to_numpy()
            return pdf
        return map_blocks(sf, whole, added, **positions)

    lookback, order, keys = sf.lookback, list(sf.order), list(sf.keys)

    def cut(pdf):
        """First row of the block's frame that counts, and the first that the
        next block's frame brings itself."""
        own = int(np.flatnonzero(~pdf[HALO].astype(bool).to_numpy())[0])
        p0, size = int(pdf[START].iloc[0]), len(pdf)
        last = p0 + size >= int(pdf[NTOTAL].iloc[0])
        return max(own - lookback, -p0, 0), size if last else max(size - lookback, -p0, 0)

    def record(key, pdf):
        pdf = pdf.sort_values(order, kind="stable")
        a, b = cut(pdf)
        r = ema_segment(pdf[col].to_numpy(float, na_value=np.nan)[a:b], span)
        return pd.DataFrame([[*key, dict(zip(("lead", "x1", "mul", "add", "trail"), r))]],
                            columns=[*keys, BLK, "r"])

    kinds = T.StructType([sf.df.schema[k] for k in (*keys, BLK)]).add(
        "r", T.StructType.fromDDL(_RECORD))
    used = list(dict.fromkeys([*keys, BLK, *order, col, START, NTOTAL, HALO]))
    records = sf.df.select(*used).groupBy(*keys, BLK).applyInPandas(record, kinds)
    carried = materialize(scan_segments(records, keys, span))

    def run(pdf):
        a, _ = cut(pdf)
        values = pdf[col].to_numpy(float, na_value=np.nan)[a:]
        before = pdf["_ema"].iloc[0]
        given = 0
        if int(pdf[START].iloc[0]) + a > 0 and pd.notna(before):
            given = 1 + int(pdf["_gap"].iloc[0])
            values = np.concatenate([[before], np.full(given - 1, np.nan), values])
        ema = np.full(len(pdf), np.nan)
        ema[a:] = ema_recursive(pd.Series(values), span).to_numpy()[given:]
        pdf[out] = ema
        return pdf

    joined = join_small(sf.df, carried, [*keys, BLK], "left")
    done = map_blocks(replace(sf, df=joined), run, added, **positions)
    return done.drop("_ema", "_gap")


def ema_column(sf: SeqFrame, col: str = "close", span: int = EMA_SPAN,
               history: int | None = None):
    """EMA of ``col`` as a window expression over a prepared ``SeqFrame``."""
    h = history or ema_frame_rows(span)
    return ema_fold(F.collect_list(col).over(sf.rows(-(h - 1), 0)), span)


def with_ema(df: DataFrame, col: str = "close", span: int = EMA_SPAN, out: str = "EMA5",
             keys: list[str] | str = "symbol", order: list[str] | str = "datetime",
             history: int | None = None, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Add the EMA of ``col`` per key in time order.

    ``history=None`` gives the recursive EMA: one vectorised pass per block of
    the key's series, with the average carried from block to block
    (``blocked_ema``).  A number ``h`` recomputes
    every value from the last ``h`` rows only (seeded at the oldest of them),
    as a consumer holding a bounded buffer of closes does — a window fold.
    A history of at least ``ema_frame_rows`` rows forgets what lies before it
    unless values fall by many orders of magnitude, so it takes the vectorised
    path too.
    """
    if history is None or history >= ema_frame_rows(span):
        h = ema_frame_rows(span)
        sf = sequence_frame(df, keys, order, lookback=h - 1, block_rows=max(block_rows, h))
        return blocked_ema(sf, col, span, out)
    h = history
    sf = sequence_frame(df, keys, order, lookback=h - 1, block_rows=max(block_rows, h))
    return sf.finish(sf.df.withColumn(out, ema_column(sf, col, span, h)))
