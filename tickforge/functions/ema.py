"""Exponential moving average as a bounded left fold.

``ema_1 = x_1``, ``ema_t = a·x_t + (1-a)·ema_{t-1}`` with ``a = 2/(span+1)``
(the recursive, non-adjusted form).  The weight of a value ``h`` rows back is
``(1-a)^h``; once that falls below 2^-74 the value cannot change a double, so
folding the last ``h`` closes — seeded by the oldest of them — equals the
infinite recursion.  For span 5 that is a 128-row frame.  The fold keeps the
running value when it already equals the new close (no rounding drift on
flat series).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EMA_SPAN = 5


def ema_alpha(span: int = EMA_SPAN) -> float:
    return 2.0 / (span + 1)


def ema_frame_rows(span: int = EMA_SPAN) -> int:
    """Rows in the frame (current row included) for double-exact results."""
    a = ema_alpha(span)
    return int(math.ceil(74 * math.log(2) / -math.log(1.0 - a))) + 1


def ema_step(acc: Column, v: Column, span: int = EMA_SPAN) -> Column:
    a = ema_alpha(span)
    return F.when(acc == v, acc).otherwise(acc * F.lit(1.0 - a) + v * F.lit(a))


def ema_fold(values: Column, span: int = EMA_SPAN) -> Column:
    """EMA of the last element of ``values`` (an ordered array)."""
    return F.aggregate(F.slice(values, 2, F.size(values)), values[0],
                       lambda acc, v: ema_step(acc, v, span))


def ema_sql_lambda(span: int = EMA_SPAN) -> str:
    """The same fold step in SQL text (Spark ``aggregate`` / DuckDB
    ``list_reduce``), with the constants as exact DOUBLE literals."""
    a = ema_alpha(span)
    return (f"CASE WHEN acc = v THEN acc ELSE acc * CAST('{1.0 - a!r}' AS DOUBLE) "
            f"+ v * CAST('{a!r}' AS DOUBLE) END")
