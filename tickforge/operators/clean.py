"""Cleaning: nulls, duplicates, numeric coercion, time parsing, ordering.

Operators that pick one row per key (first duplicate, latest bar) are
``min_by`` / ``max_by`` aggregations rather than ``row_number`` windows: the
aggregate is combined map-side, so a key holding a third of all rows is
reduced inside every map task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.schemas import BAR_VALUE_COLS

DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Other names of the bar time in producer files.
TIME_NAMES = ("date", "time")


def canonical_name(column: str) -> str:
    """Name of a producer column in any letter case; others stay as they are."""
    low = column.lower()
    if low in TIME_NAMES:
        return "datetime"
    return low if low in ("symbol", "datetime", *BAR_VALUE_COLS) else column


def _is_missing(df: DataFrame, c: str) -> Column:
    miss = F.col(c).isNull()
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        miss = miss | F.isnan(c)
    return miss


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN, as pandas treats it) in any of ``cols``
    (default: every column)."""
    cols = cols or df.columns
    cond = None
    for c in cols:
        m = _is_missing(df, c)
        cond = m if cond is None else (cond | m)
    return df.where(~cond) if cond is not None else df


def dedup_keep_first(df: DataFrame, keys: list[str], order: str | list[str]) -> DataFrame:
    """Keep the first row of each key in ``order`` (the ingest order).

    ``min_by(struct(row), order)`` is deterministic, unlike
    ``dropDuplicates``, and partial-aggregates before the shuffle.
    """
    order_cols = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    order_key = F.struct(*order_cols) if len(order_cols) > 1 else F.col(order_cols[0])
    picked = (df.groupBy(*keys)
              .agg(F.min_by(F.struct(*rest), order_key).alias("_row")))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def latest_per_key(df: DataFrame, keys: list[str] | str = "symbol",
                   order: str = "datetime") -> DataFrame:
    """Newest row of each key (``max_by`` on the time column)."""
    keys = [keys] if isinstance(keys, str) else keys
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename the bar columns to canonical names (only columns present); two
    columns for one name are an error."""
    names = {c: canonical_name(c) for c in df.columns}
    found = list(names.values())
    doubled = sorted(c for c in names if found.count(names[c]) > 1)
    if doubled:
        raise ValueError(f"several columns stand for one: {doubled}")
    return df.withColumnsRenamed({k: v for k, v in names.items() if k != v})


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Raise listing every missing required column."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}; have {df.columns}")
    return df


def coerce_numeric(df: DataFrame, cols: list[str] | None = None,
                   observation: Observation | None = None) -> DataFrame:
    """Cast text to DOUBLE (unparseable -> null) and drop incomplete rows.

    With an ``Observation`` the input rows and the dropped rows are counted
    in the same pass (metrics ``rows_in`` / ``rows_dropped``) — no second job.
    """
    cols = cols or [c for c in BAR_VALUE_COLS if c in df.columns]
    casted = df.withColumns({c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in cols})
    bad = None
    for c in cols:
        m = F.col(c).isNull() | F.isnan(c)
        bad = m if bad is None else (bad | m)
    if observation is not None:
        casted = casted.observe(
            observation,
            F.count(F.lit(1)).alias("rows_in"),
            F.sum(F.when(bad, 1).otherwise(0)).alias("rows_dropped"))
    return casted.where(~bad)


def parse_datetime(col: str | Column = "datetime", fmt: str | None = None) -> Column:
    """String -> TIMESTAMP; text that does not parse becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    if fmt:
        return F.try_to_timestamp(c, F.lit(fmt))
    return F.try_to_timestamp(c)


def epoch_seconds(col: str | Column = "datetime") -> Column:
    """TIMESTAMP -> whole epoch seconds (UTC session time zone)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_seconds(c.cast("timestamp"))


def clean_bars(raw: DataFrame, order: str | list[str] | None = None, unique: bool = False) -> DataFrame:
    """Batch cleaning of raw bars.

    1. drop rows with a null/NaN in a bar column,
    2. drop repeated ``(datetime, symbol)`` keys keeping the first in ingest
       ``order``; ``unique`` says that the keys are unique already (bars made
       by an aggregation on them), then there is nothing to drop,
    3. parse ``datetime`` to TIMESTAMP (strings) and
    4. add ``timestamp`` = epoch seconds.

    Time order is not materialised: every consumer orders inside its window.
    """
    value_cols = [c for c in ["symbol", "datetime", *BAR_VALUE_COLS] if c in raw.columns]
    df = drop_incomplete(raw, value_cols)
    if not unique:
        if order is None:
            raise ValueError("clean_bars needs the ingest order of the rows, or unique=True")
        df = dedup_keep_first(df, ["datetime", "symbol"], order)
    if isinstance(df.schema["datetime"].dataType, T.StringType):
        df = df.withColumn("datetime", parse_datetime("datetime")).where(F.col("datetime").isNotNull())
    elif isinstance(df.schema["datetime"].dataType, T.TimestampNTZType):
        df = df.withColumn("datetime", F.col("datetime").cast("timestamp"))
    return df.withColumn("timestamp", epoch_seconds("datetime"))


def tail_n(df: DataFrame, n: int, keys: list[str] | str = "symbol",
           order: str = "datetime") -> DataFrame:
    """Last ``n`` rows of each key.

    ``row_number() <= n`` over a descending order is planned as a window
    group limit, so every map task ships at most ``n`` rows per key.
    """
    from pyspark.sql import Window
    keys = [keys] if isinstance(keys, str) else keys
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= n).drop("_rn"))
