"""Ordered per-key row frames that stay parallel when one key is huge.

A plain ``Window.partitionBy("symbol").orderBy("datetime")`` sends every row
of a symbol to one task.  When one symbol holds a third of the data that one
task holds a third of the data.  ``sequence_frame`` instead cuts each key's
time-ordered rows into *blocks* of about ``block_rows`` rows and copies the
last ``lookback`` rows of every block into the next one (a halo).  Any frame
``rowsBetween(-lookback, 0)`` evaluated inside a block then sees exactly the
rows it would see over the whole series, and the window is partitioned by
``(key, block)``: many tasks per hot key, one sort per block.

Block boundaries are planned on a small stored table: row counts per key and
time bucket (a day by default).  Prefix counts over it are taken in two
levels (groups of buckets, then buckets of a group), and a block is every
bucket that starts within the same ``block_rows`` positions.  A bucket of more
than ``block_rows`` rows is split first, at splitters drawn from its own rows
by a hash of the order columns, so one dense minute spreads over many blocks.
The data is joined with the plan by bucket (broadcast by AQE when it measured
it small, shuffled otherwise).

Positions are exact: each bucket (or part of one) knows the 0-based position
of its first row within the key, and a block's frame begins with a whole one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators.joins import join_small
from tickforge.session import materialize

DEFAULT_BLOCK_ROWS = 1 << 20
DEFAULT_BUCKET_SECONDS = 86_400

#: Buckets whose prefix counts one group adds up.
GROUP_BUCKETS = 1024
#: Rows drawn for one splitter of a dense bucket.
DRAWN_PER_SPLITTER = 16

BKT, SUB, BLK, DST, START, NTOTAL, HALO, CNT = (
    "_sq_bkt", "_sq_sub", "_sq_blk", "_sq_dst", "_sq_start", "_sq_n", "_sq_halo", "_sq_cnt")
_HELPERS = [BKT, SUB, BLK, START, NTOTAL, HALO]


def time_bucket(col: str | Column, seconds: int = DEFAULT_BUCKET_SECONDS) -> Column:
    """Coarse time bucket of a timestamp column (days by default)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")


def plan_blocks(cells: DataFrame, keys: list[str], block_rows: int, lookback: int) -> DataFrame:
    """Block plan of ``cells`` (keys, bucket, part of the bucket, rows).

    Adds each cell's first position in its key, the rows of the key, its block
    and ``_sq_dst``: the block and those it is copied to because it overlaps
    the ``lookback`` rows before them.  With ``block_rows >= lookback`` these
    are at most the next two blocks that have rows.
    """
    by_key = Window.partitionBy(*keys)
    before = (Window.unboundedPreceding, -1)
    grouped = cells.withColumn("_sq_g", F.floor(F.col(BKT) / F.lit(GROUP_BUCKETS)))
    groups = (grouped.groupBy(*keys, "_sq_g").agg(F.sum(CNT).alias("_sq_gn"))
              .withColumn("_sq_g0", F.coalesce(F.sum("_sq_gn").over(
                  by_key.orderBy("_sq_g").rowsBetween(*before)), F.lit(0)))
              .withColumn(NTOTAL, F.sum("_sq_gn").over(by_key)).drop("_sq_gn"))
    inside = Window.partitionBy(*keys, "_sq_g").orderBy(BKT, SUB).rowsBetween(*before)
    placed = (grouped.join(groups, [*keys, "_sq_g"])
              .withColumn(START, F.col("_sq_g0") + F.coalesce(F.sum(CNT).over(inside), F.lit(0)))
              .withColumn(BLK, F.floor(F.col(START) / F.lit(block_rows))))
    in_order = by_key.orderBy(BLK)
    blocks = placed.groupBy(*keys, BLK).agg(F.min(START).alias("_sq_b0"))
    blocks = blocks.select(*keys, BLK, *[F.lead(c, k).over(in_order).alias(f"{c}_{k}")
                                         for c in (BLK, "_sq_b0") for k in (1, 2)])
    reach = F.col(START) + F.col(CNT) + F.lit(lookback)
    dst = F.array(F.col(BLK), *[F.when(F.col(f"_sq_b0_{k}") < reach, F.col(f"{BLK}_{k}")) for k in (1, 2)])
    return placed.join(blocks, [*keys, BLK]).select(
        *keys, BKT, SUB, CNT, START, NTOTAL, BLK, F.filter(dst, lambda b: b.isNotNull()).alias(DST))


def _split_dense(rows: DataFrame, counts: DataFrame, keys: list[str], order: list[str],
                 block_rows: int) -> DataFrame:
    """``rows`` with ``_sq_sub``, the part of its bucket a row lies in: 0, or
    the splitters before it where the bucket has more than ``block_rows`` rows."""
    at = F.struct(*order)
    drawn = F.pmod(F.xxhash64(*order), F.lit(max(1, block_rows // DRAWN_PER_SPLITTER))) == 0
    dense = counts.where(F.col(CNT) > block_rows).select(*keys, BKT)
    splitters = materialize(
        join_small(rows.where(drawn).select(*keys, BKT, at.alias("_sq_at")), dense, [*keys, BKT])
        .groupBy(*keys, BKT).agg(F.sort_array(F.collect_list("_sq_at")).alias("_sq_all"))
        .select(*keys, BKT, F.filter("_sq_all", lambda x, i: i % DRAWN_PER_SPLITTER == DRAWN_PER_SPLITTER - 1)
                .alias("_sq_split")))
    part = F.when(F.col("_sq_split").isNull(), F.lit(0)).otherwise(
        F.size(F.filter("_sq_split", lambda x: x < at)))
    return (join_small(rows, splitters, [*keys, BKT], "left")
            .withColumn(SUB, part.cast("int")).drop("_sq_split"))


@dataclass
class SeqFrame:
    """Rows of every key, blocked, with halo copies marked in ``_sq_halo``."""

    df: DataFrame
    keys: list[str]
    order: list[str]
    lookback: int
    #: False where no key has rows beyond its first block.
    split: bool = True

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, BLK).orderBy(*self.order)

    def rows(self, start: int, end: int) -> WindowSpec:
        if -start > self.lookback:
            raise ValueError(f"frame reaches {-start} rows back; lookback is {self.lookback}")
        return self.window.rowsBetween(start, end)

    def position(self) -> Column:
        """Global 0-based position of the row within its key."""
        return F.first(START).over(self.window) + F.row_number().over(self.window) - 1

    @staticmethod
    def count() -> Column:
        """Number of rows of the row's key."""
        return F.col(NTOTAL)

    def finish(self, df: DataFrame) -> DataFrame:
        """Drop halo copies and helper columns."""
        return df.where(~F.col(HALO)).drop(*_HELPERS)


def sequence_frame(df: DataFrame, keys: list[str] | str, order: list[str] | str,
                   lookback: int, block_rows: int = DEFAULT_BLOCK_ROWS,
                   bucket: Column | None = None,
                   bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> SeqFrame:
    """Prepare ``df`` for per-key ordered frames reaching ``lookback`` rows back.

    ``order`` must be unique within a key (bars: ``datetime``); ``bucket``
    must be non-decreasing in ``order`` (default: ``order[0]`` cut into
    ``bucket_seconds``).  Buckets that hold few rows each plan best: a day
    suits bars, raw events want minutes.  Key columns must be non-null.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    if block_rows < max(lookback, 1):
        raise ValueError("block_rows must be at least lookback")
    bucket = time_bucket(order[0], bucket_seconds) if bucket is None else bucket
    rows = df.withColumn(BKT, bucket)
    counts = materialize(rows.groupBy(*keys, BKT).agg(F.count(F.lit(1)).alias(CNT)))
    most = (counts.groupBy(*keys).agg(F.sum(CNT).alias("n"), F.max(CNT).alias("m"))
            .agg(F.max("n").alias("n"), F.max("m").alias("m")).first())
    if (most["m"] or 0) > block_rows:
        rows = _split_dense(rows, counts, keys, order, block_rows)
        cells = materialize(rows.groupBy(*keys, BKT, SUB).agg(F.count(F.lit(1)).alias(CNT)))
        plan = materialize(plan_blocks(cells, keys, block_rows, lookback).drop(CNT, BLK))
        joined = join_small(rows, plan, [*keys, BKT, SUB])
    else:
        plan = plan_blocks(counts.withColumn(SUB, F.lit(0)), keys, block_rows, lookback)
        joined = rows.join(plan.drop(CNT, BLK), [*keys, BKT])
    blocked = (joined.select("*", F.posexplode(DST).alias("_sq_copy", BLK))
               .withColumn(HALO, F.col("_sq_copy") > 0).drop(DST, "_sq_copy"))
    return SeqFrame(blocked, keys, order, lookback, (most["n"] or 0) > block_rows)


def position_frame(df: DataFrame, keys: list[str] | str, lookback: int, pos: str = "pos",
                   n: str | None = "n", block_rows: int = DEFAULT_BLOCK_ROWS) -> SeqFrame:
    """Blocked frame for rows that already carry their exact position.

    Blocks are fixed ranges of ``block_rows`` positions and the halo is the
    last ``lookback`` positions of the previous block — no counting pass and
    no plan join, just one explode before the window's shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if block_rows < max(lookback, 1):
        raise ValueError("block_rows must be at least lookback")
    p = F.col(pos)
    blk = F.floor(p / F.lit(block_rows)).cast("long")
    in_halo = (F.lit(lookback) > 0) & (F.pmod(p, F.lit(block_rows)) >= F.lit(block_rows - lookback))
    dst = F.explode(F.when(in_halo, F.array(blk, blk + 1)).otherwise(F.array(blk)))
    out = (df.withColumn("_sq_dst", dst)
           .withColumn(HALO, F.col("_sq_dst") != blk)
           .withColumn(BLK, F.col("_sq_dst"))
           .withColumn(START, F.when(F.col(BLK) > 0, F.col(BLK) * F.lit(block_rows) - F.lit(lookback))
                       .otherwise(F.lit(0)).cast("long"))
           .withColumn(NTOTAL, F.col(n) if n else F.lit(None).cast("long"))
           .withColumn(BKT, F.lit(None).cast("long"))
           .withColumn(SUB, F.lit(0))
           .drop("_sq_dst"))
    return SeqFrame(out, keys, [pos], lookback)


def ordered_frame(df: DataFrame, keys: list[str] | str, order: list[str] | str, lookback: int,
                  block_rows: int = DEFAULT_BLOCK_ROWS,
                  bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> SeqFrame:
    """``position_frame`` when ``df`` has ``pos`` (the position assigned by
    ``features.with_positions``), else ``sequence_frame``."""
    if "pos" in df.columns:
        return position_frame(df, keys, lookback, n="n" if "n" in df.columns else None,
                              block_rows=max(block_rows, lookback))
    return sequence_frame(df, keys, order, lookback, block_rows=max(block_rows, lookback),
                          bucket_seconds=bucket_seconds)


def map_blocks(sf: SeqFrame, fn, added: list[T.StructField], with_position: str | None = None,
               with_count: str | None = None) -> DataFrame:
    """Run ``fn(pdf) -> pdf`` over each time-ordered block (halo first) of a
    ``SeqFrame`` and return the non-halo rows with the ``added`` columns.

    For sequential recurrences (EMA) that a window expression could only
    evaluate as an O(frame) fold per row: here each block is one vectorised
    pass.  Blocks are bounded by ``block_rows + lookback`` rows, so a hot key
    is spread over many groups.
    """
    base = [f for f in sf.df.schema.fields if f.name not in _HELPERS]
    extra = list(added)
    if with_position:
        extra.append(T.StructField(with_position, T.LongType()))
    if with_count:
        extra.append(T.StructField(with_count, T.LongType()))
    schema = T.StructType(base + extra)
    names = schema.fieldNames()
    order = list(sf.order)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
        pdf = fn(pdf)
        if with_position:
            pdf[with_position] = pdf[START].iloc[0] + np.arange(len(pdf))
        if with_count:
            pdf[with_count] = pdf[NTOTAL]
        return pdf.loc[~pdf[HALO].astype(bool), names]

    return sf.df.groupBy(*sf.keys, BLK).applyInPandas(run, schema)
