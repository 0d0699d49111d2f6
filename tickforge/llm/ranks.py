"""Exact positions and running sums in a group that no single task holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.llm.common import saved


def text_key(column: str, null_first: bool):
    """A text that is never null and sorts like ``column`` by code point, with
    nulls before or after all others."""
    return F.when(F.col(column).isNull(), F.lit("" if null_first else ">")).otherwise(
        F.concat(F.lit("="), F.col(column)))


def positions(rows: DataFrame, group: list[str], order: list[str], value: str | None = None,
              name: str = "ranked") -> DataFrame:
    """``rows`` with pos, the row's place from 0 within its group by ``order``,
    and, where ``value`` is named, before: the sum of it over earlier rows.

    The rows are dealt by ranges of (group, order), counted once for each
    group and range, and numbered within a range from the counts of the ranges
    before: a hot group is as many tasks as it has ranges.  Rows equal in group
    and order may swap places."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = saved(rows.repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id()), name)
    spent = F.sum(value) if value else F.lit(0).cast("long")
    sums = ranged.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_rows"), spent.alias("_spent"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    offsets = sums.select(*group, "_part", F.coalesce(F.sum("_rows").over(earlier), zero).alias("_rows_before"),
                          F.coalesce(F.sum("_spent").over(earlier), zero).alias("_spent_before"))
    own = Window.partitionBy(*group, "_part").orderBy(*order)
    out = ranged.join(offsets, [*group, "_part"]).withColumn("pos", F.col("_rows_before") + F.row_number().over(own) - 1)
    if value:
        out = out.withColumn("before", F.col("_spent_before") + F.sum(value).over(
            own.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value))
    return out.drop("_part", "_rows_before", "_spent_before")
