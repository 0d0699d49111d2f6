"""Joins of bars with tables of one row per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows up to which the smaller side is broadcast.
BROADCAST_ROWS = 50_000
#: Shares into which every key is dealt beyond that.
SALTS = 32


def join_small(facts: DataFrame, small: DataFrame, keys: list[str] | str, how: str = "inner",
               max_rows: int = BROADCAST_ROWS, salts: int = SALTS) -> DataFrame:
    """``facts`` joined with ``small``, a table with one row per key.

    ``small`` is counted (so it should be stored or quickly made): up to
    ``max_rows`` rows are broadcast and the facts stay where they are.  A
    larger one is repeated ``salts`` times and joined by a shuffle on the key
    and a hash of the fact row, so that a hot key is dealt over many tasks.
    Both ways give the same rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if small.limit(max_rows + 1).count() <= max_rows:
        return facts.join(F.broadcast(small), keys, how)
    dealt = [f.name for f in facts.schema.fields if not isinstance(f.dataType, T.MapType)]
    left = facts.withColumn("_salt", F.pmod(F.xxhash64(*dealt), F.lit(salts)))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
