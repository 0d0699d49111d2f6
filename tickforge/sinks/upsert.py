"""Keyed upsert (merge) of a batch into a table.

``upsert(target, updates, keys, update_cols)``: a key absent from the target
is inserted; a key present in both takes ``update_cols`` from the update and
keeps every other column from the target (the first value written).  Inside
one update batch the last row of a key wins (``order``).  Expressed as a
``max_by`` pre-aggregation (partial per map task) and one full outer join on
the key — no row-at-a-time statements.  ``upsert_table`` does so for the
partitions of a stored table that a batch touches.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.session import materialize

#: A published list: one row a partition, and one that holds the schema.
LIST_SCHEMA = "part string, wrote int, schema string"


def last_per_key(updates: DataFrame, keys: list[str], order: str | list[str]) -> DataFrame:
    """The row of each key that comes last in ``order``, which must say more
    than the key itself."""
    order = [order] if isinstance(order, str) else list(order)
    if not order or set(order) & set(keys):
        raise ValueError(f"order {order} must be columns other than the keys {keys}")
    rest = [c for c in updates.columns if c not in keys]
    ok = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return (updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), ok).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], update_cols: list[str],
           order: str | list[str] | None = None, touched_col: str | None = "created_at") -> DataFrame:
    """Merged table (same columns as ``target``).  ``touched_col`` is set to
    ``current_timestamp()`` on inserted and updated rows."""
    if order is not None:
        updates = last_per_key(updates, keys, order)
    cols = [c for c in target.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t"))
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols if c in updates.columns],
                       F.lit(True).alias("_u"))
    j = t.join(u, keys, "full_outer")
    in_u = F.col("_u").isNotNull()
    in_t = F.col("_t").isNotNull()
    out = []
    for c in cols:
        tc = F.col(f"_t_{c}")
        uc = F.col(f"_u_{c}") if c in updates.columns else F.lit(None)
        if c == touched_col:
            out.append(F.when(in_u, F.current_timestamp()).otherwise(tc).alias(c))
        elif c in update_cols:
            out.append(F.when(in_u, uc).otherwise(tc).alias(c))
        else:
            out.append(F.when(in_t, tc).otherwise(uc).alias(c))
    return j.select(*keys, *out)


def published(spark, path: str) -> list[int]:
    """Versions of the table whose write has finished, ascending; none where
    the folder does not exist.  Any other failure to list is raised."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path
    found = [f.getPath() for f in fs.listStatus(root) if f.getPath().getName().startswith("v=")]
    return sorted(int(p.getName()[2:]) for p in found if fs.exists(done(p, "_SUCCESS")))


#: Partitions into which the default rule deals the keys of a table.
DEFAULT_PARTS = 64
PART = "_part"


def key_parts(keys: list[str], parts: int = DEFAULT_PARTS) -> Column:
    """Default partition rule: a hash of the key."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts))


def _delete(spark, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _listed(spark, base: str, version: int) -> tuple[dict[str, int], T.StructType]:
    """Partition -> version that wrote it, and the schema, of a published list."""
    rows = spark.read.schema(LIST_SCHEMA).parquet(f"{base}/v={version}").collect()
    schema = next(r["schema"] for r in rows if r["schema"])
    return ({r["part"]: r["wrote"] for r in rows if r["part"] is not None},
            T.StructType.fromJson(json.loads(schema)))


def _read_parts(spark, base: str, listed: dict[str, int], schema: T.StructType) -> DataFrame:
    paths = [f"{base}/data/v={v}/{PART}={p}" for p, v in sorted(listed.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def upsert_table(updates: DataFrame, path: str, keys: list[str], update_cols: list[str],
                 version: int, order: str | list[str] | None = None,
                 touched_col: str | None = "created_at", keep: int = 2,
                 part: Column | None = None) -> str:
    """Merge ``updates`` into the newest published version below ``version``
    of the table at ``path``; returns the folder of the new version's list.

    ``part``, a column over ``keys`` (default: 64 hash buckets), deals the rows
    to partitions.  Only the partitions that the batch touches are read,
    merged and written, to ``path/data/v=N``; ``path/v=N`` lists for every
    partition the version that wrote it, and publishes N once its write has
    finished.  A version left unfinished is never read, and re-running one
    starts from the version before it, so a replayed micro-batch gives the
    same table.  The last ``keep`` lists and what they name stay.

    ``part`` must not change over the table's life and should keep to few
    thousand partitions: their names pass the driver, as file listings do.
    """
    spark = updates.sparkSession
    base = path.rstrip("/")
    part = key_parts(keys) if part is None else part
    part = F.concat(F.lit("p"), F.regexp_replace(F.coalesce(part.cast("string"), F.lit("")), "[^A-Za-z0-9.-]", "_"))
    earlier = [v for v in published(spark, base) if v < int(version)]
    batch = materialize(updates if order is None else last_per_key(updates, keys, order))
    touched = [r[0] for r in batch.select(part).distinct().collect()]
    if not earlier:
        listed, merged = {}, batch
        if touched_col and touched_col in merged.columns:
            merged = merged.withColumn(touched_col, F.current_timestamp())
        schema = merged.schema
    else:
        listed, schema = _listed(spark, base, earlier[-1])
        old = _read_parts(spark, base, {p: listed[p] for p in touched if p in listed}, schema)
        merged = upsert(old, batch, keys, update_cols, None, touched_col).select(*schema.fieldNames())
    if touched:
        (merged.withColumn(PART, part).repartition(PART, *keys).write.mode("overwrite")
         .partitionBy(PART).parquet(f"{base}/data/v={int(version)}"))
    now = listed | {p: int(version) for p in touched}
    out = f"{base}/v={int(version)}"
    spark.createDataFrame([(None, None, schema.json())] + [(p, v, None) for p, v in sorted(now.items())],
                          LIST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(out)
    kept = earlier[max(0, len(earlier) + 1 - keep):]
    stay = set(now.items()).union(*[_listed(spark, base, v)[0].items() for v in kept])
    for v in earlier[:len(earlier) - len(kept)]:
        for p, wrote in set(_listed(spark, base, v)[0].items()) - stay:
            _delete(spark, f"{base}/data/v={wrote}/{PART}={p}")
        _delete(spark, f"{base}/v={v}")
    return out


def read_latest(spark, path: str) -> DataFrame:
    """Newest published version of a table written by ``upsert_table``."""
    base = path.rstrip("/")
    return _read_parts(spark, base, *_listed(spark, base, published(spark, base)[-1]))
