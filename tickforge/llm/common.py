"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.session import apply_runtime_defaults, scratch_path, ship_package

#: Bytes of text handled at once inside a task; whole texts are never cut, a
#: longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings and package shipping every operator relies on."""
    apply_runtime_defaults(spark)
    # texts go to Python in batches that stay small beside an executor's memory
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(CHUNK_BYTES))
    ship_package(spark)


#: Rows for one file of a table whose size is known before it is written.
ROWS_PER_FILE = 50_000


def saved(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to a new folder under ``spark.checkpoint.dir`` and reread
    it: lineage is cut, the rows survive lost executors.  ``rows``, a known
    bound of its size, sets the number of files; the rows are the same."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(rows // ROWS_PER_FILE + 1)
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hinted(small: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a stored table of at most ``max_rows`` rows (counted here);
    a larger one is joined by a shuffle."""
    return F.broadcast(small) if small.count() <= max_rows else small


def sampled(rows: DataFrame, id_column: str, about: int) -> DataFrame:
    """About ``about`` of ``rows``, those with the smallest 63-bit hashes of the
    id; all where there are no more, and never none of a table with rows."""
    draw = F.shiftrightunsigned(F.xxhash64(id_column), 1)
    n, least = rows.agg(F.count(F.lit(1)), F.min(draw)).first()
    return rows if n <= about else rows.where(draw <= max(least, (about << 63) // n - 1))


def ascii_lower(col):
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def chunks(batches, text_column: str, chunk_bytes: int = CHUNK_BYTES):
    """Slices of Arrow batches holding about ``chunk_bytes`` of text each."""
    import pyarrow.compute as pc
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_numpy(
            zero_copy_only=False)
        begin, held = 0, 0
        for i, size in enumerate(sizes):
            if i > begin and held + size > chunk_bytes:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += int(size)
        if begin < batch.num_rows:
            yield batch.slice(begin)


def dropped(df: DataFrame) -> None:
    """Delete the folder of a table made by ``saved`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in folder:
            where = spark._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def trim() -> None:
    """Give memory that a finished task no longer uses back to the system."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not the GNU C library
        pass
