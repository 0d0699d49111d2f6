"""Spark session and shared-storage helpers.

Everything runs on a plain ``SparkSession``.  The defaults here are the ones
the library relies on (UTC session time zone, AQE with skew handling, Arrow
for pandas functions); on a cluster the caller's own settings win because
``getOrCreate`` keeps an existing session's configuration.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def sizing_conf(input_bytes: int, executor_memory_bytes: int = 16 << 30,
                executor_cores: int = 8, total_cores: int = 8) -> dict[str, str]:
    """Partition sizes for an input of ``input_bytes`` (compressed Parquet).

    * scan splits of 128 MB (256 MB above 10 TB), so a task's decoded batch
      stays a small part of its share of executor memory;
    * shuffle partitions = 3 × input / (half the memory of one task) —
      shuffle data expands about 3× over compressed Parquet — rounded up to a
      multiple of the cluster cores and capped at 200,000 (map-status size
      on the driver); larger partitions spill in the sort-based shuffle.
      AQE then merges small partitions (advisory 256 MB) and splits skewed
      ones.
    """
    import math
    split = (256 << 20) if input_bytes > (10 << 40) else (128 << 20)
    per_task_mem = executor_memory_bytes / max(executor_cores, 1)
    target = per_task_mem / 2
    parts = max(total_cores, math.ceil(3 * input_bytes / target))
    parts = int(min(math.ceil(parts / total_cores) * total_cores, 200_000))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    }


def get_spark(master: str | None = None, app: str = "tickforge",
              shuffle_partitions: int | None = None,
              input_bytes: int | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings the operators assume.

    ``input_bytes`` sizes scan splits and shuffle partitions for the data
    (``sizing_conf``); otherwise the shuffle width is the local core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cores = os.cpu_count() or 8
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # AQE measures the materialised side before turning a join into a
        # broadcast; this is the size check for every implicit broadcast.
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
        # small inputs with heavy per-row work (distances, tree binning,
        # network training) keep several tasks instead of one
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cores),
        "spark.ui.enabled": "false",
        # checkpoint files of tables no longer referenced are removed
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("TICKFORGE_DRIVER_MEMORY", "16g"),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if input_bytes is not None:
        conf.update(sizing_conf(input_bytes, total_cores=cores))
        if shuffle_partitions:
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Runtime SQL settings the operators rely on, for sessions built
    elsewhere (the values of ``get_spark``)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256KB")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    On a cluster the folder must come from ``spark.checkpoint.dir`` (a shared
    file system).  Only a local-mode session without that setting — tests and
    laptop runs — gets a private temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="tickforge-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def ship_package(spark: SparkSession) -> None:
    """Make ``tickforge`` usable in every Python worker (once per context).

    Its functions are pickled by value, and the package is also zipped on the
    driver and registered with ``addPyFile`` (served to every executor, as
    ``--py-files`` would) for code that imports it by name.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_tickforge_shipped", False):
        return
    # Functions and classes of this package are pickled by value, so Python
    # processes that never received the zip (driver-side streaming runners)
    # can still run them.
    import importlib

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(importlib.import_module("tickforge"))
    root = os.path.dirname(os.path.abspath(__file__))
    fd, zpath = tempfile.mkstemp(prefix="tickforge-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _dirs, files in os.walk(root):
            if "__pycache__" in dirpath:
                continue
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(zpath)
    sc._tickforge_shipped = True


def materialize(df, eager: bool = True):
    """Cut the lineage of a table reused by several branches: a reliable
    checkpoint into the shared ``spark.checkpoint.dir`` (survives executor
    loss, and later stages read it instead of recomputing the plan)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_stream_state_store(spark: SparkSession) -> None:
    """Keyed state with several variables needs the RocksDB state store
    (column families); set it when the session runs another provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)
