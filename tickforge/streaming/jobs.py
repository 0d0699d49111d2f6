"""Streaming jobs: replay, keyed forecasting with state, per-batch sinks."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.operators import clean as C
from tickforge.schemas import FEATURES_G2, STREAM_BAR
from tickforge.session import ensure_stream_state_store, scratch_path
from tickforge.sinks import messages as MSG
from tickforge.sources import stream as ST
from tickforge.streaming.processor import OUTPUT, SEED_SCHEMA, BarForecaster


def replay_messages(bars: DataFrame, path: str, chunks: int = 3,
                    files_per_chunk: int | None = None, first_chunk: int = 0) -> list[str]:
    """Write bars as keyed message files in ``chunks`` consecutive time
    ranges (R9).  Each range is written after the previous one and
    hash-partitioned by symbol, so a file source that takes files oldest
    first sees every symbol's bars in time order, whatever
    ``maxFilesPerTrigger`` is."""
    spark = bars.sparkSession
    parts = files_per_chunk or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rng = bars.agg(F.min(F.unix_micros("datetime")).alias("lo"),
                   F.max(F.unix_micros("datetime")).alias("hi")).first()
    if rng["lo"] is None:
        return []
    lo, hi = int(rng["lo"]), int(rng["hi"]) + 1
    step = -(-(hi - lo) // chunks)
    written = []
    for k in range(chunks):
        a, b = lo + k * step, lo + (k + 1) * step
        part = bars.where((F.unix_micros("datetime") >= a) & (F.unix_micros("datetime") < b))
        out = f"{path.rstrip('/')}/chunk={first_chunk + k:05d}"
        MSG.encode_bars(part).repartition(parts, "key").write.mode("overwrite").json(out)
        written.append(out)
    return written


def message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                   kafka_options: dict[str, str] | None = None) -> DataFrame:
    """Streaming messages of the chunk folders under ``path``, or of Kafka."""
    return ST.read_message_stream(spark, path + "/*" if kafka_options is None else path,
                                  max_files_per_trigger=max_files_per_trigger,
                                  kafka_options=kafka_options)


def bar_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
               kafka_options: dict[str, str] | None = None) -> DataFrame:
    """Decoded streaming bars (P1-P3, P9), datetime as TIMESTAMP."""
    return ST.timed_bars(message_stream(spark, path, max_files_per_trigger, kafka_options))


def start_rejected(messages: DataFrame, paths: SinkPaths, trigger: str | None = None):
    """Start the query that appends every message left out of the bars, with
    the reason, to ``paths.rejected``: a stateless filter with a file sink and
    a checkpoint of its own, so a restart neither loses nor repeats a row."""
    w = (ST.rejected_messages(messages).writeStream.format("parquet")
         .option("path", paths.rejected)
         .option("checkpointLocation", f"{paths.root.rstrip('/')}/_checkpoint_rejected"))
    return (w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)).start()


def read_rejected(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    """(key, value, reason) rows written so far."""
    return spark.read.schema("key string, value string, reason string").parquet(paths.rejected)


def scaler_arrays(scaler: DataFrame, features: list[str] = FEATURES_G2) -> DataFrame:
    """Scaler rows as ``smin`` / ``smax`` arrays (feature order)."""
    return scaler.select("symbol", F.array(*[F.col(f"{f}_min").cast("double") for f in features]).alias("smin"),
                         F.array(*[F.col(f"{f}_max").cast("double") for f in features]).alias("smax"))


def seed_state(feat: DataFrame, scaler: DataFrame | None, net_state: DataFrame | None,
               seq_len: int = 3, features: list[str] = FEATURES_G2) -> DataFrame:
    """Initial stream state per symbol from history (W12): the last EMA5 and
    bar time, the last ``seq_len`` scaled rows, and the trained network."""
    from tickforge.operators.features import apply_minmax
    last = C.latest_per_key(feat.select("symbol", "datetime", "EMA5"))
    seeds = last.select("symbol", F.col("EMA5").alias("ema"),
                        F.unix_micros("datetime").alias("last_ts"), F.lit(0).cast("long").alias("seen"))
    if scaler is not None:
        tail = C.tail_n(feat, seq_len)
        sc = apply_minmax(tail, scaler, features)
        vec = F.array(*[F.col(f"{f}_s").cast("double") for f in features])
        rows = (sc.groupBy("symbol")
                .agg(F.array_sort(F.collect_list(F.struct("datetime", vec.alias("v")))).alias("_r"))
                .select("symbol", F.transform("_r", lambda s: s["v"]).alias("rows")))
        seeds = seeds.join(rows, "symbol", "left")
    else:
        seeds = seeds.withColumn("rows", F.lit(None).cast(SEED_SCHEMA["rows"].dataType))
    if net_state is not None:
        seeds = seeds.join(net_state.select("symbol", "params", "adam_m", "adam_v", "step"),
                           "symbol", "left")
    else:
        for c in ("params", "adam_m", "adam_v"):
            seeds = seeds.withColumn(c, F.lit(None).cast(SEED_SCHEMA[c].dataType))
        seeds = seeds.withColumn("step", F.lit(None).cast("long"))
    return seeds.select(*SEED_SCHEMA.fieldNames())


def forecast_stream(bars: DataFrame, scaler: DataFrame | None = None,
                    seeds: DataFrame | None = None, seq_len: int = 3, hidden: int = 64,
                    lr: float = 1e-4, include_current: bool = False, online: bool = True,
                    emit_state: bool = False, features: list[str] = FEATURES_G2,
                    idle_seconds: int | None = None, delay: str = "1 hour") -> DataFrame:
    """Keyed stateful step (R4/R5/R6): ``groupBy(symbol)`` then the
    per-symbol processor.  The scaler is a stream-static join.  With
    ``idle_seconds`` the state of a symbol without bars for longer is removed
    (watermark ``delay``; bars older than the watermark are dropped)."""
    ensure_stream_state_store(bars.sparkSession)
    rows = bars if idle_seconds is None else bars.withWatermark("datetime", delay)
    if scaler is not None:
        rows = rows.join(scaler_arrays(scaler, features), "symbol", "left")
    else:
        arr = "array<double>"
        rows = rows.withColumn("smin", F.lit(None).cast(arr)).withColumn("smax", F.lit(None).cast(arr))
    proc = BarForecaster(seq_len, len(features), hidden, lr, include_current, online,
                         emit_state=emit_state, features=list(features), idle_seconds=idle_seconds)
    init = seeds.groupBy("symbol") if seeds is not None else None
    return (rows.select("symbol", "datetime", "open", "high", "low", "close", "volume",
                        "smin", "smax")
            .groupBy("symbol")
            .transformWithStateInPandas(proc, OUTPUT, "append", "None" if idle_seconds is None else "EventTime",
                                        initialState=init))


@dataclass
class SinkPaths:
    """Output folders of the per-batch handler (all idempotent per batch)."""
    root: str
    capture: str = field(init=False)
    predictions: str = field(init=False)
    late: str = field(init=False)
    states: str = field(init=False)
    csv: str = field(init=False)
    results: str = field(init=False)
    errors: str = field(init=False)
    rejected: str = field(init=False)
    predictions_long: str = field(init=False)
    idle: str = field(init=False)

    def __post_init__(self):
        r = self.root.rstrip("/")
        self.capture, self.predictions = f"{r}/capture", f"{r}/predictions"
        self.late, self.states, self.csv = f"{r}/late", f"{r}/model_state", f"{r}/batches_csv"
        self.results = f"{r}/results"
        self.errors, self.rejected = f"{r}/errors", f"{r}/rejected"
        self.predictions_long = f"{r}/predictions_long"
        self.idle = f"{r}/idle"


# Columns of the keyed result table and the ones a conflict updates.
RESULT_UPDATE_COLS = ["close_actual", "close_predicted", "ema5", "inc_loss"]


def result_rows(bars: DataFrame) -> DataFrame:
    """Result-table rows of streamed bars: prices, EMA5, the recurrent network forecast
    in price units (null during warm-up), its online loss and ``seq``, the
    bar time in microseconds (``trade_date`` has whole seconds)."""
    from tickforge.operators.features import minmax_inverse
    pred = minmax_inverse(F.col("pred_recurrent"), F.col("close_min"), F.col("close_max"))
    return bars.select(
        "symbol", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("trade_date"),
        F.col("open").alias("open_price"), F.col("high").alias("high_price"),
        F.col("low").alias("low_price"), F.col("close").alias("close_actual"),
        pred.alias("close_predicted"), F.col("EMA5").alias("ema5"), "volume", "inc_loss",
        F.current_timestamp().alias("created_at"), F.unix_micros("datetime").alias("seq"))


def result_part():
    """Partition of a result row: one of 16 shares of the symbols, and the month."""
    return F.concat_ws("-", F.pmod(F.xxhash64("symbol"), F.lit(16)), F.substring("trade_date", 1, 7))


def make_batch_handler(paths: SinkPaths, score_fn=None, write_csv: bool = False,
                       console: bool = False, upsert_results: bool = True, keep_idle: bool = False):
    """``foreachBatch`` handler (R3): compute stays in DataFrames; the
    handler only writes.  Every write is keyed by ``batch_id`` so a replayed
    batch overwrites its own output (no side effects inside transforms)."""
    from tickforge.sinks import tables as TB

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            bars = batch.where((F.col("kind") == "bar") & ~F.col("late"))
            TB.append_capture(bars.select("symbol", "datetime", "open", "high", "low", "close",
                                          "volume", "EMA5"), paths.capture, batch_id)
            late = batch.where((F.col("kind") == "bar") & F.col("late"))
            TB.append_capture(late.select("symbol", "datetime", "open", "high", "low", "close",
                                          "volume"), paths.late, batch_id)
            errors = batch.where(F.col("kind") == "error")
            TB.append_capture(errors.select("symbol", "datetime", "open", "high", "low", "close",
                                            "volume"), paths.errors, batch_id)
            if keep_idle:
                idle = batch.where(F.col("kind") == "idle")
                TB.append_capture(idle.select("symbol", "datetime", "EMA5", "seen"), paths.idle, batch_id)
            states = batch.where(F.col("kind") == "state")
            (states.select("symbol", "params", "adam_m", "adam_v", "step",
                           F.lit(int(batch_id)).alias("version"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("symbol").parquet(paths.states))
            if upsert_results:
                from tickforge.sinks.upsert import last_per_key, upsert_table
                keys = ["symbol", "trade_date"]
                upsert_table(last_per_key(result_rows(bars), keys, "seq").drop("seq"), paths.results, keys,
                             RESULT_UPDATE_COLS, version=batch_id, part=result_part())
            ready = bars.where("ready")
            if score_fn is not None:
                wide = score_fn(ready).persist()
                TB.append_capture(wide, paths.predictions, batch_id)
                TB.append_capture(TB.to_long(wide), paths.predictions_long, batch_id)
                if write_csv:
                    TB.write_batch_csv(wide, paths.csv, batch_id)
                if console:
                    TB.show_batch(wide)
                wide.unpersist()
        finally:
            batch.unpersist()

    return handle


def run_replay(spark: SparkSession, source: str, out_root: str, scaler=None, seeds=None,
               score_fn=None, max_files_per_trigger: int | None = None, trigger: str | None = None,
               checkpoint: str | None = None, write_csv: bool = False, **kw) -> SinkPaths:
    """Run the forecasting stream over message files, and beside it the query
    that stores rejected messages, until they are consumed (``availableNow``)
    or, with ``trigger="5 seconds"``, as two long-running queries (returned
    paths; the caller stops them)."""
    paths = SinkPaths(out_root)
    stream = forecast_stream(bar_stream(spark, source, max_files_per_trigger), scaler, seeds, **kw)
    w = (stream.writeStream.foreachBatch(make_batch_handler(
        paths, score_fn, write_csv=write_csv, keep_idle=kw.get("idle_seconds") is not None))
         .option("checkpointLocation", checkpoint or f"{out_root.rstrip('/')}/_checkpoint"))
    w = w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)
    q = w.start()
    rejected = start_rejected(message_stream(spark, source, max_files_per_trigger), paths, trigger)
    if not trigger:
        q.awaitTermination()
        rejected.awaitTermination()
    return paths


def stop_gracefully(queries: list) -> None:
    """Stop long-running queries after everything that has arrived went
    through: each finishes its open batches and commits sinks and state."""
    for q in queries:
        q.processAllAvailable()
    for q in queries:
        q.stop()
        q.awaitTermination()


def read_bar_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """symbol, EMA5, datetime of the last bar and bars seen, from the keyed
    state that a stopped forecasting stream committed last (or at a batch)."""
    ensure_stream_state_store(spark)
    state = spark.read.format("statestore").option("stateVarName", "bar")
    if batch_id is not None:
        state = state.option("batchId", int(batch_id))
    kept = state.load(checkpoint)
    return kept.select(F.col("key.symbol").alias("symbol"), F.col("value.ema").alias("EMA5"),
                       F.timestamp_micros("value.last_ts").alias("datetime"), F.col("value.seen").alias("seen"))


def read_idle(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    """Closed stretches written so far: symbol, last bar, EMA5 and bars; no rows if none was closed."""
    return (spark.read.schema("symbol string, datetime timestamp, EMA5 double, seen long").parquet(paths.idle)
            .select("symbol", "datetime", "EMA5", "seen"))


def new_scratch(spark: SparkSession, prefix: str) -> str:
    return scratch_path(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")
