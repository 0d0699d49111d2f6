"""Symbols without bars are closed and their state removed."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickforge.streaming import jobs as SJ
from tickforge.streaming.processor import BarForecaster
from test_processor_features import Value


def _bars(spark):
    """``a`` has bars for half an hour, comes back after ten hours; ``b`` always has some."""
    at = pd.Timestamp("2024-01-01")
    rows = [("a", str(at + pd.Timedelta(minutes=15 * k)), float(k)) for k in (0, 1, 2, 41)]
    rows += [("b", str(at + pd.Timedelta(minutes=15 * k)), 10.0 + k % 3) for k in range(48)]
    df = spark.createDataFrame(rows, "symbol string, at string, close double")
    return df.select("symbol", F.col("at").cast("timestamp").alias("datetime"), *[F.col("close").alias(c) for c in ("open", "high", "low")],
                     "close", F.lit(1.0).alias("volume"))


def _run(spark, bars, chunks, per_batch):
    root = SJ.new_scratch(spark, "test-idle")
    SJ.replay_messages(bars, root + "/msgs", chunks=chunks, files_per_chunk=2)
    paths = SJ.run_replay(spark, root + "/msgs", root + "/out", max_files_per_trigger=per_batch,
                          idle_seconds=3600, delay="30 minutes")
    return root, paths


def _idle(spark, paths):
    rows = SJ.read_idle(spark, paths).collect()
    return sorted((r["symbol"], str(r["datetime"]), r["EMA5"], r["seen"]) for r in rows)


def test_idle_symbol_is_closed_once_however_bars_fall_into_batches(spark):
    bars = _bars(spark)
    ema = 1 / 3 * (1 - 1 / 3) + 2 / 3
    for chunks, per_batch in ((6, 2), (1, 100)):
        root, paths = _run(spark, bars, chunks, per_batch)
        # the second stretch of ``a`` ends 75 minutes before the last bar: not past the watermark yet
        (row,) = _idle(spark, paths)
        assert row[0] == "a" and row[1] == "2024-01-01 00:30:00" and row[3] == 3 and np.isclose(row[2], ema)
        back = spark.read.parquet(paths.capture).where("symbol = 'a'").orderBy("datetime").collect()
        assert len(back) == 4 and back[-1]["EMA5"] == 41.0


def test_timer_removes_the_state_across_a_restart(spark):
    bars = _bars(spark)
    cut = F.lit("2024-01-01 04:00:00").cast("timestamp")
    root, paths = _run(spark, bars.where(F.col("datetime") < cut), 3, 2)
    assert {r["symbol"] for r in SJ.read_bar_state(spark, root + "/out/_checkpoint").collect()} == {"b"}
    assert len(_idle(spark, paths)) == 1
    SJ.replay_messages(bars.where(F.col("datetime") >= cut), root + "/msgs", chunks=2, files_per_chunk=2,
                       first_chunk=3)
    SJ.run_replay(spark, root + "/msgs", root + "/out", max_files_per_trigger=2, idle_seconds=3600,
                  delay="30 minutes")
    kept = {r["symbol"]: r["seen"] for r in SJ.read_bar_state(spark, root + "/out/_checkpoint").collect()}
    assert kept == {"a": 1, "b": 48} and len(_idle(spark, paths)) == 1


def test_no_symbol_is_idle(spark):
    _, paths = _run(spark, _bars(spark).where("symbol = 'b'"), 1, 100)
    assert _idle(spark, paths) == []


class Timers:
    def __init__(self):
        self.at = []

    def listTimers(self):
        return iter(self.at)

    def deleteTimer(self, at):
        self.at.remove(at)

    def registerTimer(self, at):
        self.at.append(at)


def test_network_is_emitted_before_it_is_removed():
    proc = BarForecaster(seq_len=2, n_features=7, hidden=2, idle_seconds=3600)
    proc.bar, proc.buf, proc.net, proc.handle = Value(), Value(), Value(), Timers()
    size = proc.layout.size
    weights = np.linspace(-0.5, 0.5, size)
    proc._keep_net([weights, np.zeros(size), np.zeros(size), 5])
    assert (proc._kept_net()[0] == weights).all() and proc._kept_net()[3] == 5

    def feed(times):
        rows = pd.DataFrame({"datetime": pd.to_datetime(times), "open": 1.0, "high": 2.0, "low": 3.0,
                             "close": 4.0, "volume": 5.0})
        rows["smin"], rows["smax"] = [[0.0] * 7] * len(rows), [[9.0] * 7] * len(rows)
        return pd.concat(list(proc.handleInputRows(("s",), iter([rows]), None)))

    feed(["2024-01-01 00:00", "2024-01-01 00:15", "2024-01-01 00:30"])
    assert proc._kept_net()[3] == 6 and len(proc.handle.at) == 1
    learnt = proc._kept_net()[0]
    out = feed(["2024-01-01 09:00", "2024-01-01 09:15"])
    assert out["kind"].tolist() == ["idle", "state", "bar", "bar"]
    assert out["params"].iloc[1] == learnt.tolist() and out["seen"].iloc[0] == 3
    assert not proc.net.exists() and not out["ready"].iloc[2] and len(proc.handle.at) == 1
