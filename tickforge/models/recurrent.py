"""Recurrent network per symbol as Spark jobs (M4 predict, M5 train, M11 state).

Training is data-parallel minibatch Adam.  A symbol's windows lie in shards of
``shard_rows``; a seeded hash of the window number deals them to minibatches,
so every shard knows its part of each batch.  Per step, the shards sum the
gradients of their windows under the weights they are sent, the sums are added
by slices of the weight vector, and one Adam update gives the next weights.
Every window trains, no task holds more than a shard, and the weights do not
depend on the shards beyond rounding.  A symbol of one shard has nothing to
exchange: its steps follow one another inside its task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.models import recurrent_net as N
from tickforge.operators.joins import join_small
from tickforge.session import materialize

STATE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("params", T.ArrayType(T.DoubleType())),
    T.StructField("adam_m", T.ArrayType(T.DoubleType())),
    T.StructField("adam_v", T.ArrayType(T.DoubleType())),
    T.StructField("step", T.LongType()),
    T.StructField("n_train", T.LongType()),
    T.StructField("losses", T.ArrayType(T.DoubleType())),
])


def _windows_to_xy(pdf: pd.DataFrame, seq_len: int, n_features: int):
    X = np.stack(pdf["x"].to_numpy()).reshape(len(pdf), seq_len, n_features)
    y = pdf["y"].to_numpy(dtype=float) if "y" in pdf else None
    return X, y


#: Windows of a shard, steps of an epoch at most (batches grow beyond), slices
#: in which gradients are added, and symbols of several shards trained at once
#: (their weights and moments are what the driver holds).
SHARD_ROWS = 100_000
MAX_STEPS = 64
SLICES = 16
WAVE = 32


@dataclass(frozen=True)
class Training:
    """Settings of a fit."""
    layout: N.Layout
    seq_len: int
    epochs: int
    batch_size: int
    lr: float
    seed: int
    max_steps: int

    def start(self, symbol: str, state=None):
        if state is None:
            flat = N.init_params(self.layout, N.symbol_seed(self.seed, symbol))
            return flat, np.zeros_like(flat), np.zeros_like(flat), 0
        return (*(np.asarray(state[c], float) for c in ("params", "adam_m", "adam_v")), int(state["step"]))

    def batch_count(self, n: int) -> int:
        return N.minibatch_count(n, self.batch_size, self.max_steps)


def _whole_symbol(cfg: Training):
    """Pandas function that trains one symbol in its task."""
    def train(win: pd.DataFrame, state=None) -> pd.DataFrame:
        symbol = win["symbol"].iloc[0]
        win = win.sort_values("widx", kind="stable")
        X, y = _windows_to_xy(win, cfg.seq_len, cfg.layout.input_size)
        widx, count, own = win["widx"].to_numpy(), cfg.batch_count(len(y)), N.symbol_seed(cfg.seed, symbol)

        def batches(e):
            dealt = N.minibatch_of(widx, own, e, count)
            return (np.flatnonzero(dealt == b) for b in range(count))
        flat, m, v, step, losses = N.train_batches(*cfg.start(symbol, state), cfg.layout, X, y, cfg.epochs, cfg.lr, batches)
        return pd.DataFrame([(symbol, flat, m, v, step, len(y), losses)], columns=STATE_SCHEMA.fieldNames())
    return train


def _packed(windows: DataFrame, shard_rows: int, cfg: Training) -> DataFrame:
    """One stored row per (symbol, shard): window numbers, inputs and targets
    as bytes, read again by every step."""
    def pack(win: pd.DataFrame) -> pd.DataFrame:
        win = win.sort_values("widx", kind="stable")
        X, y = _windows_to_xy(win, cfg.seq_len, cfg.layout.input_size)
        return pd.DataFrame([(win["symbol"].iloc[0], int(win["shard"].iloc[0]), win["widx"].to_numpy(np.int64).tobytes(),
                              X.tobytes(), y.tobytes())], columns=["symbol", "shard", "widx", "x", "y"])
    dealt = windows.withColumn("shard", F.expr(f"(widx - _from) div {int(shard_rows)}"))
    return materialize(dealt.groupBy("symbol", "shard").applyInPandas(
        pack, "symbol string, shard long, widx binary, x binary, y binary"))


def _gradients(packed: DataFrame, weights, cfg: Training, epoch: int, batch: int) -> DataFrame:
    """(symbol, slice, n, loss, g): gradient sums of one minibatch of every
    symbol in the broadcast ``weights`` (symbol -> weights, batch count)."""
    def part(frames):
        sent = weights.value
        for frame in frames:
            rows = []
            for symbol, shard, widx, x, y in zip(*(frame[c] for c in ("symbol", "shard", "widx", "x", "y"))):
                flat, count = sent.get(symbol, (None, 0))
                if flat is None:
                    continue
                own = N.symbol_seed(cfg.seed, symbol)
                at = np.flatnonzero(N.minibatch_of(np.frombuffer(widx, np.int64), own, epoch, count) == batch)
                if len(at):
                    X = np.frombuffer(x).reshape(-1, cfg.seq_len, cfg.layout.input_size)[at]
                    n, loss, g = N.gradient_sum(flat, cfg.layout, X, np.frombuffer(y)[at])
                    rows += [(symbol, shard, k, n, loss, s.tobytes()) for k, s in enumerate(np.array_split(g, SLICES))]
            yield pd.DataFrame(rows, columns=["symbol", "shard", "slice", "n", "loss", "g"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard", kind="stable")  # the same sum on every run
        g = np.zeros(len(rows["g"].iloc[0]) // 8)
        for s in rows["g"]:
            g += np.frombuffer(s)
        return pd.DataFrame([(rows["symbol"].iloc[0], rows["slice"].iloc[0], rows["n"].sum(), rows["loss"].sum(),
                              g.tobytes())], columns=["symbol", "slice", "n", "loss", "g"])
    parts = packed.mapInPandas(part, "symbol string, shard long, slice int, n long, loss double, g binary")
    return parts.groupBy("symbol", "slice").applyInPandas(
        add, "symbol string, slice int, n long, loss double, g binary")


def _train_shards(windows: DataFrame, sizes: dict[str, int], init, shard_rows: int, cfg: Training) -> DataFrame:
    """State rows of the symbols in ``sizes`` (at most ``WAVE``), one Spark job
    a step; the driver holds their weights and moments and nothing of the rows."""
    spark = windows.sparkSession
    names = sorted(sizes)
    packed = _packed(windows.where(F.col("symbol").isin(names)), shard_rows, cfg)
    given = {r["symbol"]: r for r in init.where(F.col("symbol").isin(names)).collect()} if init is not None else {}
    state = {s: list(cfg.start(s, given.get(s))) for s in names}
    losses = {s: [] for s in names}
    counts = {s: cfg.batch_count(n) for s, n in sizes.items()}
    for epoch in range(cfg.epochs):
        spent = {s: [] for s in names}
        for batch in range(max(counts.values())):
            weights = spark.sparkContext.broadcast({s: (state[s][0], counts[s]) for s in names if batch < counts[s]})
            found: dict[str, list] = {}
            for r in _gradients(packed, weights, cfg, epoch, batch).collect():
                found.setdefault(r["symbol"], []).append(r)
            for s, slices in found.items():
                slices.sort(key=lambda r: r["slice"])
                n = slices[0]["n"]
                grad = np.concatenate([np.frombuffer(r["g"]) for r in slices]) / n
                state[s] = list(N.adam_step(*state[s], grad, cfg.lr))
                spent[s].append(slices[0]["loss"] / n)
            weights.destroy()
        for s in names:
            losses[s].append(float(np.sum(spent[s]) / max(len(spent[s]), 1)))
    rows = [(s, state[s][0].tolist(), state[s][1].tolist(), state[s][2].tolist(), state[s][3], sizes[s], losses[s])
            for s in names]
    return materialize(spark.createDataFrame(rows, STATE_SCHEMA))


def fit(windows: DataFrame, seq_len: int, n_features: int, hidden: int = 64,
        epochs: int = 50, batch_size: int = 16, lr: float = 1e-4, seed: int = 0,
        init: DataFrame | None = None, shard_rows: int = SHARD_ROWS, max_steps: int = MAX_STEPS) -> DataFrame:
    """Train one network per symbol on all of its windows; returns the state
    table (one row per symbol).  ``init`` resumes from a saved state table
    (weights and Adam moments), otherwise weights start from a seeded uniform
    init.  An epoch of n windows is min(ceil(n / batch_size), max_steps) steps."""
    cfg = Training(N.Layout(n_features, hidden), seq_len, epochs, batch_size, lr, seed, max_steps)
    sizes = materialize(windows.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n"), F.min("widx").alias("_from"),
                                                      F.max("widx").alias("_to")))
    rows = join_small(windows.select("symbol", "widx", "x", "y"), sizes, "symbol")
    shards = F.expr(f"(_to - _from) div {int(shard_rows)}")
    alone = rows.where(shards == 0).drop("_n", "_from", "_to")
    train = _whole_symbol(cfg)

    def resumed(win: pd.DataFrame, st: pd.DataFrame) -> pd.DataFrame:
        if win.empty:
            return st[STATE_SCHEMA.fieldNames()]
        return train(win, None if st.empty else st.iloc[0])

    several = sizes.where(shards > 0)
    state = None
    if init is None:
        out = alone.groupBy("symbol").applyInPandas(lambda win: train(win), STATE_SCHEMA)
    else:
        state = init.select(*STATE_SCHEMA.fieldNames())
        rest = state.join(several.select("symbol"), "symbol", "left_anti")
        out = alone.groupBy("symbol").cogroup(rest.groupBy("symbol")).applyInPandas(resumed, STATE_SCHEMA)
    out = materialize(out)
    wave: dict[str, int] = {}

    def finish(found: DataFrame) -> DataFrame:
        return found.union(_train_shards(rows, wave, state, shard_rows, cfg)) if wave else found
    for r in several.select("symbol", "_n").orderBy("symbol").toLocalIterator():
        wave[r["symbol"]] = r["_n"]
        if len(wave) == WAVE:
            out, wave = finish(out), {}
    return finish(out)


def epoch_losses(state: DataFrame) -> DataFrame:
    """(symbol, epoch from 0, loss): the mean loss of every epoch."""
    return state.select("symbol", F.posexplode("losses").alias("epoch", "loss"))


def predict(windows: DataFrame, state: DataFrame, seq_len: int, n_features: int,
            hidden: int = 64, out: str = "pred_recurrent", shard_rows: int = 100_000) -> DataFrame:
    """Forward pass of each symbol's network over its windows (vectorised
    per shard); returns the window rows with ``out`` added."""
    layout = N.Layout(n_features, hidden)
    cols = windows.columns
    parts = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = (windows.withColumn("_shard", F.floor(F.col("widx") / F.lit(shard_rows)).cast("long"))
         .repartition(parts, "symbol", "_shard"))
    per_shard = (w.select(F.col("symbol").alias("symbol"), F.col("_shard").alias("_shard"))
                 .distinct().join(state.select("symbol", "params"), "symbol")
                 .repartition(parts, "symbol", "_shard"))
    schema = T.StructType([f for f in windows.schema.fields] + [T.StructField(out, T.DoubleType())])

    def _fwd(win: pd.DataFrame, st: pd.DataFrame) -> pd.DataFrame:
        if win.empty:
            return pd.DataFrame(columns=schema.fieldNames())
        res = win[cols].copy()
        if st.empty:
            res[out] = np.nan
            return res
        X, _ = _windows_to_xy(win, seq_len, n_features)
        res[out] = N.forward(np.asarray(st["params"].iloc[0], float), layout, X)
        return res

    return (w.groupBy("symbol", "_shard").cogroup(per_shard.groupBy("symbol", "_shard"))
            .applyInPandas(_fwd, schema))
