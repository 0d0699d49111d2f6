"""Per-symbol streaming state (``transformWithStateInPandas`` keyed by symbol).

State of a symbol, kept in the state store (checkpointed with the query):

* ``bar``   — last EMA5, time of the last handled bar, bars seen;
* ``buf``   — ring buffer of the last ``seq_len`` scaled feature rows;
* ``net``   — recurrent network weights, Adam moments (bytes of doubles) and step (online learning).

For each micro-batch the rows of a symbol are sorted by bar time and folded
in order: EMA5 is updated by one multiply-add (W2), the bar is scaled with
the symbol's scaler, a forecast is made from the ``seq_len`` bars *before*
it (W8; ``include_current`` uses the window ending with it, W7), the
network learns from the observed close with one Adam step (M8), and the
scaled bar enters the buffer.  A bar not newer than the last handled one is
emitted with ``late = true`` and changes no state; a bar with a missing or
non-finite price or volume is emitted with ``kind = "error"`` and changes no
state either.

With ``idle_seconds`` a symbol that has no bar for longer is closed: its last
EMA, bar time and count are emitted with ``kind = "idle"`` (its network, if
any, with ``kind = "state"``) and its state is removed.  An event-time timer
does so once the watermark is past; a bar that comes after such a gap does so
too, and then starts anew, so what is emitted does not depend on how the bars
fall into batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickforge.schemas import FEATURES_G1, FEATURES_G2
from tickforge.functions.ema import EMA_SPAN, ema_alpha
from tickforge.models import recurrent_net as N

BAR_STATE = T.StructType([T.StructField("ema", T.DoubleType()),
                          T.StructField("last_ts", T.LongType()),
                          T.StructField("seen", T.LongType())])
BUF_STATE = T.StructType([T.StructField("rows", T.ArrayType(T.ArrayType(T.DoubleType())))])
NET_STATE = T.StructType([T.StructField("params", T.BinaryType()),
                          T.StructField("adam_m", T.BinaryType()),
                          T.StructField("adam_v", T.BinaryType()),
                          T.StructField("step", T.LongType())])

OUTPUT = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("datetime", T.TimestampType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("EMA5", T.DoubleType()),
    T.StructField("late", T.BooleanType()),
    T.StructField("ready", T.BooleanType()),
    T.StructField("x", T.ArrayType(T.DoubleType())),
    T.StructField("y", T.DoubleType()),
    T.StructField("pred_recurrent", T.DoubleType()),
    T.StructField("inc_loss", T.DoubleType()),
    T.StructField("close_min", T.DoubleType()),
    T.StructField("close_max", T.DoubleType()),
    T.StructField("params", T.ArrayType(T.DoubleType())),
    T.StructField("adam_m", T.ArrayType(T.DoubleType())),
    T.StructField("adam_v", T.ArrayType(T.DoubleType())),
    T.StructField("step", T.LongType()),
    T.StructField("seen", T.LongType()),
])

SEED_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ema", T.DoubleType()),
    T.StructField("last_ts", T.LongType()),
    T.StructField("seen", T.LongType()),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("params", T.ArrayType(T.DoubleType())),
    T.StructField("adam_m", T.ArrayType(T.DoubleType())),
    T.StructField("adam_v", T.ArrayType(T.DoubleType())),
    T.StructField("step", T.LongType()),
])

_TINY = 10 * 2.220446049250313e-16


def _scale(vec: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    rng = hi - lo
    s = 1.0 / np.where(rng < _TINY, 1.0, rng)
    return vec * s + (0.0 - lo * s)


class BarForecaster(StatefulProcessor):
    def __init__(self, seq_len: int = 3, n_features: int = 7, hidden: int = 64,
                 lr: float = 1e-4, include_current: bool = False, online: bool = True,
                 span: int = EMA_SPAN, emit_state: bool = False, target_idx: int = 3,
                 features: list[str] | None = None, idle_seconds: int | None = None):
        self.seq_len, self.n_features, self.hidden = seq_len, n_features, hidden
        self.lr, self.include_current, self.online = lr, include_current, online
        self.alpha = ema_alpha(span)
        self.emit_state = emit_state
        self.target_idx = target_idx
        self.idle_us = None if idle_seconds is None else int(idle_seconds) * 1_000_000
        # inputs are taken by name, in the order the model was trained on
        self.features = list(features or {len(f): f for f in (FEATURES_G1, FEATURES_G2)}[n_features])
        unknown = [f for f in self.features if f not in FEATURES_G2]
        if unknown or len(self.features) != n_features:
            raise ValueError(f"unknown or missing features: {self.features}")
        self.layout = N.Layout(n_features, hidden)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bar = handle.getValueState("bar", BAR_STATE)
        self.buf = handle.getValueState("buf", BUF_STATE)
        self.net = handle.getValueState("net", NET_STATE)

    def handleInitialState(self, key, init: pd.DataFrame, timerValues) -> None:
        r = init.iloc[0]
        if pd.notna(r["ema"]):
            self.bar.update((float(r["ema"]), int(r["last_ts"]), int(r["seen"])))
            self._set_timer(int(r["last_ts"]))
        if r["rows"] is not None:
            self.buf.update(([list(map(float, row)) for row in r["rows"]],))
        if r["params"] is not None:
            self._keep_net([np.asarray(r[c], float) for c in ("params", "adam_m", "adam_v")] + [int(r["step"])])

    def _keep_net(self, net: list) -> None:
        self.net.update((*(np.asarray(a, float).tobytes() for a in net[:3]), int(net[3])))

    def _kept_net(self) -> list | None:
        if not self.net.exists():
            return None
        *arrays, step = self.net.get()
        return [np.frombuffer(bytes(a), float).copy() for a in arrays] + [int(step)]

    def _set_timer(self, last_ts: int) -> None:
        """One timer per symbol: a millisecond after it has been idle for long enough."""
        if self.idle_us is None:
            return
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer((last_ts + self.idle_us) // 1000 + 1)

    def _closed(self, key, ema, last_ts, seen, net) -> list[dict]:
        """Rows emitted for a symbol whose state is removed."""
        blank = {**dict.fromkeys(OUTPUT.fieldNames()), "symbol": key[0], "late": False, "ready": False}
        out = [{**blank, "kind": "idle", "datetime": pd.Timestamp(last_ts * 1000), "EMA5": ema, "seen": seen}]
        if net is not None:
            out.append(self._net_row(key, net))
        return out

    @staticmethod
    def _net_row(key, net) -> dict:
        return {**dict.fromkeys(OUTPUT.fieldNames()), "kind": "state", "symbol": key[0], "params": net[0].tolist(),
                "adam_m": net[1].tolist(), "adam_v": net[2].tolist(), "step": int(net[3])}

    @staticmethod
    def _frame(out: list[dict]) -> pd.DataFrame:
        res = pd.DataFrame(out, columns=OUTPUT.fieldNames()).astype(object)
        return res.where(pd.notna(res), None) if len(res) else res

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        ema, last_ts, seen = self.bar.get() if self.bar.exists() else (None, None, 0)
        if last_ts is None or (last_ts + self.idle_us) // 1000 + 1 > expiredTimerInfo.getExpiryTimeInMs():
            return
        out = self._closed(key, ema, last_ts, seen, self._kept_net())
        for kept in (self.bar, self.buf, self.net):
            kept.clear()
        yield self._frame(out)

    def _step_ema(self, ema, close):
        if ema is None:
            return close
        if ema == close:
            return ema
        return ema * (1.0 - self.alpha) + close * self.alpha

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows), ignore_index=True)
        pdf = pdf.sort_values("datetime", kind="stable")
        ema, last_ts, seen = self.bar.get() if self.bar.exists() else (None, None, 0)
        buf = [np.asarray(r, float) for r in self.buf.get()[0]] if self.buf.exists() else []
        net = self._kept_net()
        out = []
        blank = dict.fromkeys(OUTPUT.fieldNames())
        L = self.seq_len
        for r in pdf.itertuples(index=False):
            ts_us = int(pd.Timestamp(r.datetime).value // 1000)
            base = {**blank, "kind": "bar", "symbol": key[0], "datetime": r.datetime,
                    "open": r.open, "high": r.high, "low": r.low, "close": r.close,
                    "volume": r.volume}
            vals = np.array([r.open, r.high, r.low, r.close, r.volume], dtype=float)
            if not np.isfinite(vals).all():
                # bad row: reported, state untouched, the batch goes on
                out.append({**base, "kind": "error", "late": False, "ready": False})
                continue
            if last_ts is not None and ts_us <= last_ts:
                out.append({**base, "late": True, "ready": False})
                continue
            if last_ts is not None and self.idle_us is not None and ts_us - last_ts > self.idle_us:
                out += self._closed(key, ema, last_ts, seen, net)
                ema, seen, buf, net = None, 0, [], None
                self.net.clear()
            ema = self._step_ema(ema, float(r.close))
            last_ts, seen = ts_us, seen + 1
            row = {**base, "EMA5": ema, "late": False, "ready": False}
            lo = getattr(r, "smin", None)
            if lo is not None and not (isinstance(lo, float) and np.isnan(lo)):
                lo, hi = np.asarray(r.smin, float), np.asarray(r.smax, float)
                known = {"open": r.open, "high": r.high, "low": r.low, "close": r.close,
                         "volume": r.volume, "timestamp": ts_us / 1e6, "EMA5": ema}
                feat = np.array([known[f] for f in self.features], float)
                scaled = _scale(feat, lo, hi)
                y = float(scaled[self.target_idx])
                row.update(close_min=float(lo[self.target_idx]), close_max=float(hi[self.target_idx]),
                           y=y)
                if self.include_current:
                    # the new close is learnt from the window before it; the
                    # window that ends here forecasts the next bar
                    if net is not None and self.online and len(buf) >= L:
                        _, loss, (pp, mm, vv, st) = N.online_update(
                            net[0], net[1], net[2], net[3], self.layout, np.stack(buf[-L:]), y, self.lr)
                        net = [pp, mm, vv, st]
                        row.update(inc_loss=loss)
                    buf = (buf + [scaled])[-L:]
                window = buf[-L:] if len(buf) >= L else None
                if window is not None:
                    X = np.stack(window)
                    row.update(ready=True, x=X.ravel().tolist())
                    if net is not None:
                        if self.online and not self.include_current:
                            pred, loss, (pp, mm, vv, st) = N.online_update(
                                net[0], net[1], net[2], net[3], self.layout, X, y, self.lr)
                            net = [pp, mm, vv, st]
                            row.update(pred_recurrent=pred, inc_loss=loss)
                        else:
                            row.update(pred_recurrent=float(N.forward(net[0], self.layout, X[None])[0]))
                if not self.include_current:
                    buf = (buf + [scaled])[-L:]
            out.append(row)
        self.bar.update((ema, last_ts, seen))
        self.buf.update(([b.tolist() for b in buf],))
        if last_ts is not None:
            self._set_timer(last_ts)
        if net is not None:
            self._keep_net(net)
            if self.emit_state and self.online:
                out.append(self._net_row(key, net))
        yield self._frame(out)

    def close(self) -> None:
        pass
