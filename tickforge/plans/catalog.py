"""Registered queries: one Spark plan per operator of the bar engine, each
with the DuckDB SQL that recomputes it from the same raw tables.

Every query reads the driver tables (``sf_dir``) in full; nothing is
sampled or capped except where a limit is the operator itself (tail-n,
top-k).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.operators import clean as C
from tickforge.operators.indicators import with_ema
from tickforge.plans import inputs as I
from tickforge.plans import oracle_sql as Q
from tickforge.session import materialize
from tickforge.sources import bars as B

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


BAR_OUT = "symbol, datetime, open, high, low, close, volume"
SPLIT_TIME = "2024-01-16 00:00:00"

# ---------------------------------------------------------------- sources


@query("bars_hourly", f"SELECT {BAR_OUT} FROM ({Q.EVENTS_BARS})")
def bars_hourly(spark, sf):
    """S2/adapter: hourly OHLCV bars per event type."""
    return B.events_bars(B.table(spark, sf, "events"))


@query("bars_daily_brand", f"SELECT {BAR_OUT} FROM ({Q.LINEITEM_BARS})")
def bars_daily_brand(spark, sf):
    """Adapter: daily OHLCV bars per part brand (lineitem ⋈ part)."""
    return B.lineitem_bars(B.table(spark, sf, "lineitem"), B.table(spark, sf, "part"))


@query("bars_union_by_name", f"""
SELECT {BAR_OUT}, timestamp, EMA5 FROM ({Q.ema(Q.HOURLY)}) WHERE datetime < TIMESTAMP '{SPLIT_TIME}'
UNION ALL BY NAME
SELECT {BAR_OUT}, EMA5 FROM ({Q.ema(Q.HOURLY)}) WHERE datetime >= TIMESTAMP '{SPLIT_TIME}'""")
def bars_union_by_name(spark, sf):
    """Stored history (with ``timestamp``) ∪ stream captures (without)."""
    bars = with_ema(I.hourly_bars(spark, sf))
    cut = F.lit(SPLIT_TIME).cast("timestamp")
    history = bars.where(F.col("datetime") < cut)
    captures = bars.where(F.col("datetime") >= cut).drop("timestamp")
    return B.union_by_name(history, captures)


# ---------------------------------------------------------------- cleaning


@query("clean_bars", f"SELECT * FROM ({Q.clean(Q.MINUTE_TICKS, '_ts, _eid')})")
def clean_bars_q(spark, sf):
    """Raw minute feed -> complete, unique, epoch-stamped bars."""
    return C.clean_bars(I.minute_ticks(spark, sf), order="ingest_order").drop("ingest_order")


@query("dedup_keep_first", f"""
SELECT {BAR_OUT} FROM (SELECT *, row_number() OVER (PARTITION BY datetime, symbol
                                                    ORDER BY _ts, _eid) AS rn
                       FROM ({Q.MINUTE_TICKS})) WHERE rn = 1""")
def dedup_keep_first_q(spark, sf):
    """P5: first bar of each (datetime, symbol) in ingest order."""
    return C.dedup_keep_first(I.minute_ticks(spark, sf), ["datetime", "symbol"],
                              "ingest_order").drop("ingest_order")


@query("coerce_numeric", """
SELECT * FROM (
  SELECT event_type AS symbol, CAST(ts AS VARCHAR) AS datetime,
         TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS open,
         TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS high,
         TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS low,
         TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS close,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume
  FROM events)
WHERE open IS NOT NULL AND NOT isnan(open) AND high IS NOT NULL AND NOT isnan(high)
  AND low IS NOT NULL AND NOT isnan(low) AND close IS NOT NULL AND NOT isnan(close)
  AND volume IS NOT NULL AND NOT isnan(volume)""")
def coerce_numeric_q(spark, sf):
    """Producer text columns -> canonical names -> DOUBLE, bad rows out."""
    ev = B.table(spark, sf, "events")
    text = ev.select(
        F.col("event_type").alias("symbol"), F.col("ts").cast("string").alias("Date"),
        *[F.col("value").cast("string").alias(n) for n in ("Open", "High", "Low", "Close")],
        F.get_json_object("props", "$.k").alias("Volume"))
    canon = C.require_columns(C.normalise_columns(text),
                              ["symbol", "datetime", "open", "high", "low", "close", "volume"])
    return C.coerce_numeric(canon)


@query("tail_n", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) AS rn
               FROM ({Q.HOURLY})) WHERE rn <= 30""")
def tail_n_q(spark, sf):
    """Last 30 bars of each symbol (rank kept as ``rn``)."""
    from pyspark.sql import Window
    w = Window.partitionBy("symbol").orderBy(F.col("datetime").desc())
    bars = I.hourly_bars(spark, sf)
    return bars.withColumn("rn", F.row_number().over(w).cast("long")).where(F.col("rn") <= 30)


@query("latest_bar", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY datetime DESC) AS rn
               FROM ({Q.ema(Q.HOURLY)})) WHERE rn = 1""")
def latest_bar_q(spark, sf):
    """Newest bar of each symbol with its EMA5 (EMA seed for a stream)."""
    return C.latest_per_key(with_ema(I.hourly_bars(spark, sf)))


# ---------------------------------------------------------------- indicators


@query("ema5", Q.ema(Q.HOURLY))
def ema5_q(spark, sf):
    """Exact recursive EMA5 of close per symbol."""
    return with_ema(I.hourly_bars(spark, sf))


@query("ema5_daily_brand", Q.ema(Q.DAILY))
def ema5_daily_brand_q(spark, sf):
    """W1 on the larger daily brand bars."""
    return with_ema(I.daily_brand_bars(spark, sf))


@query("bars_daily_returnflag", f"SELECT {BAR_OUT} FROM ({Q.RETURNFLAG_BARS})")
def bars_daily_returnflag_q(spark, sf):
    """Adapter with hot keys: daily bars per return flag (3 keys, a third of
    the rows each) — partial aggregation before the shuffle."""
    return B.lineitem_bars(B.table(spark, sf, "lineitem"), key="l_returnflag")


@query("ema5_returnflag_blocked", Q.ema(Q.DAILY_FLAG))
def ema5_returnflag_blocked_q(spark, sf):
    """W1 on the hot-key bars with 512-row blocks: each key's series is cut
    into several blocks with a 127-row halo, evaluated as separate groups,
    and must equal the unblocked EMA."""
    return with_ema(I.daily_returnflag_bars(spark, sf), block_rows=512)


@query("ema5_hist30", Q.ema(Q.HOURLY, rows=30))
def ema5_hist30_q(spark, sf):
    """EMA recomputed from the last 30 bars only (snapshot consumer)."""
    return with_ema(I.hourly_bars(spark, sf), history=30)


@query("ema5_hist530", Q.ema(Q.HOURLY, rows=530))
def ema5_hist530_q(spark, sf):
    """EMA over a bounded buffer of at most 530 closes."""
    return with_ema(I.hourly_bars(spark, sf), history=530)


# ---------------------------------------------------------------- features

from tickforge.operators import features as FT  # noqa: E402
from tickforge.operators import metrics as MT  # noqa: E402
from tickforge.schemas import FEATURES_G2  # noqa: E402

SEQ = 3
NX = SEQ * len(FEATURES_G2)
X_COLS = [f"x_{i}" for i in range(NX)]
SCALED_COLS = [f"{f}_s" for f in FEATURES_G2]


def _feat(spark, sf):
    """Hourly bars + EMA5 + pos + n, materialised once (several branches read it)."""
    return materialize(FT.with_positions(I.hourly_bars(spark, sf)))


def _scaled(spark, sf, keep=("close",), bars=None):
    feat = _feat(spark, sf) if bars is None else materialize(FT.with_positions(bars))
    return FT.apply_minmax(feat, materialize(FT.fit_minmax(feat)), keep_bounds=list(keep))


@query("scaler_fit", Q.scaler(Q.FEAT_H))
def scaler_fit_q(spark, sf):
    """A1: per-symbol min/max of the 7 features over the first 80 % of rows."""
    return FT.fit_minmax(_feat(spark, sf))


@query("scale", f"SELECT symbol, datetime, pos, {', '.join(SCALED_COLS)} FROM ({Q.scaled(Q.FEAT_H)})")
def scale_q(spark, sf):
    """min-max transform of all rows with the fitted scaler (unclipped)."""
    return _scaled(spark, sf, keep=()).select("symbol", "datetime", "pos", *SCALED_COLS)


@query("inverse_close", f"""
SELECT symbol, datetime, close, close_s, {Q.inverse_expr('close', 'close_s')} AS close_back
FROM ({Q.SCALED_H})""")
def inverse_close_q(spark, sf):
    """scale the target, then invert it back to price units."""
    s = _scaled(spark, sf)
    back = FT.minmax_inverse(F.col("close_s"), F.col("close_min"), F.col("close_max"))
    return s.select("symbol", "datetime", "close", "close_s", back.alias("close_back"))


@query("sliding_windows", Q.windows(Q.SCALED_H))
def sliding_windows_q(spark, sf):
    """Windows of the 3 previous scaled bars, flattened time-major,
    with the scaled close of the bar as target."""
    w = FT.sliding_windows(_scaled(spark, sf), SCALED_COLS, SEQ)
    return w.select("symbol", "datetime", "widx", "y",
                    *[F.col("x")[i].alias(c) for i, c in enumerate(X_COLS)])


def _flat_names():
    return [f"f{t}_{f}" for t in range(SEQ) for f in FEATURES_G2]


@query("windows_flat", f"""
SELECT symbol, datetime, widx, {", ".join(f"x_{i} AS {n}" for i, n in enumerate(_flat_names()))}
FROM ({Q.windows(Q.SCALED_H)})""")
def windows_flat_q(spark, sf):
    """The (3 × 7) window flattened time-major (bar t-3 first), one
    named column per (bar, feature)."""
    w = FT.sliding_windows(_scaled(spark, sf), SCALED_COLS, SEQ, target=None)
    flat = F.flatten("xs")
    return w.select("symbol", "datetime", "widx",
                    *[flat[i].alias(n) for i, n in enumerate(_flat_names())])


@query("windows_incl_current", Q.windows(Q.SCALED_H, include_current=True))
def windows_incl_current_q(spark, sf):
    """Stream-style windows ending with the current bar."""
    w = FT.sliding_windows(_scaled(spark, sf), SCALED_COLS, SEQ, target=None,
                           include_current=True)
    return w.select("symbol", "datetime", "widx",
                    *[F.col("x")[i].alias(c) for i, c in enumerate(X_COLS)])


@query("chrono_split", f"""
SELECT symbol, datetime, pos, n, pos < floor(0.8 * n) AS fit_row,
       CASE WHEN pos >= {SEQ} THEN (pos - {SEQ}) < floor(0.8 * (n - {SEQ})) END AS train_window
FROM ({Q.FEAT_H})""")
def chrono_split_q(spark, sf):
    """Chronological 80/20 split of rows (scaler) and of windows (models)."""
    f = _feat(spark, sf)
    return f.select("symbol", "datetime", "pos", "n", FT.fit_rows().alias("fit_row"),
                    F.when(F.col("pos") >= SEQ,
                           FT.window_split(F.col("pos") - F.lit(SEQ), "n", SEQ))
                    .alias("train_window"))


@query("new_bar_flag", """
SELECT symbol, poll_ts, event_id, bar_datetime,
       coalesce(lag(bar_datetime) OVER w <> bar_datetime, TRUE) AS is_new
FROM (SELECT event_type AS symbol, ts AS poll_ts, event_id,
             date_trunc('hour', ts) AS bar_datetime FROM events) p
WINDOW w AS (PARTITION BY symbol ORDER BY poll_ts, event_id)""")
def new_bar_flag_q(spark, sf):
    """A poll is new when its newest bar differs from the previous poll's."""
    ev = B.table(spark, sf, "events")
    polls = ev.select(F.col("event_type").alias("symbol"), F.col("ts").alias("poll_ts"),
                      "event_id", F.date_trunc("hour", "ts").alias("bar_datetime"))
    return FT.flag_new_bars(polls, "symbol", ["poll_ts", "event_id"])


@query("warmup_gate", f"""
SELECT symbol, datetime, pos, CASE WHEN pos >= {SEQ} THEN EMA5 END AS forecast_next
FROM ({Q.FEAT_H})""")
def warmup_gate_q(spark, sf):
    """No forecast until 3 bars are buffered (null before)."""
    f = _feat(spark, sf).withColumn("forecast_next", F.col("EMA5"))
    return FT.warmup_gate(f, SEQ, cols=["forecast_next"]).select(
        "symbol", "datetime", "pos", "forecast_next")


# ---------------------------------------------------------------- metrics

BASELINES = {"Naive": "close", "EMA5": "EMA5"}
DASH_MODELS = ["Naive", "EMA5", "LinearRegression"]


def _forecasts(spark, sf):
    return MT.next_bar_forecasts(_feat(spark, sf), BASELINES)


@query("next_bar_forecasts", Q.FC_H)
def next_bar_forecasts_q(spark, sf):
    """Forecast made at bar t-1 matched with the close of bar t."""
    return _forecasts(spark, sf)


@query("metrics_by_model", f"""
SELECT symbol, model_type, count(*) AS n,
       round(avg((ps - as_) * (ps - as_)), 9) AS mse, round(sqrt(avg((ps - as_) * (ps - as_))), 9) AS rmse
FROM (SELECT fc.symbol, model_type, pos, n,
             {Q.scale_expr('close', 'predicted_price')} AS ps,
             {Q.scale_expr('close', 'actual_price')} AS as_
      FROM ({Q.FC_H}) fc JOIN ({Q.scaler(Q.FEAT_H, ['close'])}) s USING (symbol)) t
WHERE pos >= floor(0.8 * n) GROUP BY ALL""")
def metrics_by_model_q(spark, sf):
    """A2/M6: hold-out (last 20 %) MSE and RMSE per symbol × model on scaled prices."""
    feat = _feat(spark, sf)
    fc = MT.next_bar_forecasts(feat, BASELINES)
    sc = FT.fit_minmax(feat, ["close"])
    j = fc.join(sc, "symbol")
    lo, hi = F.col("close_min"), F.col("close_max")
    j = j.withColumns({"predicted_price": FT.minmax_transform(F.col("predicted_price"), lo, hi),
                       "actual_price": FT.minmax_transform(F.col("actual_price"), lo, hi)})
    m = MT.error_metrics(j.where(~FT.fit_rows()), ["symbol", "model_type"])
    return m.select("symbol", "model_type", "n", F.round("mse", 9).alias("mse"),
                    F.round(F.sqrt("mse"), 9).alias("rmse"))


@query("dashboard_metrics", f"""
WITH fc AS ({Q.FC_H}),
m AS (SELECT symbol, model_type, avg((predicted_price - actual_price) * (predicted_price - actual_price)) AS mse,
             avg({Q.pct_err()}) * 100.0 AS mape FROM fc GROUP BY ALL),
s AS (SELECT DISTINCT symbol FROM fc),
models(model_type) AS (VALUES {", ".join(f"('{m}')" for m in DASH_MODELS)})
SELECT s.symbol, models.model_type, round(coalesce(m.mse, 0), 4) AS mse,
       round(sqrt(coalesce(m.mse, 0)), 4) AS rmse, round(coalesce(m.mape, 0), 2) AS mape
FROM s CROSS JOIN models LEFT JOIN m ON m.symbol = s.symbol AND m.model_type = models.model_type""")
def dashboard_metrics_q(spark, sf):
    """A3: dashboard MSE/RMSE/MAPE per symbol × model, zeros for a model
    without records."""
    return MT.dashboard_metrics(_forecasts(spark, sf), DASH_MODELS)


@query("naive_forecast_eval", f"""
SELECT symbol, model_type, count(*) AS n,
       round(avg((predicted_price - actual_price) * (predicted_price - actual_price)), 9) AS mse,
       round(avg(abs(predicted_price - actual_price)), 9) AS mae,
       round(avg({Q.pct_err()}) * 100.0, 9) AS mape,
       round(sqrt(avg((predicted_price - actual_price) * (predicted_price - actual_price))), 9) AS rmse
FROM ({Q.FC_H}) GROUP BY ALL""")
def naive_forecast_eval_q(spark, sf):
    """A4: MAE / RMSE / MAPE of next-bar forecasts over the whole run."""
    m = MT.error_metrics(_forecasts(spark, sf), ["symbol", "model_type"])
    return m.select("symbol", "model_type", "n",
                    *[F.round(c, 9).alias(c) for c in ("mse", "mae", "mape")],
                    F.round(F.sqrt("mse"), 9).alias("rmse"))


@query("topk_predictions", f"""
SELECT symbol, model_type, datetime, predicted_price, actual_price, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, model_type ORDER BY datetime DESC) AS rn
  FROM ({Q.FC_H})) WHERE rn <= 25""")
def topk_predictions_q(spark, sf):
    """Newest 25 predictions per symbol × model."""
    t = MT.read_predictions(_forecasts(spark, sf), limit=25, per_group=["symbol", "model_type"])
    return t.select("symbol", "model_type", "datetime", "predicted_price", "actual_price", "rn")


@query("read_predictions", f"""
SELECT symbol, model_type, datetime, predicted_price, actual_price FROM ({Q.FC_H})
WHERE symbol = 'click' AND model_type = 'EMA5' ORDER BY datetime DESC LIMIT 50""")
def read_predictions_q(spark, sf):
    """Newest-first read with optional symbol / model filters."""
    t = MT.read_predictions(_forecasts(spark, sf), symbol="click", model_type="EMA5", limit=50)
    return t.select("symbol", "model_type", "datetime", "predicted_price", "actual_price")


@query("series_by_model", f"""
SELECT symbol, model_type, count(*) AS n_points, min(datetime) AS first_t, max(datetime) AS last_t,
       arg_min(predicted_price, datetime) AS first_p, arg_max(predicted_price, datetime) AS last_p
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, model_type ORDER BY datetime DESC) AS rn
      FROM ({Q.FC_H})) WHERE rn <= 100 GROUP BY ALL""")
def series_by_model_q(spark, sf):
    """A5: time-ordered series per model over the newest 100 points."""
    top = MT.read_predictions(_forecasts(spark, sf), limit=100, per_group=["symbol", "model_type"])
    s = MT.series_by_model(top, ["symbol", "model_type"])
    return s.select("symbol", "model_type", F.size("series").cast("long").alias("n_points"),
                    F.col("series")[0]["t"].alias("first_t"),
                    F.element_at("series", -1)["t"].alias("last_t"),
                    F.col("series")[0]["p"].alias("first_p"),
                    F.element_at("series", -1)["p"].alias("last_p"))


@query("display_points", f"""
SELECT symbol, model_type, datetime, strftime(datetime, '%H:%M:%S') AS label,
       round(predicted_price, 2) AS predicted_price, round(actual_price, 2) AS actual_price
FROM (SELECT *, row_number() OVER (PARTITION BY symbol, model_type ORDER BY datetime DESC) AS rn
      FROM ({Q.FC_H})) WHERE rn <= 100""")
def display_points_q(spark, sf):
    """Chart projection of the newest 100 points per model."""
    top = MT.read_predictions(_forecasts(spark, sf), limit=100, per_group=["symbol", "model_type"])
    return MT.display_points(top).select("symbol", "model_type", "datetime", "label",
                                         "predicted_price", "actual_price")


# ---------------------------------------------------------------- models

from tickforge.models import knn as KNN  # noqa: E402
from tickforge.models import linear as LIN  # noqa: E402


def _windows(spark, sf, bars=None):
    """Training/test windows of ``bars`` or the hourly bars (symbol, widx, x, y, n, split)."""
    w = FT.sliding_windows(_scaled(spark, sf, bars=bars), SCALED_COLS, SEQ)
    return w.withColumn("train", FT.window_split("widx", "n", SEQ))


def _moment_names(d):
    return (["n", "sy"] + [f"sx_{i}" for i in range(d)] + [f"sxy_{i}" for i in range(d)]
            + [f"sxx_{i}_{j}" for i in range(d) for j in range(i, d)])


def _moments_sql(d):
    cols = ["CAST(count(*) AS DOUBLE) AS n", "sum(y) AS sy"]
    cols += [f"sum(x_{i}) AS sx_{i}" for i in range(d)]
    cols += [f"sum(x_{i} * y) AS sxy_{i}" for i in range(d)]
    cols += [f"sum(x_{i} * x_{j}) AS sxx_{i}_{j}" for i in range(d) for j in range(i, d)]
    return f"""
SELECT symbol, moment, round(value, 6) AS value FROM (
  UNPIVOT (SELECT symbol, {", ".join(cols)} FROM ({Q.WIN_H}) w WHERE {Q.TRAIN_COND} GROUP BY symbol)
  ON COLUMNS(* EXCLUDE (symbol)) INTO NAME moment VALUE value)"""


@query("ols_moments", _moments_sql(NX))
def ols_moments_q(spark, sf):
    """M1 fit, distributed part: per-symbol moment sums of the training windows."""
    m = LIN.moments(_windows(spark, sf).where("train"), NX)
    names = _moment_names(NX)
    vals = F.concat(F.array(F.col("n").cast("double"), F.col("sy")), "sx", "sxy", "sxx")
    pairs = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("moment"), vals.alias("value"))
    return (m.select("symbol", F.explode(pairs).alias("_p"))
            .select("symbol", F.col("_p.moment").alias("moment"),
                    F.round("_p.value", 6).alias("value")))


@query("ols_predict")
def ols_predict_q(spark, sf):
    """M1: per-symbol OLS fitted on the training windows, scored on the
    hold-out windows (scaled close)."""
    w = _windows(spark, sf)
    model = LIN.fit(w.where("train"), NX)
    return LIN.predict(w.where(~F.col("train")), model).select(
        "symbol", "datetime", "y", "pred_linear")


@query("knn_predict", f"""
WITH w AS ({Q.WIN_H}),
tr AS (SELECT * FROM w WHERE {Q.TRAIN_COND}),
te AS (SELECT * FROM w WHERE NOT ({Q.TRAIN_COND})),
c AS (SELECT te.symbol, te.datetime, tr.widx AS tid, tr.y AS ty, {Q.sq_dist_sql(NX)} AS dist2
      FROM te JOIN tr ON te.symbol = tr.symbol),
r AS (SELECT *, row_number() OVER (PARTITION BY symbol, datetime ORDER BY dist2, tid) AS rn FROM c)
SELECT symbol, datetime, round(avg(ty), 9) AS pred_knn FROM r WHERE rn <= 5 GROUP BY ALL""")
def knn_predict_q(spark, sf):
    """Exact 5-NN regression of each hold-out window on the training
    windows of its symbol (projection-band search, no all-pairs join)."""
    w = _windows(spark, sf)
    train = w.where("train").select("symbol", F.col("widx").alias("tid"), "x", "y")
    test = w.where(~F.col("train")).select("symbol", F.col("widx").alias("qid"), "datetime", "x")
    p = KNN.predict(train, test, NX, k=5)
    return p.select("symbol", "datetime", F.round("pred_knn", 9).alias("pred_knn"))


# ---------------------------------------------------------------- messages / sinks

from tickforge.operators.sequence import ordered_frame  # noqa: E402
from tickforge.sinks import messages as MSG  # noqa: E402
from tickforge.sinks import tables as TB  # noqa: E402
from tickforge.sinks import upsert as UP  # noqa: E402
from tickforge.sources import stream as ST  # noqa: E402

UPSERT_UPDATE_COLS = ["close_actual", "close_predicted", "ema5", "inc_loss"]
UPSERT_KEEP_COLS = ["open_price", "high_price", "low_price", "volume"]
TARGET_BEFORE = "2024-01-20 00:00:00"
UPDATES_FROM = "2024-01-10 00:00:00"


@query("to_kafka_json", Q.bar_json(Q.HOURLY))
def to_kafka_json_q(spark, sf):
    """Bars as keyed messages (key = symbol, value = JSON bar)."""
    return MSG.encode_bars(I.hourly_bars(spark, sf))


@query("parse_kafka_json", f"""
SELECT symbol, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, open, high, low, close, volume
FROM ({Q.HOURLY})""")
def parse_kafka_json_q(spark, sf):
    """Decode a topic holding bar messages and foreign messages
    (``events.props`` objects): bad or foreign values parse to nulls and are
    dropped by ``close IS NOT NULL``."""
    ev = B.table(spark, sf, "events")
    foreign = ev.select(F.col("event_type").alias("key"), F.col("props").alias("value"))
    topic = MSG.encode_bars(I.hourly_bars(spark, sf)).unionByName(foreign)
    return ST.decode_bars(topic)


@query("stream_errors", """
SELECT key, reason, count(*) AS n FROM (
  SELECT event_type AS key, 'not a bar' AS reason FROM events
  UNION ALL
  SELECT event_type, CASE WHEN value IS NULL THEN 'not a bar' WHEN event_type IS NULL THEN 'no symbol'
                          ELSE 'no time' END FROM events) m
GROUP BY key, reason""")
def stream_errors_q(spark, sf):
    """A stream over bar messages, foreign messages and bars whose time
    is no time; the messages left out are stored with the reason and counted."""
    ev = B.table(spark, sf, "events")
    foreign = ev.select(F.col("event_type").alias("key"), F.col("props").alias("value"))
    price = [F.col("value").alias(n) for n in ("open", "high", "low", "close")]
    timeless = ev.select(F.col("event_type").alias("key"), F.to_json(F.struct(
        F.col("event_type").alias("symbol"), F.col("props").alias("datetime"), *price)).alias("value"))
    topic = MSG.encode_bars(I.hourly_bars(spark, sf)).unionByName(foreign).unionByName(timeless)
    root = SJ.new_scratch(spark, "stream-errors")
    MSG.write_messages(topic, f"{root}/msgs/chunk=00000")
    paths = SJ.SinkPaths(f"{root}/out")
    SJ.start_rejected(SJ.message_stream(spark, f"{root}/msgs"), paths).awaitTermination()
    return SJ.read_rejected(spark, paths).groupBy("key", "reason").agg(F.count(F.lit(1)).alias("n"))


def _with_lags(spark, sf):
    feat = _feat(spark, sf)
    fr = ordered_frame(feat, "symbol", "datetime", lookback=1)
    return fr.finish(fr.df.withColumns({"prev_close": F.lag("close", 1).over(fr.window),
                                        "prev_ema": F.lag("EMA5", 1).over(fr.window)}))


def result_rows(df, pred):
    """F9 rows (one per bar) with the forecast in ``close_predicted`` and its
    squared error in ``inc_loss``."""
    return df.select(
        "symbol", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("trade_date"),
        F.col("open").alias("open_price"), F.col("high").alias("high_price"),
        F.col("low").alias("low_price"), F.col("close").alias("close_actual"),
        F.col(pred).alias("close_predicted"), F.col("EMA5").alias("ema5"), "volume",
        ((F.col(pred) - F.col("close")) * (F.col(pred) - F.col("close"))).alias("inc_loss"),
        F.current_timestamp().alias("created_at"))


_t = Q.result_rows("prev_close", f"datetime < TIMESTAMP '{TARGET_BEFORE}'")
_u = Q.result_rows("prev_ema", f"datetime >= TIMESTAMP '{UPDATES_FROM}'")
_keep = ", ".join(f"CASE WHEN t.symbol IS NOT NULL THEN t.{c} ELSE u.{c} END AS {c}"
                  for c in UPSERT_KEEP_COLS)
_upd = ", ".join(f"CASE WHEN u.symbol IS NOT NULL THEN u.{c} ELSE t.{c} END AS {c}"
                 for c in UPSERT_UPDATE_COLS)


@query("upsert_latest", f"""
SELECT coalesce(t.symbol, u.symbol) AS symbol, coalesce(t.trade_date, u.trade_date) AS trade_date,
       {_keep}, {_upd}
FROM ({_t}) t FULL OUTER JOIN ({_u}) u ON t.symbol = u.symbol AND t.trade_date = u.trade_date""")
def upsert_latest_q(spark, sf):
    """K4: merge a batch of result rows into the result table on
    (symbol, trade_date): conflicts update close/prediction/EMA/loss and keep
    the first open/high/low/volume (``created_at`` left out of the check).
    Every key of the batch is updated twice; the later one (``seq``) wins."""
    rows = _with_lags(spark, sf)
    target = result_rows(rows.where(F.col("datetime") < F.lit(TARGET_BEFORE).cast("timestamp")),
                         "prev_close")
    late = rows.where(F.col("datetime") >= F.lit(UPDATES_FROM).cast("timestamp"))
    updates = (result_rows(late, "prev_ema").withColumn("seq", F.lit(2))
               .unionByName(result_rows(late, "prev_close").withColumn("seq", F.lit(1))))
    merged = UP.upsert(target, updates, ["symbol", "trade_date"], UPSERT_UPDATE_COLS, order="seq")
    return merged.drop("created_at")


@query("upsert_batches", ORACLE["upsert_latest"])
def upsert_batches_q(spark, sf):
    """K4 on the stored table: the rows of ``upsert_latest`` in three batches,
    each merged into the partitions (symbol share, month) it touches."""
    rows = materialize(_with_lags(spark, sf))
    late = rows.where(F.col("datetime") >= F.lit(UPDATES_FROM).cast("timestamp"))
    path = SJ.new_scratch(spark, "upsert-batches")
    batches = [result_rows(rows.where(F.col("datetime") < F.lit(TARGET_BEFORE).cast("timestamp")), "prev_close"),
               result_rows(late, "prev_close"), result_rows(late, "prev_ema")]
    for version, batch in enumerate(batches):
        UP.upsert_table(batch, path, ["symbol", "trade_date"], UPSERT_UPDATE_COLS, version,
                        part=SJ.result_part())
    return UP.read_latest(spark, path).drop("created_at")


@query("unpivot_predictions", """
SELECT symbol, round(predicted_price, 6) AS predicted_price, round(actual_price, 6) AS actual_price,
       model_type, timestamp FROM (
  SELECT symbol, prev_close AS predicted_price, close AS actual_price, 'Naive' AS model_type,
         datetime AS timestamp FROM L
  UNION ALL
  SELECT symbol, prev_ema, close, 'EMA5', datetime FROM L) u""".replace(
    "FROM L", f"FROM ({Q.FEAT_LAGS_H}) l"))
def unpivot_predictions_q(spark, sf):
    """Wide prediction rows -> long rows (label map, 6 decimals,
    event-time ``timestamp``; the stable ``id`` hash is left out of the check)."""
    wide = _with_lags(spark, sf).select("symbol", "datetime", F.col("close").alias("actual_price"),
                                        "prev_close", "prev_ema")
    return TB.to_long(wide, [("Naive", "prev_close"), ("EMA5", "prev_ema")]).drop("id")


from tickforge.models import recurrent as HBL  # noqa: E402
from tickforge.models import tree as TREE  # noqa: E402
from tickforge.plans import training as TRN  # noqa: E402


@query("tree_predict", Q.tree_sql(NX, 10))
def tree_predict_q(spark, sf):
    """M2: per-symbol depth-10 regression tree fitted on the training
    windows, scored on the hold-out windows (scaled close)."""
    w = materialize(_windows(spark, sf))
    model = TREE.fit(w.where("train"), NX, max_depth=10)
    return TREE.predict(w.where(~F.col("train")), model).select("symbol", "datetime", "y", "pred_dt")


@query("tree_depth2_brand", Q.tree_sql(NX, 2).replace(Q.HOURLY, Q.DAILY))
def tree_depth2_brand_q(spark, sf):
    """M2: a tree of depth two per part brand on the daily bars, its values
    sorted in many chunks."""
    w = materialize(_windows(spark, sf, I.daily_brand_bars(spark, sf)))
    model = TREE.fit(w.where("train"), NX, max_depth=2, chunk_rows=512)
    return TREE.predict(w.where(~F.col("train")), model, max_depth=2).select("symbol", "datetime", "y", "pred_dt")


@query("recurrent_predict")
def recurrent_predict_q(spark, sf):
    """M4/M5: per-symbol recurrent network (hidden 64, 50 epochs, batch 16, Adam 1e-4)
    trained on the training windows, scored on the hold-out windows."""
    w = materialize(_windows(spark, sf))
    state = HBL.fit(w.where("train"), SEQ, len(FEATURES_G2))
    return HBL.predict(w.where(~F.col("train")), state, SEQ, len(FEATURES_G2)).select(
        "symbol", "datetime", "y", "pred_recurrent")


@query("score_all_models")
def score_all_models_q(spark, sf):
    """Q1/M7/M9: train the four models for every symbol and score the
    hold-out windows in price units (wide prediction rows)."""
    cfg = TRN.ModelConfig()
    scaler, w = TRN.prepare_windows(I.hourly_bars(spark, sf), cfg)
    models = TRN.train_all(w, scaler, cfg)
    return TRN.score(w.where(~F.col("train")), models)


@query("model_holdout_metrics")
def model_holdout_metrics_q(spark, sf):
    """A2/M6/M7: MSE and RMSE of the four trained models on the hold-out
    windows, per symbol × model, on scaled prices."""
    cfg = TRN.ModelConfig()
    scaler, w = TRN.prepare_windows(I.hourly_bars(spark, sf), cfg)
    models = TRN.train_all(w, scaler, cfg)
    return TRN.holdout_metrics(TRN.score(w.where(~F.col("train")), models, inverse=False))


# ---------------------------------------------------------------- streaming

from tickforge.streaming import jobs as SJ  # noqa: E402

STREAM_FROM = "2024-01-25 00:00:00"


@query("stream_ema5", f"SELECT symbol, datetime, close, EMA5 FROM ({Q.ema(Q.HOURLY)})")
def stream_ema5_q(spark, sf):
    """Bars replayed as keyed messages in 3 time chunks through
    a file-source stream (8 files per trigger); EMA5 kept in per-symbol state
    equals the batch EMA."""
    root = SJ.new_scratch(spark, "stream-ema5")
    SJ.replay_messages(I.hourly_bars(spark, sf), root + "/msgs", chunks=3)
    paths = SJ.run_replay(spark, root + "/msgs", root + "/out", max_files_per_trigger=8)
    return spark.read.parquet(paths.capture).select("symbol", "datetime", "close", "EMA5")


@query("state_at_stop", f"""
SELECT symbol, max_by(EMA5, datetime) AS EMA5, max(datetime) AS datetime, count(*) AS seen
FROM ({Q.ema(Q.HOURLY)}) e GROUP BY symbol""")
def state_at_stop_q(spark, sf):
    """Long-running queries are stopped after the arrived bars went
    through; the state they leave holds each symbol's last EMA, bar and count."""
    root = SJ.new_scratch(spark, "state-at-stop")
    SJ.replay_messages(I.hourly_bars(spark, sf), root + "/msgs", chunks=3)
    others = {q.id for q in spark.streams.active}
    SJ.run_replay(spark, root + "/msgs", root + "/out", max_files_per_trigger=8, trigger="1 second")
    SJ.stop_gracefully([q for q in spark.streams.active if q.id not in others])
    return SJ.read_bar_state(spark, root + "/out/_checkpoint")


#: A symbol without bars for longer is closed; bars may come this much later than others.
IDLE_SECONDS, IDLE_DELAY_SECONDS = 3600, 5400


@query("stream_idle", f"""
WITH RECURSIVE gaps AS (SELECT symbol, datetime, close, lag(datetime) OVER w AS before, lead(datetime) OVER w AS after,
                     row_number() OVER w AS pos
              FROM ({Q.HOURLY}) b WINDOW w AS (PARTITION BY symbol ORDER BY datetime)),
marked AS (SELECT *, before IS NULL OR epoch_us(datetime) - epoch_us(before) > {IDLE_SECONDS * 1_000_000} AS fresh,
                  after IS NULL OR epoch_us(after) - epoch_us(datetime) > {IDLE_SECONDS * 1_000_000} AS ends
           FROM gaps),
run AS (
  SELECT symbol, pos, datetime, ends, after, close AS EMA5, CAST(1 AS BIGINT) AS seen FROM marked WHERE pos = 1
  UNION ALL
  SELECT m.symbol, m.pos, m.datetime, m.ends, m.after,
         CASE WHEN m.fresh OR run.EMA5 = m.close THEN m.close
              ELSE run.EMA5 * (1.0::DOUBLE - 1.0::DOUBLE / 3) + m.close * (1.0::DOUBLE / 3) END,
         CASE WHEN m.fresh THEN 1 ELSE run.seen + 1 END
  FROM run JOIN marked m ON m.symbol = run.symbol AND m.pos = run.pos + 1)
SELECT symbol, datetime, EMA5, seen FROM run
WHERE ends AND (after IS NOT NULL OR epoch_us(datetime) + {(IDLE_SECONDS + IDLE_DELAY_SECONDS) * 1_000_000} <
                (SELECT max(epoch_us(datetime)) FROM gaps))""")
def stream_idle_q(spark, sf):
    """Symbols are closed by an event-time timer, or by a bar after a gap;
    every closed stretch with its last EMA, bar and count."""
    root = SJ.new_scratch(spark, "stream-idle")
    SJ.replay_messages(I.hourly_bars(spark, sf), root + "/msgs", chunks=3, files_per_chunk=8)
    paths = SJ.run_replay(spark, root + "/msgs", root + "/out", max_files_per_trigger=8,
                          idle_seconds=IDLE_SECONDS, delay=f"{IDLE_DELAY_SECONDS} seconds")
    return SJ.read_idle(spark, paths)


from tickforge.streaming import dedup as SD  # noqa: E402

#: Deliveries of the dedup stream, and what each repeats: seconds before its
#: range, and the oldest seconds of all (older than the watermark by then).
DELIVERIES, AGAIN_SECONDS, STALE_SECONDS = 3, 1800, 3600


def _dedup_stream(spark, sf):
    ticks = I.minute_ticks(spark, sf)
    root = SJ.new_scratch(spark, "stream-dedup")
    paths = SD.DedupPaths(f"{root}/out")
    for k, rows in enumerate(SD.redelivered(ticks, DELIVERIES, AGAIN_SECONDS, STALE_SECONDS)):
        SD.deliver(rows, f"{root}/msgs/chunk={k:05d}", "ingest_order")
        # each delivery is a micro-batch of a query that was stopped before
        paths = SD.run_dedup(spark, lambda: SJ.message_stream(spark, f"{root}/msgs"), paths.root)
    return paths


@query("stream_dedup", ORACLE["dedup_keep_first"])
def stream_dedup_q(spark, sf):
    """P5 on streams: ticks delivered in three overlapping micro-batches, the
    query restarted between them; the kept bars are those of the batch rule."""
    return SD.read_kept(spark, _dedup_stream(spark, sf).kept)


@query("stream_counts", f"""
WITH t AS (SELECT symbol, datetime, epoch_us(datetime::TIMESTAMP) AS us FROM ({Q.MINUTE_TICKS})),
b AS (SELECT min(us) AS lo, (max(us) + 1 - min(us) + {DELIVERIES - 1}) // {DELIVERIES} AS step FROM t),
d AS (SELECT k, t.*, lo, lo + k * step AS start_us
      FROM t, b, unnest(range({DELIVERIES})) AS r(k)
      WHERE (us >= lo + k * step - CASE WHEN k > 0 THEN {AGAIN_SECONDS * 1_000_000} ELSE 0 END AND us < lo + (k + 1) * step)
         OR (k > 0 AND us < lo + {STALE_SECONDS * 1_000_000}))
SELECT k AS batch_id, count(*) AS messages, count(*) AS bars,
       count(DISTINCT (symbol, datetime)) FILTER (us >= start_us) AS kept,
       count(*) FILTER (NOT (k > 0 AND us < lo + {STALE_SECONDS * 1_000_000}))
           - count(DISTINCT (symbol, datetime)) FILTER (us >= start_us) AS duplicates,
       count(*) FILTER (k > 0 AND us < lo + {STALE_SECONDS * 1_000_000}) AS late
FROM d GROUP BY k""")
def stream_counts_q(spark, sf):
    """A6 on streams: messages, bars, kept, duplicates and late rows of each
    micro-batch, from observed metrics and the operator's own counters."""
    counts = SD.read_counts(spark, _dedup_stream(spark, sf))
    from pyspark.sql import Window
    # batches without messages only move the watermark: number the others
    number = F.row_number().over(Window.orderBy("batch_id")) - 1
    return counts.withColumn("batch_id", number.cast("long"))


def _stream_scorer(models):
    """Per-batch scoring of the stateless models on the stream's windows."""
    cfg = models.config

    def score(ready):
        w = ready.withColumn("widx", F.unix_micros("datetime"))
        w = LIN.predict(w, models.linear)
        w = TREE.predict(w, models.tree, max_depth=cfg.tree_depth)
        w = KNN.predict(models.knn_train, w.withColumn("qid", F.col("widx")), cfg.flat_size,
                        k=cfg.knn_k, index=models.knn_index).drop("qid")
        lo, hi = F.col("close_min"), F.col("close_max")
        preds = ["pred_linear", "pred_dt", "pred_knn", "pred_recurrent"]
        w = w.withColumns({p: FT.minmax_inverse(F.col(p), lo, hi) for p in preds})
        return w.select("symbol", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
                        F.col("close").alias("actual_price"), *preds)
    return score


def _stream_predictions(spark, sf):
    cfg = TRN.ModelConfig()
    bars = materialize(I.hourly_bars(spark, sf))
    cut = F.lit(STREAM_FROM).cast("timestamp")
    hist, live = bars.where(F.col("datetime") < cut), bars.where(F.col("datetime") >= cut)
    scaler, w = TRN.prepare_windows(hist, cfg)
    models = TRN.train_all(w, scaler, cfg)
    seeds = SJ.seed_state(FT.with_positions(hist), scaler, models.recurrent, cfg.seq_len)
    root = SJ.new_scratch(spark, "stream-predict")
    SJ.replay_messages(live, root + "/msgs", chunks=4)
    paths = SJ.run_replay(spark, root + "/msgs", root + "/out", scaler=scaler, seeds=seeds,
                          score_fn=_stream_scorer(models), max_files_per_trigger=8,
                          seq_len=cfg.seq_len, hidden=cfg.hidden, lr=cfg.lr)
    return spark.read.parquet(paths.predictions).drop("batch_id")


@query("stream_predict")
def stream_predict_q(spark, sf):
    """Models trained on the history before the stream,
    state seeded from it; each streamed bar is forecast by the four models
    from the 3 bars before it, then recurrent network learns it (one Adam step)."""
    return _stream_predictions(spark, sf)


@query("prequential_eval")
def prequential_eval_q(spark, sf):
    """Predict-then-learn evaluation of the stream — MAE, RMSE, MAPE
    per symbol × model over the streamed bars."""
    long = TB.to_long(_stream_predictions(spark, sf), decimals=12)
    m = MT.error_metrics(long, ["symbol", "model_type"])
    return m.select("symbol", "model_type", "n", "mae", "rmse", "mape")
