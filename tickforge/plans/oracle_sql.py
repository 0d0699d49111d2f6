"""DuckDB SQL that recomputes each catalog query from the raw tables.

Used only to check the Spark operators (the driver runs these strings next
to the Spark results).  The fragments mirror the Spark adapters one to one.
"""

from __future__ import annotations

from tickforge.functions.ema import ema_frame_rows, ema_sql_lambda

EVENTS_BARS = """
SELECT event_type AS symbol, date_trunc('hour', ts) AS datetime,
       arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume
FROM events GROUP BY ALL"""

LINEITEM_BARS = """
SELECT p_brand AS symbol, date_trunc('day', l_shipdate) AS datetime,
       arg_min(price, (l_orderkey, l_linenumber)) AS open, max(price) AS high,
       min(price) AS low, arg_max(price, (l_orderkey, l_linenumber)) AS close,
       sum(l_quantity) AS volume
FROM (SELECT p_brand, l_shipdate, l_orderkey, l_linenumber, l_quantity,
             l_extendedprice * (1 - l_discount) / l_quantity AS price
      FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY ALL"""

RETURNFLAG_BARS = """
SELECT l_returnflag AS symbol, date_trunc('day', l_shipdate) AS datetime,
       arg_min(price, (l_orderkey, l_linenumber)) AS open, max(price) AS high,
       min(price) AS low, arg_max(price, (l_orderkey, l_linenumber)) AS close,
       sum(l_quantity) AS volume
FROM (SELECT l_returnflag, l_shipdate, l_orderkey, l_linenumber, l_quantity,
             l_extendedprice * (1 - l_discount) / l_quantity AS price FROM lineitem) GROUP BY ALL"""

MINUTE_TICKS = """
SELECT event_type AS symbol, date_trunc('minute', ts) AS datetime,
       value AS open, value AS high, value AS low, value AS close,
       1.0::DOUBLE AS volume, ts AS _ts, event_id AS _eid
FROM events"""


def clean(raw_sql: str, order: str = "open, high, low, close, volume") -> str:
    """Null/NaN drop, keep-first dedup on (datetime, symbol), epoch seconds."""
    return f"""
SELECT symbol, datetime, open, high, low, close, volume,
       CAST(floor(epoch(datetime)) AS BIGINT) AS timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY datetime, symbol ORDER BY {order}) AS _rn
      FROM ({raw_sql}) r
      WHERE symbol IS NOT NULL AND datetime IS NOT NULL
        AND open IS NOT NULL AND NOT isnan(open) AND high IS NOT NULL AND NOT isnan(high)
        AND low IS NOT NULL AND NOT isnan(low) AND close IS NOT NULL AND NOT isnan(close)
        AND volume IS NOT NULL AND NOT isnan(volume)) d
WHERE _rn = 1"""


HOURLY = clean(EVENTS_BARS)
DAILY = clean(LINEITEM_BARS)
DAILY_FLAG = clean(RETURNFLAG_BARS)


def ema(src_sql: str, col: str = "close", rows: int | None = None, out: str = "EMA5",
        span: int = 5) -> str:
    rows = rows or ema_frame_rows(span)
    return f"""
SELECT *, list_reduce(list({col}) OVER (PARTITION BY symbol ORDER BY datetime
                      ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW),
                      lambda acc, v: {ema_sql_lambda(span)}) AS {out}
FROM ({src_sql}) s"""


G2 = ["open", "high", "low", "close", "volume", "timestamp", "EMA5"]
SEQ_LEN = 3
TINY = "CAST('2.220446049250313e-15' AS DOUBLE)"


def positions(src_sql: str) -> str:
    return f"""
SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY datetime) - 1 AS pos,
       count(*) OVER (PARTITION BY symbol) AS n
FROM ({src_sql}) p"""


FEAT_H = positions(ema(HOURLY))


def scaler(feat_sql: str, feats: list[str] = G2) -> str:
    cols = ", ".join(f"min({f}) AS {f}_min, max({f}) AS {f}_max" for f in feats)
    return f"SELECT symbol, {cols} FROM ({feat_sql}) f WHERE pos < floor(0.8 * n) GROUP BY symbol"


def _scale(f: str) -> str:
    rng = f"CAST({f}_max - {f}_min AS DOUBLE)"
    return f"(1.0::DOUBLE / CASE WHEN {rng} < {TINY} THEN 1.0::DOUBLE ELSE {rng} END)"


def scale_expr(f: str, x: str | None = None) -> str:
    x = x or f
    return f"(CAST({x} AS DOUBLE) * {_scale(f)} + (0.0::DOUBLE - CAST({f}_min AS DOUBLE) * {_scale(f)}))"


def inverse_expr(f: str, v: str) -> str:
    return f"(({v} - (0.0::DOUBLE - CAST({f}_min AS DOUBLE) * {_scale(f)})) / {_scale(f)})"


def scaled(feat_sql: str, feats: list[str] = G2, keep_bounds: tuple[str, ...] = ()) -> str:
    cols = ", ".join(f"{scale_expr(f)} AS {f}_s" for f in feats)
    bounds = "".join(f", s.{f}_min, s.{f}_max" for f in keep_bounds)
    return f"SELECT f.*, {cols}{bounds} FROM ({feat_sql}) f JOIN ({scaler(feat_sql, feats)}) s USING (symbol)"


SCALED_H = scaled(FEAT_H, keep_bounds=("close",))


def windows(scaled_sql: str, feats: list[str] = G2, seq_len: int = SEQ_LEN,
            include_current: bool = False, extra: str = "") -> str:
    first = seq_len - 1 if include_current else seq_len
    xs = []
    for k in range(seq_len):
        lag = (seq_len - 1 - k) if include_current else (seq_len - k)
        for i, f in enumerate(feats):
            xs.append(f"lag({f}_s, {lag}) OVER w AS x_{k * len(feats) + i}")
    y = "" if include_current else ", close_s AS y"
    return f"""
SELECT * EXCLUDE (pos) FROM (
  SELECT symbol, datetime, pos, pos - {first} AS widx{y}{extra}, {", ".join(xs)}
  FROM ({scaled_sql}) s WINDOW w AS (PARTITION BY symbol ORDER BY datetime)) q
WHERE pos >= {first}"""


def forecasts(feat_sql: str) -> str:
    """Baseline next-bar forecasts (previous close, previous EMA5) in long form."""
    return f"""
SELECT symbol, datetime, pos, n, model_type, predicted_price, actual_price FROM (
  SELECT symbol, datetime, pos, n, 'Naive' AS model_type, prev_close AS predicted_price,
         close AS actual_price FROM L
  UNION ALL
  SELECT symbol, datetime, pos, n, 'EMA5', prev_ema, close FROM L) u
WHERE predicted_price IS NOT NULL""".replace("FROM L", f"""FROM (
  SELECT *, lag(close) OVER w AS prev_close, lag(EMA5) OVER w AS prev_ema
  FROM ({feat_sql}) f WINDOW w AS (PARTITION BY symbol ORDER BY datetime)) l""")


FC_H = forecasts(FEAT_H)


def pct_err(p: str = "predicted_price", a: str = "actual_price") -> str:
    return f"CASE WHEN {a} = 0 THEN NULL ELSE abs(({p} - {a}) / {a}) END"


WIN_H = windows(SCALED_H, extra=", n")
TRAIN_COND = f"widx < floor(0.8 * (n - {SEQ_LEN}))"


def sq_dist_sql(d: int, a: str = "te", b: str = "tr") -> str:
    return "(0.0::DOUBLE" + "".join(f" + ({a}.x_{i} - {b}.x_{i}) * ({a}.x_{i} - {b}.x_{i})"
                                    for i in range(d)) + ")"


def tree_sql(d: int, depth: int) -> str:
    """Hold-out predictions of a regression tree of ``depth`` levels, one set
    of named tables per level."""
    cols = ", ".join(f"x_{i}" for i in range(d))
    parts = [f"""
w AS MATERIALIZED (SELECT *, {TRAIN_COND} AS train FROM ({WIN_H}) q),
b AS MATERIALIZED (SELECT symbol, min(y) AS lo, max(y) - min(y) AS span FROM w WHERE train GROUP BY symbol),
cells AS MATERIALIZED (
  SELECT symbol, widx, train,
         CASE WHEN span > 0 THEN CAST(floor((y - lo) / span * 1099511627776.0::DOUBLE + 0.5::DOUBLE) AS BIGINT)
              ELSE 0 END AS z,
         unnest(range({d})) AS f, unnest([{cols}]) AS v
  FROM w LEFT JOIN b USING (symbol)),
at0 AS MATERIALIZED (SELECT symbol, widx, 1 AS node FROM w)"""]
    for k in range(depth):
        parts.append(f"""
sums{k} AS MATERIALIZED (
  SELECT symbol, node, f, v, count(*) AS c, sum(z) AS s FROM cells JOIN at{k} USING (symbol, widx)
  WHERE train AND node >= {2 ** k} GROUP BY symbol, node, f, v),
sides{k} AS (
  SELECT symbol, node, f, v, lead(v) OVER o AS nxt, sum(c) OVER o AS cl, sum(s) OVER o AS sl,
         sum(c) OVER a AS ct, sum(s) OVER a AS st
  FROM sums{k} WINDOW o AS (PARTITION BY symbol, node, f ORDER BY v), a AS (PARTITION BY symbol, node, f)),
means{k} AS (
  SELECT *, CAST(cl AS DOUBLE) AS l, CAST(ct - cl AS DOUBLE) AS r, CAST(ct AS DOUBLE) AS t,
         CAST(sl AS DOUBLE) / CAST(cl AS DOUBLE) AS ml, CAST(st - sl AS DOUBLE) / CAST(ct - cl AS DOUBLE) AS mr
  FROM sides{k} WHERE ct > cl),
best{k} AS MATERIALIZED (
  SELECT symbol, node, f, CASE WHEN v / 2 + nxt / 2 >= v AND v / 2 + nxt / 2 < nxt THEN v / 2 + nxt / 2
                               ELSE v END AS threshold
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol, node
               ORDER BY l * r / t * abs(ml - mr) * abs(ml - mr) DESC, f, v) AS rn
        FROM means{k} WHERE abs(ml - mr) > 1e-12::DOUBLE * greatest(abs(ml), abs(mr))) g WHERE rn = 1),
at{k + 1} AS MATERIALIZED (
  SELECT at{k}.symbol, at{k}.widx, CASE WHEN best{k}.node IS NULL THEN at{k}.node
         ELSE 2 * at{k}.node + CASE WHEN cells.v > best{k}.threshold THEN 1 ELSE 0 END END AS node
  FROM at{k} LEFT JOIN best{k} ON at{k}.symbol = best{k}.symbol AND at{k}.node = best{k}.node
       LEFT JOIN cells ON cells.symbol = at{k}.symbol AND cells.widx = at{k}.widx AND cells.f = best{k}.f)""")
    parts.append(f"""
leaves AS (
  SELECT symbol, node, lo + CAST(sum(z) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 1099511627776.0::DOUBLE * span AS value
  FROM cells JOIN at{depth} USING (symbol, widx) JOIN b USING (symbol) WHERE train AND f = 0
  GROUP BY symbol, node, lo, span)""")
    return f"""WITH {",".join(parts)}
SELECT w.symbol, w.datetime, w.y, leaves.value AS pred_dt
FROM w JOIN at{depth} USING (symbol, widx) LEFT JOIN leaves ON leaves.symbol = w.symbol
     AND leaves.node = at{depth}.node
WHERE NOT w.train"""


def bar_json(src: str) -> str:
    return f"""
SELECT symbol AS key,
       CAST(to_json(struct_pack(symbol := symbol,
            datetime := strftime(datetime, '%Y-%m-%d %H:%M:%S'), open := open, high := high,
            low := low, close := close, volume := volume)) AS VARCHAR) AS value
FROM ({src}) b"""


FEAT_LAGS_H = f"""
SELECT *, lag(close) OVER w AS prev_close, lag(EMA5) OVER w AS prev_ema
FROM ({FEAT_H}) f WINDOW w AS (PARTITION BY symbol ORDER BY datetime)"""


def result_rows(pred: str, where: str) -> str:
    return f"""
SELECT symbol, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS trade_date, open AS open_price,
       high AS high_price, low AS low_price, close AS close_actual, {pred} AS close_predicted,
       EMA5 AS ema5, volume, ({pred} - close) * ({pred} - close) AS inc_loss
FROM ({FEAT_LAGS_H}) l WHERE {where}"""
