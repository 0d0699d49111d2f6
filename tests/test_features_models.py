import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickforge.models import knn as KNN
from tickforge.models import linear as LIN
from tickforge.operators import features as FT
from tickforge.operators import clean as C
from tickforge.plans import inputs as I
from tickforge.schemas import FEATURES_G2
from conftest import SF001

SCALED = [f"{f}_s" for f in FEATURES_G2]


def _windows(spark, sf=SF001, block_rows=1 << 20):
    feat = FT.with_positions(I.hourly_bars(spark, sf), block_rows=max(block_rows, 128))
    sc = FT.apply_minmax(feat, FT.fit_minmax(feat), keep_bounds=["close"])
    w = FT.sliding_windows(sc, SCALED, 3, block_rows=block_rows)
    return w.withColumn("train", FT.window_split("widx", "n", 3))


def test_six_bars_give_three_windows(spark, six_bars):
    feat = FT.with_positions(C.clean_bars(six_bars, unique=True))
    sc = FT.apply_minmax(feat, FT.fit_minmax(feat))
    w = FT.sliding_windows(sc, SCALED, 3).toPandas()
    assert len(w) == 3
    assert all(len(x) == 21 for x in w["x"])


def test_minmax_matches_sklearn_formula_and_roundtrips(spark):
    rows = [("s", i, float(v), 7.0) for i, v in enumerate([3.0, 1.0, 2.0, 5.0, 9.0])]
    df = spark.createDataFrame(rows, "symbol string, pos long, a double, c double")
    df = df.withColumn("n", F.lit(5).cast("long"))
    sc = FT.fit_minmax(df, ["a", "c"])          # fit on first int(0.8*5) = 4 rows
    out = FT.apply_minmax(df, sc, ["a", "c"], keep_bounds=["a"]).orderBy("pos").toPandas()
    a = np.array([3.0, 1.0, 2.0, 5.0, 9.0])
    scale = 1.0 / (5.0 - 1.0)
    assert np.array_equal(out["a_s"].to_numpy(), a * scale + (0.0 - 1.0 * scale))
    assert out["a_s"].iloc[-1] > 1.0                      # not clipped
    assert (out["c_s"] == 0.0).all()                      # constant column -> x - min
    back = out.apply(lambda r: (r.a_s - (0.0 - r.a_min * scale)) / scale, axis=1)
    assert np.allclose(back, a)


def test_window_count_and_blocked_equality(spark):
    a = _windows(spark).toPandas().sort_values(["symbol", "datetime"]).reset_index(drop=True)
    b = _windows(spark, block_rows=20).toPandas().sort_values(["symbol", "datetime"]).reset_index(drop=True)
    n = I.hourly_bars(spark, SF001).groupBy("symbol").count().toPandas()
    assert len(a) == int((n["count"] - 3).sum())
    assert len(a) == len(b)
    assert all(np.array_equal(x, y) for x, y in zip(a["x"], b["x"]))


def test_ols_matches_lstsq(spark):
    w = _windows(spark)
    train = w.where("train")
    model = LIN.fit(train, 21)
    pred = LIN.predict(w.where(~F.col("train")), model).toPandas()
    tr = train.toPandas()
    for sym, g in tr.groupby("symbol"):
        X = np.vstack(g["x"].to_numpy())
        y = g["y"].to_numpy()
        Xc = np.hstack([np.ones((len(X), 1)), X])
        beta = np.linalg.lstsq(Xc, y, rcond=None)[0]
        p = pred[pred.symbol == sym]
        ref = np.hstack([np.ones((len(p), 1)), np.vstack(p["x"].to_numpy())]) @ beta
        assert np.allclose(p["pred_linear"].to_numpy(), ref, atol=1e-6), sym


def test_knn_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(0)
    pts = rng.integers(0, 4, size=(60, 3)).astype(float)     # many equal distances
    ys = rng.normal(size=60)
    train = spark.createDataFrame([("s", i, pts[i].tolist(), float(ys[i])) for i in range(40)],
                                  "symbol string, tid long, x array<double>, y double")
    queries = spark.createDataFrame([("s", i, pts[i].tolist()) for i in range(40, 60)],
                                    "symbol string, qid long, x array<double>")
    got = KNN.predict(train, queries, 3, k=5, cell_rows=4).toPandas().set_index("qid")
    for i in range(40, 60):
        d = ((pts[:40] - pts[i]) ** 2).sum(axis=1)
        order = np.lexsort((np.arange(40), d))[:5]
        assert np.isclose(got.loc[i, "pred_knn"], ys[order].mean()), i


def _exact_cart(X, y, depth, min_leaf=1):
    """Exact squared-error CART (threshold = each distinct value but the
    largest), ties to the lower feature then lower threshold."""
    def sse(v):
        return float(((v - v.mean()) ** 2).sum()) if len(v) else 0.0

    def grow(idx, d):
        yv = y[idx]
        if d == depth or len(idx) < 2:
            return ("leaf", yv.mean())
        best = None
        for f in range(X.shape[1]):
            for t in np.unique(X[idx, f])[:-1]:
                left = idx[X[idx, f] <= t]
                right = idx[X[idx, f] > t]
                g = sse(yv) - sse(y[left]) - sse(y[right])
                if g > 1e-12 and (best is None or g > best[0] + 1e-12):
                    best = (g, f, t, left, right)
        if best is None:
            return ("leaf", yv.mean())
        _, f, t, left, right = best
        return ("split", f, t, grow(left, d + 1), grow(right, d + 1))

    def pred(node, x):
        while node[0] == "split":
            node = node[3] if x[node[1]] <= node[2] else node[4]
        return node[1]

    root = grow(np.arange(len(y)), 0)
    return np.array([pred(root, x) for x in X])


def test_tree_equals_exact_cart_on_few_distinct_values(spark):
    from tickforge.models import tree as TR
    rng = np.random.default_rng(5)
    X = rng.integers(0, 4, size=(200, 3)).astype(float)
    y = X[:, 0] * 2 + (X[:, 1] > 1) + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([("s", X[i].tolist(), float(y[i])) for i in range(200)],
                               "symbol string, x array<double>, y double")
    model = TR.fit(df, 3, max_depth=3)
    got = TR.predict(df.withColumn("i", F.monotonically_increasing_id()), model, max_depth=3)
    got = got.orderBy("i").toPandas()["pred_dt"].to_numpy()
    ref = _exact_cart(X, y, 3)
    assert np.allclose(np.sort(got), np.sort(ref))
    assert np.allclose(got, ref)


def test_short_series_give_no_window_and_seq_plus_one_gives_one(spark, six_bars):
    from tickforge.operators import clean as C2
    bars = C2.clean_bars(six_bars, unique=True)
    for keep, expect in ((2, 0), (3, 0), (4, 1)):
        sub = bars.orderBy("datetime").limit(keep)
        feat = FT.with_positions(sub)
        sc = FT.apply_minmax(feat, FT.fit_minmax(feat))
        assert FT.sliding_windows(sc, SCALED, 3).count() == expect, keep


def test_mape_ignores_zero_actual(spark):
    from tickforge.operators import metrics as MT
    df = spark.createDataFrame([("s", "m", 1.0, 0.0), ("s", "m", 3.0, 2.0)],
                               "symbol string, model_type string, predicted_price double, actual_price double")
    r = MT.error_metrics(df, ["symbol", "model_type"]).first()
    assert r["mape"] == 50.0 and r["n"] == 2 and r["mse"] == 1.0
    d = MT.dashboard_metrics(df, ["m", "other"]).orderBy("model_type").toPandas()
    assert d["mse"].tolist() == [1.0, 0.0] and d["mape"].tolist() == [50.0, 0.0]
