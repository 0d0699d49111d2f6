"""Ordinary least squares with intercept, one model per symbol (M1).

Fit = triangular factors (QR) of the columns ``1, x, y``: every task factors
its rows symbol by symbol (a few hundred numbers each, whatever the rows), the
factors of a symbol are merged in ``SALTS`` groups and then in one, and the
merged factor is solved.  The constant column centres the others; unlike
sums of squares, factors keep the full precision of the data.  Of exactly
collinear inputs (lagged timestamps, repeated prices) the solution of least
norm is taken, as a least-squares solver does.

``moments`` gives the plain moment sums (used for principal axes).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators.joins import join_small

#: Singular values (of columns scaled to length one) below this share of the
#: largest are collinear inputs.  Double precision leaves about 1e-15 there,
#: whatever the number of rows.
REL_TOL = 1e-12
#: Factors a task holds before it passes them on.
HELD_FACTORS = 2048
#: Groups in which the factors of one symbol are merged first.
SALTS = 64

FACTOR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("salt", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("r", T.ArrayType(T.DoubleType())),
])

MODEL_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("rank", T.IntegerType()),
    T.StructField("n", T.LongType()),
])


def moments(windows: DataFrame, d: int, keys: list[str] | None = None,
            x: str = "x", y: str = "y") -> DataFrame:
    """Moment sums per key: ``n, sy, sx[d], sxy[d], sxx[d(d+1)/2]``."""
    keys = keys or ["symbol"]
    xs = [F.col(x)[i] for i in range(d)]
    yc = F.col(y)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(yc).alias("sy")]
    aggs += [F.sum(xs[i]).alias(f"_sx{i}") for i in range(d)]
    aggs += [F.sum(xs[i] * yc).alias(f"_sxy{i}") for i in range(d)]
    aggs += [F.sum(xs[i] * xs[j]).alias(f"_sxx{i}_{j}") for i in range(d) for j in range(i, d)]
    m = windows.groupBy(*keys).agg(*aggs)
    return m.select(*keys, "n", "sy",
                    F.array(*[f"_sx{i}" for i in range(d)]).alias("sx"),
                    F.array(*[f"_sxy{i}" for i in range(d)]).alias("sxy"),
                    F.array(*[f"_sxx{i}_{j}" for i in range(d) for j in range(i, d)]).alias("sxx"))


def solve_factor(r: np.ndarray, d: int, rel_tol: float = REL_TOL) -> tuple[float, np.ndarray, int]:
    """Intercept, coefficients and rank from the triangular factor of the
    columns ``1, x, y``; the rows below the first are those of the centred
    columns.  Of several solutions the one of least norm."""
    mean = r[0, 1:] / r[0, 0]
    a, b = r[1:, 1:d + 1], r[1:, d + 1]
    size = np.sqrt((a * a).sum(axis=0))
    scale = np.where(size > 0, size, 1.0)
    coef, rank = np.zeros(d), 0
    if len(a) and size.any():
        u, s, vt = np.linalg.svd(a / scale)
        s = np.append(s, np.zeros(d - len(s)))
        keep = s > rel_tol * s[0]
        rank = int(keep.sum())
        coef = (vt[keep].T @ ((u[:, :rank].T @ b) / s[keep])) / scale
        if rank < d:
            # entries that are rounding only would grow by the scale of their column
            null, _ = np.linalg.qr((np.where(np.abs(vt[~keep]) < rel_tol, 0.0, vt[~keep]) / scale).T)
            coef -= null @ (null.T @ coef)
    return float(mean[d] - mean[:d] @ coef), coef, rank


def fit(windows: DataFrame, d: int) -> DataFrame:
    """One row per symbol: ``intercept, coef[d], rank, n``."""
    width = d + 2

    def stacked(r):
        return np.vstack([np.asarray(x, float).reshape(-1, width) for x in r])

    def local(it):
        salt = TaskContext.get().partitionId() % SALTS
        held: dict = {}

        def passed_on():
            return pd.DataFrame([(k, salt, n, r.ravel()) for k, (n, r) in held.items()],
                                columns=FACTOR_SCHEMA.fieldNames())
        for pdf in it:
            for symbol, g in pdf.groupby("symbol", dropna=False):
                block = np.column_stack([np.ones(len(g)), np.stack(g["x"].to_numpy()),
                                         g["y"].to_numpy(dtype=float)])
                n, before = held.get(symbol, (0, np.empty((0, width))))
                held[symbol] = n + len(g), np.linalg.qr(np.vstack([before, block]), mode="r")
            if len(held) > HELD_FACTORS:
                yield passed_on()
                held.clear()
        if held:
            yield passed_on()

    def merged(pdf):
        r = np.linalg.qr(stacked(pdf["r"]), mode="r")
        return pd.DataFrame([(pdf["symbol"].iloc[0], pdf["salt"].iloc[0], pdf["n"].sum(), r.ravel())],
                            columns=FACTOR_SCHEMA.fieldNames())

    def solved(pdf):
        b0, coef, rank = solve_factor(np.linalg.qr(stacked(pdf["r"]), mode="r"), d)
        return pd.DataFrame([(pdf["symbol"].iloc[0], b0, coef, rank, pdf["n"].sum())],
                            columns=MODEL_SCHEMA.fieldNames())

    factors = windows.select("symbol", "x", "y").mapInPandas(local, FACTOR_SCHEMA)
    return (factors.groupBy("symbol", "salt").applyInPandas(merged, FACTOR_SCHEMA)
            .groupBy("symbol").applyInPandas(solved, MODEL_SCHEMA))


def dot(x: str, coef: str):
    return F.aggregate(F.zip_with(F.col(x), F.col(coef), lambda a, b: a * b),
                       F.lit(0.0), lambda acc, v: acc + v)


def predict(windows: DataFrame, model: DataFrame, out: str = "pred_linear",
            x: str = "x") -> DataFrame:
    """``intercept + x·coef``, evaluated JVM-side after joining the model;
    null for a symbol without a model."""
    m = model.select("symbol", F.col("intercept").alias("_b0"), F.col("coef").alias("_coef"))
    return (join_small(windows, m, "symbol", "left")
            .withColumn(out, F.col("_b0") + dot(x, "_coef")).drop("_b0", "_coef"))
