"""Exact k-nearest-neighbour regression per symbol without all pairs.

``y_hat(q) = mean of y over the k train windows nearest to q`` (Euclidean,
uniform weights; equal distances are broken by the smaller train index).

Every window gets ``AXES + 1`` coordinates: its projections on the symbol's
first principal axes (from distributed moment sums) and its distance from
their common plane.  Projections shorten distances, and by the triangle
inequality two windows are at least as far apart as their distances from the
plane differ; so the distance of two windows is at least that of their
coordinates.  The train windows lie in cells of about ``cell_rows``, equal
counts by the first axis (slabs) and within a slab by the second, and a
directory has the box of coordinates of each cell.

1. *bound* - a query meets the windows of its own cell and its neighbours; the
   k-th smallest distance there, ``r``, bounds that of the true neighbours.
   Queries that found fewer than k windows widen their range and retry.
2. *search* - a query meets the boxes of the slabs within ``r``, then the
   windows of the boxes within ``r``, and is compared with those whose
   coordinates are within ``r``: all that can be nearer.

Of equal windows only the k with the smallest index can be answers; the others
are left out of the index, so thousands of equal windows fill no cell.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.operators.joins import join_small
from tickforge.session import materialize

SLACK = 1e-9


def sq_dist(a: str, b: str) -> Column:
    """Sequential sum of squared differences (same order as the SQL check)."""
    return F.aggregate(F.zip_with(F.col(a), F.col(b), lambda u, v: (u - v) * (u - v)),
                       F.lit(0.0), lambda acc, v: acc + v)


#: Principal axes used, slabs of a symbol and cells of a slab at most.
AXES = 6
GRID = 256


def principal_axes(train: DataFrame, d: int) -> DataFrame:
    """First ``AXES`` principal axes of each symbol's training windows, unit
    vectors (signs fixed so the largest component is positive)."""
    import numpy as np
    import pandas as pd

    from tickforge.models.linear import moments
    m = min(AXES, d)

    def solve(it):
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                n = float(r.n)
                S = np.zeros((d, d))
                S[np.triu_indices(d)] = np.asarray(r.sxx, float)
                S = S + S.T - np.diag(np.diag(S))
                mx = np.asarray(r.sx, float) / n
                axes = np.linalg.eigh(S - n * np.outer(mx, mx))[1][:, ::-1].T[:m]
                axes *= np.sign(axes[np.arange(m), np.abs(axes).argmax(axis=1)])[:, None]
                out.append((r.symbol, axes.tolist()))
            yield pd.DataFrame(out, columns=["symbol", "axes"])

    return moments(train, d).mapInPandas(solve, "symbol string, axes array<array<double>>")


def _coordinates(x: str) -> Column:
    """Projections of column ``x`` on ``axes`` and the length of what they leave."""
    return F.expr(f"""
        concat(transform(axes, u -> aggregate(zip_with(u, {x}, (a, b) -> a * b), 0D, (s, v) -> s + v)),
               array(sqrt(aggregate(aggregate(
                   axes, {x}, (rest, u) -> zip_with(rest, u, (a, b) -> a - b * aggregate(
                       zip_with(u, {x}, (c, e) -> c * e), 0D, (s, v) -> s + v))), 0D, (s, v) -> s + v * v))))""")


def _below(bounds: str, value: str) -> Column:
    """Number of ``bounds`` below ``value``: its place among equal-count cells."""
    return F.expr(f"size(filter({bounds}, b -> b < {value}))")


def _cuts(column: str, count: str) -> Column:
    """``count`` - 1 inner quantiles of ``column`` (aggregate; ``count`` is an
    aggregate of at most GRID)."""
    marks = ", ".join(repr(i / GRID) for i in range(1, GRID))
    return F.expr(f"transform(sequence(1, greatest({count}, 2) - 1), i -> "
                  f"percentile_approx({column}, array({marks}), 10000)[int(i * {GRID} / greatest({count}, 2)) - 1])")


def _topk(cand: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("symbol", "qid").orderBy("dist2", "tid")
    return cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)


@dataclass(frozen=True)
class Index:
    """Stored tables: ``windows`` (symbol, slab, cell, tid, tx, y, tc), the
    ``boxes`` of the cells, the ``slabs`` with their cuts, and the ``grid``
    (symbol, nt, axes, cuts)."""
    windows: DataFrame
    boxes: DataFrame
    slabs: DataFrame
    grid: DataFrame


def build_index(train: DataFrame, d: int, cell_rows: int = 16, k: int = 5) -> Index:
    """Index of ``train`` (symbol, tid, x, y) for up to ``k`` neighbours."""
    axes = materialize(principal_axes(train, d))
    m = min(AXES, d) + 1
    equal = Window.partitionBy("symbol", "tx").orderBy("tid")
    tr = (train.select("symbol", "tid", F.col("x").alias("tx"), "y")
          .withColumn("_r", F.row_number().over(equal)).where(F.col("_r") <= k).drop("_r"))
    tr = materialize(join_small(tr, axes, "symbol").withColumn("tc", _coordinates("tx")).drop("axes")
                     .withColumns({"p1": F.col("tc")[0], "p2": F.col("tc")[1]}))
    n_slabs = f"least({GRID}, int(ceil(sqrt(count(1) / {cell_rows}D))))"
    grid = materialize(join_small(tr.groupBy("symbol").agg(F.count(F.lit(1)).alias("nt"), _cuts("p1", n_slabs).alias("cuts")),
                                  axes, "symbol"))
    tr = join_small(tr, grid.select("symbol", "cuts"), "symbol").withColumn("slab", _below("cuts", "p1")).drop("cuts")
    n_cells = f"least({GRID}, int(ceil(count(1) / {cell_rows}D)))"
    tr = materialize(tr)
    slabs = materialize(tr.groupBy("symbol", "slab").agg(_cuts("p2", n_cells).alias("inner")))
    tr = materialize(join_small(tr, slabs, ["symbol", "slab"]).withColumn("cell", _below("inner", "p2"))
                     .select("symbol", "slab", "cell", "tid", "tx", "y", "tc"))
    boxes = materialize(tr.groupBy("symbol", "slab", "cell").agg(
        F.array(*(F.min(F.col("tc")[j]) for j in range(m))).alias("low"),
        F.array(*(F.max(F.col("tc")[j]) for j in range(m))).alias("high"), F.count(F.lit(1)).alias("rows")))
    return Index(tr, boxes, slabs, grid)


BOX_DIST2 = """aggregate(zip_with(zip_with(low, qc, (a, q) -> a - q), zip_with(high, qc, (b, q) -> q - b),
                                  (a, b) -> greatest(a, b, 0D)), 0D, (s, v) -> s + v * v)"""


def candidates(q: DataFrame, index: Index) -> DataFrame:
    """The pairs that are compared: of each query (qid, qx, qc, r, and cuts of
    its symbol) with the windows whose coordinates are within r."""
    near = q.withColumn("slab", F.explode(F.sequence(_below("cuts", "qc[0] - r"), _below("cuts", "qc[0] + r")))).drop("cuts")
    near = near.join(index.boxes, ["symbol", "slab"]).where(f"{BOX_DIST2} <= r * r").drop("low", "high", "rows")
    return near.join(index.windows, ["symbol", "slab", "cell"]).where(
        "aggregate(zip_with(tc, qc, (a, b) -> (a - b) * (a - b)), 0D, (s, v) -> s + v) <= r * r")


def bounded(queries: DataFrame, index: Index, k: int = 5, max_rounds: int = 40) -> DataFrame:
    """``queries`` (symbol, qid, x) as (symbol, qid, qx, qc, cuts, r): no k-th
    neighbour is farther than r."""
    q = (join_small(queries.select("symbol", "qid", F.col("x").alias("qx")), index.grid, "symbol")
         .withColumn("qc", _coordinates("qx")).drop("axes").withColumn("slab", _below("cuts", "qc[0]")))
    q = materialize(q.join(index.slabs, ["symbol", "slab"], "left").withColumn(
        "qcell", F.coalesce(_below("inner", "qc[1]"), F.lit(0))).drop("inner"))
    bounds, pending, reach = None, q, 0
    for _ in range(max_rounds):
        if reach:
            home = _below("cuts", "qc[0]")
            probe = pending.withColumn("slab", F.explode(F.sequence(F.greatest(home - reach, F.lit(0)), home + reach)))
            cand = probe.join(index.windows, ["symbol", "slab"])
        else:
            probe = pending.withColumn("cell", F.explode(F.sequence(F.greatest(F.col("qcell") - 1, F.lit(0)),
                                                                    F.col("qcell") + 1)))
            cand = probe.join(index.windows, ["symbol", "slab", "cell"])
        top = _topk(cand.withColumn("dist2", sq_dist("qx", "tx")).select("symbol", "qid", "tid", "dist2"), k)
        found = top.groupBy("symbol", "qid").agg(F.count(F.lit(1)).alias("m"), F.max("dist2").alias("r2"))
        got = materialize(pending.join(found, ["symbol", "qid"], "left").withColumn(
            "_ok", F.coalesce(F.col("m") >= F.least(F.lit(k), F.col("nt")), F.lit(False))))
        done = got.where("_ok").select("symbol", "qid", "qx", "qc", "cuts",
                                       (F.sqrt("r2") * F.lit(1 + SLACK) + F.lit(SLACK)).alias("r"))
        bounds = done if bounds is None else bounds.unionByName(done)
        pending = got.where(~F.col("_ok")).drop("m", "r2", "_ok")
        if pending.isEmpty():
            return bounds
        reach = 4 * reach or 1
    raise RuntimeError("kNN bound search did not converge")


def predict(train: DataFrame, queries: DataFrame, d: int, k: int = 5, cell_rows: int = 16,
            out: str = "pred_knn", index: Index | None = None) -> DataFrame:
    """kNN predictions for ``queries`` (needs ``symbol, qid, x``) from
    ``train`` (``symbol, tid, x, y``) or a prebuilt ``index``.  Returns
    queries + ``out``."""
    index = index if index is not None else build_index(train, d, cell_rows, k)
    cand = candidates(bounded(queries, index, k), index).withColumn("dist2", sq_dist("qx", "tx"))
    best = _topk(cand.select("symbol", "qid", "tid", "dist2", "y"), k)
    pred = best.groupBy("symbol", "qid").agg(F.avg("y").alias(out))
    return queries.join(pred, ["symbol", "qid"], "left")
