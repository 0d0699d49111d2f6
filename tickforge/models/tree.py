"""Regression tree per symbol (M2): squared-error CART grown level by level,
with exact splits.

Every distinct value of a feature is a candidate; there are no bins.  The
targets are put on a grid of ``2^40`` steps between their symbol's smallest
and largest one, so sums are exact whole numbers (decimals) and the tree does
not depend on the order in which rows arrive.

Per level, one grouped aggregation counts and sums ``(symbol, node, feature,
value)``, combined map-side, so a value that a third of the rows share is one
row per task.  The values of a feature lie in ranges (*chunks*) of about
``chunk_rows`` rows, cut at per-symbol quantiles (``percentile_approx``, a
mergeable sketch; where they lie changes no result).  Prefix sums run in each
chunk by value, and what the chunks before it hold is carried over from a
table with one row per chunk, so a hot symbol's feature is sorted by many
tasks.  The best split of a node is the largest drop of the sum of squared
errors, ``cl·cr/c·(mean_l - mean_r)²``; ties go to the lower feature, then the
lower value.  The threshold lies midway to the node's next value.

The rows are stored once and never change: a row's node follows from the
splits made so far, an array indexed by node.  Rows with ``x <= threshold``
(and those whose value is null) go to child ``2·node``, others, NaN too, to
``2·node + 1``.  Rows without a target take no part in the fit.  Two means
count as equal when they differ by rounding only; that test does not depend
on the number of rows.

Prediction follows the path inside the JVM: the nodes of a symbol are an
array (at most ``2^(depth+1)`` entries) joined to the windows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.operators.joins import join_small
from tickforge.session import materialize

#: Means that differ by less than this share of the larger one are equal.
EQUAL_MEANS = 1e-12
#: Steps of the grid between a symbol's smallest and largest target.
GRID = 1 << 40
#: Rows of a feature's values that one window sorts.
CHUNK_ROWS = 1 << 20
#: Symbols whose trees are broadcast.
TREE_ROWS = 1000


def _prepare(train: DataFrame, d: int, chunk_rows: int) -> tuple[DataFrame, DataFrame, bool]:
    """Stored rows ``symbol, x, chunks, z`` (target on its grid) and the
    symbols' smallest target and range; whether columns have several chunks."""
    known = (train.where(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("y"))
             .select("symbol", "x", F.col("y").cast("double").alias("y")))
    bounds = materialize(known.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.min("y").alias("lo"), (F.max("y") - F.min("y")).alias("span")))
    most = bounds.agg(F.max("rows")).first()[0] or 0
    cuts = -(-most // chunk_rows)
    if cuts > 1:
        at = [i / cuts for i in range(1, cuts)]
        edges = known.groupBy("symbol").agg(F.array(*[
            F.array_distinct(F.percentile_approx(F.get("x", F.lit(i)), at, max(10_000, 100 * cuts)))
            for i in range(d)]).alias("edges"))
        rows = join_small(known, materialize(edges), "symbol", max_rows=TREE_ROWS)
    else:
        rows = known.withColumn("edges", F.array(*[F.expr("cast(array() as array<double>)")] * d))
    z = F.when(F.col("span") > 0, F.floor((F.col("y") - F.col("lo")) / F.col("span") * F.lit(float(GRID))
                                          + F.lit(0.5))).otherwise(F.lit(0).cast("long"))
    chunks = F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda i: F.size(
        F.filter(F.coalesce(F.get("edges", i), F.expr("cast(array() as array<double>)")),
                 lambda t: t < F.get("x", i))))
    rows = (join_small(rows, bounds, "symbol", max_rows=TREE_ROWS)
            .select("symbol", F.slice("x", 1, d).alias("x"), chunks.alias("chunks"),
                    z.cast("decimal(13,0)").alias("z")))
    return materialize(rows), bounds.select("symbol", "lo", "span"), cuts > 1


def _by_node(nodes: DataFrame, size: int, out: str) -> DataFrame:
    """One row per symbol: array ``out`` with the node's struct at its index."""
    packed = nodes.groupBy("symbol").agg(F.map_from_entries(F.collect_list(
        F.struct("node", F.struct("feature", "threshold", "value")))).alias("_m"))
    return packed.select("symbol", F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long")),
        lambda i: F.element_at("_m", i)).alias(out))


def _descend(nodes: str, x: str, steps: int) -> Column:
    """The node reached from the root in ``steps`` steps through splits."""
    def step(node, _i):
        nd = F.get(nodes, node.cast("int"))
        go = F.when(F.get(x, nd["feature"]) > nd["threshold"], 1).otherwise(0)
        return F.when(nd.isNull() | nd["feature"].isNull(), node).otherwise(node * 2 + go)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(1).cast("long"), step)


def _located(rows: DataFrame, splits: list[DataFrame]) -> DataFrame:
    """``rows`` with their ``node`` after the levels of ``splits``."""
    if not splits:
        return rows.withColumn("node", F.lit(1).cast("long"))
    made = _by_node(reduce(DataFrame.unionByName, splits), 2 ** len(splits), "_s")
    j = join_small(rows, made, "symbol", "left", TREE_ROWS)
    return j.withColumn("node", _descend("_s", "x", len(splits))).drop("_s")


def _best_splits(live: DataFrame, min_samples_split: int, min_samples_leaf: int, chunked: bool) -> DataFrame:
    """The best split of every node of ``live`` that has one.  Without chunks
    nothing is carried and one window sees the whole column."""
    cells = (live.select("symbol", "node", "z", F.posexplode(F.arrays_zip("x", "chunks")).alias("f", "_c"))
             .select("symbol", "node", "f", F.col("_c.chunks").alias("chunk"), F.col("_c.x").alias("v"), "z")
             .groupBy("symbol", "node", "f", "chunk", "v")
             .agg(F.count(F.lit(1)).alias("c"), F.sum("z").alias("s")))
    chunk = ["symbol", "node", "f", "chunk"]
    whole = Window.partitionBy(*chunk)
    inside = whole.orderBy("v")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    side = cells.withColumns({"cl": F.sum("c").over(upto), "sl": F.sum("s").over(upto),
                              "next": F.lead("v").over(inside)})
    if chunked:
        # one row per chunk: what the chunks before it hold, the next one's first value
        column = Window.partitionBy("symbol", "node", "f")
        before = column.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        carried = (cells.groupBy(*chunk).agg(F.sum("c").alias("cc"), F.sum("s").alias("cs"), F.min("v").alias("v0"))
                   .select(*chunk,
                           F.coalesce(F.sum("cc").over(before), F.lit(0)).alias("c0"),
                           F.coalesce(F.sum("cs").over(before), F.lit(0)).alias("s0"),
                           F.sum("cc").over(column).alias("ct"), F.sum("cs").over(column).alias("st"),
                           F.lead("v0").over(column.orderBy("chunk")).alias("after")))
        side = side.join(carried, chunk)
    else:
        side = side.withColumns({"c0": F.lit(0), "s0": F.lit(0), "after": F.lit(None).cast("double"),
                                 "ct": F.sum("c").over(whole), "st": F.sum("s").over(whole)})
    num = [(F.col("c0") + F.col("cl")).cast("double").alias("cl"),
           (F.col("s0") + F.col("sl")).cast("double").alias("sl"),
           (F.col("ct") - F.col("c0") - F.col("cl")).cast("double").alias("cr"),
           (F.col("st") - F.col("s0") - F.col("sl")).cast("double").alias("sr"),
           F.col("ct").cast("double").alias("ct")]
    side = (side.select("symbol", "node", "f", "v", F.coalesce("next", "after").alias("next"), *num)
            .where(F.col("v").isNotNull() & (F.col("cl") >= min_samples_leaf) & (F.col("cr") > 0)
                   & (F.col("cr") >= min_samples_leaf) & (F.col("ct") >= min_samples_split))
            .withColumn("ml", F.col("sl") / F.col("cl"))
            .withColumn("mr", F.col("sr") / F.col("cr"))
            .withColumn("apart", F.abs(F.col("ml") - F.col("mr")))
            .where(F.col("apart") > F.lit(EQUAL_MEANS) * F.greatest(F.abs("ml"), F.abs("mr")))
            .withColumn("gain", F.col("cl") * F.col("cr") / F.col("ct") * F.col("apart") * F.col("apart")))
    midway = F.col("v") / 2 + F.col("next") / 2
    return (side.withColumn("threshold", F.when((midway >= F.col("v")) & (midway < F.col("next")), midway)
                            .otherwise(F.col("v")))
            .groupBy("symbol", "node")
            .agg(F.min_by(F.struct("f", "threshold"),
                          F.struct((-F.col("gain")).alias("g"), "f", "v")).alias("_s"))
            .select("symbol", "node", F.col("_s.f").alias("feature"), F.col("_s.threshold").alias("threshold"),
                    F.lit(None).cast("double").alias("value")))


def fit(train: DataFrame, d: int, max_depth: int = 10, chunk_rows: int = CHUNK_ROWS,
        min_samples_split: int = 2, min_samples_leaf: int = 1) -> DataFrame:
    """Node table per symbol: ``node, is_leaf, feature, threshold, value``.

    ``train`` has ``symbol, x`` (array of ``d`` features) and ``y``.
    """
    rows, bounds, chunked = _prepare(train, d, chunk_rows)
    splits: list[DataFrame] = []
    for level in range(max_depth):
        # the nodes of a level are those from 2^level on
        live = _located(rows, splits).where(F.col("node") >= 2 ** level)
        best = materialize(_best_splits(live, min_samples_split, min_samples_leaf, chunked))
        if best.isEmpty():
            break
        splits.append(best)
    means = (_located(rows, splits).groupBy("symbol", "node")
             .agg((F.sum("z").cast("double") / F.count(F.lit(1))).alias("m")))
    leaves = join_small(means, bounds, "symbol", max_rows=TREE_ROWS).select(
        "symbol", "node", F.lit(True).alias("is_leaf"), F.lit(None).cast("int").alias("feature"),
        F.lit(None).cast("double").alias("threshold"),
        (F.col("lo") + F.col("m") / F.lit(float(GRID)) * F.col("span")).alias("value"))
    inner = [s.withColumn("is_leaf", F.lit(False)) for s in splits]
    return reduce(DataFrame.unionByName, inner, leaves)


def predict(windows: DataFrame, model: DataFrame, max_depth: int = 10,
            out: str = "pred_dt", x: str = "x") -> DataFrame:
    """Follow each window's path from the root to a leaf; null for a symbol
    without a tree."""
    trees = _by_node(model, 2 ** (max_depth + 1), "_tree")
    j = join_small(windows, trees, "symbol", "left", TREE_ROWS)
    leaf = _descend("_tree", x, max_depth)
    return j.withColumn(out, F.get("_tree", leaf.cast("int"))["value"]).drop("_tree")
