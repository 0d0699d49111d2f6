"""The metric index of the nearest-neighbour search."""

import numpy as np
from pyspark.sql import functions as F

from tickforge.models import knn as KNN
from tickforge.plans import inputs as I
from tickforge.plans import training as TRN
from tickforge.session import materialize
from conftest import SF001

SCHEMA = "symbol string, {0} long, x array<double>"


def _frames(spark, train, queries):
    t = spark.createDataFrame([(s, i, x.tolist(), float(y)) for s, i, x, y in train], SCHEMA.format("tid") + ", y double")
    q = spark.createDataFrame([(s, i, x.tolist()) for s, i, x in queries], SCHEMA.format("qid"))
    return t, q


def _brute(train, queries, k):
    for s, i, x in queries:
        own = sorted((float(np.add.accumulate((x - t) ** 2)[-1]), j, y) for z, j, t, y in train if z == s)[:k]
        yield (s, i), np.mean([y for _, _, y in own])


def test_search_equals_brute_force_with_ties_and_far_queries(spark):
    rng = np.random.default_rng(5)
    train = [("a", i, rng.integers(0, 4, 8) / 4, rng.normal()) for i in range(900)]
    train += [("few", i, rng.normal(size=8), float(i)) for i in range(3)]
    train += [("line", i, np.full(8, i // 7 / 10), float(i)) for i in range(200)]
    queries = [("a", i, rng.integers(-1, 6, 8) / 4) for i in range(60)]
    queries += [("few", 0, rng.normal(size=8)), ("line", 0, np.full(8, 50.0)), ("line", 1, np.full(8, .55))]
    t, q = _frames(spark, train, queries)
    got = {(r.symbol, r.qid): r.pred_knn for r in KNN.predict(t, q, 8, k=5, cell_rows=4).collect()}
    want = dict(_brute(train, queries, 5))
    assert set(got) == set(want) and all(abs(got[x] - want[x]) < 1e-12 for x in want)


def test_thousands_of_equal_windows_fill_no_cell(spark):
    rng = np.random.default_rng(6)
    train = [("a", i, np.full(6, .5), float(i)) for i in range(4000)]
    train += [("a", 4000 + i, rng.random(6), float(i)) for i in range(300)]
    queries = [("a", 0, np.full(6, .5)), ("a", 1, np.full(6, .50001)), ("a", 2, rng.random(6))]
    t, q = _frames(spark, train, queries)
    index = KNN.build_index(t, 6, cell_rows=8, k=5)
    assert index.boxes.agg(F.max("rows")).first()[0] <= 3 * 8
    got = {r.qid: r.pred_knn for r in KNN.predict(t, q, 6, k=5, index=index).collect()}
    want = {i: v for (_, i), v in _brute(train, queries, 5)}
    assert got[0] == got[1] == 2.0 and all(abs(got[i] - want[i]) < 1e-12 for i in want)


def test_share_of_pairs_compared(spark, capsys):
    """Brand bars and hourly bars: under a third of all pairs are compared."""
    cfg = TRN.ModelConfig()
    for name, bars in (("brand bars", I.daily_brand_bars(spark, SF001)), ("hourly bars", I.hourly_bars(spark, SF001))):
        _, w = TRN.prepare_windows(bars, cfg)
        train = w.where("train").select("symbol", F.col("widx").alias("tid"), "x", "y")
        test = materialize(w.where("NOT train").select("symbol", F.col("widx").alias("qid"), "x"))
        index = KNN.build_index(train, cfg.flat_size)
        compared = KNN.candidates(KNN.bounded(test, index), index).count()
        pairs = train.groupBy("symbol").count().join(test.groupBy("symbol").agg(F.count(F.lit(1)).alias("m")), "symbol").agg(
            F.sum(F.col("count") * F.col("m"))).first()[0]
        with capsys.disabled():
            print(f"\n{name}: {compared} of {pairs} pairs compared, {compared / pairs:.3f}")
        assert compared < pairs / 3
