"""Results that must not depend on the number of rows or on how they are dealt."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.models import linear as LIN
from tickforge.models import recurrent as NET
from tickforge.models import recurrent_net as NN
from tickforge.models import tree as TR
from tickforge.operators import clean as C
from tickforge.operators.joins import join_small
from tickforge.sinks import upsert as UP
from tickforge.streaming.jobs import new_scratch


@pytest.mark.parametrize("rows", [1_000, 2_000_000])
def test_ols_rank_is_the_same_for_any_number_of_rows(spark, rows):
    """Three lags of a clock with irregular gaps are independent inputs."""
    gap = F.pmod(F.xxhash64("id"), F.lit(600)).cast("double")
    t = spark.range(rows).select(F.lit("s").alias("symbol"), *[
        (1.7e9 + 900.0 * (F.col("id") + k) + F.pmod(F.xxhash64(F.col("id") + k), F.lit(600))).alias(f"t{k}")
        for k in range(3)], gap.alias("gap"))
    w = t.select("symbol", F.array("t0", "t1", "t2").alias("x"),
                 (F.lit(5.0) + F.col("t0") * 2.0 - F.col("t1") + F.col("t2") * 0.5).alias("y"))
    got = LIN.fit(w, 3).first()
    assert got["rank"] == 3 and got["n"] == rows
    assert np.allclose(got["coef"], [2.0, -1.0, 0.5], atol=1e-5)


def test_ols_of_collinear_and_badly_scaled_inputs(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=300) * 1e9, rng.normal(size=300) * 1e-6
    X = np.column_stack([a, 2 * a, b])
    y = 3e-9 * a + 4e6 * b + 1
    w = spark.createDataFrame([("s", x.tolist(), float(v)) for x, v in zip(X, y)],
                              "symbol string, x array<double>, y double").repartition(5)
    got = LIN.fit(w, 3).first()
    assert got["rank"] == 2
    assert np.allclose(np.array(got["coef"]) / [0.6e-9, 1.2e-9, 4e6], 1, rtol=1e-6)


def test_tree_finds_small_steps_on_a_high_level(spark):
    y = [1e6 + (i % 64 >= 32) * 1e-3 for i in range(6400)]
    df = spark.createDataFrame([("s", [float(i % 64)], y[i]) for i in range(6400)],
                               "symbol string, x array<double>, y double")
    got = TR.predict(df, TR.fit(df, 1, max_depth=3), max_depth=3)
    assert got.where(F.abs(F.col("y") - F.col("pred_dt")) > 1e-6).count() == 0


def test_tree_takes_every_distinct_value_up_to_its_bins(spark):
    df = spark.createDataFrame([("s", [float(i)], float(i == 77)) for i in range(100)],
                               "symbol string, x array<double>, y double")
    got = TR.predict(df, TR.fit(df, 1, max_depth=2), max_depth=2).where("y <> pred_dt")
    assert got.count() == 0


def test_join_small_gives_the_same_rows_both_ways(spark):
    facts = spark.range(500).select(F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string"))
                                    .alias("symbol"), "id")
    small = spark.createDataFrame([("hot", 1.0), ("450", 2.0), ("none", 3.0)], "symbol string, v double")
    for how in ("inner", "left"):
        want = sorted(map(str, join_small(facts, small, "symbol", how).collect()))
        assert want == sorted(map(str, join_small(facts, small, "symbol", how, max_rows=1).collect()))


def _network_windows(spark, sizes):
    rng = np.random.default_rng(2)
    return spark.createDataFrame([(s, 3 + i, rng.normal(size=6).tolist(), float(i % 3))
                                  for s, n in sizes.items() for i in range(n)],
                                 "symbol string, widx long, x array<double>, y double")


def _states(df):
    return {r["symbol"]: r for r in df.collect()}


def test_network_weights_do_not_depend_on_the_shards(spark, monkeypatch):
    """Every window of a hot symbol trains, whatever the shards are."""
    monkeypatch.setattr(NET, "WAVE", 1)
    w = _network_windows(spark, {"hot": 60, "mid": 35, "low": 4})
    whole, few, many = (_states(NET.fit(w, 3, 2, hidden=3, epochs=2, lr=1e-2, shard_rows=k)) for k in (1000, 40, 7))
    for got in (few, many):
        assert {s: r["n_train"] for s, r in got.items()} == {"hot": 60, "mid": 35, "low": 4}
        for s, r in got.items():
            assert r["step"] == whole[s]["step"]
            for c in ("params", "adam_m", "adam_v", "losses"):
                assert np.allclose(r[c], whole[s][c], rtol=1e-9, atol=1e-12), (s, c)


def test_network_of_a_sharded_symbol_resumes(spark):
    w = _network_windows(spark, {"hot": 40, "low": 5})
    once = NET.fit(w, 3, 2, hidden=3, epochs=1, lr=1e-2, shard_rows=1000)
    again = [_states(NET.fit(w, 3, 2, hidden=3, epochs=1, lr=1e-2, init=once, shard_rows=k)) for k in (1000, 9)]
    assert set(again[1]) == {"hot", "low"} and again[1]["hot"]["step"] == 2 * _states(once)["hot"]["step"]
    assert np.allclose(again[0]["hot"]["params"], again[1]["hot"]["params"], rtol=1e-9)


def test_network_reads_every_window_in_each_epoch():
    widx = np.arange(5_000)
    for epoch in range(3):
        dealt = NN.minibatch_of(widx, 7, epoch, NN.minibatch_count(len(widx), 16, 64))
        assert set(dealt) == set(range(64))
        assert np.bincount(dealt).max() < 130
    assert (NN.minibatch_of(widx, 7, 0, 64) != NN.minibatch_of(widx, 7, 1, 64)).any()
    assert NN.minibatch_count(100, 16, 64) == 7 and NN.minibatch_count(10**9, 16, 64) == 64


def test_network_gives_the_loss_of_every_epoch(spark):
    rng = np.random.default_rng(2)
    w = spark.createDataFrame([("s", i, rng.normal(size=6).tolist(), float(i % 3)) for i in range(40)],
                              "symbol string, widx long, x array<double>, y double")
    state = NET.fit(w, 3, 2, hidden=3, epochs=4, lr=1e-2)
    loss = [r["loss"] for r in NET.epoch_losses(state).orderBy("epoch").collect()]
    assert len(loss) == 4 and loss[-1] < loss[0]


def test_upsert_needs_an_order_beyond_the_key(spark):
    rows = spark.createDataFrame([("k", 1.0)], "k string, v double")
    with pytest.raises(ValueError):
        UP.last_per_key(rows, ["k"], "k")


def test_only_published_versions_count(spark):
    path = new_scratch(spark, "test-versions")
    for v in range(4):
        rows = spark.createDataFrame([("k", float(v))], "k string, v_ double")
        UP.upsert_table(rows, path, ["k"], ["v_"], version=v, touched_col=None)
    assert UP.published(spark, path) == [2, 3]
    spark.createDataFrame([("k", 9.0)], "k string, v_ double").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/v=9")
    assert UP.read_latest(spark, path).first()["v_"] == 3.0


def _parts_written(spark, path, version):
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true").load(f"{path}/data/v={version}").select("path").collect()
    return {r["path"].split("_part=")[1].split("/")[0] for r in files}


def test_upsert_writes_only_the_partitions_a_batch_touches(spark):
    path, schema = new_scratch(spark, "test-parts"), "k string, first double, last double"
    plain = {}
    batches = [[(f"{m:02d}-{i}", 0.0, 0.0) for m in range(6) for i in range(5)],
               [("01-2", 1.0, 1.0), ("01-9", 1.0, 1.0), ("07/1", 1.0, 1.0)],
               [], [("01-9", 3.0, 3.0), (None, 3.0, 3.0), ("", 3.0, 3.0)],
               [("05-0", 4.0, 4.0)]]
    want_parts = [{f"p{m:02d}" for m in range(6)}, {"p01", "p07"}, set(), {"p01", "p"}, {"p05"}]
    for v, rows in enumerate(batches):
        for _ in range(2 if v == 1 else 1):             # a replayed batch
            UP.upsert_table(spark.createDataFrame(rows, schema), path, ["k"], ["last"], version=v,
                            touched_col=None, part=F.substring("k", 1, 2))
        for k, first, last in rows:
            if k is not None:
                plain[k] = (plain.get(k, (first,))[0], last)
        if rows:
            assert _parts_written(spark, path, v) == want_parts[v]
        got = UP.read_latest(spark, path).collect()
        assert {r["k"]: (r["first"], r["last"]) for r in got if r["k"] is not None} == plain
        assert len(got) == len(plain) + (v >= 3)
    assert UP.published(spark, path) == [3, 4]
    # partitions that no kept list names are gone, the others stay where they were written
    assert _parts_written(spark, path, 0) == {"p00", "p02", "p03", "p04", "p05"}
    assert _parts_written(spark, path, 1) == {"p07"}


def test_cleaning_needs_an_ingest_order(spark, six_bars):
    with pytest.raises(ValueError):
        C.clean_bars(six_bars)


def _sse_tree(X, y, depth):
    """Greedy tree with thresholds midway between neighbouring values, scored by error sums over slices."""
    if depth == 0 or np.ptp(y) == 0:
        return y.mean()
    best = None
    for f in range(X.shape[1]):
        v = np.unique(X[:, f])
        for a, b in zip(v, v[1:]):
            left = X[:, f] <= a
            drop = y.var() * len(y) - y[left].var() * left.sum() - y[~left].var() * (~left).sum()
            if best is None or drop > best[0] * (1 + 1e-9):
                best = (drop, f, a / 2 + b / 2)
    if best is None:
        return y.mean()
    _, f, t = best
    left = X[:, f] <= t
    return f, t, _sse_tree(X[left], y[left], depth - 1), _sse_tree(X[~left], y[~left], depth - 1)


def _walk(node, x):
    while isinstance(node, tuple):
        node = node[2] if x[node[0]] <= node[1] else node[3]
    return node


def test_tree_splits_distinct_values_like_brute_force_in_any_chunks(spark):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(400, 3))
    X[:150, 1] = 0.25  # a value that many rows share
    y = np.sin(3 * X[:, 0]) + (X[:, 1] > 0.25) + rng.normal(scale=0.05, size=400)
    new = rng.normal(size=(200, 3))
    train = spark.createDataFrame([("s", X[i].tolist(), float(y[i])) for i in range(400)],
                                  "symbol string, x array<double>, y double")
    test = spark.createDataFrame([("s", i, new[i].tolist()) for i in range(200)],
                                 "symbol string, i int, x array<double>")
    root = _sse_tree(X, y, 3)
    want = [_walk(root, x) for x in new]
    for chunk_rows in (1 << 20, 40):
        got = TR.predict(test, TR.fit(train, 3, max_depth=3, chunk_rows=chunk_rows), max_depth=3)
        assert np.allclose(got.orderBy("i").toPandas()["pred_dt"], want, rtol=1e-9), chunk_rows


def test_tree_with_nulls_constant_targets_and_no_rows(spark):
    rows = [("s", [None, 1.0], 1.0), ("s", [None, 2.0], 1.0), ("s", [5.0, 3.0], 9.0),
            ("s", [float("nan"), 3.0], 9.0), ("s", [5.0, 1.0], None), ("s", None, 4.0),
            ("flat", [1.0, 2.0], 7.0), ("flat", [2.0, 2.0], 7.0)]
    train = spark.createDataFrame(rows, "symbol string, x array<double>, y double")
    model = TR.fit(train, 2, max_depth=2)
    got = {(r["symbol"], str(r["x"])): r["pred_dt"] for r in TR.predict(train.where("x is not null"), model, 2).collect()}
    assert got["s", "[None, 1.0]"] == 1.0 and got["s", "[5.0, 3.0]"] == 9.0 and got["s", "[nan, 3.0]"] == 9.0
    assert got["flat", "[1.0, 2.0]"] == 7.0 and model.where("symbol = 'flat'").count() == 1
    assert TR.fit(train.where("false"), 2, max_depth=2).count() == 0
