import json
import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickforge.operators.indicators import with_ema
from tickforge.plans import inputs as I
from tickforge.sinks.upsert import read_latest
from tickforge.sources import bars as B
from tickforge.sources import stream as ST
from tickforge.streaming import jobs as SJ
from conftest import SF001


def test_csv_symbol_from_file_keeps_leading_zeros(spark, six_bars):
    d = tempfile.mkdtemp(prefix="tf-csv-")
    pdf = six_bars.drop("symbol").toPandas()
    for name in ("000001", "000002"):
        pdf.to_csv(os.path.join(d, f"{name}.csv"), index=False)
    df = B.read_bars_csv(spark, d + "/*.csv", symbol_from_file=True).toPandas()
    assert sorted(df["symbol"].unique()) == ["000001", "000002"]
    assert len(df) == 12
    assert B.normalise_symbol(F.lit("SSE:000001")) is not None
    got = spark.range(1).select(B.normalise_symbol(F.lit("SSE:000001")).alias("s")).first()["s"]
    assert got == "000001"


def test_config_json(spark):
    d = tempfile.mkdtemp(prefix="tf-cfg-")
    cfg = {"seq_len": 3, "input_size": 7, "hidden_size": 64, "target_col": "close",
           "features_cols": ["open", "high", "low", "close", "volume", "timestamp", "EMA5"]}
    with open(os.path.join(d, "config.json"), "w") as f:
        json.dump(cfg, f)
    row = ST.read_config(spark, d).first()
    assert row["seq_len"] == 3 and row["features_cols"][5] == "timestamp"


def test_stream_equals_batch_across_restart(spark):
    bars = I.hourly_bars(spark, SF001)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp")
    root = SJ.new_scratch(spark, "test-stream")
    src, out = root + "/msgs", root + "/out"
    SJ.replay_messages(bars.where(F.col("datetime") < cut), src, chunks=2)
    SJ.run_replay(spark, src, out, max_files_per_trigger=3)
    first = spark.read.parquet(out + "/capture").count()
    SJ.replay_messages(bars.where(F.col("datetime") >= cut), src, chunks=2, first_chunk=2)
    paths = SJ.run_replay(spark, src, out, max_files_per_trigger=3)   # restart from checkpoint
    got = spark.read.parquet(paths.capture).select("symbol", "datetime", "EMA5").toPandas()
    ref = with_ema(bars).select("symbol", "datetime", "EMA5").toPandas()
    assert 0 < first < len(ref)
    m = ref.merge(got, on=["symbol", "datetime"], suffixes=("", "_s"))
    assert len(m) == len(ref) == len(got)
    assert (m["EMA5"] == m["EMA5_s"]).all()
    res = read_latest(spark, paths.results).toPandas()
    assert len(res) == len(ref)                         # upserted result table holds every bar
    assert _count(spark, paths.late) == 0


def _count(spark, path):
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(path).count()
    except AnalysisException:      # nothing written yet
        return 0


def test_late_bar_changes_no_state(spark):
    root = SJ.new_scratch(spark, "test-late")
    src = root + "/msgs"
    rows = [("a", "2024-01-01 02:00:00", 1.0, 1.0, 1.0, 10.0, 1.0),
            ("a", "2024-01-01 01:00:00", 1.0, 1.0, 1.0, 99.0, 1.0),
            ("a", "2024-01-01 03:00:00", 1.0, 1.0, 1.0, 13.0, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, datetime string, open double, high double, "
                                     "low double, close double, volume double")
    from tickforge.sinks.messages import encode_bars
    for i, r in enumerate([[0], [1, 2]]):
        part = spark.createDataFrame([rows[j] for j in r], df.schema)
        encode_bars(part).write.mode("overwrite").json(f"{src}/chunk={i:05d}")
    bad = spark.createDataFrame([("a", "2024-01-01 04:00:00", None, 1.0, 1.0, 50.0, 1.0)], df.schema)
    encode_bars(bad).write.mode("overwrite").json(f"{src}/chunk=00002")
    paths = SJ.run_replay(spark, src, root + "/out", max_files_per_trigger=1)
    assert spark.read.parquet(paths.errors).count() == 1
    cap = spark.read.parquet(paths.capture).orderBy("datetime").toPandas()
    assert cap["close"].tolist() == [10.0, 13.0]
    assert cap["EMA5"].iloc[1] == 10.0 * (1 - 1 / 3) + 13.0 / 3
    assert spark.read.parquet(paths.late).count() == 1


def test_model_store_roundtrip(spark):
    from tickforge.plans import training as TRN
    cfg = TRN.ModelConfig(hidden=4, epochs=2, tree_depth=3)
    scaler, w = TRN.prepare_windows(I.hourly_bars(spark, SF001), cfg)
    models = TRN.train_all(w, scaler, cfg)
    root = SJ.new_scratch(spark, "test-models")
    TRN.save_models(models, root)
    back = TRN.load_models(spark, root, cfg, symbols=["click"])
    assert back.scaler.count() == 1
    st = back.recurrent.first()
    assert st["step"] > 0 and len(st["params"]) == len(st["adam_m"]) == len(st["adam_v"])
    scored = TRN.score(w.where(~F.col("train") & (F.col("symbol") == "click")), back).toPandas()
    assert len(scored) > 0 and scored[["pred_linear", "pred_dt", "pred_knn", "pred_recurrent"]].notna().all().all()


def test_history_layout_and_new_bar_append(spark):
    from tickforge.sinks import tables as TB
    bars = I.hourly_bars(spark, SF001)
    root = SJ.new_scratch(spark, "test-history")
    TB.write_history(bars, root + "/hist")
    back = B.read_bars_parquet(spark, root + "/hist", symbol="click")
    assert back.count() == bars.where("symbol = 'click'").count()
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "symbol" in plan
    TB.append_new_bars_csv(bars, root + "/csv")
    TB.append_new_bars_csv(bars, root + "/csv")
    assert spark.read.option("header", True).csv(root + "/csv").count() == 10


def test_seeded_stream_learns_and_snapshots_state(spark):
    """W12 seeding, M8 online steps, K7 state snapshots, K3 batch CSVs, M11 resume."""
    from tickforge.models import recurrent as HB
    from tickforge.operators import features as FT
    from tickforge.plans import training as TRN
    cfg = TRN.ModelConfig(hidden=4, epochs=1)
    bars = I.hourly_bars(spark, SF001)
    cut = F.lit("2024-01-28 00:00:00").cast("timestamp")
    hist, live = bars.where(F.col("datetime") < cut), bars.where(F.col("datetime") >= cut)
    scaler, w = TRN.prepare_windows(hist, cfg)
    net = HB.fit(w.where("train"), 3, 7, hidden=4, epochs=1)
    resumed = HB.fit(w.where("train"), 3, 7, hidden=4, epochs=1, init=net)      # M11
    steps0 = dict(net.select("symbol", "step").collect())
    assert all(r["step"] == 2 * steps0[r["symbol"]] for r in resumed.collect())
    seeds = SJ.seed_state(FT.with_positions(hist), scaler, net, 3)
    root = SJ.new_scratch(spark, "test-seeded")
    SJ.replay_messages(live, root + "/msgs", chunks=2)

    def score(ready):
        return ready.select("symbol", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
                            F.col("close").alias("actual_price"),
                            *[F.col("pred_recurrent").alias(c) for c in
                              ("pred_linear", "pred_dt", "pred_knn", "pred_recurrent")])

    paths = SJ.run_replay(spark, root + "/msgs", root + "/out", scaler=scaler, seeds=seeds,
                          score_fn=score, write_csv=True, hidden=4, emit_state=True)
    cap = spark.read.parquet(paths.capture).count()
    preds = spark.read.parquet(paths.predictions).toPandas()
    assert cap == live.count() and len(preds) == cap             # seeded: every bar forecast
    assert preds["pred_recurrent"].notna().all()
    st = spark.read.parquet(paths.states).toPandas()
    assert len(st) == bars.select("symbol").distinct().count()
    for r in st.itertuples():
        assert r.step == steps0[r.symbol] + preds[preds.symbol == r.symbol].shape[0]
    assert spark.read.option("header", True).csv(paths.csv + "/*").count() == cap
    assert spark.read.parquet(paths.predictions_long).count() == 4 * cap


def test_missing_symbol_history_is_an_error(spark):
    root = SJ.new_scratch(spark, "test-hist-missing")
    I.hourly_bars(spark, SF001).write.partitionBy("symbol").parquet(root)
    assert B.load_symbol_history(spark, root, "click").count() > 0
    try:
        B.load_symbol_history(spark, root, "nosuch")
    except ValueError as e:
        assert "nosuch" in str(e)
    else:
        raise AssertionError("no error for a symbol without history")


def test_rejected_messages_are_stored_once_with_a_reason(spark):
    bars = I.hourly_bars(spark, SF001)
    root = SJ.new_scratch(spark, "test-rejected")
    src, out = root + "/msgs", root + "/out"
    bad = spark.createDataFrame([
        ("a", "{broken"), ("a", None), ("b", '{"k": 1}'), ("b", '{"symbol": "b", "close": 1.0, "datetime": "soon"}'),
        (None, '{"close": 1.0, "datetime": "2024-01-01 00:00:00"}')], "key string, value string")
    bad.write.json(src + "/chunk=99999")
    SJ.replay_messages(bars, src, chunks=1)
    paths = SJ.run_replay(spark, src, out)
    SJ.run_replay(spark, src, out)  # nothing new: nothing is stored again
    got = sorted(r["reason"] for r in SJ.read_rejected(spark, paths).collect())
    assert got == ["no symbol", "no time", "not a bar", "not a bar", "not a bar"]
    assert spark.read.parquet(paths.capture).count() == bars.count()


def test_graceful_stop_leaves_the_state_of_every_bar(spark):
    """Bars that arrived before the stop are in the state; a restart goes on from it."""
    from tickforge.schemas import RAW_BAR_CSV
    from tickforge.operators import clean as C
    from tickforge.sinks import messages as MSG
    rows = [(f"2024-06-03 {9 + i // 4:02d}:{15 * (i % 4):02d}:00", s, 1.0, 2.0, 0.5, 10.0 * k + i * i, 1.0)
            for k, s in enumerate(["IDX:000042", "IDX:000007"]) for i in range(12)]
    bars = C.clean_bars(spark.createDataFrame(rows, RAW_BAR_CSV), unique=True)
    want = with_ema(bars).toPandas()
    root = SJ.new_scratch(spark, "test-stop")
    for k, part in enumerate([F.col("datetime") < "2024-06-03 10:30:00", F.col("datetime") >= "2024-06-03 10:30:00"]):
        MSG.write_messages(MSG.encode_bars(bars.where(part)), f"{root}/msgs/chunk={k:05d}")
        others = {q.id for q in spark.streams.active}
        SJ.run_replay(spark, f"{root}/msgs", f"{root}/out", trigger="1 second")
        SJ.stop_gracefully([q for q in spark.streams.active if q.id not in others])
        assert {q.id for q in spark.streams.active} <= others
        got = SJ.read_bar_state(spark, f"{root}/out/_checkpoint").toPandas().set_index("symbol")
        assert (got["seen"] == (6, 12)[k]).all() and len(got) == 2
        for symbol, one in want.groupby("symbol"):
            last = one.sort_values("datetime").iloc[(6, 12)[k] - 1]
            assert got.loc[symbol, "EMA5"] == last["EMA5"] and got.loc[symbol, "datetime"] == last["datetime"]
