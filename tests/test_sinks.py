import tempfile

from pyspark.sql import functions as F

from tickforge.sinks import messages as MSG
from tickforge.sinks import tables as TB
from tickforge.sinks.upsert import upsert
from tickforge.sources import stream as ST
from tickforge.operators import clean as C


def test_encode_decode_roundtrip_and_bad_messages(spark, six_bars):
    bars = C.clean_bars(six_bars, unique=True)
    msgs = MSG.encode_bars(bars)
    bad = spark.createDataFrame([("k", "{not json"), ("k", '{"symbol":"x","open":1.0}')],
                                "key string, value string")
    out = ST.decode_bars(msgs.unionByName(bad)).toPandas()
    assert len(out) == 6
    assert set(out["datetime"]) == set(r.datetime for r in six_bars.collect())


def test_upsert_semantics(spark):
    schema = "k string, open_price double, close_actual double, close_predicted double, n int"
    target = spark.createDataFrame([("a", 1.0, 10.0, 11.0, 0), ("b", 2.0, 20.0, 21.0, 0)], schema)
    updates = spark.createDataFrame([("b", 9.0, 25.0, None, 1), ("b", 8.0, 26.0, 27.0, 2),
                                     ("c", 3.0, 30.0, 31.0, 1)], schema)
    out = (upsert(target, updates, ["k"], ["close_actual", "close_predicted"], order="n")
           .orderBy("k").toPandas().set_index("k"))
    assert out.loc["a", "close_actual"] == 10.0
    assert out.loc["b", "open_price"] == 2.0           # first value kept
    assert out.loc["b", "close_actual"] == 26.0        # last update of the batch wins
    assert out.loc["b", "close_predicted"] == 27.0
    assert out.loc["c", "open_price"] == 3.0           # inserted
    again = upsert(out.reset_index()[["k", "open_price", "close_actual", "close_predicted", "n"]]
                   .pipe(spark.createDataFrame), updates, ["k"],
                   ["close_actual", "close_predicted"], order="n")
    assert again.orderBy("k").toPandas().equals(out.reset_index().sort_values("k").reset_index(drop=True)
                                                 .astype(again.toPandas().dtypes.to_dict()))


def test_long_predictions_and_capture_idempotent(spark):
    wide = spark.createDataFrame(
        [("s", "2024-01-01 00:00:00", 10.0, 1.1234567, 2.0, 3.0, 4.0)],
        "symbol string, datetime string, actual_price double, pred_linear double, "
        "pred_dt double, pred_knn double, pred_recurrent double")
    long = TB.to_long(wide).toPandas()
    assert sorted(long["model_type"]) == ["DecisionTree", "KNN", "LinearRegression", "Recurrent"]
    assert long.loc[long.model_type == "LinearRegression", "predicted_price"].iloc[0] == 1.123457
    assert long["id"].nunique() == 4
    path = tempfile.mkdtemp(prefix="tf-capture-")
    bars = spark.createDataFrame([("s", "2024-01-01 00:00:00", 1.0)], "symbol string, datetime string, close double")
    TB.append_capture(bars, path, 7)
    TB.append_capture(bars, path, 7)          # replayed batch
    TB.append_capture(bars, path, 8)
    assert spark.read.parquet(path).count() == 2


def test_single_symbol_messages(spark, six_bars):
    msgs = six_bars.select(F.lit("k").alias("key"), F.to_json(F.struct(
        F.col("datetime").alias("date"), "open", "high", "low", "close", "volume")).alias("value"))
    out = ST.decode_single_symbol(msgs, "000001").toPandas()
    assert len(out) == 6 and set(out["symbol"]) == {"000001"}
    assert out.columns.tolist() == ["symbol", "datetime", "open", "high", "low", "close", "volume"]
