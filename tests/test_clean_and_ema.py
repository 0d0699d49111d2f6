import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tickforge.operators import clean as C
from tickforge.operators import indicators as IND
from tickforge.operators import sequence as SQ
from tickforge.operators.indicators import with_ema
from tickforge.operators.sequence import sequence_frame
from tickforge.plans import inputs as I
from conftest import SF001, SF01


def test_clean_six_bars(spark, six_bars):
    df = C.clean_bars(six_bars, unique=True).orderBy("datetime").toPandas()
    assert len(df) == 6
    assert str(df["datetime"].dtype).startswith("datetime64")
    assert df["timestamp"].iloc[0] == int(pd.Timestamp("2024-06-03 10:00:00", tz="UTC").timestamp())


def test_two_sources_of_one_column_are_refused(spark):
    df = spark.createDataFrame([("2024-01-01", "10:00")], "Date string, Time string")
    with pytest.raises(ValueError, match="several columns"):
        C.normalise_columns(df)


def test_drop_null_nan_and_dedup_keep_first(spark):
    rows = [("a", "2024-01-01 00:00:00", 1.0, 1.0, 1.0, 1.0, 1.0, 2),
            ("a", "2024-01-01 00:00:00", 2.0, 2.0, 2.0, 9.0, 1.0, 1),   # first by ingest
            ("a", "2024-01-01 01:00:00", 1.0, 1.0, 1.0, float("nan"), 1.0, 3),
            ("a", "2024-01-01 02:00:00", 1.0, None, 1.0, 1.0, 1.0, 4),
            ("b", "2024-01-01 00:00:00", 5.0, 5.0, 5.0, 5.0, 5.0, 5)]
    df = spark.createDataFrame(rows, "symbol string, datetime string, open double, high double, "
                                     "low double, close double, volume double, seq int")
    out = C.clean_bars(df, order="seq").orderBy("symbol").toPandas()
    assert out["symbol"].tolist() == ["a", "b"]
    assert out.loc[0, "close"] == 9.0


def test_coerce_numeric_counts(spark):
    df = spark.createDataFrame([("a", "1.5", "2"), ("b", "x", "3"), ("c", "4", None)],
                               "symbol string, open string, close string")
    obs = Observation("coerce")
    out = C.coerce_numeric(df, ["open", "close"], obs).toPandas()
    assert out["symbol"].tolist() == ["a"]
    assert obs.get == {"rows_in": 3, "rows_dropped": 2}


def test_normalise_and_require_columns(spark):
    df = spark.createDataFrame([("x", 1.0)], "Date string, Close double")
    out = C.normalise_columns(df)
    assert out.columns == ["datetime", "close"]
    try:
        C.require_columns(out, ["datetime", "close", "volume"])
    except ValueError as e:
        assert "volume" in str(e)
    else:
        raise AssertionError("missing column not reported")


def _pandas_ema(df):
    df = df.sort_values(["symbol", "datetime"]).copy()
    df["ref"] = df.groupby("symbol")["close"].transform(lambda s: s.ewm(span=5, adjust=False).mean())
    return df


def test_ema_matches_pandas_recursion_exactly(spark):
    out = _pandas_ema(with_ema(I.hourly_bars(spark, SF01)).toPandas())
    assert (out["EMA5"] == out["ref"]).all()


def test_ema_blocked_equals_unblocked(spark):
    bars = I.hourly_bars(spark, SF001)
    a = with_ema(bars).toPandas().sort_values(["symbol", "datetime"]).reset_index(drop=True)
    b = with_ema(bars, block_rows=128).toPandas().sort_values(["symbol", "datetime"]).reset_index(drop=True)
    assert len(a) == len(b)
    assert (a["EMA5"] == b["EMA5"]).all()


def test_ema_within_running_range(spark):
    out = with_ema(I.hourly_bars(spark, SF001)).toPandas().sort_values(["symbol", "datetime"])
    lo = out.groupby("symbol")["close"].cummin()
    hi = out.groupby("symbol")["close"].cummax()
    assert ((out["EMA5"] >= lo - 1e-9) & (out["EMA5"] <= hi + 1e-9)).all()


@pytest.mark.parametrize("group", [1024, 2])
def test_plan_blocks_halo_and_positions(spark, monkeypatch, group):
    monkeypatch.setattr(SQ, "GROUP_BUCKETS", group)
    sizes = [5, 1, 7, 2, 2, 9]
    cells = spark.createDataFrame([("s", i, 0, n) for i, n in enumerate(sizes)],
                                  "symbol string, _sq_bkt long, _sq_sub int, _sq_cnt long")
    plan = SQ.plan_blocks(cells, ["symbol"], block_rows=6, lookback=3).toPandas().sort_values("_sq_bkt")
    start = np.cumsum([0] + sizes[:-1])
    assert (plan["_sq_start"] == start).all() and (plan["_sq_n"] == 26).all()
    assert (plan["_sq_blk"] == start // 6).all()
    # a bucket goes to every later block that begins less than 3 rows after its end
    first = {blk: start[plan["_sq_blk"] == blk].min() for blk in set(plan["_sq_blk"])}
    for blk, s0, n, dst in zip(plan["_sq_blk"], start, sizes, plan["_sq_dst"]):
        assert list(dst) == [blk] + [b for b in sorted(first) if b > blk and first[b] - 3 < s0 + n]


def _dense_minute(spark, ties):
    """900 rows of one key in one minute, half of them at one moment, and few others."""
    at = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 50) if ties else F.col("id") % 60
    hot = spark.range(900).select(F.lit("hot").alias("symbol"), "id", F.timestamp_seconds(
        F.lit(1_700_000_040) + at).alias("ts"))
    low = spark.range(70).select(F.when(F.col("id") < 40, "hot").otherwise("low").alias("symbol"),
                                 (F.col("id") + 5000).alias("id"),
                                 F.timestamp_seconds(F.lit(1_699_990_000) + F.col("id") * 700).alias("ts"))
    return hot.unionByName(low)


@pytest.mark.parametrize("ties", [True, False])
def test_a_dense_bucket_spreads_over_blocks(spark, ties):
    sf = sequence_frame(_dense_minute(spark, ties), "symbol", ["ts", "id"], lookback=3, block_rows=40,
                        bucket_seconds=60)
    assert sf.split
    rows = sf.df.withColumn("p", sf.position()).withColumn(
        "back", F.collect_list("id").over(sf.rows(-3, 0)))
    assert rows.groupBy("symbol", "_sq_blk").count().agg(F.max("count")).first()[0] < 200
    got = sf.finish(rows).toPandas().sort_values(["symbol", "ts", "id"]).reset_index(drop=True)
    assert len(got) == 970
    for _, one in got.groupby("symbol"):
        ids = one["id"].tolist()
        assert one["p"].tolist() == list(range(len(one)))
        assert [list(v) for v in one["back"]] == [ids[max(0, i - 3):i + 1] for i in range(len(ids))]


def test_new_bar_flags_of_a_skewed_minute(spark):
    from tickforge.operators.features import flag_new_bars
    polls = _dense_minute(spark, True).withColumnRenamed("ts", "poll_ts").withColumn(
        "bar_datetime", F.floor(F.col("id") / 7))
    one, many = (flag_new_bars(polls, "symbol", ["poll_ts", "id"], block_rows=k).toPandas()
                 .sort_values("id")["is_new"].tolist() for k in (5000, 25))
    assert one == many and len(one) == 970


def _series(spark, values):
    return spark.createDataFrame([(s, i, float(v)) for s, vs in values.items() for i, v in enumerate(vs)],
                                 "symbol string, i long, close double").withColumn(
        "datetime", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("i") * 3600)).drop("i")


def _series_cases():
    rng = np.random.default_rng(4)
    gaps = np.where(rng.random(900) < 0.4, np.nan, rng.normal(size=900) * 10.0 ** rng.integers(-9, 30, 900))
    gaps[300:700] = np.nan
    late = np.r_[np.full(400, np.nan), rng.normal(size=300)]
    return {"fall": np.r_[np.full(200, 1e30), np.ones(700)], "gaps": gaps, "late": late, "short": [3.0, 4.0],
            "walk": 100 + np.cumsum(rng.normal(size=1500))}


@pytest.mark.parametrize("chunk", [256, 2])
def test_blocked_ema_equals_the_recursion_after_extreme_falls(spark, monkeypatch, chunk):
    monkeypatch.setattr(IND, "CHUNK_BLOCKS", chunk)
    cases = _series_cases()
    got = with_ema(_series(spark, cases), block_rows=130).toPandas().sort_values(["symbol", "datetime"])
    for symbol, values in cases.items():
        want = pd.Series(values).ewm(span=5, adjust=False).mean().to_numpy()
        have = got.loc[got["symbol"] == symbol, "EMA5"].to_numpy(float)
        assert np.array_equal(np.isnan(have), np.isnan(want)), symbol
        assert np.allclose(have, want, rtol=1e-12, atol=0, equal_nan=True), symbol


def test_sequence_positions_exact(spark):
    bars = I.hourly_bars(spark, SF001)
    sf = sequence_frame(bars, "symbol", "datetime", lookback=2, block_rows=17)
    got = sf.finish(sf.df.withColumn("p", sf.position())).toPandas()
    got = got.sort_values(["symbol", "datetime"])
    expect = got.groupby("symbol").cumcount()
    assert (got["p"].to_numpy() == expect.to_numpy()).all()


def test_tail_and_latest(spark):
    bars = I.hourly_bars(spark, SF001)
    tail = C.tail_n(bars, 4).toPandas()
    assert tail.groupby("symbol").size().max() == 4
    latest = C.latest_per_key(bars).toPandas()
    pdf = bars.toPandas()
    assert (latest.set_index("symbol")["datetime"]
            == pdf.groupby("symbol")["datetime"].max()).all()


def test_new_bar_flags_blocked_equal_unblocked(spark):
    from tickforge.operators.features import flag_new_bars
    from tickforge.sources.bars import table
    ev = table(spark, SF001, "events")
    polls = ev.select(F.col("event_type").alias("symbol"), F.col("ts").alias("poll_ts"),
                      "event_id", F.date_trunc("hour", "ts").alias("bar_datetime"))
    a = flag_new_bars(polls, "symbol", ["poll_ts", "event_id"]).toPandas()
    b = flag_new_bars(polls, "symbol", ["poll_ts", "event_id"], block_rows=7).toPandas()
    m = a.merge(b, on=["symbol", "event_id"], suffixes=("", "_b"))
    assert len(m) == len(a) == len(b) == 1000
    assert (m["is_new"] == m["is_new_b"]).all()
    assert a.groupby("symbol")["is_new"].sum().sum() == polls.select("symbol", "bar_datetime").distinct().count()
