"""Offline training and scoring of the four per-symbol models (Q1, M7, M9).

One DAG for all symbols: bars -> features (EMA5, positions) -> per-symbol
scaler on the first 80 % of rows -> scaled sliding windows -> chronological
80/20 split of windows -> linear / tree / kNN / recurrent network -> hold-out scoring
and metrics -> model tables.  Symbols without data simply have no groups.
The feature and window tables are checkpointed once; every model reads them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.models import recurrent as HB
from tickforge.models import knn as KNN
from tickforge.models import linear as LIN
from tickforge.models import tree as TR
from tickforge.operators import features as FT
from tickforge.operators import metrics as MT
from tickforge.schemas import DEFAULT_SEQ_LEN, FEATURES_G2, TARGET_COL
from tickforge.session import materialize


@dataclass
class ModelConfig:
    seq_len: int = DEFAULT_SEQ_LEN
    features: tuple[str, ...] = tuple(FEATURES_G2)
    hidden: int = 64
    epochs: int = 50
    batch_size: int = 16
    lr: float = 1e-4
    knn_k: int = 5
    tree_depth: int = 10
    seed: int = 0

    @property
    def input_size(self) -> int:
        return len(self.features)

    @property
    def flat_size(self) -> int:
        return self.seq_len * self.input_size


@dataclass
class Models:
    config: ModelConfig
    scaler: DataFrame
    linear: DataFrame
    tree: DataFrame
    knn_train: DataFrame
    recurrent: DataFrame
    knn_index: KNN.Index | None = None

    def __post_init__(self):
        if self.knn_index is None:
            self.knn_index = KNN.build_index(self.knn_train, self.config.flat_size)


def prepare_windows(bars: DataFrame, cfg: ModelConfig) -> tuple[DataFrame, DataFrame]:
    """(scaler, windows) — windows carry ``train`` and the close bounds."""
    feat = materialize(FT.with_positions(bars))
    feats = list(cfg.features)
    scaler = materialize(FT.fit_minmax(feat, feats))
    scaled = FT.apply_minmax(feat, scaler, feats, keep_bounds=[TARGET_COL])
    w = FT.sliding_windows(scaled, [f"{f}_s" for f in feats], cfg.seq_len,
                           target=f"{TARGET_COL}_s")
    w = w.withColumn("train", FT.window_split("widx", "n", cfg.seq_len))
    keep = ["symbol", "datetime", "widx", "x", "y", "train", "close",
            f"{TARGET_COL}_min", f"{TARGET_COL}_max"]
    return scaler, materialize(w.select(*keep))


def train_all(windows: DataFrame, scaler: DataFrame, cfg: ModelConfig,
              concurrent: bool = False) -> Models:
    """Fit the four models.  The fits are independent Spark jobs; with
    ``concurrent`` they are submitted from parallel threads so small models
    do not leave the cluster idle while another model trains."""
    from concurrent.futures import ThreadPoolExecutor

    train = windows.where("train")
    d = cfg.flat_size
    knn_train = train.select("symbol", F.col("widx").alias("tid"), "x", "y")
    jobs = {
        "linear": lambda: materialize(LIN.fit(train, d)),
        "tree": lambda: materialize(TR.fit(train, d, max_depth=cfg.tree_depth)),
        "recurrent": lambda: HB.fit(train, cfg.seq_len, cfg.input_size, hidden=cfg.hidden,
                                 epochs=cfg.epochs, batch_size=cfg.batch_size, lr=cfg.lr,
                                 seed=cfg.seed),
        "knn_index": lambda: KNN.build_index(knn_train, d),
    }
    if concurrent:
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            futures = {k: pool.submit(f) for k, f in jobs.items()}
            out = {k: fut.result() for k, fut in futures.items()}
    else:
        out = {k: f() for k, f in jobs.items()}
    return Models(config=cfg, scaler=scaler, linear=out["linear"], tree=out["tree"],
                  knn_train=knn_train, recurrent=out["recurrent"], knn_index=out["knn_index"])


def score(windows: DataFrame, models: Models, inverse: bool = True) -> DataFrame:
    """Wide predictions of the four models on ``windows`` (M9).  With
    ``inverse`` the predictions and ``actual_price`` are in price units."""
    cfg = models.config
    w = LIN.predict(windows, models.linear)
    w = TR.predict(w, models.tree, max_depth=cfg.tree_depth)
    w = HB.predict(w, models.recurrent, cfg.seq_len, cfg.input_size, hidden=cfg.hidden)
    q = w.withColumn("qid", F.col("widx"))
    w = KNN.predict(models.knn_train, q, cfg.flat_size, k=cfg.knn_k,
                    index=models.knn_index).drop("qid")
    preds = ["pred_linear", "pred_dt", "pred_knn", "pred_recurrent"]
    lo, hi = F.col(f"{TARGET_COL}_min"), F.col(f"{TARGET_COL}_max")
    if inverse:
        w = w.withColumns({p: FT.minmax_inverse(F.col(p), lo, hi) for p in preds})
        actual = F.col("close")
    else:
        actual = F.col("y")
    return w.select("symbol", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
                    actual.alias("actual_price"), *preds)


def holdout_metrics(scored_scaled: DataFrame) -> DataFrame:
    """MSE / RMSE per symbol × model on scaled hold-out predictions (A2/M6)."""
    from tickforge.sinks.tables import to_long
    long = to_long(scored_scaled, decimals=15)
    return MT.error_metrics(long, ["symbol", "model_type"]).select(
        "symbol", "model_type", "n", "mse", "rmse")


def save_models(models: Models, root: str) -> None:
    """Model store (K6): one table per artefact, partitioned by symbol."""
    from tickforge.sinks.tables import write_models
    cfg = models.config
    config = models.scaler.select("symbol").withColumns({
        "seq_len": F.lit(cfg.seq_len), "input_size": F.lit(cfg.input_size),
        "hidden_size": F.lit(cfg.hidden),
        "features_cols": F.array(*[F.lit(f) for f in cfg.features]),
        "target_col": F.lit(TARGET_COL)})
    for name, df in (("scaler", models.scaler), ("linear", models.linear),
                     ("tree", models.tree), ("knn", models.knn_train),
                     ("recurrent", models.recurrent), ("config", config)):
        write_models(df, f"{root.rstrip('/')}/{name}")


def load_models(spark: SparkSession, root: str, cfg: ModelConfig | None = None,
                symbols: list[str] | None = None) -> Models:
    """Model lookup (S7): read the artefact tables, pruned to ``symbols``."""
    def rd(name):
        df = spark.read.parquet(f"{root.rstrip('/')}/{name}")
        return df.where(F.col("symbol").isin(symbols)) if symbols else df
    return Models(cfg or ModelConfig(), rd("scaler"), rd("linear"), rd("tree"), rd("knn"),
                  rd("recurrent"))
