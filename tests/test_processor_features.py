"""The stream processor takes its inputs by feature name."""

import numpy as np
import pandas as pd
import pytest

from tickforge.schemas import FEATURES_G1
from tickforge.streaming.processor import BarForecaster


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


def run(proc, closes):
    proc.bar, proc.buf, proc.net = Value(), Value(), Value()
    n = proc.n_features
    rows = pd.DataFrame({"datetime": pd.date_range("2024-01-01", periods=len(closes), freq="15min"),
                         "open": 1.0, "high": 2.0, "low": 3.0, "close": closes, "volume": 5.0})
    rows["smin"], rows["smax"] = [[0.0] * n] * len(rows), [[1.0] * n] * len(rows)
    return pd.concat(list(proc.handleInputRows(("s",), iter([rows]), None)))


def test_six_features_end_with_the_average():
    out = run(BarForecaster(seq_len=2, n_features=6, features=FEATURES_G1), [4.0, 7.0, 10.0])
    last = np.array(out["x"].iloc[-1]).reshape(2, 6)
    assert last[:, 3].tolist() == [4.0, 7.0]
    assert np.allclose(last[:, 5], [4.0, 5.0])


def test_window_with_the_current_bar_forecasts_the_next():
    out = run(BarForecaster(seq_len=2, n_features=6, features=FEATURES_G1, include_current=True), [4.0, 7.0, 10.0])
    assert np.array(out["x"].iloc[-1]).reshape(2, 6)[:, 3].tolist() == [7.0, 10.0]


def test_unknown_feature_is_refused():
    with pytest.raises(ValueError):
        BarForecaster(n_features=2, features=["open", "volume_x"])
