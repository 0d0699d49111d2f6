import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickforge.session import get_spark
    s = get_spark("local[4]", app="tickforge-tests", shuffle_partitions=4)
    yield s


@pytest.fixture()
def six_bars(spark):
    """Six bars of one symbol, fifteen minutes apart (datetime as text)."""
    from tickforge.schemas import RAW_BAR_CSV
    rows = [(f"2024-06-03 1{i // 4}:{15 * (i % 4):02d}:00", "IDX:000042", 50.0 + i, 51.5 + i, 49.0 + i,
             50.5 + i * i, 10.0 * (i + 1)) for i in range(6)]
    return spark.createDataFrame(rows, RAW_BAR_CSV)
