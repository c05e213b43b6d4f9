import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickforge.session import local_session

    s = local_session("*", shuffle_partitions=8, app="tickforge-tests")
    yield s
    s.stop()


def tick_ramp(spark, n=200):
    """200 ticks: ids 1..n, price linear 3500 -> 3550, qty 0.5, maker alternating from True."""
    from tickforge.schema import TRADE_SCHEMA

    rows = []
    for i in range(n):
        price = 3500.0 + 50.0 * i / max(n - 1, 1)
        rows.append((i + 1, price, 0.5, price * 0.5, 1_718_265_600_000 + 100 * i, i % 2 == 0, True))
    return spark.createDataFrame(rows, TRADE_SCHEMA)
