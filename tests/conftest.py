import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kandela.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def candles(spark):
    """make(closes, symbol=, interval=, skip=) -> candle frame on the interval's grid."""
    from datetime import datetime, timedelta

    from kandela.schemas import CANDLE, INTERVAL_SECONDS

    def make(closes, symbol="AAAUSDT", interval="1h", skip=(), start=datetime(2024, 1, 1)):
        step, rows = timedelta(seconds=INTERVAL_SECONDS[interval]), []
        for i, close in enumerate(map(float, closes)):
            if i in skip:
                continue
            opened = start + i * step
            rows.append((symbol, interval, opened, close, close + 1.0, close - 1.0, close, float(i),
                         opened + step - timedelta(milliseconds=1)))
        return spark.createDataFrame(rows, CANDLE)

    return make
