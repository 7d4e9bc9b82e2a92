import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barloom.session import build_session, release  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "8g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def testdata():
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables here")
    return TESTDATA


@pytest.fixture
def series(spark):
    """Build a frame of daily rows from lists of closes per symbol."""

    def build(**closes):
        start = dt.date(2024, 1, 1)
        rows = [
            (symbol, start + dt.timedelta(days=i), None if v is None else float(v))
            for symbol, values in closes.items()
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, "symbol string, date date, close double")

    return build


def column(df, name, symbol=None):
    rows = df.orderBy("symbol", "date").collect()
    return [r[name] for r in rows if symbol is None or r["symbol"] == symbol]
