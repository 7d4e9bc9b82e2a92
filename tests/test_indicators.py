"""Golden cases and parity with pandas, over many small blocks."""

import numpy as np
import pandas as pd
import pytest

from barloom.functions import indicators as I
from barloom.operators import features
from barloom.operators import series as S

from .conftest import column


def approx(values):
    return [None if v is None else pytest.approx(v, abs=1e-4) for v in values]


def test_sma(series):
    out = S.measure(series(A=[10, 11, 9, 12]), I.sma("close", 3, "sma"))
    assert column(out, "sma") == approx([None, None, 10, 10.6667])


def test_sma_is_missing_while_a_value_is(series):
    out = S.measure(series(A=[1, None, 3, 4, 5]), I.sma("close", 2, "sma"))
    assert column(out, "sma") == [None, None, None, 3.5, 4.5]


def test_ema(series):
    out = S.measure(series(A=[10, 11, 9, 12]), I.ema("close", 3, "ema"))
    assert column(out, "ema") == approx([10, 10.5, 9.75, 10.875])


def test_ema_over_a_gap(series):
    out = features.ema_over_gaps(series(A=[None, 1, None, 2, 3]), "close", 3, "ema")
    assert column(out, "ema") == approx([None, 1, 1, 1.6667, 2.3333])


@pytest.mark.parametrize("share", [0.5, 0.01, 0.0005])
def test_ema_over_many_gaps_agrees_with_pandas(spark, share):
    rng = np.random.default_rng(5)
    n = 12000
    close = pd.Series(100 + np.cumsum(rng.normal(size=n))).where(rng.random(n) < share)
    dates = pd.date_range("1970-01-01", periods=n).date
    frame = pd.DataFrame({"symbol": "A", "date": dates, "close": close}).astype(object)
    df = spark.createDataFrame(
        frame.where(frame.notna(), None), "symbol string, date date, close double")
    for span in (3, 26):
        out = features.ema_over_gaps(df, "close", span, "ema").toPandas().sort_values("date")
        expected = close.ewm(span=span, adjust=False).mean()
        np.testing.assert_allclose(
            out["ema"].to_numpy(float), expected.to_numpy(float), rtol=1e-9, atol=1e-9)


def test_percent_change(series):
    out = S.measure(
        series(A=[10, 11, 9, 12], B=[0, 5, 0, 0]), I.pct_change("close", "change")
    )
    assert column(out, "change", "A") == approx([None, 10, -18.1818, 33.3333])
    assert column(out, "change", "B") == [None, float("inf"), -100.0, None]


def test_percent_change_over_a_gap(series):
    out = features.change(series(A=[1, None, 2]), "close", "change")
    assert column(out, "change") == [None, 0.0, 100.0]
    assert column(out, "close") == [1.0, None, 2.0]


def test_second_difference(series):
    out = S.measure(series(A=[10, 11, 9, 12]), I.diff("close", "d2", 2))
    assert column(out, "d2") == [None, None, -3.0, 5.0]


def test_rsi(series):
    rows = series(
        swing=[10, 11] * 8, up=range(29), down=range(16, 0, -1), flat=[5] * 30
    )
    out = S.measure(rows, I.rsi("close", "rsi"))
    swing = column(out, "rsi", "swing")
    assert swing[:13] == [None] * 13
    assert swing[13:] == approx([53.8462, 50, 50])
    assert column(out, "rsi", "up")[13:] == [100.0] * 16
    assert column(out, "rsi", "down")[13:] == [0.0] * 3
    assert column(out, "rsi", "flat") == [None] * 30


def test_back_fill_keeps_infinity_and_trailing_gaps(series):
    out = features.bfill(series(A=[None, None, 3, None, float("inf"), None]), ["close"])
    inf = float("inf")
    assert column(out, "close") == [3.0, 3.0, 3.0, inf, inf, None]


@pytest.fixture(scope="module")
def walks(spark):
    rng = np.random.default_rng(7)
    parts = []
    # The first symbol holds more than half of the rows; the last is shorter than any window.
    for symbol, n in (("^HOT", 6000), ("B", 2600), ("C", 700), ("D", 3)):
        dates = pd.bdate_range("1990-01-01", periods=n).date
        close = 100 + np.abs(np.cumsum(rng.normal(size=n)))
        parts.append(pd.DataFrame({"symbol": symbol, "date": dates, "close": close}))
    frame = pd.concat(parts)
    shuffled = frame.sample(frac=1, random_state=1)
    return frame, spark.createDataFrame(shuffled).repartition(5)


def by_symbol(frame, fn):
    return frame.groupby("symbol", group_keys=False)["close"].apply(fn)


def rsi(c):
    d = c.diff()
    gain = d.where(d > 0, 0).rolling(14).mean()
    loss = (-d.where(d < 0, 0)).rolling(14).mean()
    return 100 - 100 / (1 + gain / loss)


def ema(span):
    return lambda c: c.ewm(span=span, adjust=False).mean()


def macd(c):
    return ema(12)(c) - ema(26)(c)


PARITY = {
    "sma5": (I.sma("close", 5, "sma5"), lambda c: c.rolling(5).mean()),
    "sma60": (I.sma("close", 60, "sma60"), lambda c: c.rolling(60).mean()),
    "before7": (I.trailing_mean("close", 7, "before7"), lambda c: c.rolling(7).mean().shift()),
    "d1": (I.diff("close", "d1"), lambda c: c.diff()),
    "d2": (I.diff("close", "d2", 2), lambda c: c.diff().diff()),
    "p5": (I.pct_change("close", "p5", 5), lambda c: c.pct_change(periods=5) * 100),
    "rsi": (I.rsi("close", "rsi"), rsi),
    "ema3": (I.ema("close", 3, "ema3"), ema(3)),
    "ema200": (I.ema("close", 200, "ema200"), ema(200)),
    "lead2": (I.lead("close", 2, "lead2"), lambda c: c.shift(-2)),
}


def test_parity_with_pandas(walks):
    frame, df = walks
    out = S.measure(df, *[ind for ind, _ in PARITY.values()], I.macd("close")).toPandas()
    out = out.sort_values(["symbol", "date"]).reset_index(drop=True)
    frame = frame.sort_values(["symbol", "date"]).reset_index(drop=True)
    wanted = {name: by_symbol(frame, fn) for name, (_, fn) in PARITY.items()}
    wanted["macd"] = by_symbol(frame, macd)
    wanted["signal"] = by_symbol(frame, lambda c: ema_signal(c))
    wanted["histogram"] = wanted["macd"] - wanted["signal"]
    for name, expected in wanted.items():
        np.testing.assert_allclose(
            out[name].to_numpy(float), expected.to_numpy(float), rtol=1e-9, atol=1e-9, err_msg=name
        )


def ema_signal(c):
    return macd(c).ewm(span=9, adjust=False).mean()


@pytest.mark.parametrize("rows", [600, 1500])
def test_results_do_not_depend_on_the_block_size(walks, rows):
    _, df = walks
    items = [I.macd("close"), I.sma("close", 60, "sma"), I.rsi("close", "rsi")]
    base = S.measure(df, *items).toPandas().sort_values(["symbol", "date"])
    other = S.measure(df, *items, block_rows=rows).toPandas().sort_values(["symbol", "date"])
    for name in ("macd", "signal", "sma", "rsi"):
        np.testing.assert_allclose(base[name], other[name], rtol=0, atol=1e-9)


@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("levels", [1, 2])
def test_fill_reaches_over_many_blocks(walks, spark, forward, levels):
    frame, _ = walks
    gaps = frame.sort_values(["symbol", "date"]).reset_index(drop=True)
    keep = np.random.default_rng(3).random(len(gaps)) > 0.998
    gaps["close"] = gaps["close"].where(keep)
    df = spark.createDataFrame(
        gaps.astype(object).where(gaps.notna(), None), "symbol string, date date, close double"
    )
    out = S.fill(df, ["close"], forward, block_rows=16, levels=levels).toPandas()
    out = out.sort_values(["symbol", "date"])
    grouped = gaps.groupby("symbol")["close"]
    expected = grouped.ffill() if forward else grouped.bfill()
    np.testing.assert_array_equal(out["close"].to_numpy(float), expected.to_numpy(float))
