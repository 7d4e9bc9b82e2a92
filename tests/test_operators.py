"""Merge, cleaning, splits, scalers, metrics, alerts, reports."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from barloom.functions import columns as C
from barloom.operators import (
    alerts, clean, features, forecast, merge, metrics, reporting, scale, split,
)
from barloom.session import cut
from barloom.sources import readers

from .conftest import column

BAR = "symbol string, date date, open double, high double, low double, close double, volume double"


def bar(symbol, day, close, volume=1.0):
    return (symbol, dt.date.fromisoformat(day), 1.0, 2.0, 0.5, float(close), float(volume))


@pytest.fixture
def frame(spark):
    return lambda *rows, extra="": spark.createDataFrame(list(rows), BAR + extra)


def test_first_source_wins_whatever_the_input_order(frame):
    rows = [(*bar("A", "2024-01-02", c), f) for c, f in ((3, "b"), (1, "a"), (2, "c"))]
    for order in (rows, rows[::-1]):
        out = merge.combine(frame(*order, extra=", file string"), ["file"]).collect()
        assert [r["close"] for r in out] == [1.0]


def test_many_copies_of_one_date(spark):
    copies = spark.range(20000).select(
        F.lit("A").alias("symbol"), F.lit(dt.date(2024, 1, 2)).alias("date"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low")],
        F.col("id").cast("double").alias("close"), F.lit(1.0).alias("volume"), "id",
    )
    out = merge.combine(copies.repartition(6), ["id"])
    assert [r["close"] for r in out.collect()] == [0.0]
    # Copies are reduced before the exchange.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_upsert_keeps_the_stored_row_and_is_idempotent(frame):
    old = frame(bar("A", "2024-01-02", 1), bar("A", "2024-01-03", 2))
    new = frame(bar("A", "2024-01-03", 9), bar("A", "2024-01-04", 3))
    once = merge.upsert(old, new)
    assert column(once, "close") == [1.0, 2.0, 3.0]
    assert column(merge.upsert(once, new), "close") == [1.0, 2.0, 3.0]


def test_new_rows_start_after_the_high_water_date(frame):
    stored = frame(bar("A", "2024-01-03", 1), bar("A", "2024-01-02", 1))
    incoming = frame(
        bar("A", "2024-01-03", 2), bar("A", "2024-01-04", 2), bar("B", "2020-01-01", 2)
    )
    out = merge.new_rows(incoming, stored).orderBy("symbol").collect()
    assert [(r["symbol"], str(r["date"])) for r in out] == [
        ("A", "2024-01-04"), ("B", "2020-01-01")
    ]


def test_pair_lines(spark):
    lines = spark.createDataFrame(
        [('2024-01-02\t{"Open":1,"High":2,"Low":0.5,"Close":1.5,"Volume":10}',), ("no tab",)],
        "value string",
    )
    good, rejects = clean.bars(clean.pair_lines(lines))
    assert [r["close"] for r in good.collect()] == [1.5]
    assert rejects.count() == 1


def test_normalise(spark):
    raw = spark.createDataFrame(
        [("2024-01-02", 1.0, 2.0, 0.0, 0.0)],
        "`index` string, `Open.X` double, `Close.X` double, `Dividends` double, "
        "`Stock Splits` double",
    )
    assert readers.normalise(raw).columns == ["date", "open", "close"]


def test_lookback_is_half_open(frame):
    rows = frame(*[bar("A", d, 1) for d in ("2023-10-03", "2023-10-02", "2024-01-01", "2023-12-31")])
    out = readers.lookback(rows, "2024-01-01", 90)
    assert [str(d) for d in column(out, "date")] == ["2023-10-03", "2023-12-31"]


@pytest.mark.parametrize("test,train", [(30, 420), (30, 1500)])
def test_tail_split_sizes(series, test, train):
    parts = {
        r["part"]: r["count"]
        for r in split.tail(series(A=range(2499)), test, train).groupBy("part").count().collect()
    }
    assert parts == {"test": test, "train": train}
    short = split.tail(series(A=range(40)), 30, 420).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in short} == {"test": 30, "train": 10}


def test_random_split_is_exact_and_repeatable(series):
    rows = series(A=range(2498), B=range(10), C=range(1))
    out = split.random(rows).where("part = 'test'")
    sizes = {r["symbol"]: r["count"] for r in out.groupBy("symbol").count().collect()}
    assert sizes == {"A": 500, "B": 2, "C": 1}
    again = split.random(rows.repartition(7)).where("part = 'test'")
    assert out.exceptAll(again).isEmpty()
    for share, sizes in ((0.0, set()), (1.0, {2498, 10, 1})):
        out = split.random(rows, share).where("part = 'test'")
        assert {r["count"] for r in out.groupBy("symbol").count().collect()} == sizes


def test_random_split_moves_no_row_but_the_border_chunk(series, monkeypatch):
    written = []
    monkeypatch.setattr(split, "cut", lambda df, name: written.append(cut(df, name)) or written[-1])
    rows = cut(series(A=range(3000), B=range(500)))
    plan = split.random(rows)._jdf.queryExecution().sparkPlan().toString()
    # No join sorts or deals the rows, and what is ranked are the rows of one chunk per symbol.
    assert plan.count("BroadcastHashJoin") == plan.count("BuildRight") == plan.count("Join") and "Window" in plan
    assert written[0].count() == 2
    twice = rows.unionAll(rows)
    sizes = {r["symbol"]: r["count"] for r in split.random(twice).where("part = 'test'").groupBy("symbol").count().collect()}
    assert sizes == {"A": 1200, "B": 200}


def test_targets_and_sequences(series):
    rows = series(A=range(10), B=range(3))
    pairs = features.target(rows)
    assert column(pairs, "target", "A") == [float(v) for v in range(1, 10)]
    out = features.sequences(rows, ["close"], length=4).orderBy("date").collect()
    assert len(out) == 6
    assert out[0]["x"] == [[0.0], [1.0], [2.0], [3.0]] and out[0]["y"] == 4.0
    assert features.sequences(rows, ["close"], length=10).isEmpty()
    window = features.last_window(rows, ["close"], length=4, skip=2).collect()
    assert [(r["symbol"], r["x"]) for r in window] == [("A", [[4.0], [5.0], [6.0], [7.0]])]


def test_scalers(series):
    rows = series(A=[1, 2, 4], B=[7, 7, 7])
    params = scale.fit_standard(rows, ["close"])
    std = {r["symbol"]: r["close_scale"] for r in params.collect()}
    assert std == {"A": pytest.approx(1.2472, abs=1e-4), "B": 1.0}
    scaled = scale.apply(rows, params, ["close"])
    assert column(scaled, "close", "B") == [0.0, 0.0, 0.0]
    assert column(scale.invert(scaled, params, "close"), "close") == [
        pytest.approx(v) for v in (1, 2, 4, 7, 7, 7)
    ]
    low = scale.apply(rows, scale.fit_minmax(rows, ["close"]), ["close"])
    assert column(low, "close") == [pytest.approx(v) for v in (0, 1 / 3, 1, 0, 0, 0)]


def test_metrics(spark):
    rows = spark.createDataFrame(
        [("A", 100.0, 110.0), ("A", 200.0, 190.0), ("A", 50.0, 50.0), ("Z", 0.0, 1.0)],
        "symbol string, actual double, predicted double",
    )
    out = {r["symbol"]: r for r in metrics.evaluate(rows).collect()}
    a = out["A"]
    assert (a["rmse"], a["mae"], a["mape"]) == (
        pytest.approx(8.1650, abs=1e-4), pytest.approx(6.6667, abs=1e-4), pytest.approx(5.0)
    )
    assert out["Z"]["mape"] is None and out["Z"]["zero_actuals"] == 1


def test_rank_orders_by_mean_error(spark):
    rows = [("A", name, run, 100.0, 100.0 + miss)
            for name, misses in (("good", (1, 3)), ("bad", (2, 4))) for run, miss in enumerate(misses)]
    df = spark.createDataFrame(
        rows, "symbol string, feature_set string, run int, actual double, predicted double")
    out = metrics.rank(df).orderBy("place").collect()
    assert [(r["feature_set"], r["mape"], r["runs"]) for r in out] == [
        ("good", pytest.approx(2.0), 2), ("bad", pytest.approx(3.0), 2)
    ]


def test_dates_names_and_labels(spark):
    row = spark.createDataFrame(
        [("^IX/C base tech", dt.date(2024, 1, 5), 1.0, "x", "2024-01-02T00:00:00.000")],
        "name string, day date, price double, text string, stamp string",
    ).select(
        C.safe_name("name").alias("safe"),
        C.next_date("day").alias("next"),
        C.next_date("day", "business").alias("monday"),
        C.direction(F.lit(1.0), "price").alias("direction"),
        C.to_number("text").alias("number"),
        C.to_day("stamp").alias("parsed"),
        C.to_day("text").alias("unparsed"),
        C.rsi_level(F.lit(71.0)).alias("level"),
        C.or_unknown(F.lit(None).cast("string")).alias("unknown"),
    ).first()
    assert row["safe"] == "IX_C_base_tech" == C.safe_text("^IX/C base tech")
    assert (row["next"], row["monday"]) == (dt.date(2024, 1, 6), dt.date(2024, 1, 8))
    assert row["direction"] == "down" and row["number"] is None
    assert row["parsed"] == dt.date(2024, 1, 2) and row["unparsed"] is None
    assert row["level"] == "overbought" and row["unknown"] == "Unknown"


@pytest.fixture
def prices(spark):
    ticks = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 2, 10), 100.0, 1), ("A", dt.datetime(2024, 1, 2, 11), 100.5, 2),
         ("A", dt.datetime(2024, 1, 3, 10), 50.0, 3), ("B", dt.datetime(2024, 1, 2, 10), 0.0, 4)],
        "symbol string, ts timestamp, price double, event_id long")
    preds = spark.createDataFrame(
        [("A", dt.date(2024, 1, 2), 101.0), ("B", dt.date(2024, 1, 2), 5.0)],
        "symbol string, prediction_date date, predicted double")
    return ticks, preds


def test_alert_at_exactly_the_threshold(prices):
    out = alerts.messages(*prices, "2024-01-02 12:00:00").collect()
    assert [(r["ticker"], r["current_price"], r["direction"]) for r in out] == [("A", 100.0, "up")]
    assert out[0]["price_diff_percent"] == 1.0
    assert out[0]["last_update"] == "2024-01-02 10:00:00"


def test_salting_changes_no_alert(prices):
    plain = alerts.messages(*prices, "2024-01-02 12:00:00", threshold=0.1)
    salted = alerts.messages(*prices, "2024-01-02 12:00:00", threshold=0.1, salts=5)
    assert plain.count() == 2
    assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()


def test_one_frame_alone_never_raises_an_alert(frame):
    rows = frame(bar("A", "2024-01-02", 1), bar("B", "2024-01-05", 1))
    assert not any(r["is_intraday"] for r in alerts.single_frame_intraday(rows).collect())


def test_change_info_of_no_change(spark):
    df = spark.createDataFrame([("A", 5.0, 5.0)], "symbol string, current_close double, "
                                                   "predicted_close double")
    row = reporting.change_info(df).first()
    assert row["is_positive"] is False and row["percent_change"] == 0.0


def test_recursive_baseline_feeds_itself(series):
    out = forecast.recursive_baseline(series(A=[1, 2, 3, 9, 9, 9]), n=2, test=3)
    assert column(out, "predicted") == [2.5, 2.75, 2.625]
    assert column(out, "actual") == [9.0, 9.0, 9.0]
    assert math.isclose(sum(column(out, "predicted")), 7.875)
