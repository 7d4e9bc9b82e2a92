"""The chains end to end on small data."""

import datetime as dt
import json
import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barloom import session
from barloom.operators import features, forecast, scale
from barloom.plans import daily
from barloom.schemas import BARS, RESULT
from barloom.sources import models, writers


@pytest.fixture(scope="module")
def bars(spark):
    rng = np.random.default_rng(11)
    parts = []
    for symbol, n in (("^A", 700), ("B", 520)):
        close = 100 + np.cumsum(rng.normal(size=n))
        parts.append(pd.DataFrame({
            "symbol": symbol, "date": pd.date_range("2020-01-01", periods=n).date,
            "open": close - 0.2, "high": close + 1, "low": close - 1, "close": close,
            "volume": rng.integers(10, 99, n).astype(float),
        }))
    return spark.createDataFrame(pd.concat(parts), BARS)


def land(folder, symbol, month, records):
    path = os.path.join(folder, symbol, "monthly")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"{month}.json"), "w") as f:
        f.write(json.dumps(records))


def record(day, close):
    return {"Date": f"{day}T00:00:00.000", "Open": 1, "High": 2, "Low": 1, "Close": close,
            "Volume": 5}


def test_ingest_takes_only_what_is_new(spark, tmp_path):
    landing, store = str(tmp_path / "in"), str(tmp_path / "store")
    land(landing, "^IXIC", "2024-01", [record("2024-01-30", 1), record("2024-01-31", 2)])
    assert daily.ingest(spark, landing, store, str(tmp_path / "bad")).count() == 2
    land(landing, "^IXIC", "2024-01", [record("2024-01-31", 9)])
    land(landing, "^IXIC", "2024-02", [record("2024-02-01", 3), {"Date": "2024-02-02"}])
    assert daily.ingest(spark, landing, store, str(tmp_path / "bad")).count() == 1
    assert daily.ingest(spark, landing, store).isEmpty()
    stored = writers.read_months(spark, store).orderBy("date").collect()
    assert [(r["symbol"], r["close"]) for r in stored] == [
        ("^IXIC", 1.0), ("^IXIC", 2.0), ("^IXIC", 3.0)
    ]
    assert spark.read.json(str(tmp_path / "bad")).count() == 1
    daily.merge_store(spark, store, str(tmp_path / "combined"))
    assert spark.read.json(str(tmp_path / "combined")).count() == 3


def test_empty_input_is_refused(spark):
    with pytest.raises(ValueError):
        daily.train(spark.createDataFrame([], BARS), trees=2, depth=2)


def test_train_publish_and_predict(spark, bars, tmp_path):
    trained = daily.train(bars, trees=5, depth=5)
    scores = {r["symbol"]: r for r in trained.metrics.collect()}
    assert scores["^A"]["n"] == 140 and scores["B"]["n"] == 104
    assert all(0 < r["mape"] < 10 for r in scores.values())
    assert sum(trained.importance.values()) == pytest.approx(1.0)
    root = str(tmp_path / "models")
    daily.publish(trained, root, "^A", "rf", "2021-12-01 00:00:00")
    document = {r["symbol"]: r for r in spark.read.schema(RESULT).json(f"{root}/latest_results").collect()}
    assert document["B"]["prediction_date"] == "2021-06-04"
    assert set(document["B"]["feature_importance"]) == set(features.FEATURE_SETS["rf"])
    model, params = models.load(spark, root, "^A", "rf")
    out = daily.predict(bars, model, params, "2021-12-01", "2021-12-01 09:00:00").collect()
    assert [r["ticker"] for r in out] == ["^A"]
    assert 0 < len(out[0]["historical_data"]) <= 90
    assert out[0]["is_intraday"] is False


def test_study_ranks_reports_and_fits_on_all_rows(spark, bars, tmp_path):
    study = daily.study(bars, ("base",), runs=2)
    assert {(r["symbol"], r["runs"], r["place"], r["failed"]) for r in study.ranking.collect()} == {
        ("^A", 2, 1, 0), ("B", 2, 1, 0)
    }
    rows = study.report.groupBy("symbol").agg(F.count("*").alias("n"), F.max(F.abs("error_pct")).alias("e"))
    assert all(r["n"] == 30 and r["e"] < 60 for r in rows.collect())
    # Scalers of the final model span whole series, which tails do not.
    complete = features.indicators(bars)
    spans = complete.groupBy("symbol").agg((F.max("close") - F.min("close")).alias("span"))
    for r in spans.join(study.params, "symbol").collect():
        assert r["span"] == pytest.approx(r["close_scale"])
    cols, root = features.FEATURE_SETS[study.best], str(tmp_path)
    models.save(study.model, study.params, root, "^ALL", study.best, cols, "2021-12-01 00:00:00")
    model, params = models.load(spark, root, "^ALL", study.best)
    assert model.coefficients == study.model.coefficients and params.count() == 2


@pytest.mark.parametrize("name", features.FEATURE_SETS)
def test_train_takes_every_named_set(name, bars):
    cols = features.FEATURE_SETS[name]
    rows = forecast.supervised(bars, cols)
    assert set(cols) <= set(rows.columns) and rows.count() > 900
    trained = daily.train(bars, name, trees=2, depth=3)
    assert trained.next_day.count() == 2 and set(trained.importance) == set(cols)


def test_train_refuses_unknown_columns(bars):
    with pytest.raises(ValueError, match="no_such"):
        forecast.supervised(bars, ["close", "no_such"])


def test_failed_runs_are_skipped_and_counted(bars, monkeypatch):
    rows = features.indicators(bars)
    real, calls = forecast.fit_sequence, []

    def sometimes(*args, **kwargs):
        calls.append(1)
        if len(calls) in (1, 4, 5):
            raise PySparkException("no")
        return real(*args, **kwargs)

    monkeypatch.setattr(forecast, "fit_sequence", sometimes)
    sets = {"close": ["close"], "volume": ["close", "volume"]}
    ranked = forecast.compare_feature_sets(rows, sets, runs=3, length=20, train=60).collect()
    assert {(r["feature_set"], r["runs"], r["failed"]) for r in ranked} == {("close", 2, 1), ("volume", 1, 2)}
    monkeypatch.setattr(forecast, "fit_sequence", lambda *a, **k: (_ for _ in ()).throw(PySparkException("no")))
    with pytest.raises(ValueError):
        forecast.compare_feature_sets(rows, {"close": ["close"]}, runs=1, length=20, train=60)


def test_draws_do_not_depend_on_the_partitioning(spark, bars):
    once, again = (forecast.bootstrap(df, 5) for df in (bars, bars.repartition(7, "close")))
    assert once.exceptAll(again).isEmpty()
    mean = once.agg(F.sum("_times")).first()[0] / bars.count()
    assert 0.9 < mean < 1.1 and not once.exceptAll(forecast.bootstrap(bars, 6)).isEmpty()


def test_landing_layouts_and_lost_symbols(spark, tmp_path):
    landing, store, bad = (str(tmp_path / n) for n in ("in", "store", "bad"))
    for folder in ("AAPL", "MSFT"):
        os.makedirs(f"{landing}/{folder}")
        with open(f"{landing}/{folder}/2024-01.json", "w") as f:
            f.write(json.dumps([record("2024-01-30", 1), record("2024-01-31", 2)]))
    land(landing, "^IXIC", "2024-01", [record("2024-01-31", 3)])
    os.makedirs(f"{landing}/odd")
    with open(f"{landing}/odd/notes.json", "w") as f:
        f.write(json.dumps([record("2024-01-31", 4)]))
    new = daily.ingest(spark, landing, store, bad)
    got = sorted((r["symbol"], r["close"]) for r in new.collect())
    assert got == [("AAPL", 1.0), ("AAPL", 2.0), ("MSFT", 1.0), ("MSFT", 2.0), ("^IXIC", 3.0)]
    for _ in range(2):
        daily.ingest(spark, landing, store, bad)
        assert [r["reason"] for r in spark.read.json(bad).collect()] == ["no symbol"]


def test_published_files_are_ingested_again(spark, bars, tmp_path):
    path = str(tmp_path / "published")
    writers.publish_months(bars, path)
    assert os.path.isfile(f"{path}/^A/monthly/2020-01.json")
    assert sorted(os.listdir(path)) == ["B", "^A"]
    daily.ingest(spark, path, str(tmp_path / "store"))
    back = writers.read_months(spark, str(tmp_path / "store")).drop("year_month")
    assert back.exceptAll(bars).isEmpty() and back.count() == bars.count()


def test_files_are_published_by_tasks(spark, bars, tmp_path, monkeypatch):
    path = str(tmp_path / "published")
    odd = bars.withColumn("symbol", F.concat("symbol", F.lit("/x y%25+é")))
    with monkeypatch.context() as m:
        m.setattr(writers.Files, "move", lambda *a: (_ for _ in ()).throw(AssertionError("moved by the driver")))
        writers.publish_months(odd, path)
        writers.publish_months(odd.withColumn("close", F.col("close") + 1), path)
    assert not any(n.startswith("_") for n in os.listdir(path))
    daily.ingest(spark, path, str(tmp_path / "store"))
    back = writers.read_months(spark, str(tmp_path / "store")).drop("year_month")
    assert back.exceptAll(odd.withColumn("close", F.col("close") + 1)).isEmpty() and back.count() == bars.count()


def test_interrupted_publishing_is_completed_or_dropped(spark, bars, tmp_path, monkeypatch):
    path = str(tmp_path / "published")
    with monkeypatch.context() as m:
        real = writers.finish_publishing
        calls = []
        m.setattr(writers, "finish_publishing", lambda s, p: calls.append(p) or (real(s, p) if len(calls) == 1 else None))
        writers.publish_months(bars.where("symbol = 'B'"), path, "")
    assert [n[:9] for n in os.listdir(path)] == ["_staging-"]
    os.makedirs(f"{path}/_staging-broken/symbol=Z/year_month=2020-01")
    writers.finish_publishing(spark, path)
    assert os.listdir(path) == ["B"] and os.path.isfile(f"{path}/B/2020-01.json")
    # The same from the driver, for file systems that tasks cannot open.
    with monkeypatch.context() as m:
        closed = type("Closed", (), {"from_uri": staticmethod(lambda p: (_ for _ in ()).throw(OSError(p)))})
        m.setattr(writers, "FileSystem", closed)
        writers.publish_months(bars.where("symbol = '^A'"), path)
    assert os.path.isfile(f"{path}/^A/monthly/2020-01.json")


def test_ingest_reads_marks_and_not_the_store(spark, tmp_path, monkeypatch):
    landing, store = str(tmp_path / "in"), str(tmp_path / "store")
    land(landing, "A", "2024-01", [record("2024-01-30", 1)])
    daily.ingest(spark, landing, store)
    asked, real = [], writers.read_months
    monkeypatch.setattr(writers, "read_months", lambda s, p, months=None: (asked.append(months), real(s, p, months))[1])
    land(landing, "A", "2024-02", [record("2024-02-01", 2)])
    assert daily.ingest(spark, landing, store).count() == 1
    assert asked == [["2024-02"]]
    assert [tuple(r) for r in writers.read_marks(spark, store).collect()] == [("A", dt.date(2024, 2, 1))]


def opened(monkeypatch):
    """The files that each read of records opens, as its plan lists them."""
    out, real = [], daily.readers.read_records

    def noted(*args, **kwargs):
        df = real(*args, **kwargs)
        out.append(sorted("/".join(f.split("/")[-3:]) for f in df.inputFiles()))
        return df

    monkeypatch.setattr(daily.readers, "read_records", noted)
    return out


def test_ingest_opens_new_and_rewritten_files_only(spark, tmp_path, monkeypatch):
    landing, store, bad = (str(tmp_path / n) for n in ("in", "store", "bad"))
    asked = opened(monkeypatch)
    for month in ("2024-01", "2024-02"):
        land(landing, "^A", month, [record(f"{month}-03", 1), {"Date": f"{month}-04"}])
        land(landing, "B", month, [record(f"{month}-03", 1)])
    assert daily.ingest(spark, landing, store, bad).count() == 4
    assert len(asked.pop()) == 4
    # An unchanged tree: no file is opened, and what was there is not read, whatever it holds.
    for _ in range(2):
        assert daily.ingest(spark, landing, store, bad).isEmpty() and asked == []
    time.sleep(0.05)
    land(landing, "B", "2024-02", [record("2024-02-03", 7), record("2024-02-05", 2), {"Date": "x"}])
    assert [(r.symbol, r.date.day, r.close) for r in daily.ingest(spark, landing, store, bad).collect()] == [("B", 5, 2.0)]
    assert asked == [["B/monthly/2024-02.json"]]
    assert spark.read.json(bad).count() == 3
    assert writers.read_ledger(spark, store).select("batch").distinct().count() == 2


def test_old_times_of_new_files_are_found(spark, tmp_path, monkeypatch):
    landing, store, bad = (str(tmp_path / n) for n in ("in", "store", "bad"))
    asked = opened(monkeypatch)
    for day, month in enumerate(("2024-01", "2024-02", "2024-03")):
        land(landing, "A", month, [record(f"{month}-03", 1), {"Date": month}])
        os.utime(f"{landing}/A/monthly/{month}.json", (1_700_000_000 + day, 1_700_000_000 + day))
    assert daily.ingest(spark, landing, store, bad).count() == 3
    # One between times already taken: the read is bounded to its time.
    land(landing, "Z", "2024-02", [record("2024-02-03", 5), {"Date": "x"}])
    os.utime(f"{landing}/Z/monthly/2024-02.json", (1_700_000_001, 1_700_000_001))
    assert [r.symbol for r in daily.ingest(spark, landing, store, bad).collect()] == ["Z"]
    assert asked[1] == ["A/monthly/2024-02.json", "Z/monthly/2024-02.json"]
    assert spark.read.json(bad).count() == 4


def test_an_interrupted_ingest_is_taken_again(spark, tmp_path, monkeypatch):
    landing, store, bad = (str(tmp_path / n) for n in ("in", "store", "bad"))
    land(landing, "A", "2024-01", [record("2024-01-03", 1), {"Date": "2024-01-04"}])
    with monkeypatch.context() as m:
        m.setattr(writers, "upsert_months", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            daily.ingest(spark, landing, store, bad)
    assert spark.read.json(bad).count() == 1 and writers.read_ledger(spark, store).isEmpty()
    assert daily.ingest(spark, landing, store, bad).count() == 1
    assert spark.read.json(bad).count() == 1 and writers.read_ledger(spark, store).count() == 1
    assert not any(n.startswith(writers.PENDING) for n in os.listdir(store))
    # Staged and marked ready, but not moved: the ledger comes with the months.
    land(landing, "A", "2024-02", [record("2024-02-03", 1), {"Date": "2024-02-04"}])
    with monkeypatch.context() as m:
        m.setattr(writers, "recover_months", lambda s, p: None)
        daily.ingest(spark, landing, store, bad)
    assert daily.ingest(spark, landing, store, bad).isEmpty()
    assert writers.read_months(spark, store).count() == 2 and spark.read.json(bad).count() == 2


def test_an_interrupted_upsert_is_completed(spark, bars, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    writers.upsert_months(bars.where("symbol = 'B'"), store)
    # The driver is lost after the new months are staged, before any is moved.
    with monkeypatch.context() as m:
        m.setattr(writers, "recover_months", lambda s, p: None)
        writers.upsert_months(bars.where("symbol = '^A'"), store)
    assert any(n.startswith("_staging-") for n in os.listdir(store))
    assert writers.read_months(spark, store).count() == bars.count()
    # One that was never marked ready leaves the store as it was.
    os.makedirs(f"{store}/_staging-x/year_month=2020-01")
    assert writers.read_months(spark, store).count() == bars.count()
    assert not any(n.startswith("_staging-") for n in os.listdir(store))


def test_exchanges_follow_known_sizes_only(spark, bars, monkeypatch):
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    session.size_exchanges(bars)
    session.size_exchanges(bars.join(session.cut(bars), "symbol"))
    assert spark.conf.get(setting) == before
    monkeypatch.setattr(session, "PARTITION_BYTES", 100)
    session.size_exchanges(session.cut(bars))
    assert int(before) < int(spark.conf.get(setting)) < 10_000
    spark.conf.set(setting, before)


def test_released_tables_are_gone(spark, bars):
    before = session.written()
    path = session.cut(bars).inputFiles()[0]
    session.release(spark, before)
    assert session.written() == before and not os.path.exists(path.removeprefix("file://"))


def test_recursive_forecast_against_brute_force(spark, bars):
    cols = ["close", "volume"]
    rows = forecast.study_rows(bars, cols, test=8, train=60)
    params = forecast.fit_study_scalers(rows, cols)
    samples = forecast.sequence_samples(rows, params, cols, length=10)
    model = forecast.fit_sequence(samples)
    out = forecast.recursive(model, rows, params, cols, length=10, test=8).toPandas()
    scaled = scale.apply(rows, params, cols).toPandas()
    fitted = params.toPandas().set_index("symbol")
    weights, bias = model.coefficients.toArray(), model.intercept
    for symbol, part in scaled.sort_values("date").groupby("symbol"):
        values = part[cols].to_numpy()
        window, test = list(values[-18:-8]), values[-8:]
        guesses = []
        for row in test:
            guesses.append(float(np.dot(np.concatenate(window), weights) + bias))
            window = window[1:] + [np.array([guesses[-1], row[1]])]
        p = fitted.loc[symbol]
        expected = np.array(guesses) * p["close_scale"] + p["close_shift"]
        got = out[out["symbol"] == symbol].sort_values("date")["predicted"].to_numpy()
        np.testing.assert_allclose(got, expected, rtol=1e-9)


def test_walk_forward_windows_hold_the_rows_before_the_target(spark, bars):
    rows = forecast.study_rows(bars, ["close"], test=5, train=40)
    params = forecast.fit_study_scalers(rows, ["close"])
    samples = forecast.sequence_samples(rows, params, ["close"], length=10).toPandas()
    scaled = scale.apply(rows, params, ["close"]).toPandas().sort_values(["symbol", "date"])
    assert (samples["part"] == "test").sum() == 10
    for symbol, part in scaled.groupby("symbol"):
        closes, dates = part["close"].to_list(), part["date"].to_list()
        for _, s in samples[samples["symbol"] == symbol].iterrows():
            i = dates.index(s["date"])
            assert [v[0] for v in s["x"]] == pytest.approx(closes[i - 10:i])
            assert s["y"] == pytest.approx(closes[i])
