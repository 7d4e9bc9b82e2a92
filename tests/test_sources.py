"""Files in and out, on small hand-made directories."""

import datetime as dt
import json
import os

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from barloom.operators import clean, merge
from barloom.sources import models, readers, writers

from .conftest import column

GOOD = {"Date": "2024-01-02T00:00:00.000", "Open": 1, "High": 2, "Low": 0.5, "Close": 1.5,
        "Volume": 10, "Dividends": 0}


def record(day, close=1.5):
    return {**GOOD, "Date": f"2024-01-{day:02d}T00:00:00.000", "Close": close}


@pytest.fixture
def landing(tmp_path):
    def write(symbol, month, *lines):
        folder = tmp_path / "landing" / symbol / "monthly"
        os.makedirs(folder, exist_ok=True)
        (folder / f"{month}.json").write_text("\n".join(lines), encoding="utf-8")
        return str(tmp_path / "landing")

    return write


def test_bad_records_are_set_aside(spark, landing):
    missing = {k: v for k, v in record(5).items() if k != "Close"}
    path = landing(
        "^IXIC", "2024-01",
        json.dumps([record(2), record(3)]), json.dumps(record(4)), '{"Date": "2024-01-',
        json.dumps(missing),
    )
    landing("A B+C", "2024-02", json.dumps([record(2)]))
    with open(os.path.join(path, "^IXIC", "monthly", "notes.txt"), "w") as f:
        f.write("not json")
    records = readers.symbol_from_path(readers.read_records(spark, path))
    good, rejects = clean.bars(records)
    assert [str(d) for d in column(good, "date", "^IXIC")] == [
        "2024-01-02", "2024-01-03", "2024-01-04"
    ]
    assert column(good, "close", "A B+C") == [1.5]
    assert sorted(r["reason"] for r in rejects.collect()) == ["missing value", "unreadable line"]


def test_the_first_file_and_then_the_first_record_wins(spark, landing):
    path = landing("A", "b", json.dumps([record(2, 5), record(2, 4)]), json.dumps(record(3, 3)),
                   json.dumps(record(3, 1)))
    landing("A", "a", json.dumps([record(4, 9), record(4, 8)]))
    landing("A", "c", json.dumps([record(2, 1), record(4, 1)]))
    good, _ = clean.bars(readers.symbol_from_path(readers.read_records(spark, path)))
    out = merge.combine(good, readers.FILE_ORDER)
    assert column(out, "close") == [5.0, 3.0, 9.0]


@pytest.fixture
def bars(spark):
    rows = [
        (s, dt.date(2024, m, d), 1.0, 2.0, 0.5, float(d), 10.0)
        for s in ("^IXIC", "A/B") for m in (1, 2) for d in (30 - m * 10, 2, 5)
    ]
    return spark.createDataFrame(
        rows, "symbol string, date date, open double, high double, low double, close double, "
              "volume double")


def same(a, b):
    names = sorted(a.columns)
    return a.select(names).exceptAll(b.select(names)).isEmpty() and a.count() == b.count()


def test_published_months_are_one_array_per_file(spark, bars, tmp_path):
    path = str(tmp_path / "published")
    writers.publish_months(bars, path)
    writers.publish_months(bars, path)
    lines = spark.read.option("recursiveFileLookup", True).text(path).collect()
    assert len(lines) == 4
    days = [r["Date"][:10] for r in json.loads(lines[0]["value"])]
    assert days == sorted(days) and len(days) == 3
    good, _ = clean.bars(readers.symbol_from_path(readers.read_records(spark, path)))
    assert same(good.select(bars.columns), bars)


def test_split_months_read_back_with_symbols_from_the_path(spark, bars, tmp_path):
    path = str(tmp_path / "split")
    writers.split_months(bars, path)
    good, _ = clean.bars(readers.symbol_from_path(readers.read_records(spark, path)))
    assert same(good.select(bars.columns), bars)


def test_store_upsert_touches_only_its_months(spark, bars, tmp_path):
    path = str(tmp_path / "store")
    assert writers.read_months(spark, path).isEmpty()
    writers.upsert_months(bars, path)
    january = os.path.join(path, "year_month=2024-01")
    before = sorted(os.listdir(january))
    changed = bars.where(F.month("date") == 2).withColumn("close", F.lit(-1.0))
    later = changed.withColumn("date", F.date_add("date", 1)).withColumn("close", F.lit(7.0))
    writers.upsert_months(changed.unionByName(later), path)
    assert sorted(os.listdir(january)) == before
    out = writers.read_months(spark, path)
    assert out.where("close = -1").isEmpty()
    assert out.where("close = 7").count() == 6
    again = out.count()
    writers.upsert_months(changed.unionByName(later), path)
    assert writers.read_months(spark, path).count() == again
    plan = writers.read_months(spark, path, ["2024-02"])._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(year_month" in plan.toString()


def test_combined_series_is_ordered_over_its_files(spark, bars, tmp_path):
    path = str(tmp_path / "combined")
    writers.write_combined(bars, path)
    lines = [
        (row["symbol"], row["Date"])
        for name in sorted(os.listdir(path)) if name.endswith(".json")
        for row in map(json.loads, open(os.path.join(path, name), encoding="utf-8"))
    ]
    assert lines == sorted(lines) and len(lines) == 12
    assert readers.read_combined(spark, path).count() == 12


def test_combined_reader_skips_noise_and_refuses_nothing(spark, tmp_path):
    path = tmp_path / "lines"
    path.mkdir()
    (path / "a.json").write_text("\n".join([json.dumps(record(3)), "", "{oops", json.dumps(record(2))]))
    out = readers.read_combined(spark, str(path)).collect()
    assert [str(r["date"]) for r in out] == ["2024-01-02", "2024-01-03"]
    (path / "a.json").write_text("{oops\n")
    with pytest.raises(ValueError):
        readers.read_combined(spark, str(path))


def test_csv_round_trip_and_range(spark, bars, tmp_path):
    path = str(tmp_path / "csv")
    writers.write_csv(bars, path)
    assert same(readers.read_bars(spark, path, "csv"), bars)
    some = readers.read_bars(spark, path, "csv", dt.date(2024, 1, 5), dt.date(2024, 2, 5))
    assert sorted({str(r["date"]) for r in some.collect()}) == [
        "2024-01-05", "2024-01-20", "2024-02-02"
    ]


def test_range_reaches_the_parquet_scan(spark, bars, tmp_path):
    path = str(tmp_path / "parquet")
    bars.write.parquet(path)
    out = readers.read_bars(spark, path, start=dt.date(2024, 1, 5)).select("close")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2024-01-05)" in plan
    assert "ReadSchema: struct<date:date,close:double>" in plan


def test_missing_model_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path does not exist|not exist"):
        models.load(spark, str(tmp_path), "A", "rf")


def test_catalog_fills_absent_keys_and_skips_bad_files(spark, tmp_path):
    meta = {"ticker": "^IXIC", "features": ["close"]}
    (tmp_path / "a_meta.json").write_text(json.dumps(meta, indent=4))
    (tmp_path / "b_meta.json").write_text("{broken")
    out = readers.read_catalog(spark, str(tmp_path)).collect()
    assert [(r["ticker"], r["feature_set"], r["created_date"]) for r in out] == [
        ("^IXIC", "Unknown", "Unknown")
    ]


def test_a_save_broken_at_any_step_leaves_the_earlier_version(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(float(i), 2.0 * i + 1, "A") for i in range(9)], "x double, y double, symbol string")
    vector = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    fitted = [LinearRegression(labelCol="y", regParam=p).fit(vector) for p in (0.0, 5.0)]
    root = str(tmp_path / "models")
    scalers = [rows.select("symbol").distinct().withColumn("close_shift", F.lit(v)) for v in (1.0, 2.0)]
    models.save(fitted[0], scalers[0], root, "A", "rf", ["x"], "2024-01-01")

    def newest():
        model, params = models.load(spark, root, "A", "rf")
        meta = models.metadata(spark, root, "A", "rf")
        return model.coefficients[0], params.first()["close_shift"], meta["created_date"]

    before = newest()
    real = {n: getattr(models.Files, n) for n in ("write", "replace")}
    for step in ("write", "replace"):
        with monkeypatch.context() as m:
            m.setattr(models.Files, step, lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                models.save(fitted[1], scalers[1], root, "A", "rf", ["x"], "2024-01-02")
        assert newest() == before
    with pytest.raises(Exception):
        models.save(fitted[1], scalers[1].withColumn("bad", F.raise_error(F.lit("lost"))), root, "A", "rf", ["x"], "2024-01-02")
    assert newest() == before and all(getattr(models.Files, n) is f for n, f in real.items())
    models.save(fitted[1], scalers[1], root, "A", "rf", ["x"], "2024-01-03")
    after = newest()
    assert after[0] != before[0] and after[1:] == (2.0, "2024-01-03")
    assert readers.read_catalog(spark, f"{root}/meta").count() == 1
    assert models.prune(spark, root, "A", "rf") == 4 and newest() == after
