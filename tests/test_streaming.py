"""Streams over files against the same work in batch."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from barloom.operators import alerts
from barloom.schemas import MESSAGES, TICKS
from barloom.sources import tables
from barloom.streaming import alerts as alert_stream
from barloom.streaming import bars as intraday
from barloom.streaming import changing, topics

STAMP = "2024-01-31 12:00:00"


@pytest.fixture
def ticks(spark, tmp_path):
    """A stream of event files, one per given batch, and the same ticks as a table."""
    folder = tmp_path / "events"

    def build(*batches):
        for n, rows in enumerate(batches):
            frame = spark.createDataFrame(
                [(i, ts, 1, s, float(p), "{}") for i, s, ts, p in rows], TICKS)
            frame.coalesce(1).write.mode("append").parquet(str(folder / f"{n}"))
        stream = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(
            str(folder / "*"))
        table = spark.read.schema(TICKS).parquet(str(folder / "*"))
        return tables.as_ticks(stream), tables.as_ticks(table)

    return build


def at(day, hour, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_alerts_of_stream_and_batch_agree(spark, ticks, tmp_path):
    stream, table = ticks(
        [(1, "A", at(2, 9), 100), (2, "A", at(2, 10), 90)], [(3, "A", at(2, 11), 120)]
    )
    preds = spark.createDataFrame(
        [("A", dt.date(2024, 1, 2), 100.0)],
        "symbol string, prediction_date date, predicted double")
    topic = topics.Topic(format="json", path=str(tmp_path / "topic"))
    topics.write_topic(
        alert_stream.stream(stream, preds, STAMP), topic, str(tmp_path / "c"), wait=True)
    sent = spark.read.schema(MESSAGES).json(topic.path)
    batch = alerts.as_topic_rows(alerts.messages(table, preds, STAMP))
    assert rows(sent) == rows(batch) and sent.count() == 2
    body = json.loads(sent.where("value like '%120%'").first()["value"])
    assert body["direction"] == "down" and body["alert_type"] == "intraday_price_difference"


def test_one_alert_per_symbol_and_day_on_request(spark, ticks, tmp_path):
    stream, _ = ticks([(1, "A", at(2, 9), 90), (2, "A", at(2, 10), 91), (3, "B", at(2, 10), 91)])
    preds = spark.createDataFrame(
        [(s, dt.date(2024, 1, 2), 100.0) for s in "AB"],
        "symbol string, prediction_date date, predicted double")
    out = alert_stream.stream(stream, preds, STAMP, once_within="1 day")
    topics.write_table(out, str(tmp_path / "o"), str(tmp_path / "c"), wait=True)
    sent = spark.read.parquet(str(tmp_path / "o"))
    assert sorted(r["key"] for r in sent.collect()) == ["A", "B"]


def test_each_message_is_handled_once(spark, ticks, tmp_path):
    stream, _ = ticks([(1, "A", at(2, 9), 90)], [(2, "B", at(2, 10), 91)])
    topic = topics.Topic(format="json", path=str(tmp_path / "topic"))
    sent = topics.envelope(stream.withColumn("message", F.col("symbol")))
    topics.write_topic(sent, topic, str(tmp_path / "sent"), wait=True)
    for _ in range(2):
        topics.handle(topics.read_topic(spark, topic), topics.into_table(str(tmp_path / "t")),
                      str(tmp_path / "got"), wait=True)
    got = spark.read.parquet(str(tmp_path / "t")).collect()
    assert sorted(json.loads(r["value"])["message"] for r in got) == ["A", "B"]
    keys = {r["key"] for r in got}
    assert keys == {"1704186000.000000", "1704189600.000000"}


def test_late_ticks_are_dropped_after_the_watermark(spark, ticks, tmp_path):
    stream, table = ticks(
        [(1, "A", at(2, 1), 10), (2, "A", at(2, 2), 12)],
        [(3, "A", at(2, 13), 11)],
        [(6, "A", at(2, 13, 30), 11)],  # closes the window of the first ticks
        [(4, "A", at(2, 3), 99)],
        [(5, "A", at(3, 1), 9)],
    )
    out = intraday.bars(stream, watermark="1 hour")
    topics.write_table(out, str(tmp_path / "o"), str(tmp_path / "c"), wait=True)
    got = {r["window_start"].hour: r for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert set(got) == {0, 12}
    assert (got[0]["open"], got[0]["high"], got[0]["close"], got[0]["ticks"]) == (10, 12, 12, 2)
    batch = {r["window_start"]: r["ticks"] for r in intraday.bars(table).collect()}
    assert batch[at(2, 0)] == 3


def test_band_breaches(spark, ticks):
    _, table = ticks([(1, "A", at(2, 1), 10), (2, "A", at(2, 5), 20), (3, "A", at(2, 9), 5)])
    bands = spark.createDataFrame(
        [("A", dt.date(2024, 1, 2), 15.0, 8.0)],
        "symbol string, prediction_date date, predicted_high double, predicted_low double")
    out = intraday.band_breaches(intraday.bars(table), bands).orderBy("window_start").collect()
    assert [(r["window_start"].hour, r["side"]) for r in out] == [(4, "above"), (8, "below")]


MADE = "symbol string, prediction_date date, predicted double, made_at timestamp"


def test_predictions_that_land_and_change_while_the_stream_runs(spark, tmp_path):
    day = dt.date(2024, 1, 2)
    folders = {n: str(tmp_path / n) for n in ("ticks", "made", "out", "check")}

    def land(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folders[name])

    tick = "symbol string, ts timestamp, price double"
    land("ticks", [("A", at(2, 9), 90.0), ("A", at(2, 11), 100.0), ("B", at(2, 9), 5.0)], tick)
    land("made", [("Z", day, 1.0, at(2, 0))], MADE)

    def run():
        out = changing.stream(spark.readStream.schema(tick).parquet(folders["ticks"]),
                              spark.readStream.schema(MADE).parquet(folders["made"]), STAMP, lateness="2 days", salts=2)
        topics.write_table(out, folders["out"], folders["check"], wait=True)
        bodies = [json.loads(r["value"]) for r in spark.read.parquet(folders["out"]).collect()]
        return sorted((b["ticker"], b["last_update"][11:16], b["predicted_price"]) for b in bodies)

    assert run() == []
    # Made in the morning, landed after the ticks: the waiting ticks after it are answered.
    land("made", [("A", day, 100.0, at(2, 8))], MADE)
    assert run() == [("A", "09:00", 100.0)]
    # Replaced at noon: ticks from then on meet the new one, earlier late ones still the old one.
    land("made", [("A", day, 50.0, at(2, 12)), ("B", day, 9.0, at(2, 10))], MADE)
    land("ticks", [("A", at(2, 13), 100.0), ("A", at(2, 10), 80.0), ("B", at(2, 12), 9.0), (None, at(2, 12), 1.0)], tick)
    assert run() == [("A", "09:00", 100.0), ("A", "10:00", 100.0), ("A", "13:00", 50.0)]
    # Of the same time the greatest counts; a prediction for a day that is over is no error.
    land("made", [("A", day, 60.0, at(2, 12)), ("A", dt.date(2023, 1, 1), 1.0, at(2, 12))], MADE)
    land("ticks", [("A", at(2, 14), 60.0), ("A", at(9, 1), 7.0)], tick)
    assert len(run()) == 3
    # A week later the day's state has gone: its ticks are too late, and nothing fails.
    land("ticks", [("A", at(2, 15), 1.0), ("A", at(9, 2), 7.0)], tick)
    assert len(run()) == 3


class Failing(topics.OncePerPart):
    """Fails at a message until a file says otherwise."""

    def __init__(self, path, allowed):
        super().__init__(path)
        self.allowed = allowed

    def handled(self, row):
        if "bad" in row["value"] and not os.path.exists(self.allowed):
            raise ValueError("bad message")
        return super().handled(row)


def test_messages_are_handled_in_tasks_once_per_part(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("topic", "out", "check"))
    for value in ("one", "bad", "three"):
        spark.createDataFrame([(value, value)], MESSAGES).coalesce(1).write.mode("append").json(folder)
    topic = topics.Topic(format="json", path=folder)
    handler = Failing(out, str(tmp_path / "allowed"))
    with pytest.raises(Exception, match="bad message"):
        topics.handle_each(topics.read_topic(spark, topic), handler, check, wait=True)
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("part-*")}
    assert not any("bad" in p.read_text() for p in kept)
    (tmp_path / "allowed").touch()
    topics.handle_each(topics.read_topic(spark, topic), handler, check, wait=True)
    # The epoch was replayed: parts that were done are as they were, and every message is there once.
    assert all(p.stat().st_mtime_ns == t for p, t in kept.items())
    rows_ = spark.read.schema(MESSAGES).json(out).collect()
    assert sorted(r["value"] for r in rows_) == ["bad", "one", "three"]
    assert not list((tmp_path / "out").rglob("_part-*"))


def test_console_prints_in_tasks(spark, capfd):
    batch = spark.createDataFrame([("k", "v")], MESSAGES)
    batch.toLocalIterator = None  # the driver takes no row
    topics.to_console(batch, 0)


def test_open_windows_and_late_ticks_are_kept(spark, ticks, tmp_path):
    stream, table = ticks(
        [(1, "A", at(2, 1), 10), (2, "A", at(2, 2), 12)],
        [(3, "A", at(2, 13), 11), (9, "B", at(2, 13), 5)],
        [(4, "A", at(2, 3), 99), (5, "A", at(2, 0), 8)],
        [(6, "A", at(2, 13, 30), 14)],
    )
    path, calls = str(tmp_path / "windows"), []
    handler = intraday.into_windows(path)

    def twice(batch, epoch):
        handler(batch, epoch)
        handler(batch, epoch)  # replayed
        calls.append(epoch)

    topics.handle(stream, twice, str(tmp_path / "c"), wait=True)
    assert len(calls) == 4
    got = intraday.read_windows(spark, path)
    assert rows(got.drop("late")) == rows(intraday.bars(table))
    assert {(r["symbol"], r["window_start"].hour): r["late"] for r in got.collect()} == {
        ("A", 0): 2, ("A", 12): 0, ("B", 12): 0}
    before = rows(got)
    intraday.compact_windows(spark, path, 2)
    assert sorted(n for n in os.listdir(path) if n.startswith("epoch")) == ["epoch=2", "epoch=3"]
    assert rows(intraday.read_windows(spark, path)) == before
    # A compaction that broke off after its result was named is finished by the next reader.
    intraday._merged(intraday._partials(spark, path)).write.parquet(f"{path}/_compact-3")
    assert rows(intraday.read_windows(spark, path)) == before
    assert [n for n in os.listdir(path) if n.startswith("epoch")] == ["epoch=3"]
    assert intraday.read_windows(spark, str(tmp_path / "nothing")).collect() == []
