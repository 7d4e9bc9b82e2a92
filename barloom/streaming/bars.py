"""Intraday bars from ticks, and breaches of a predicted band. Batch and stream alike."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.merge import WIDE, wide
from barloom.session import Files


def tick_order() -> Column:
    """Time and event id, which is not negative, as one number; it keeps a hash aggregate."""
    micros = F.unix_micros("ts").cast(WIDE) + wide(1 << 62)
    return micros * wide(10**19) + F.col("event_id").cast(WIDE)


def bars(ticks: DataFrame, width: str = "240 minutes", watermark: str | None = None) -> DataFrame:
    """Open, high, low, close and tick count per symbol and window.

    A stream needs `watermark`: a window is emitted once no earlier tick can arrive, and ticks
    later than that are dropped.
    """
    if watermark:
        ticks = ticks.withWatermark("ts", watermark)
    order = tick_order()
    return (
        ticks.groupBy(F.window("ts", width).alias("w"), "symbol")
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.count("price").alias("ticks"),
        )
        .select(
            "symbol",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "open", "high", "low", "close", "ticks",
        )
    )


PARTIAL = ("symbol string, window_start timestamp, window_end timestamp, open double, open_at decimal(38,0), "
           "high double, low double, close double, close_at decimal(38,0), ticks long, late long")
EPOCH, COMPACT = "epoch", "_compact-"


def _partial(ticks: DataFrame, width: str) -> DataFrame:
    order = tick_order()
    return ticks.groupBy(F.window("ts", width).alias("w"), "symbol").agg(
        F.min_by("price", order).alias("open"), F.min(order).alias("open_at"),
        F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", order).alias("close"), F.max(order).alias("close_at"),
        F.count("price").alias("ticks"),
    ).select("symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
             "open", "open_at", "high", "low", "close", "close_at", "ticks")


def _merged(partials: DataFrame) -> DataFrame:
    return partials.groupBy("symbol", "window_start", "window_end").agg(
        F.min_by("open", "open_at").alias("open"), F.min("open_at").alias("open_at"),
        F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "close_at").alias("close"), F.max("close_at").alias("close_at"),
        F.sum("ticks").alias("ticks"), F.sum("late").alias("late"))


def into_windows(path: str, width: str = "240 minutes", lateness: str = "1 hour"):
    """A handler of tick batches that keeps every window up to date, the open ones too.

    A batch is brought down to one partial bar per symbol and window, stored under its epoch: a
    batch that is replayed replaces its own partials, and none is counted twice. No tick is too late
    for a partial; ticks whose window ended `lateness` before the newest tick of earlier epochs are
    counted in `late`.
    """

    def process(batch: DataFrame, epoch: int) -> None:
        earlier = _partials(batch.sparkSession, path).where(F.col(EPOCH) < epoch)
        newest = earlier.agg(F.max("close_at")).first()[0]
        rows = _partial(batch, width)
        late = F.lit(0).cast("long")
        if newest is not None:
            seen = F.timestamp_micros(F.lit(int(newest) // 10**19 - (1 << 62)))
            late = F.when(F.col("window_end") <= seen - F.expr(f"INTERVAL {lateness}"), F.col("ticks")).otherwise(late)
        rows.withColumn("late", late).write.mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")

    return process


def _partials(spark: SparkSession, path: str) -> DataFrame:
    """The partials of all epochs, after an interrupted compaction is finished."""
    schema, files = f"{PARTIAL}, {EPOCH} long", Files(spark, path)
    for name in files.names(path):
        if name.startswith(COMPACT):
            upto = int(name.removeprefix(COMPACT))
            for epoch in files.names(path):
                if epoch.startswith(f"{EPOCH}=") and int(epoch.split("=")[1]) <= upto:
                    files.delete(f"{path}/{epoch}")
            files.move(f"{path}/{name}", f"{path}/{EPOCH}={upto}")
    if not any(n.startswith(f"{EPOCH}=") for n in files.names(path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """Every window that `into_windows` has seen a tick of, with all of its ticks so far."""
    return _merged(_partials(spark, path)).drop("open_at", "close_at")


def compact_windows(spark: SparkSession, path: str, upto: int) -> None:
    """Bring the partials of the epochs up to `upto` down to one per window, under that epoch.

    For use while no stream writes, and with an `upto` that will not be replayed. The complete
    result is named before anything goes; if the rest is interrupted, the next reader finishes it.
    """
    merged = _merged(_partials(spark, path).where(F.col(EPOCH) <= upto))
    draft = f"{path}/_draft-{uuid.uuid4().hex}"
    merged.write.parquet(draft)
    Files(spark, path).move(draft, f"{path}/{COMPACT}{upto}")
    _partials(spark, path)


def band_breaches(intraday: DataFrame, bands: DataFrame) -> DataFrame:
    """Intraday bars that leave the band predicted for their day.

    `bands` has symbol, prediction_date, predicted_high and predicted_low.
    """
    days = bands.select(
        "symbol",
        F.col("prediction_date").alias("_day"),
        "predicted_high",
        "predicted_low",
    )
    above = F.col("high") > F.col("predicted_high")
    below = F.col("low") < F.col("predicted_low")
    side = F.when(above & below, "both").when(above, "above").when(below, "below")
    return (
        intraday.withColumn("_day", F.to_date("window_start"))
        .join(days, ["symbol", "_day"])
        .withColumn("side", side)
        .where(F.col("side").isNotNull())
        .withColumnRenamed("_day", "prediction_date")
    )
