"""Divergence alerts: the current price against the prediction for its day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions import columns as C

# The threshold in percent and the type that alerts carry.
THRESHOLD = 1.0
ALERT_TYPE = "intraday_price_difference"


def _timed(ticks: DataFrame, predictions: DataFrame, salts: int) -> DataFrame:
    """Each tick with the prediction made for its own day."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    days = predictions.select("symbol", "prediction_date", "predicted", copies.alias("_salt"))
    salt = F.pmod(F.xxhash64("ts", "price"), F.lit(salts)).cast("int")
    keyed = ticks.withColumns({"prediction_date": F.to_date("ts"), "_salt": salt})
    return keyed.join(days, ["symbol", "prediction_date", "_salt"]).drop("_salt")


def diverging(
    ticks: DataFrame, predictions: DataFrame, threshold: float = THRESHOLD, salts: int = 1
) -> DataFrame:
    """Ticks whose price is at least `threshold` percent away from the day's prediction.

    The planner broadcasts predictions when they are small. Where they are not, one symbol's day
    may hold much of a batch: `salts` copies of each prediction then spread it over as many tasks.
    """
    return (
        _timed(ticks, predictions, salts)
        .withColumn("price_diff_percent", C.deviation_pct("predicted", "price"))
        .where(F.col("price_diff_percent") >= threshold)
    )


def messages(
    ticks: DataFrame, predictions: DataFrame, as_of, threshold: float = THRESHOLD, salts: int = 1
) -> DataFrame:
    """Alert fields, one row per diverging tick."""
    return as_messages(diverging(ticks, predictions, threshold, salts), as_of)


def as_messages(marked: DataFrame, as_of) -> DataFrame:
    """Alert fields of diverging ticks; `as_of` stamps the alert."""
    stamp = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return marked.select(
        F.col("symbol").alias("ticker"),
        F.col("price").alias("current_price"),
        F.col("predicted").alias("predicted_price"),
        "price_diff_percent",
        C.day_text("prediction_date").alias("prediction_date"),
        C.second_text("ts").alias("last_update"),
        C.iso_text(stamp).alias("alert_timestamp"),
        F.lit(ALERT_TYPE).alias("alert_type"),
        C.direction("predicted", "price").alias("direction"),
    )


def as_topic_rows(alerts: DataFrame) -> DataFrame:
    """Key and JSON value, ready for a topic."""
    return alerts.select(
        F.col("ticker").alias("key"), F.to_json(F.struct(*alerts.columns)).alias("value")
    )


def single_frame_intraday(df: DataFrame) -> DataFrame:
    """The newest bar compared with the day after it: by construction never intraday.

    Kept to show why alerts join ticks with predictions of an earlier run.
    """
    last = df.groupBy("symbol").agg(F.max("date").alias("last_date"))
    return last.withColumn("is_intraday", F.col("last_date") == C.next_date("last_date"))
