"""Ticks against predictions that arrive, and are replaced, while the stream runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

import barloom
from barloom.functions import columns as C
from barloom.operators import alerts

cloudpickle.register_pickle_by_value(barloom)

DAY_MS = 24 * 60 * 60 * 1000
COMPARED = "symbol string, prediction_date date, ts_micros long, price double, predicted double"
# Of a symbol's day: predictions by the time they were made, and ticks that no prediction precedes.
STATE = "made array<long>, predicted array<double>, waiting array<long>, prices array<double>"


def _columns(found: list[pd.DataFrame], names: list[str], kinds: list) -> list[np.ndarray]:
    return [np.concatenate([f[n].to_numpy(k) for f in found]) if found else np.zeros(0, k) for n, k in zip(names, kinds)]


def _compare(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Each tick beside the newest prediction made before it, as soon as there is one."""
    symbol, day, _ = key
    if state.hasTimedOut:
        state.remove()
        return
    held = state.get if state.exists else ([], [], [], [])
    made, predicted, waiting, prices = (np.array(h, k) for h, k in zip(held, (np.int64, float, np.int64, float)))
    found = list(frames)
    new = [f[f["predicted"].notna()] for f in found]
    at, values = _columns(new, ["at", "predicted"], [np.int64, float])
    made, predicted = np.concatenate([made, at]), np.concatenate([predicted, values])
    order = np.lexsort((predicted, made))
    made, predicted = made[order], predicted[order]
    at, values = _columns([f[f["predicted"].isna()] for f in found], ["at", "price"], [np.int64, float])
    waiting, prices = np.concatenate([waiting, at]), np.concatenate([prices, values])
    place = np.searchsorted(made, waiting, "right") - 1
    known = place >= 0
    if known.any():
        yield pd.DataFrame({
            "symbol": symbol, "prediction_date": day, "ts_micros": waiting[known], "price": prices[known],
            "predicted": predicted[place[known]]})
    over = pd.Timestamp(day).value // 1_000_000 + DAY_MS
    if over <= state.getCurrentWatermarkMs():
        # The day is over: no tick of it can come any more.
        if state.exists:
            state.remove()
        return
    state.update((made.tolist(), predicted.tolist(), waiting[~known].tolist(), prices[~known].tolist()))
    state.setTimeoutTimestamp(over)


def compared(ticks: DataFrame, predictions: DataFrame, lateness: str = "1 hour", salts: int = 1) -> DataFrame:
    """(symbol, ts, price, prediction_date, predicted) of a stream of ticks (symbol, ts, price) and a
    stream of predictions (symbol, prediction_date, predicted, made_at).

    A tick meets the newest prediction for its day that was made at or before it; of those made at
    the same time the greatest counts. A prediction that lands later than the ticks after it still
    meets those which had none so far. Ticks that were answered are not answered again when a newer
    prediction lands late. Ticks later than `lateness` are dropped, and a day's state goes when the
    day and the lateness are over, with the ticks that never had a prediction. `salts` copies of
    the predictions spread the ticks of a hot symbol over as many tasks.
    """
    salt = F.pmod(F.xxhash64("ts", "price"), F.lit(salts)).cast("int")
    day, none = F.to_date("ts"), F.lit(None)
    watched = ticks.where("symbol IS NOT NULL AND ts IS NOT NULL AND price IS NOT NULL").select(
        "symbol", day.alias("prediction_date"), salt.alias("salt"), F.col("ts").alias("clock"),
        F.unix_micros("ts").alias("at"), "price", none.cast("double").alias("predicted"))
    # Predictions carry no clock: they neither move the watermark nor come too late for it.
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    made = predictions.where(
        "symbol IS NOT NULL AND prediction_date IS NOT NULL AND predicted IS NOT NULL AND made_at IS NOT NULL"
    ).select("symbol", "prediction_date", copies.alias("salt"), none.cast("timestamp").alias("clock"),
             F.unix_micros("made_at").alias("at"), none.cast("double").alias("price"), "predicted")
    both = watched.unionByName(made).withWatermark("clock", lateness)
    out = both.groupBy("symbol", "prediction_date", "salt").applyInPandasWithState(
        _compare, COMPARED, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.withColumn("ts", F.timestamp_micros("ts_micros")).drop("ts_micros")


def stream(
    ticks: DataFrame, predictions: DataFrame, as_of, threshold: float = alerts.THRESHOLD,
    lateness: str = "1 hour", salts: int = 1,
) -> DataFrame:
    """Key and JSON alert per tick that diverges from the newest prediction made before it."""
    marked = compared(ticks, predictions, lateness, salts).withColumn(
        "price_diff_percent", C.deviation_pct("predicted", "price"))
    return alerts.as_topic_rows(alerts.as_messages(marked.where(F.col("price_diff_percent") >= threshold), as_of))
