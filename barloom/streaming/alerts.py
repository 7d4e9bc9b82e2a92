"""Divergence alerts on a stream of ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barloom.operators import alerts


def stream(
    ticks: DataFrame,
    predictions: DataFrame,
    as_of,
    threshold: float = alerts.THRESHOLD,
    once_within: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """Key and JSON alert per diverging tick; a stateless join with the static predictions.

    `once_within` keeps one alert per symbol and day within that time, which needs state.
    """
    if once_within:
        watched = ticks.withWatermark("ts", once_within)
        marked = alerts.diverging(watched, predictions, threshold, salts)
        first = marked.dropDuplicatesWithinWatermark(["symbol", "prediction_date"])
        return alerts.as_topic_rows(alerts.as_messages(first, as_of))
    return alerts.as_topic_rows(alerts.messages(ticks, predictions, as_of, threshold, salts))
