"""Documents and feeds for readers outside Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions import columns as C
from barloom.operators import merge
from barloom.schemas import OHLCV
from barloom.sources.readers import lookback


def chart_feed(df: DataFrame) -> DataFrame:
    """Chart rows in date order: the day as text, five numbers (also from text), the colour."""
    numbers = {name: C.to_number(name) for name in OHLCV}
    return (
        df.withColumns(numbers)
        .withColumn("time", C.day_text("date"))
        .select("symbol", "time", *OHLCV, C.bar_color().alias("color"))
        .orderBy("symbol", "time")
    )


def change_info(predictions: DataFrame) -> DataFrame:
    """Predicted change against the current close; no change is not positive."""
    change = F.col("predicted_close") - F.col("current_close")
    return predictions.withColumns({
        "change": change,
        "percent_change": F.try_divide(change, F.col("current_close")) * 100,
        "is_positive": change > 0,
    })


def result_document(
    metrics: DataFrame, next_day: DataFrame, as_of, importance: Column | None = None
) -> DataFrame:
    """One nested result row per symbol.

    `metrics` has rmse, mae and mape, `next_day` has prediction_date and predicted_close.
    """
    if importance is None:
        importance = F.lit(None).cast("map<string,double>")
    return metrics.join(next_day, "symbol").select(
        "symbol",
        F.struct(
            F.struct(
                F.col("rmse").alias("RMSE"), F.col("mae").alias("MAE"), F.col("mape").alias("MAPE")
            ).alias("Close")
        ).alias("metrics"),
        F.struct(F.col("predicted_close").alias("Pred_Close")).alias("next_day_prediction"),
        importance.alias("feature_importance"),
        C.day_text("prediction_date").alias("prediction_date"),
        C.iso_text(F.lit(as_of).cast("timestamp")).alias("timestamp"),
    )


def prediction_response(
    bars: DataFrame, predictions: DataFrame, as_of, stamp, days: int = 90
) -> DataFrame:
    """Prediction, current close and the bars of the last `days` days, nested per symbol.

    Copies of a day are merged first, so the nested history holds at most `days` rows.
    """
    recent = merge.combine(lookback(bars, as_of, days), [])
    history = recent.groupBy("symbol").agg(
        F.array_sort(F.collect_list(F.struct("date", *OHLCV))).alias("historical_data"),
        F.max_by("close", "date").alias("current_close"),
        F.max("date").alias("_last"),
    )
    return history.join(predictions, "symbol").select(
        F.col("symbol").alias("ticker"),
        C.day_text("prediction_date").alias("prediction_date"),
        "predicted_close",
        "current_close",
        C.iso_text(F.lit(stamp).cast("timestamp")).alias("prediction_timestamp"),
        (F.col("_last") == F.col("prediction_date")).alias("is_intraday"),
        "historical_data",
    )
