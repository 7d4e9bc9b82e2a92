"""Forecast errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import columns as C


def evaluate(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: list[str] = ("symbol",)
) -> DataFrame:
    """RMSE, MAE and MAPE per group. Rows with actual 0 have no percentage and are counted."""
    miss = F.col(actual) - F.col(predicted)
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.avg(F.abs(miss)).alias("mae"),
        (F.avg(F.abs(F.try_divide(miss, F.col(actual)))) * 100).alias("mape"),
        F.count(miss).alias("n"),
        F.count_if(F.col(actual) == 0).alias("zero_actuals"),
    )


def report(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Signed error and percentage beside each prediction."""
    return df.withColumns({
        "error": F.col(actual) - F.col(predicted),
        "error_pct": C.error_pct(actual, predicted),
    })


def rank(predictions: DataFrame) -> DataFrame:
    """Candidates per symbol by mean MAPE over their runs, best first.

    Takes one row per (symbol, feature_set, run, date) with `actual` and `predicted`. A candidate
    without a finished run has no rows and does not appear.
    """
    runs = evaluate(predictions, by=["symbol", "feature_set", "run"])
    means = runs.groupBy("symbol", "feature_set").agg(
        F.avg("mape").alias("mape"), F.count("mape").alias("runs")
    )
    best = Window.partitionBy("symbol").orderBy("mape", "feature_set")
    return means.withColumn("place", F.row_number().over(best))
