"""Scalers with one row of parameters per symbol: `{col}_shift` and `{col}_scale`.

Spark ML's scalers use the sample deviation and send a constant to 0.5; these use the population
deviation and send it to 0. Neither join below carries a hint: the parameter table has one row
per symbol, and the adaptive planner broadcasts it only when its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _params(df: DataFrame, cols: list[str], shift, scale, by: str) -> DataFrame:
    stats = {}
    for c in cols:
        stats[f"{c}_shift"] = shift(c)
        stats[f"{c}_scale"] = scale(c)
    fitted = df.groupBy(by).agg(*[value.alias(name) for name, value in stats.items()])
    return fitted.withColumns({
        f"{c}_scale": F.when(F.col(f"{c}_scale") == 0, 1.0).otherwise(F.col(f"{c}_scale"))
        for c in cols
    })


def fit_standard(df: DataFrame, cols: list[str], by: str = "symbol") -> DataFrame:
    return _params(df, cols, F.avg, F.stddev_pop, by)


def fit_minmax(df: DataFrame, cols: list[str], by: str = "symbol") -> DataFrame:
    return _params(df, cols, F.min, lambda c: F.max(c) - F.min(c), by)


def scaled(col: str, by: str | None = None) -> Column:
    by = by or col
    return (F.col(col) - F.col(f"{by}_shift")) / F.col(f"{by}_scale")


def unscaled(col: str, by: str | None = None) -> Column:
    by = by or col
    return F.col(col) * F.col(f"{by}_scale") + F.col(f"{by}_shift")


def apply(
    df: DataFrame, params: DataFrame, cols: list[str], suffix: str = "", by: str = "symbol"
) -> DataFrame:
    """Replace `cols` by their scaled values, or add them under `suffix`."""
    out = df.join(params, by).withColumns({f"{c}{suffix}": scaled(c) for c in cols})
    return out.drop(*[c for c in params.columns if c != by])


def invert(
    df: DataFrame, params: DataFrame, col: str, of: str | None = None, by: str = "symbol"
) -> DataFrame:
    """Bring `col` back to original units with the parameters of column `of`."""
    out = df.join(params, by).withColumn(col, unscaled(col, of))
    return out.drop(*[c for c in params.columns if c != by])
