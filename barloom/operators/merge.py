"""De-duplication, union by priority, and incremental selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.schemas import OHLCV

KEYS = ["symbol", "date"]


WIDE = "decimal(38,0)"
# Decimal digits of an integral type, and what lifts its negative half above zero.
DIGITS = {"tinyint": (3, 1 << 7), "smallint": (5, 1 << 15), "int": (10, 1 << 31), "bigint": (20, 1 << 63)}
PLACE_DIGITS = 19


def wide(number: int) -> Column:
    return F.lit(str(number)).cast(WIDE)


def _order_key(df: DataFrame, order_cols: list[str]) -> Column | None:
    """The integral order columns, then the place of landing, as one number; null counts as least."""
    kinds = [DIGITS.get(dict(df.dtypes)[c]) for c in order_cols]
    if not kinds or None in kinds or sum(d for d, _ in kinds) + PLACE_DIGITS > 38:
        return None
    key = wide(0)
    for name, (digits, shift) in zip(order_cols, kinds, strict=True):
        part = F.coalesce(F.col(name).cast(WIDE) + wide(shift), wide(0))
        key = key * wide(10**digits) + part
    return key * wide(10**PLACE_DIGITS) + F.monotonically_increasing_id()


def combine(df: DataFrame, order_cols: list[str], values: list[str] | None = None) -> DataFrame:
    """The first record per symbol and date in the order of `order_cols`.

    Copies shrink to one per task before the exchange, so a date with very many copies costs no
    more than any other. Integral orders are packed into one unique number with the place in the
    input, which keeps a hash aggregate and lets the first landed of equals win. Other orders take
    a minimum over a struct, in which equal orders fall back on the values.
    """
    values = values or OHLCV
    key = _order_key(df, order_cols)
    if key is None:
        first = F.min(F.struct(*order_cols, *values)).alias("_first")
        return df.groupBy(*KEYS).agg(first).select(*KEYS, *[f"_first.{v}" for v in values])
    keyed = df.withColumn("_order", key)
    return keyed.groupBy(*KEYS).agg(*[F.min_by(v, "_order").alias(v) for v in values])


def upsert(
    existing: DataFrame, incoming: DataFrame, order_cols: list[str] | None = None
) -> DataFrame:
    """Existing and new rows together; on the same date the existing row stays."""
    rows = existing.withColumn("_rank", F.lit(0)).unionByName(
        incoming.withColumn("_rank", F.lit(1)), allowMissingColumns=True
    )
    return combine(rows, ["_rank", *(order_cols or [])])


def high_water(df: DataFrame) -> DataFrame:
    """The latest stored date per symbol."""
    return df.groupBy("symbol").agg(F.max("date").alias("last_date"))


def new_rows(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming rows after the stored high-water date; all rows of an unknown symbol.

    `stored` are bars, or their marks (symbol, last_date).
    """
    marks = stored if "last_date" in stored.columns else high_water(stored)
    late = F.col("last_date").isNull() | (F.col("date") > F.col("last_date"))
    return incoming.join(marks, "symbol", "left").where(late).drop("last_date")
