"""Train and test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.series import default_chunk, without_position
from barloom.session import cut

# Leading hex digits of a hash that cut each series into chunks.
DIGITS = 4


def newest(df: DataFrame, n: int, order: str = "date") -> DataFrame:
    """The last `n` rows of each series with `_back`, 1 for the newest.

    Rows are counted per calendar chunk; only the chunks that reach into the last `n` rows are
    ranked, each by itself, so no task holds more than a chunk whatever `n` and the series are.
    Rows without a symbol or a date belong to no series and are left out.
    """
    chunked = without_position(df).withColumn("_chunk", default_chunk(df, order))
    sizes = chunked.groupBy("symbol", "_chunk").agg(F.count("*").alias("_rows"))
    later = Window.partitionBy("symbol").orderBy(F.desc("_chunk"))
    later = later.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(later), F.lit(0))
    chunks = sizes.withColumn("_newer", before).where(F.col("_newer") < n).drop("_rows")
    rank = F.row_number().over(Window.partitionBy("symbol", "_chunk").orderBy(F.desc(order)))
    ranked = chunked.join(chunks, ["symbol", "_chunk"]).withColumn("_back", F.col("_newer") + rank)
    return ranked.where(F.col("_back") <= n).drop("_chunk", "_newer")


def tail(df: DataFrame, test: int = 30, train: int = 420) -> DataFrame:
    """The last `test` rows of a series as test, the `train` rows before them as train."""
    part = F.when(F.col("_back") <= test, "test").otherwise("train")
    return newest(df, test + train).withColumn("part", part).drop("_back")


def random(
    df: DataFrame, share: float = 0.2, seed: int = 42, digits: int = DIGITS
) -> DataFrame:
    """Exactly ceil(share * n) rows of each series as test, chosen by a hash of their key.

    The order is the hash. Its leading hex `digits` cut a series into chunks whose counts name the
    chunk that the border runs through. Every row is compared with that border, from a table of one
    row per symbol, and only the rows of the border's own chunk are moved and ranked; no other row
    is, unless the table is too large to broadcast. `df` is read three times: cut it first if it is
    costly. Rows without a symbol are left out.
    """
    key = F.concat_ws("|", "symbol", F.date_format("date", "yyyy-MM-dd"), F.lit(seed))
    hashed = without_position(df).where(F.col("symbol").isNotNull()).withColumn("_hash", F.md5(key))
    hashed = hashed.withColumn("_chunk", F.substring("_hash", 1, digits))
    sizes = hashed.groupBy("symbol", "_chunk").agg(F.count("*").alias("_rows"))
    series = Window.partitionBy("symbol")
    earlier = series.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # The product is rounded before the ceiling, so that 0.2 * 10 stays 2.
    limit = F.ceil(F.round(F.sum("_rows").over(series) * F.lit(share), 6))
    left = limit - F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    borders = sizes.withColumn("_left", left).where((F.col("_left") > 0) & (F.col("_left") <= F.col("_rows")))
    # Written, so the planner knows the table's size before it moves rows.
    borders = cut(borders.select("symbol", F.col("_chunk").alias("_border"), "_left"), "borders")
    placed = hashed.join(borders, "symbol", "left")
    inside = F.coalesce(F.col("_chunk") == F.col("_border"), F.lit(False))
    sure = placed.where(~inside).withColumn(
        "part", F.when(F.col("_chunk") < F.col("_border"), "test").otherwise("train"))
    rank = F.row_number().over(series.orderBy("_hash"))
    border = placed.where(inside).withColumn("part", F.when(rank <= F.col("_left"), "test").otherwise("train"))
    return sure.unionByName(border).drop("_hash", "_chunk", "_border", "_left")
