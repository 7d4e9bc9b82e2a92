"""Exact quantiles of long groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import cut

# Slices a group is cut into before ranking, and the precision of the sketch that cuts it.
SLICES, PRECISION = 128, 2000


def exact(df: DataFrame, col: str, shares: list[float], by: str = "symbol") -> DataFrame:
    """(key, q0, q1, ...): per group the values of rank ceil(share * n), at least 1, in order.

    A sketch cuts a group into slices of about equal size. Their exact counts name the slice that
    holds a rank, and only the rows of such slices are ranked, each slice by itself; the sketch
    decides how much is ranked and not what comes out. Nulls are left out; a group without a value
    has no row.
    """
    rows = df.select(by, F.col(col).cast("double").alias("_v")).where(F.col(by).isNotNull() & F.col("_v").isNotNull())
    borders = [i / SLICES for i in range(1, SLICES)]
    cuts = rows.groupBy(by).agg(F.array_distinct(F.percentile_approx("_v", borders, PRECISION)).alias("_cuts"))
    cuts = cut(cuts, "cuts")
    sliced = rows.join(cuts, by).withColumn("_slice", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))))
    sizes = sliced.groupBy(by, "_slice").agg(F.count("*").alias("_rows"))
    whole = Window.partitionBy(by)
    earlier = F.coalesce(F.sum("_rows").over(whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.greatest(F.lit(1), F.ceil(F.round(F.col("_n") * share, 6))).alias("rank"))
        for i, share in enumerate(shares)])).alias("_q")
    wanted = (
        sizes.withColumn("_before", earlier).withColumn("_n", F.sum("_rows").over(whole)).select("*", ranks)
        .where((F.col("_q.rank") > F.col("_before")) & (F.col("_q.rank") <= F.col("_before") + F.col("_rows")))
        .select(by, "_slice", F.col("_q.i").alias("_i"), (F.col("_q.rank") - F.col("_before")).alias("_rank"))
    )
    wanted = cut(wanted, "ranks")
    place = F.row_number().over(Window.partitionBy(by, "_slice").orderBy("_v"))
    ranked = sliced.join(wanted.select(by, "_slice").distinct(), [by, "_slice"], "left_semi").withColumn("_rank", place)
    found = ranked.join(wanted, [by, "_slice", "_rank"])
    return found.groupBy(by).agg(*[
        F.max(F.when(F.col("_i") == i, F.col("_v"))).alias(f"q{i}") for i in range(len(shares))])
