"""Bars and ticks derived from the order and event tables of the test data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.merge import WIDE, wide
from barloom.schemas import TICKS
from barloom.streaming.bars import tick_order

# The key of a line and the digits of its parts. As one number it keeps a hash aggregate.
LINE_KEY = {"l_orderkey": 16, "l_linenumber": 2, "l_partkey": 10, "l_suppkey": 10}


def _line_key() -> Column:
    key = wide(0)
    for name, digits in LINE_KEY.items():
        key = key * wide(10**digits) + F.col(name).cast(WIDE)
    return key


def _bars(lines: DataFrame, symbol: str) -> DataFrame:
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return (
        lines.withColumns({"_price": price, "_key": _line_key()})
        .groupBy(F.col(symbol).alias("symbol"), F.to_date("l_shipdate").alias("date"))
        .agg(
            F.min_by("_price", "_key").alias("open"),
            F.max("_price").alias("high"),
            F.min("_price").alias("low"),
            F.max_by("_price", "_key").alias("close"),
            F.sum("l_quantity").alias("volume"),
        )
    )


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """One bar per return flag and ship date."""
    return _bars(spark.read.parquet(f"{folder}/lineitem.parquet"), "l_returnflag")


def bars_brand(spark: SparkSession, folder: str) -> DataFrame:
    """One bar per part brand and ship date."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    parts = spark.read.parquet(f"{folder}/part.parquet").select("p_partkey", "p_brand")
    return _bars(lines.join(parts, F.col("l_partkey") == F.col("p_partkey")), "p_brand")


def as_ticks(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        "event_id",
    )


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    return as_ticks(spark.read.schema(TICKS).parquet(f"{folder}/events.parquet"))


def daily_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """One bar per event type and day; volume counts the ticks."""
    order = tick_order()
    return (
        ticks(spark, folder)
        .groupBy("symbol", F.to_date("ts").alias("date"))
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.count("price").cast("double").alias("volume"),
        )
    )
