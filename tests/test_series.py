"""Positions, blocks, and the plans they make."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from barloom.functions import indicators as I
from barloom.operators import features, split
from barloom.operators import series as S
from barloom.session import cut


@pytest.fixture(scope="module")
def bars(spark):
    days = spark.range(9000).withColumn(
        "symbol", F.when(F.col("id") % 3 == 0, "HOT").otherwise(
            F.concat(F.lit("S"), (F.col("id") % 30).cast("string")))
    )
    rows = days.select(
        "symbol",
        F.date_add(F.lit(dt.date(1970, 1, 1)), F.col("id").cast("int")).alias("date"),
        *[(F.col("id") % 97 + 1.0).alias(c) for c in ("open", "high", "low", "close", "volume")],
    )
    return cut(rows, "bars")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_position_counts_rows_in_order(bars):
    rows = S.with_position(bars).orderBy("symbol", "date").collect()
    seen = {}
    for r in rows:
        assert r["_pos"] == seen.get(r["symbol"], 0)
        seen[r["symbol"]] = r["_pos"] + 1
    assert all(r["_len"] == seen[r["symbol"]] for r in rows)


def test_position_by_timestamp(spark):
    rows = spark.range(500).select(
        F.lit("A").alias("symbol"),
        (F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3607)).alias("ts"),
        F.col("id"),
    )
    out = S.with_position(rows, order="ts")
    assert out.where(F.col("_pos") != F.col("id")).count() == 0


def test_unknown_order_type_needs_a_chunk(spark):
    with pytest.raises(TypeError):
        S.with_position(spark.range(3).withColumn("symbol", F.lit("A")), order="id")


def test_no_block_exceeds_its_size_however_hot_the_symbol(bars):
    blocked = S._with_blocks(S.with_position(bars), 100, 60, 5, "symbol")
    sizes = blocked.groupBy("symbol", "_block").count()
    assert sizes.agg(F.max("count")).first()[0] == 165
    assert sizes.where(F.col("symbol") == "HOT").count() == 30


def test_frames_may_not_reach_past_the_neighbour_block(bars):
    with pytest.raises(ValueError):
        S._with_blocks(S.with_position(bars), 50, 60, 0, "symbol")


def test_exchanges_do_not_grow_with_the_indicators(bars):
    one = S.measure(bars, I.sma("close", 5, "a"))
    many = features.training(bars, backfill=False)
    count = lambda df: len(re.findall(r"\bExchange ", plan(df)))
    assert count(one) == count(many)


def test_indicator_plans_hold_no_python(bars):
    text = plan(features.training(bars)) + plan(features.indicators(bars))
    assert "Python" not in text and "Pandas" not in text


def test_unused_columns_and_joins_go_away(bars):
    text = plan(features.supervised(bars, features.FEATURE_SETS["rf"]))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert read and all("open" not in r and "high" not in r for r in read)
    assert "_edge" not in text


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("chain", [features.training, features.serving])
def test_a_chain_runs_once(chain, spark, bars, no_broadcast, monkeypatch):
    written, real = [], S.cut
    monkeypatch.setattr(S, "cut", lambda df, name: (written.append(plan(df)), real(df, name))[1])
    after = plan(chain(bars))
    (before,) = written
    # Rows move to be ranked and to their blocks; the other exchanges hold chunk sizes.
    assert before.count("REPARTITION_BY_COL") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(symbol#\d+, _chunk#\d+", before)) == 3
    assert len(re.findall(r"FileScan", before)) == 2 and "ReadSchema: struct<symbol:string,date:date>" in before
    assert len(re.findall(r"lag\(close#\d+, 1", before)) <= 3
    assert "lag(" not in after and "FileScan" in after and "REPARTITION_BY_COL" not in after


def test_tails_rank_single_chunks(spark, bars, no_broadcast):
    for df in (split.tail(bars), split.tail(bars, 30, 5000), features.last_window(bars, ["close"], 2000)):
        text = plan(df)
        ranks = re.findall(r"Window \[row_number\(\) windowspecdefinition\((\w+)#\d+L?, (\w+)#", text)
        assert ranks and set(ranks) == {("symbol", "_chunk")}
    assert "partial_max" in plan(features.latest(bars))


def test_tails_treat_rows_alike_at_all_sizes(spark, bars):
    rows = bars.unionByName(bars.limit(3).withColumn("symbol", F.lit(None).cast("string")))
    whole = {tuple(r) for r in rows.where("symbol IS NOT NULL").collect()}
    everything = {tuple(r[:-1]) for r in split.tail(rows, 30, 10**6).select(*rows.columns, "part").collect()}
    assert everything == whole
    for test, train in ((0, 1), (30, 420), (30, 1500)):
        out = split.tail(rows, test, train)
        assert out.where("symbol IS NULL").isEmpty()
        for symbol, kept in out.groupBy("symbol").agg(F.count("*")).collect():
            assert kept == min(test + train, sum(r[0] == symbol for r in whole))


def test_only_the_border_chunk_of_a_split_is_ranked(bars, no_broadcast):
    text = plan(split.random(bars))
    assert len(re.findall(r"Window \[row_number\(\)", text)) == 1 and "Union" in text


def test_first_records_and_bars_use_hash_aggregates(spark, testdata):
    from barloom.registry import queries

    for name in ("src_bars", "merge_combined", "bars_240m"):
        text = plan(queries.QUERIES[name](spark, testdata))
        assert "HashAggregate" in text and "SortAggregate" not in text


def test_a_block_may_not_pass_the_reach(bars):
    with pytest.raises(ValueError, match="may hold"):
        S.measure(bars, I.ema("close", 9, "e"), block_rows=9000).collect()


def test_missing_values_fail_without_gaps(bars):
    holes = bars.withColumn("close", F.when(F.dayofmonth("date") != 9, F.col("close")))
    for chain in (features.training, features.serving, features.indicators):
        with pytest.raises(Exception, match="close is missing"):
            chain(holes).collect()


def test_clashing_spans_take_several_passes():
    groups = S._passes([I.ema("close", 3, "a"), I.ema("close", 200, "b"), I.sma("close", 5, "c")])
    assert len(groups) == 2
